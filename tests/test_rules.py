"""Golden cases of the rules on texts, and of lists that hold objects."""

import json
import random
import re

from pyspark.sql import functions as F

from mediaweave.functions import responses, rules


def test_objects_of_different_case_stay_apart(spark):
    items = [{"name": "Acme"}, {"name": "ACME"}, '{"name":"Acme"}', "Acme", " acme", {"name": "Acme"}, True, None]
    df = spark.createDataFrame([(0, json.dumps({"brand_mentioned": items}))], "i int, raw string")
    row = responses.with_analysis(responses.with_object(df, "raw", "v"), "v").first()
    assert row.brand_mentioned == ['{"name":"Acme"}', '{"name":"ACME"}', '{"name":"Acme"}', "Acme", "True", "None"]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_clock(spark):
    given = ["00:01:02,345", "1:02", "01:02:03", "12:05.1", "soon", "", None, "1:2:3"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(rules.clock(F.col("v"))).collect()]
    assert got == ["00:01:02", "00:01:02", "01:02:03", "00:12:05", None, None, None, None]


def test_srt_cues(spark):
    text = "1\n00:00:01,000 --> 00:00:02,500\nHello\nyou\n\n2\n00:00:03,000 --> 00:00:04,000\nBye 12\n"
    assert [tuple(c) for c in one(spark, rules.srt_cues(F.lit(text)))] == [
        (1, "00:00:01", "00:00:02", "Hello you"), (2, "00:00:03", "00:00:04", "Bye 12"),
    ]
    assert one(spark, rules.srt_cues(F.lit("no cues"))) == []


def test_phrases(spark):
    text = "Thanks to you; Check out Nike. PR  package inside, bad ads"
    assert one(spark, rules.phrases_in(F.lit(text))) == ["thanks to", "PR package", "check out Brand"]
    assert one(spark, rules.phrases_in(F.lit("an ad."))) == ["ad"]


def plain_phrases(text, phrases):
    """Each phrase by a search of its own."""
    word = lambda c: c.isascii() and c.isalnum()
    found = []
    for p in phrases:
        body = r"\s+".join(r"[^\s]+".join(re.escape(x) for x in w.split("Brand")) for w in p.split(" "))
        if re.search((r"(?<![^\W_])" if word(p[0]) else "") + body + (r"(?![^\W_])" if word(p[-1]) else ""), text, re.I):
            found.append(p)
    return found


def test_phrases_match_one_search_each(spark):
    """Overlapping phrases, phrases that begin alike, wild words, marks and other scripts."""
    lists = (rules.SPONSOR_PHRASES, rules.OFFERS + rules.THANKS, ("a Brand", "Brand b", "a", "a b", "ab", "a-b", "感謝", "感謝你"))
    words = sorted({w for phrases in lists for p in phrases for w in p.split(" ")} - {"Brand"}) + ["Acme", "x", "this video is sponsored by", "gifted", "20%", "adx", "感謝你們"]
    pick = random.Random(3)
    texts = ["", "use  my\tservice, use my code", "Affiliate\nLINK", "affiliate links", "this video is sponsored by an ad", "a b"]
    texts += ["".join(pick.choice(words) + pick.choice((" ", " ", "  ", "\n", ", ", ".", "")) for _ in range(pick.randint(1, 14))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(4)
    got = df.select("i", *[rules.phrases_in(F.col("text"), p).alias(f"p{n}") for n, p in enumerate(lists)], *[rules.has_phrase(F.col("text"), *p).alias(f"h{n}") for n, p in enumerate(lists)])
    for row in got.collect():
        for n, phrases in enumerate(lists):
            want = plain_phrases(texts[row.i], phrases)
            assert (row[f"p{n}"], row[f"h{n}"]) == (want, bool(want)), texts[row.i]
    assert one(spark, rules.phrases_in(F.lit(None).cast("string"))) == [] and one(spark, rules.has_phrase(F.lit("ad"))) is False


def test_handles(spark):
    text = "with elsie_lui and Thegrand_hk. 感謝 goodplace a@b.c x.y! 1.5"
    assert one(spark, rules.handle_candidates(F.lit(text))) == ["elsie_lui", "x.y", "goodplace"]
    kinds = [one(spark, rules.handle_class(F.lit(h), F.lit(t))) for h, t in (("a_shop", ""), ("b_mua", "link in bio"), ("c_d", "use code X"), ("c_d", "hi"))]
    assert kinds == ["brand", "mention", "brand", "mention"]


def test_audits(spark):
    tags = F.array(*[F.lit(x) for x in ("Good Tag", "bad Tag", "One Two Three Four Five", "Video", "Emoji!", "good tag")])
    got = {n: one(spark, c) for n, c in rules.tag_audit(tags).items()}
    assert got == {"n_tags": 6, "right_number": False, "bad_words": 1, "bad_case": 2, "bad_charset": 1, "fillers": 1, "repeats": 1}
    text = json.dumps([{"topic": "A", "subtopics": [{"subtopic": "x", "timestamp": "00:00:01", "detail": ""}, {"subtopic": "X ", "timestamp": "1", "detail": ""}]}, {"topic": "B"}])
    got = {n: one(spark, c) for n, c in rules.topics_audit(rules.typed_topics(F.lit(text)), F.lit("One. Two!")).items()}
    assert got == {"topics_in_range": True, "subtopics_in_range": True, "subtopics_unique": False, "bad_times": 1, "summary_in_range": True}
    assert one(spark, rules.typed_topics(F.lit("no json"))) == []


def test_topics_of_any_shape(spark):
    text = json.dumps([{"topic": "a", "subtopics": [{"subtopic": "x", "timestamp": "1:02", "detail": "d"}, "y", 7, None]}, "plain", 5, {"topic": "b"}, {"topic": "c", "subtopics": "one"}, None, {"subtopics": [["z"]]}])
    rows = spark.createDataFrame([("v", text), ("w", "no json"), ("x", '{"topic": "alone"}'), ("y", '""'), ("z", None)], "video_id string, key_topics string")
    got = {tuple(r) for r in rules.flat_topics(rows).collect()}
    assert got == {
        ("v", "a", "x", "00:01:02", "d"), ("v", "a", "y", None, None), ("v", "a", "7", None, None), ("v", "plain", None, None, None), ("v", "5", None, None, None),
        ("v", "b", None, None, None), ("v", "c", "one", None, None), ("v", None, '["z"]', None, None), ("x", "alone", None, None, None),
    }


def test_sentences(spark):
    given = {
        "It costs 3.5 dollars, e.g. at Foo Inc. today.": 1, "One. Two!": 2, "Mr. Smith came. \"He left?\" Yes.": 3, "": 0, "...": 0,
        "一。二！三": 3, "No end": 1, "A. B. C.": 3, "Version 2.0 is out. 5 stars.": 2,
    }
    for text, n in given.items():
        assert len(one(spark, rules.sentences(F.lit(text)))) == n, text


def test_number_of_tags(spark):
    tags = lambda n: F.array(*[F.lit(f"Tag {i}") for i in range(n)])
    right = lambda n, *bounds: one(spark, rules.tag_audit(tags(n), *bounds)["right_number"])
    assert [right(n) for n in (9, 10, 11)] == [False, True, False]
    assert [right(n, 20, None) for n in (19, 20, 25)] == [False, True, True]
