"""Golden cases of the response parsers."""

import json
import time

from pyspark.sql import functions as F

from mediaweave.config import JobConfig
from mediaweave.functions import responses
from mediaweave.plans.transcripts import to_payload


def frame(spark, values, name="raw"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def parsed(df, out="v"):
    return [r[0] for r in df.orderBy("i").select(F.to_json(out)).collect()]


def test_summary_answers(spark):
    given = [
        '```JSON\n{"a": 1}\n```', 'Sure: {"a": 1} done', '{"a": 1} and {"b": 2}', "no json", '{"a": 1, "a": 2}',
        "", None, "[1]", '{"a": "}"}',
    ]
    got = parsed(responses.with_object(frame(spark, given), "raw", "v"))
    assert got == ['{"a":1}', '{"a":1}', None, None, '{"a":2}', None, None, "[1]", '{"a":"}"}']


def test_tolerant_answers(spark):
    given = [
        '[1, 2] {"x": 1}', 'x {"a": [1]} y', '{"a": 1} {"b": 2}', '"{}"', '12 {"a": 1}', "null", '{"a": NaN}',
        "nothing", '{"a": {"b": 1}} ] tail', '{"a": 1',
    ]
    got = parsed(responses.with_tolerant_json(frame(spark, given), F.col("raw"), "v"))
    assert got == [
        "[1,2]", '{"a":[1]}', '{"a":1}', '"{}"', '{"a":1}', "null", '{"a":"nan"}', None, '{"a":{"b":1}}', None,
    ]


def analysis(spark, *objects):
    df = responses.with_object(frame(spark, [json.dumps(o) if not isinstance(o, str) else o for o in objects]), "raw", "v")
    return responses.with_analysis(df, "v").orderBy("i").collect()


def test_lists_in_analysis(spark):
    row = analysis(spark, {"brand_mentioned": [" A", "a", "", None, "None", {"b": 2, "a": 1}, {"a": 1, "b": 2}, 1, 1.0],
                           "product_mentioned": "one", "topic_tags": None, "key_topics": {"topic": "t"}, "other": 1})[0]
    assert row.brand_mentioned == [" A", "None", '{"a":1,"b":2}', "1", "1.0"]
    assert row.product_mentioned == ["one"]
    assert row.topic_tags == []
    assert row.key_topics == '[{"topic":"t"}]'
    assert "other" not in row.asDict()


def test_titles_in_analysis(spark):
    rows = analysis(spark, {"video_title": " T ", "summary": 5}, {"video_title": None, "summary": 0}, [1])
    assert [(r.video_title, r.summary) for r in rows] == [("T", "5"), ("", ""), ("", "")]
    assert rows[2].brand_mentioned == [] and rows[2].key_topics == "[]" and rows[2].is_sponsorship == 0


def test_two_sponsorship_flags_differ(spark):
    forms = ["true", "1", "1.0", '"yes"', '"Y"', '"t"', "1.9", "2", "null", "false", '" TRUE "', "0"]
    df = frame(spark, forms).select("i", F.try_parse_json("raw").alias("v"))
    strict = [r[0] for r in df.orderBy("i").select(responses.strict_flag(F.col("v"))).collect()]
    lenient = [r[0] for r in df.orderBy("i").select(responses.lenient_flag(F.col("v"))).collect()]
    assert strict == [1, 1, 0, 1, 0, 0, 0, 0, 0, 0, 1, 0]
    assert lenient == [1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 1, 0]


def test_names_cleared_without_sponsorship(spark):
    rows = analysis(spark, {"sponsorship_name": ["X"], "is_sponsorship": 0}, {"sponsorship_name": ["X"], "is_sponsorship": True})
    assert [r.sponsorship_name for r in rows] == [[], ["X"]]


def outcome(spark, rows):
    df = spark.createDataFrame(rows, "content string, raw string, error string")
    return responses.tag_outcome(df).collect()


def test_tag_outcomes(spark):
    ten = json.dumps({"tags": [f"tag{i}Name" for i in range(12)], "is_sponsorship": "y", "brand_name": ["iPhone", "ad"],
                      "associated_brand": ["@Bad", "good.one", None, True], "associated_mention": []})
    rows = outcome(spark, [
        ("Text", ten, None), ("Hi", ten, None), ("Text", None, "429 quota"), ("Text", None, "boom"), ("Text", " ", None),
        ("Text", '{"tags": ["a"]}', None), ("Text", '["a"]', None), ("Text", None, None),
    ])
    assert [r.reason for r in rows] == [
        "ok", "empty_input", "exception", "exception", "empty_output", "not_10_tags", "not_10_tags", "empty_output",
    ]
    assert [r.quota_fail for r in rows] == [False, False, True, False, True, False, False, True]
    assert [r.skip_retry for r in rows] == [False, True] + [False] * 6
    first = rows[0]
    assert first.topic_tags == "[" + ", ".join(f"'tag{i}Name'" for i in range(10)) + "]"
    assert first.is_sponsorship == 1
    assert first.brand_name == '["i Phone"]'
    assert first.associated_brand == '["good.one"]' and first.associated_mention is None


def test_camel_case_that_breaks_json_is_undone(spark):
    raw = '{"tags": ["caf\\u00eA x"]}'
    df = responses.with_tag_data(frame(spark, [raw]), "raw", "v")
    assert parsed(df) == ['{"tags":["cafê x"]}']


def test_mixed_tag_items(spark):
    raw = json.dumps({"tags": ["a", None, True, 1.0, 2, {"k": "v"}, ["x"]]})
    row = outcome(spark, [("Text", raw, None)])[0]
    assert row.tags == ["a", "None", "True", "1 0", "2", "k v", "x"]


def test_response_texts(spark):
    bodies = [
        '{"text": " hi "}', '{"text": " ", "candidates": [{"content": {"parts": [{"text": " a "}, {"text": 1}, {"x": 1}, {"text": "b"}]}}]}',
        '{"candidates": []}', "{}", '{"text": 5}', None,
    ]
    df = frame(spark, bodies).select("i", F.try_parse_json("raw").alias("v"))
    got = [r[0] for r in df.orderBy("i").select(responses.response_text(F.col("v"))).collect()]
    assert got == ["hi", "a\nb", "", "", "", ""]


def test_captions_responses(spark):
    good = {"data": {"content": " c ", "language_code": "en", "language_name": None, "format": "", "video_id": "other"}}
    rows = [
        ("v0", 200, json.dumps(good)), ("v1", 404, "{}"), ("v2", 200, json.dumps({**good, "message": "note"})),
        ("v3", 200, '{"data": [1]}'), ("v4", 400, json.dumps({"message": "bad id"})), ("v5", 200, "not json"),
    ]
    df = spark.createDataFrame(rows, "video_id string, status int, body string")
    got = to_payload(df.withColumn("error", F.lit(None)), JobConfig()).orderBy("video_id").collect()
    assert [r.content for r in got] == ["c", "", "c", "", "", ""]
    assert [r.error for r in got] == ["", "HTTP 404 error", "note", "", "bad id", ""]
    assert [r.srt_id for r in got] == [1, 3, 1, 3, 3, 3]
    assert {r.format for r in got} == {"srt"}
    assert [r.video_id for r in got] == [f"v{i}" for i in range(6)]


def test_distinct_texts_of_a_long_list_take_linear_work(spark):
    """different words were compared pair by pair, as structs have no hash in ``array_distinct``."""
    words = [f"{'Word' if i % 2 else 'word'}{i // 2}" for i in range(60_000)]
    mixed = ["A", " a ", None, "none", "", " ", 1, "1", {"x": 1}, '{"x":1}', {"x": 1}, ["A"], "jA", "tA", "json:x"]
    given = frame(spark, [json.dumps(words), json.dumps(mixed), '"one"', "null", '["b", null, "None", "B"]', None])
    began = time.perf_counter()
    rows = given.select("i", responses.distinct_texts(F.try_parse_json("raw")).alias("x")).orderBy("i").collect()
    took = time.perf_counter() - began
    assert rows[0].x == words[::2]
    assert [r.x for r in rows[1:]] == [
        ["A", "None", "1", '{"x":1}', '{"x":1}', '["A"]', "jA", "tA", "json:x"], ["one"], [], ["b", "None"], [],
    ]
    assert took < 20
