"""Registered queries of the rules on texts, each with SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from .inputs import Given
from .queries import query


def _phrase_sql(text: str, phrase: str) -> str:
    body = "".join(f"\\{c}" if not c.isalnum() and ord(c) < 128 and c != " " else c for c in phrase)
    body = body.replace("Brand", r"[^\s]+").replace(" ", r"\s+").replace("'", "''")
    start = r"(^|[^\p{L}\p{N}])" if phrase[0].isalnum() and ord(phrase[0]) < 128 else ""
    end = r"([^\p{L}\p{N}]|$)" if phrase[-1].isalnum() and ord(phrase[-1]) < 128 else ""
    return f"regexp_matches({text}, '(?i){start}{body}{end}')"


def _any_sql(text: str, *groups: tuple[str, ...]) -> str:
    return " OR ".join(_phrase_sql(text, p) for p in dict.fromkeys(p for g in groups for p in g))


def _list_sql(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _quoted(phrase: str) -> str:
    return "'" + phrase.replace("'", "''") + "'"


@query("""SELECT doc_id::VARCHAR AS video_id, lang AS topic, unnest(string_split(text, chr(10))) AS subtopic,
  CASE doc_id % 4 WHEN 0 THEN '00:01:02' WHEN 1 THEN '01:02:03' WHEN 2 THEN '00:12:05' END AS timestamp, source AS detail
FROM documents""")
def topics_flat(t: Given) -> DataFrame:
    """A row per subtopic of key topics stored as JSON text."""
    kind = F.col("doc_id") % 4
    at = F.when(kind == 0, "1:02").when(kind == 1, "1:02:03").when(kind == 2, "12:05,500").otherwise("soon")
    parts = F.transform(
        F.split("text", "\n"), lambda x: F.struct(x.alias("subtopic"), at.alias("timestamp"), F.col("source").alias("detail"))
    )
    topics = F.to_json(F.array(F.struct(F.col("lang").alias("topic"), parts.alias("subtopics"))))
    return rules.flat_topics(t.documents.select(F.col("doc_id").cast("string").alias("video_id"), topics.alias("key_topics")))


@query("""WITH lines AS (
  SELECT doc_id, source, lang, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
SELECT doc_id::VARCHAR AS video_id, lang AS topic, line AS subtopic, CASE WHEN i % 2 = 1 THEN '00:01:02' END AS timestamp,
       CASE WHEN i % 2 = 1 THEN source END AS detail FROM lines
UNION ALL SELECT doc_id::VARCHAR, source, NULL, NULL, NULL FROM documents
UNION ALL SELECT doc_id::VARCHAR, doc_id::VARCHAR, NULL, NULL, NULL FROM documents
UNION ALL SELECT doc_id::VARCHAR, 'none', NULL, NULL, NULL FROM documents
UNION ALL SELECT doc_id::VARCHAR, 'one', source, NULL, NULL FROM documents
UNION ALL SELECT doc_id::VARCHAR, NULL, 'lost', NULL, NULL FROM documents""")
def topics_mixed(t: Given) -> DataFrame:
    """Key topics of different shapes: objects, plain items, a number, a missing list, a list of another type."""
    quoted = lambda c: F.substring(F.to_json(F.array(c)), 2, 1 << 30)  # noqa: E731  "text"]
    part = lambda x, i: F.when(
        i % 2 == 0, F.to_json(F.struct(x.alias("subtopic"), F.lit("1:02").alias("timestamp"), F.col("source").alias("detail")))
    ).otherwise(F.rtrim(quoted(x), F.lit("]")))
    lines = F.array_join(F.transform(F.split("text", "\n"), part), ",")
    source = F.rtrim(quoted(F.col("source")), F.lit("]"))
    whole = F.concat(
        F.lit('[{"topic":"'), F.col("lang"), F.lit('","subtopics":['), lines, F.lit("]},"), source, F.lit(","), F.col("doc_id").cast("string"),
        F.lit(',null,{"topic":"none"},{"topic":"one","subtopics":'), source, F.lit('},{"subtopics":[null,"lost"]}]'),
    )
    return rules.flat_topics(t.documents.select(F.col("doc_id").cast("string").alias("video_id"), whole.alias("key_topics")))


@query(r"""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
SELECT doc_id, i::INTEGER AS number, '00:' || lpad((i // 60 % 60)::VARCHAR, 2, '0') || ':' || lpad((i % 60)::VARCHAR, 2, '0') AS start,
  trim(regexp_replace(line, '\s+', ' ', 'g')) AS words FROM lines""")
def srt_cues(t: Given) -> DataFrame:
    """Subtitle texts made of the lines of every document, read back as cues."""
    two = lambda n: F.lpad(n.cast("string"), 2, "0")

    def cue(line, i):
        time = F.concat(two(F.floor((i + 1) / 60) % 60), F.lit(":"), two((i + 1) % 60))
        return F.concat((i + 1).cast("string"), F.lit("\n00:"), time, F.lit(",000 --> 00:"), time, F.lit(",900\n"), line, F.lit("\n"))

    text = F.array_join(F.transform(F.split("text", "\n"), cue), "\n")
    rows = t.documents.select("doc_id", F.explode(rules.srt_cues(text)).alias("c"))
    return rows.select("doc_id", "c.number", "c.start", "c.words")


AUDIT_SQL = r"""WITH t AS (SELECT doc_id, string_split(text, '. ') AS tags FROM documents)
SELECT doc_id, len(tags)::INTEGER AS n_tags, len(tags) = 10 AS right_number,
  len(list_filter(tags, lambda x: len(string_split_regex(trim(x), '\s+')) NOT BETWEEN 1 AND 4))::INTEGER AS bad_words,
  len(list_filter(tags, lambda x: NOT regexp_matches(x, '^(?:[A-Z0-9]\S*)(?: [A-Z0-9]\S*)*$')))::INTEGER AS bad_case,
  len(list_filter(tags, lambda x: NOT regexp_matches(x, '^[A-Za-z0-9 ]+$')))::INTEGER AS bad_charset,
  len(list_filter(tags, lambda x: lower(x) IN @F))::INTEGER AS fillers,
  (len(tags) - len(list_distinct(list_transform(tags, lambda x: lower(x)))))::INTEGER AS repeats FROM t"""


@query(AUDIT_SQL.replace("@F", "(" + ", ".join(f"'{f.lower()}'" for f in rules.FILLER_TAGS) + ")"))
def tag_audit(t: Given) -> DataFrame:
    """The sentences of every document audited as tags."""
    rows = t.documents.select("doc_id", F.split("text", r"\. ").alias("tags"))
    return rows.select("doc_id", *[c.alias(n) for n, c in rules.tag_audit(F.col("tags")).items()])


@query(AUDIT_SQL.replace("len(tags) = 10", "len(tags) >= 20").replace("@F", "(" + ", ".join(f"'{f.lower()}'" for f in rules.FILLER_TAGS) + ")"))
def transcript_tag_audit(t: Given) -> DataFrame:
    """The same with the number that transcripts need: twenty and up."""
    rows = t.documents.select("doc_id", F.split("text", r"\. ").alias("tags"))
    return rows.select("doc_id", *[c.alias(n) for n, c in rules.tag_audit(F.col("tags"), 20, None).items()])


SENTENCES_SQL = rf"""string_split(regexp_replace(regexp_replace(regexp_replace(text, '\b({rules.SHORTENED})\.(\s)', '\1\2', 'g'),
  '{rules.SENTENCE_END.replace("'", "''")}', '\1' || chr(1) || '\2', 'g'), '([。！？])', '\1' || chr(1), 'g'), chr(1))"""


@query(rf"""WITH t AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS lines, {SENTENCES_SQL} AS sentences FROM documents),
n AS (SELECT *, list_transform(lines, lambda x: lower(trim(x, ' '))) AS names FROM t)
SELECT doc_id, 2 + doc_id % 10 <= 10 AS topics_in_range, len(lines) <= 10 AS subtopics_in_range,
  len(names) = len(list_distinct(names)) AS subtopics_unique, CASE WHEN doc_id % 3 = 0 THEN len(lines) ELSE 0 END::INTEGER AS bad_times,
  len(list_filter(sentences, lambda x: regexp_matches(x, '[\p{{L}}\p{{N}}]'))) BETWEEN 2 AND 5 AS summary_in_range FROM n""")
def topics_audit(t: Given) -> DataFrame:
    """The lines of every document audited as subtopics of one of several topics, its text as the summary."""
    at = F.when(F.col("doc_id") % 3 == 0, "1:02").otherwise("00:01:02")
    parts = F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("subtopic"), at.alias("timestamp"), F.lit("").alias("detail")))
    first = F.array(F.struct(F.col("lang").alias("topic"), parts.alias("subtopics")))
    none = F.array().cast(parts_type := "array<struct<subtopic:string,timestamp:string,detail:string>>")
    more = F.transform(F.sequence(F.lit(0), F.col("doc_id") % 10), lambda i: F.struct(i.cast("string").alias("topic"), none.alias("subtopics")))
    topics = F.concat(first.cast(f"array<struct<topic:string,subtopics:{parts_type}>>"), more)
    return t.documents.select("doc_id", *[c.alias(n) for n, c in rules.topics_audit(topics, F.col("text")).items()])


@query(f"""SELECT conv_id, turn, len(list_filter([{", ".join(f"{_phrase_sql('text', p)}" for p in rules.SPONSOR_PHRASES)}], lambda x: x))::INTEGER AS n_phrases,
  list_filter([{", ".join(f"CASE WHEN {_phrase_sql('text', p)} THEN {_quoted(p)} END" for p in rules.SPONSOR_PHRASES)}], lambda x: x IS NOT NULL)[1] AS first_phrase,
  CASE WHEN (turn % 2 = 0 AND ({_any_sql('text', rules.CALLS, rules.OFFERS, rules.PUSHES, rules.PLACES, rules.THANKS, rules.PARTNERS)}))
         OR (turn % 3 = 0 AND ({_any_sql('text', rules.SECONDARY)})) THEN 1 ELSE 0 END AS is_sponsorship
FROM (SELECT conv_id, turn, text || CASE turn % 5 WHEN 0 THEN ' Thanks to Acme.' WHEN 1 THEN ' 20% off, use my code' WHEN 2 THEN ' gifted by x' ELSE '' END AS text FROM conversations)""")
def sponsorship_rules(t: Given) -> DataFrame:
    """Sponsorship phrases of every turn, and the caption rule for turns with handles or names."""
    kind = F.col("turn") % 5
    more = F.when(kind == 0, " Thanks to Acme.").when(kind == 1, " 20% off, use my code").when(kind == 2, " gifted by x").otherwise("")
    rows = t.conversations.select("conv_id", "turn", F.concat("text", more).alias("text"))
    none = F.array().cast("array<string>")
    handles = F.when(F.col("turn") % 2 == 0, F.array(F.lit("h_k"))).otherwise(none)
    names = F.when(F.col("turn") % 3 == 0, F.array(F.lit("Acme"))).otherwise(none)
    found = rows.withColumn("_found", rules.phrases_in(F.col("text")))
    return found.select(
        "conv_id", "turn", F.size("_found").alias("n_phrases"), F.get("_found", F.lit(0)).alias("first_phrase"),
        rules.caption_sponsorship(F.col("text"), handles, names).alias("is_sponsorship"),
    )


@query(rf"""WITH c AS (SELECT conv_id, turn, text || ' 感謝 goodplace, mit some_mua und cafe.{{x}} the_shop1. a.b@c.de' AS text FROM conversations),
h AS (SELECT conv_id, turn, text, list_transform(list_concat(
    list_filter(list_transform(regexp_extract_all(text, '{rules.TOKEN.replace("'", "''")}'), lambda x: regexp_replace(x, '^\.+|\.+$', '', 'g')),
                lambda x: regexp_matches(x, '{rules.HANDLE}')),
    list_transform(regexp_extract_all(text, '{rules.THANKED}', 1), lambda x: regexp_replace(x, '^\.+|\.+$', '', 'g'))), lambda x: x) AS found FROM c),
e AS (SELECT DISTINCT conv_id, turn, text, unnest(found) AS handle FROM h)
SELECT conv_id, turn, handle, CASE WHEN list_has_any(string_split_regex(handle, '[_.0-9]+'), {_list_sql(rules.BRAND_PARTS)}) THEN 'brand'
  WHEN list_has_any(string_split_regex(handle, '[_.0-9]+'), {_list_sql(rules.CREATOR_PARTS)}) THEN 'mention'
  WHEN {_any_sql('text', rules.BRAND_CONTEXT)} THEN 'brand' ELSE 'mention' END AS kind
FROM e WHERE regexp_matches(handle, '[a-z]')""")
def handle_candidates(t: Given) -> DataFrame:
    """Handles without their sign in every turn, and whose they seem to be."""
    text = F.concat("text", F.lit(" 感謝 goodplace, mit some_mua und cafe.{x} the_shop1. a.b@c.de"))
    rows = t.conversations.select("conv_id", "turn", text.alias("text"))
    rows = rows.withColumn("handle", F.explode(rules.handle_candidates(F.col("text"))))
    return rows.select("conv_id", "turn", "handle", rules.handle_class(F.col("handle"), F.col("text")).alias("kind"))
