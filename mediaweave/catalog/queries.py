"""The registered queries: the operators over the given tables, each with SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig, scratch_path
from ..functions import errors, responses, text
from ..operators import candidates, ledger, metrics, vectors
from ..operators.candidates import PAIR
from ..operators.merge import keyed_union, last_wins, merge
from ..plans import posts as posts_job
from ..plans import transcripts as transcripts_job
from ..schemas import COUNTERS, FAILED_VIDEO, VIDEO
from ..sources import payloads
from ..sources.clients import best_answers
from ..sources.tables import read_or_empty
from . import inputs
from .inputs import (
    CAPTIONS_SQL,
    END,
    EXCLUDED,
    LANGUAGE_SQL,
    LOCATION,
    POSTS_SQL,
    SPACE_SQL,
    START,
    Given,
    handles_sql,
    phrases_sql,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
GENERIC = text.GENERIC_WORDS
PROMOTION = text.PROMOTION_WORDS


def query(sql: str | None = None):
    def register(build: Callable[[Given], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Given(spark, folder))

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


# -- channels and posts -------------------------------------------------------

POST_COLUMNS = "channel_id, video_id, publishedAt, " + ", ".join(COUNTERS)


def _channels(t: Given) -> DataFrame:
    return candidates.eligible_channels(inputs.locations(t), inputs.bios(t), LOCATION, EXCLUDED)


def _found(t: Given) -> DataFrame:
    return candidates.posts_in_range(inputs.posts(t), _channels(t), START, END, EXCLUDED)


@query(f"WITH {POSTS_SQL} SELECT channel_id FROM channels ORDER BY channel_id")
def eligible_channels(t: Given) -> DataFrame:
    return _channels(t).orderBy("channel_id")


@query(f"WITH {POSTS_SQL} SELECT {POST_COLUMNS} FROM found")
def posts_in_range(t: Given) -> DataFrame:
    return _found(t)


CAPPED_SQL = f"""WITH {POSTS_SQL}
SELECT {POST_COLUMNS} FROM (
  SELECT *, row_number() OVER (ORDER BY channel_id, publishedAt DESC, video_id) AS rn FROM found)
WHERE rn <= @N"""


@query(CAPPED_SQL.replace("@N", "500"))
def posts_capped(t: Given) -> DataFrame:
    return candidates.capped_posts(_found(t), 500)


@query(CAPPED_SQL.replace("@N", "900"))
def posts_capped_ranged(t: Given) -> DataFrame:
    """The same cap by range partitions, as taken for caps too large for one task."""
    return candidates.capped_posts(_found(t), 900, small=0)


FLAT = ["stats.publishedAt", "stats.publishedAt_ts", *[f"stats.{c}" for c in COUNTERS]]
ISO_SQL = "strftime(epoch_ms(publishedAt), '%Y-%m-%dT%H:%M:%S.%g+00:00')"


@query(f"""WITH {POSTS_SQL}
SELECT channel_id, video_id, {LOCATION} AS location_id, {ISO_SQL} AS publishedAt,
       publishedAt AS publishedAt_ts, {", ".join(COUNTERS)} FROM found""")
def post_documents(t: Given) -> DataFrame:
    documents = candidates.post_documents(_found(t), LOCATION)
    return documents.select("channel_id", "video_id", "location_id", *FLAT)


def _old_videos(t: Given) -> DataFrame:
    """Every fourth order is already a document, from another location and without counters."""
    old = inputs.posts(t).filter(F.substring("video_id", 2, 20).cast("bigint") % 4 == 0)
    return old.select(
        F.lpad(F.substring("video_id", 2, 20), 24, "0").alias("_id"),
        "channel_id",
        "video_id",
        F.lit(0).alias("location_id"),
        F.lit(None).cast(VIDEO["stats"].dataType).alias("stats"),
        F.lit(1).alias("srt_id"),
        F.lit(None).cast("timestamp").alias("srt_updated_at"),
        "publishedAt",
    )


@query(f"""WITH {POSTS_SQL},
old AS (
  SELECT video_id, arg_max(channel_id, publishedAt) AS channel_id FROM posts
  WHERE substr(video_id, 2)::BIGINT % 4 = 0 GROUP BY video_id),
new AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY publishedAt DESC) AS rn FROM found)
  WHERE rn = 1)
SELECT coalesce(new.video_id, old.video_id) AS video_id,
       coalesce(new.channel_id, old.channel_id) AS channel_id,
       CASE WHEN new.video_id IS NULL THEN 0 ELSE {LOCATION} END AS location_id,
       CASE WHEN old.video_id IS NOT NULL THEN 1 END AS srt_id,
       {ISO_SQL} AS publishedAt, new.publishedAt AS publishedAt_ts,
       {", ".join(f"new.{c}" for c in COUNTERS)}
FROM old FULL OUTER JOIN new ON old.video_id = new.video_id""")
def documents_merged(t: Given) -> DataFrame:
    """Stage A as one plan: channels, posts, documents, last one per video, upsert."""
    config = JobConfig(
        location_id=LOCATION, start_date=START, end_date=END, excluded_channels=EXCLUDED
    )
    channels = posts_job.channels_to_process(inputs.locations(t), inputs.bios(t), config)
    documents = posts_job.documents_to_save(channels, inputs.posts(t), config)
    old = last_wins(_old_videos(t), ["video_id"], ["publishedAt"]).drop("publishedAt")
    merged = posts_job.merge_documents(old, documents)
    return merged.select("video_id", "channel_id", "location_id", "srt_id", *FLAT)


@query(f"WITH {POSTS_SQL} SELECT channel_id, count(*) AS posts FROM found GROUP BY channel_id")
def post_counts(t: Given) -> DataFrame:
    return metrics.post_counts(_found(t))


@query(f"""WITH {POSTS_SQL}, per AS (SELECT channel_id, count(*) AS n FROM found GROUP BY channel_id)
SELECT count(*) AS total_channels, count(n) AS processed_channels,
       sum(n)::BIGINT AS saved_posts, round(count(n) / count(*) * 100, 2) AS progress_pct
FROM channels LEFT JOIN per USING (channel_id)""")
def channel_progress(t: Given) -> DataFrame:
    return metrics.channel_progress(_channels(t), _found(t))


# -- merges -------------------------------------------------------------------

EVENT_KEY = ["user_id", "event_type"]
CUT = "2024-01-16 00:00:00"


def _events(t: Given) -> DataFrame:
    return t.events.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp"))).drop("ts")


def _halves(t: Given) -> tuple[DataFrame, DataFrame]:
    cut = F.unix_micros(F.to_timestamp(F.lit(CUT)))
    columns = [*EVENT_KEY, "event_id", "value", "ts_us"]
    events = _events(t).select(*columns)
    seq = ["ts_us", "event_id"]
    old = last_wins(events.filter(F.col("ts_us") < cut), EVENT_KEY, seq)
    new = last_wins(events.filter(F.col("ts_us") >= cut), EVENT_KEY, seq)
    return old, new


HALVES_SQL = f"""
e AS (SELECT *, epoch_us(ts) AS ts_us FROM events),
old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts_us DESC, event_id DESC) AS rn
        FROM e WHERE ts < TIMESTAMP '{CUT}') WHERE rn = 1),
new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts_us DESC, event_id DESC) AS rn
        FROM e WHERE ts >= TIMESTAMP '{CUT}') WHERE rn = 1)
"""
LAST_SQL = """SELECT user_id, event_type, event_id, value, ts_us FROM (
  SELECT *, epoch_us(ts) AS ts_us,
         row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""


@query(LAST_SQL)
def upsert_last_wins(t: Given) -> DataFrame:
    old, new = _halves(t)
    return merge(old, new, EVENT_KEY)


@query(LAST_SQL)
def keyed_union_last(t: Given) -> DataFrame:
    old, new = _halves(t)
    return keyed_union(old, new, EVENT_KEY, ["ts_us"])


@query(f"""WITH {HALVES_SQL}
SELECT coalesce(new.user_id, old.user_id) AS user_id, coalesce(new.event_type, old.event_type) AS event_type,
       CASE WHEN new.user_id IS NULL THEN old.value ELSE new.value END AS value,
       CASE WHEN new.user_id IS NULL THEN old.event_id WHEN old.user_id IS NULL THEN NULL ELSE old.event_id END AS event_id,
       CASE WHEN old.user_id IS NULL THEN NULL WHEN new.user_id IS NULL THEN old.ts_us ELSE 1704067200 END AS ts_us
FROM old FULL OUTER JOIN new ON old.user_id = new.user_id AND old.event_type = new.event_type""")
def upsert_two_keys(t: Given) -> DataFrame:
    """One column set, one column touched on update only, one left alone."""
    old, new = _halves(t)
    touch = {"ts_us": F.lit(1704067200).cast("bigint")}
    return merge(old, new.select(*EVENT_KEY, "value"), EVENT_KEY, ["value"], touch=touch)


@query("""SELECT d.doc_id, d.source, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def update_only(t: Given) -> DataFrame:
    target = t.documents.select(
        "doc_id", "source", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic")
    )
    return merge(target, t.labels, ["doc_id"], insert=False)


# -- transcripts --------------------------------------------------------------


@query("""SELECT d.doc_id::VARCHAR AS video_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)""")
def todo_transcripts(t: Given) -> DataFrame:
    todo = candidates.videos_to_fetch(inputs.videos(t), inputs.transcript_index(t))
    return todo.select("video_id")


@query("""SELECT d.doc_id::VARCHAR AS video_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1 AND l.toxic = 0)""")
def todo_transcripts_redo(t: Given) -> DataFrame:
    """Stored failures count as open too."""
    index = inputs.transcript_index(t)
    return candidates.videos_to_fetch(inputs.videos(t), index, redo_failed=True).select("video_id")


@query("""SELECT d.doc_id::VARCHAR AS video_id,
  CASE WHEN l.quality = 1 THEN 'SKIPPED' WHEN d.doc_id % 5 = 1 THEN 'ERROR'
       WHEN d.doc_id % 7 = 3 THEN 'STOPPED' ELSE 'CHECKPOINTED' END AS status
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def video_outcomes(t: Given) -> DataFrame:
    marked = candidates.videos_marked_done(inputs.videos(t), inputs.transcript_index(t))
    staged = t.documents.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.when(F.col("doc_id") % 7 == 3, 503).otherwise(200).alias("http"),
        F.when(F.col("doc_id") % 5 == 1, "connection reset").alias("error"),
    )
    joined = marked.join(staged, "video_id", "left")
    status = transcripts_job.video_status(F.col("done"), F.col("error"), F.col("http"))
    return joined.select("video_id", status.alias("status"))


CONTENT_SQL = f"""CASE WHEN doc_id % 7 IN (5, 6) THEN '' ELSE trim(text, {SPACE_SQL}) END"""


@query(f"""WITH c AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 3 THEN 404 ELSE 200 END AS status, {CONTENT_SQL} AS content,
         CASE WHEN doc_id % 7 = 6 THEN '' ELSE {LANGUAGE_SQL} END AS language_code,
         CASE WHEN doc_id % 7 = 6 THEN '' ELSE upper(lang) END AS language_name FROM documents),
k AS (SELECT *, CASE WHEN status <> 200 OR content = '' THEN 3 WHEN language_code = 'en' THEN 1
                     WHEN language_code = 'a.en' THEN 2 ELSE 0 END AS srt_id FROM c)
SELECT doc_id::VARCHAR AS video_id, language_code, language_name, 'srt' AS format, md5(content) AS content_md5,
       CASE doc_id % 7 WHEN 4 THEN 'partial captions' WHEN 3 THEN 'HTTP 404 error' ELSE '' END AS error,
       srt_id, CASE WHEN srt_id = 0 THEN 3 ELSE srt_id END AS srt_id_stored
FROM k""")
def caption_class(t: Given) -> DataFrame:
    payload = transcripts_job.to_payload(inputs.captions_responses(t), JobConfig())
    return payload.select(
        "video_id", "language_code", "language_name", "format",
        F.md5("content").alias("content_md5"), "error", "srt_id",
        text.stored_caption_class(F.col("srt_id")).alias("srt_id_stored"),
    )


@query(f"""WITH u AS (
  SELECT page_id, CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 's3' || substr(url, strpos(url, '://'))
                  WHEN 2 THEN '/' || regexp_replace(url, '^[a-z]+://', '') ELSE ' ' END AS u FROM pages),
p AS (SELECT page_id, u, regexp_extract(u, '^[a-z0-9]+://([^/?#]*)', 1) AS host,
             regexp_extract(u, '^[a-z0-9]+://[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, page_id % 4 AS kind,
  CASE page_id % 4 WHEN 0 THEN split_part(host, '.', 1) WHEN 1 THEN host ELSE 'transcripts' END AS bucket,
  CASE page_id % 4 WHEN 0 THEN ltrim(regexp_replace(path, ';[^/]*$', ''), '/') WHEN 1 THEN ltrim(path, '/')
       WHEN 2 THEN ltrim(u, '/') ELSE 'transcript/' || page_id::VARCHAR || '.json' END AS key,
  'https://transcripts.s3.ap-southeast-1.amazonaws.com/transcript/' || page_id::VARCHAR || '.json' AS own_url
FROM p""")
def s3_location(t: Given) -> DataFrame:
    config = JobConfig()
    kind = F.col("page_id") % 4
    video = F.col("page_id").cast("string")
    url = (
        F.when(kind == 0, F.col("url"))
        .when(kind == 1, F.regexp_replace("url", "^[a-z]+", "s3"))
        .when(kind == 2, F.concat(F.lit("/"), F.regexp_replace("url", "^[a-z]+://", "")))
        .otherwise(" ")
    )
    place = text.object_location(url, video, config.bucket, config.key_prefix)
    own = text.object_url(text.object_key(video, config.key_prefix), config.bucket, config.region)
    return t.pages.select(
        "page_id", kind.alias("kind"), place["bucket"].alias("bucket"), place["key"].alias("key"),
        own.alias("own_url"),
    )


@query("""SELECT doc_id::VARCHAR AS video_id,
  CASE WHEN doc_id % 5 = 1 THEN 'OBJECT_NOT_FOUND' WHEN doc_id % 5 = 2 THEN 'OBJECT_NOT_FOUND'
       WHEN doc_id % 5 = 3 THEN 'INVALID_OBJECT' WHEN doc_id % 5 = 4 OR trim(text, """ + SPACE_SQL + """) = '' THEN 'NO_TRANSCRIPT'
       ELSE 'NO_RESPONSE' END AS error,
  CASE WHEN doc_id % 5 = 0 THEN md5(trim(text, """ + SPACE_SQL + """)) WHEN doc_id % 5 = 4 THEN md5('') END AS content_md5
FROM documents""")
def object_outcomes(t: Given) -> DataFrame:
    """Objects that are there, missing, in another bucket, no JSON object, or blank."""
    kind = F.col("doc_id") % 5
    key = F.concat(F.lit("transcript/"), F.col("doc_id").cast("string"), F.lit(".json"))
    body = F.when(kind == 3, F.to_json(F.array(F.col("text")))).otherwise(
        F.to_json(F.struct(F.when(kind == 4, " ").otherwise(F.col("text")).alias("content")))
    )
    stored = t.documents.filter(kind != 1).select(
        F.when(kind == 2, "elsewhere").otherwise("transcripts").alias("bucket"),
        key.alias("s3_key"), F.lit("2025").alias("written_at"), body.alias("body"),
    )
    index = t.documents.select(
        F.col("doc_id").cast("string").alias("video_id"), F.concat(F.lit("s3://transcripts/"), key).alias("s3_url")
    )
    wanted = payloads.wanted_objects(stored, index, JobConfig())
    found = payloads.attach_transcripts(index, payloads.newest_objects(wanted), JobConfig())
    nothing = F.lit(None).cast("string")
    error = responses.summary_outcome(F.col("content"), nothing, nothing, nothing, F.col("object_error"))
    return found.select("video_id", error.alias("error"), F.md5("content").alias("content_md5"))


@query("""SELECT doc_id::VARCHAR AS video_id, doc_id % 4 IN (1, 2) AS asked_again,
  CASE WHEN doc_id % 4 = 1 THEN 503 ELSE 200 END::INTEGER AS status, CASE WHEN doc_id % 4 <> 1 THEN md5(text) END AS body_md5
FROM documents""")
def server_error_retry(t: Given) -> DataFrame:
    """Staged answers of two runs: a 503 or a failed call is asked again, a usable answer outranks both.

    Every fourth video gets a 503 twice, every fourth one first a failed call, then an answer.
    """
    from ..plans.transcripts import usable_answer

    kind = F.col("doc_id") % 4
    video = F.col("doc_id").cast("string").alias("video_id")
    text_or_none = lambda good: F.when(good, F.col("text")).alias("body")
    first = t.documents.select(
        video, F.when(kind == 1, 503).when(kind == 2, 0).otherwise(200).alias("status"),
        text_or_none(~kind.isin(1, 2)), F.when(kind == 2, "timeout").alias("error"),
    )
    again = first.filter(~F.coalesce(usable_answer(), F.lit(False))).select("video_id", F.lit(True).alias("_again"))
    second = t.documents.filter(kind.isin(1, 2)).select(
        video, F.when(kind == 1, 503).otherwise(200).alias("status"), text_or_none(kind == 2), F.lit(None).cast("string").alias("error"),
    )
    best = best_answers(first.unionByName(second), ["video_id"], usable_answer())
    return best.join(again, "video_id", "left").select(
        "video_id", F.coalesce("_again", F.lit(False)).alias("asked_again"), "status", F.md5("body").alias("body_md5")
    )


@query(f"""SELECT doc_id, {CONTENT_SQL.replace("''", "NULL")} IS NOT NULL AND doc_id % 7 <> 6 AS readable,
  md5(coalesce({CONTENT_SQL}, '')) AS content_md5
FROM documents WHERE doc_id % 7 NOT IN (5, 6)""")
def payload_roundtrip(t: Given) -> DataFrame:
    """Payloads written as objects to the shared folder and read back by derived key."""
    config = JobConfig()
    path = scratch_path(t.spark, "objects")
    captions = transcripts_job.to_payload(inputs.captions_responses(t), config)
    payloads.write_payloads(captions, path, config)
    index = transcripts_job.index_rows(captions, config)
    found = payloads.attach_transcripts(index, payloads.read_payloads(t.spark, path), config)
    return found.filter(F.col("content") != "").select(
        F.col("video_id").cast("bigint").alias("doc_id"),
        F.col("content").isNotNull().alias("readable"),
        F.md5("content").alias("content_md5"),
    )


@query("SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def tolerant_json(t: Given) -> DataFrame:
    """Answers with stray brackets behind the object, found by closing the brackets opened so far."""
    answer = F.to_json(F.struct("lang", "text"))
    raw = F.concat(F.lit("note "), answer, F.lit(" ] tail } ["))
    found = responses.with_tolerant_json(t.documents.select("doc_id", raw.alias("raw")), F.col("raw"), "v")
    field = lambda n: F.try_variant_get("v", f"$.{n}", "string")
    return found.select("doc_id", field("lang").alias("lang"), F.md5(field("text")).alias("text_md5"))


# -- summaries ----------------------------------------------------------------


@query(f"""SELECT doc_id::VARCHAR AS video_id FROM documents d WHERE {LANGUAGE_SQL} IN ('en', 'a.en')""")
def todo_summaries_again(t: Given) -> DataFrame:
    """Reprocessing asks for transcripts that have a summary, too."""
    return _todo_summaries(t, True)


@query(f"""SELECT doc_id::VARCHAR AS video_id FROM documents d
WHERE {LANGUAGE_SQL} IN ('en', 'a.en') AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def todo_summaries(t: Given) -> DataFrame:
    return _todo_summaries(t, False)


def _todo_summaries(t: Given, reprocess: bool) -> DataFrame:
    index = t.documents.select(
        F.col("doc_id").alias("id"),
        F.col("doc_id").cast("string").alias("video_id"),
        inputs.language_code().alias("language_code"),
        F.lit("https://b.s3.r.amazonaws.com/k").alias("s3_url"),
    )
    done = t.labels.select(F.col("doc_id").cast("string").alias("video_id"))
    return candidates.transcripts_to_summarise(index, done, reprocess).select("video_id")


def _summary_answers(t: Given) -> DataFrame:
    """Fenced summary answers over all sentences and words; the flag takes six forms."""
    flags = ("true", "1", "1.0", '"Yes "', '"y"', "null")
    flag = F.lit(flags[0])
    for at, form in enumerate(flags[1:], 1):
        flag = F.when(F.col("doc_id") % 6 == at, form).otherwise(flag)
    lists = F.to_json(
        F.struct(
            F.split("text", r"\.").alias("brand_mentioned"),
            F.split("text", " ").alias("topic_tags"),
            F.col("text").alias("sponsorship_name"),
            F.col("lang").alias("video_title"),
            F.col("text").alias("summary"),
            F.array(F.struct(F.col("source").alias("topic"))).alias("key_topics"),
            F.col("source").alias("unknown_key"),
        )
    )
    body = F.concat(F.lit('{"is_sponsorship": '), flag, F.lit(", "), F.substring(lists, F.lit(2), F.length(lists)))
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    raw = F.when(F.col("doc_id") % 10 == 9, "no json").otherwise(fenced)
    return t.documents.select("doc_id", "text", raw.alias("raw"))


def _distinct_sql(parts: str, name: str) -> str:
    return f"""
{name}_e AS (SELECT doc_id, unnest({parts}) AS x, generate_subscripts({parts}, 1) AS i FROM documents WHERE doc_id % 10 <> 9),
{name}_f AS (SELECT doc_id, min(i) AS i, arg_min(x, i) AS x FROM {name}_e
             WHERE trim(x, {SPACE_SQL}) <> '' GROUP BY doc_id, lower(trim(x, {SPACE_SQL}))),
{name} AS (SELECT doc_id, count(*) AS n, md5(string_agg(x, '|' ORDER BY i)) AS h FROM {name}_f GROUP BY doc_id)"""


@query(f"""WITH {_distinct_sql("string_split(text, '.')", "b")}, {_distinct_sql("string_split(text, ' ')", "g")}
SELECT d.doc_id, CASE WHEN d.doc_id % 10 = 9 THEN '' ELSE lang END AS video_title,
  CASE WHEN d.doc_id % 10 = 9 THEN md5('') ELSE md5(trim(text, {SPACE_SQL})) END AS summary_md5,
  coalesce(b.n, 0) AS n_brands, coalesce(b.h, md5('')) AS brands_md5,
  coalesce(g.n, 0) AS n_tags, coalesce(g.h, md5('')) AS tags_md5,
  CASE WHEN d.doc_id % 10 <> 9 AND d.doc_id % 6 IN (0, 1, 3) THEN 1 ELSE 0 END AS is_sponsorship,
  CASE WHEN d.doc_id % 10 <> 9 AND d.doc_id % 6 IN (0, 1, 3) THEN text ELSE '' END = text AS has_sponsor,
  CASE WHEN d.doc_id % 10 = 9 THEN '[]' ELSE '[{{"topic":"' || source || '"}}]' END AS key_topics
FROM documents d LEFT JOIN b ON b.doc_id = d.doc_id LEFT JOIN g ON g.doc_id = d.doc_id""")
def analysis_normalised(t: Given) -> DataFrame:
    parsed = responses.with_object(_summary_answers(t), "raw", "data")
    return responses.with_analysis(parsed, "data").select(
        "doc_id", "video_title", F.md5("summary").alias("summary_md5"),
        F.size("brand_mentioned").cast("bigint").alias("n_brands"),
        F.md5(F.array_join("brand_mentioned", "|")).alias("brands_md5"),
        F.size("topic_tags").cast("bigint").alias("n_tags"),
        F.md5(F.array_join("topic_tags", "|")).alias("tags_md5"),
        "is_sponsorship",
        (F.array_join("sponsorship_name", "|") == F.col("text")).alias("has_sponsor"),
        "key_topics",
    )


@query("""SELECT doc_id::VARCHAR AS video_id,
  CASE WHEN doc_id % 9 = 0 THEN 'NO_TRANSCRIPT' WHEN doc_id % 4 = 1 THEN '503 unavailable'
       WHEN doc_id % 10 = 9 THEN 'INVALID_JSON' ELSE '' END AS error,
  doc_id % 9 = 0 OR (doc_id % 4 <> 1 AND doc_id % 10 <> 9) AS saved
FROM documents""")
def summary_outcome(t: Given) -> DataFrame:
    """Blank transcripts are saved without a call, failed answers are not saved."""
    from ..plans import summaries as job

    content = F.when(F.col("doc_id") % 9 == 0, " \n").otherwise(F.col("text"))
    transcripts = t.documents.select(F.col("doc_id").cast("string").alias("video_id"), content.alias("content"))
    bad = F.col("doc_id") % 4 == 1
    answers = _summary_answers(t).select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.when(~bad, F.col("raw")).alias("raw"),
        F.when(bad, "503 unavailable").alias("error"),
    )
    results = job.summary_results(transcripts, answers)
    return results.select(
        "video_id", "error", job.is_saved().alias("saved")
    )


@query("""SELECT doc_id, md5('Tags for this post:' || chr(10) || text || chr(10) || 'Answer in JSON.') AS prompt_md5,
  sha256('Tags for this post:' || chr(10) || text || chr(10) || 'Answer in JSON.') AS request_hash
FROM documents""")
def prompt_text(t: Given) -> DataFrame:
    from ..sources.clients import request_hash

    prompt = text.fill_prompt("Tags for this post:\n{TRANSCRIPT}\nAnswer in JSON.", F.col("text"))
    return t.documents.select(
        "doc_id", F.md5(prompt).alias("prompt_md5"), request_hash(prompt).alias("request_hash")
    )


@query(f"""SELECT doc_id, CASE WHEN doc_id % 5 = 4 THEN md5('')
  ELSE md5(trim(CASE WHEN doc_id % 5 = 0 THEN text ELSE trim(text, {SPACE_SQL}) || chr(10) || lang END, {SPACE_SQL})) END AS text_md5
FROM documents""")
def response_text(t: Given) -> DataFrame:
    """Plain text, or the parts of the first candidate."""
    def part(c):
        return F.struct(c.alias("text"))

    parts = F.array(part(F.col("text")), part(F.lit("  ")), part(F.col("lang")))
    candidate = F.array(F.struct(F.struct(parts.alias("parts")).alias("content")))
    direct = F.when(F.col("doc_id") % 5 == 0, F.col("text")).when(F.col("doc_id") % 5 == 1, "  ")
    body = F.when(F.col("doc_id") % 5 == 4, '{"candidates": []}').otherwise(
        F.to_json(F.struct(direct.alias("text"), candidate.alias("candidates")))
    )
    shown = t.documents.select("doc_id", F.try_parse_json(body).alias("v"))
    return shown.select("doc_id", F.md5(responses.response_text(F.col("v"))).alias("text_md5"))


@query("""SELECT doc_id, '["' || array_to_string(list_transform(string_split(text, chr(10)),
    lambda x: replace(replace(replace(replace(x, '\\', '\\\\'), '"', '\\"'), chr(9), '\\t'), chr(13), '\\r')), '", "') || '"]' AS json_text
FROM documents""")
def array_text(t: Given) -> DataFrame:
    return t.documents.select(
        "doc_id", text.json_list_text(F.split("text", "\n")).alias("json_text")
    )


# -- captions and tags --------------------------------------------------------


@query(f"""WITH a AS (
  SELECT 'd' || doc_id::VARCHAR AS id, CASE doc_id % 8 WHEN 0 THEN ' Thank You ' WHEN 1 THEN 'NaN' WHEN 2 THEN '12 - 34!'
         WHEN 3 THEN '你好' ELSE text END AS t FROM documents
  UNION ALL SELECT 'c' || conv_id::VARCHAR || '-' || turn::VARCHAR, text FROM conversations)
SELECT id, (regexp_matches(t, '\\p{{L}}') AND lower(trim(t, {SPACE_SQL})) NOT IN {("nan", *GENERIC)})::INTEGER AS meaningful
FROM a""")
def meaningful_text(t: Given) -> DataFrame:
    kind = F.col("doc_id") % 8
    given = (
        F.when(kind == 0, " Thank You ").when(kind == 1, "NaN").when(kind == 2, "12 - 34!")
        .when(kind == 3, "你好").otherwise(F.col("text"))
    )
    documents = t.documents.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), given.alias("t")
    )
    turns = t.conversations.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("t"),
    )
    both = documents.unionByName(turns)
    return both.select("id", text.is_meaningful(F.col("t")).cast("int").alias("meaningful"))


@query("""WITH c AS (SELECT conv_id::VARCHAR AS user_id, role AS post_id, text, turn,
                    CASE WHEN turn % 5 <> 4 THEN turn END AS dated FROM conversations),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, post_id ORDER BY dated DESC NULLS LAST, turn DESC) AS rn FROM c)
SELECT user_id, post_id, md5(text) AS content_md5 FROM r WHERE rn = 1""")
def latest_content(t: Given) -> DataFrame:
    """Newest turn per conversation and role; undated turns come last."""
    at = F.when(F.col("turn") % 5 != 4, F.timestamp_seconds(F.col("turn")))
    posts = t.conversations.select(
        F.col("conv_id").alias("ig_user_id"), F.col("role").alias("ig_post_id"),
        F.col("text").alias("content"), at.alias("postDate"), "turn",
    )
    newest = candidates.latest_captions(posts, ["turn"])
    return newest.select("user_id", "post_id", F.md5("content").alias("content_md5"))


KEYED_SQL = """
keyed AS (SELECT doc_id, lpad(hex(doc_id), 24, '0') AS _id, lang AS user_id, doc_id::VARCHAR AS post_id, source FROM documents
          WHERE doc_id % 50 <> 0 AND source <> 'src0')"""


@query(f"""WITH {KEYED_SQL}, {CAPTIONS_SQL}
SELECT k._id, k.user_id, k.post_id, md5(coalesce(c.content, '')) AS content_md5
FROM keyed k LEFT JOIN captions c ON c.user_id = k.user_id AND c.post_id = k.post_id
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = k.doc_id)""")
def posts_pending(t: Given) -> DataFrame:
    """Posts of a location without tags or a dead key, with their newest caption."""
    labelled = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id").select(
        F.col("lang").alias("user_id"), F.col("doc_id").cast("string").alias("post_id"), "quality"
    )
    done, dead = labelled.filter("quality = 1"), labelled.filter("quality = 0")
    docs = candidates.posts_with_keys(inputs.post_docs(t), 1)
    todo = candidates.without_tags(docs, done, dead)
    work = candidates.attach_captions(todo, candidates.latest_captions(inputs.caption_posts(t), wanted=todo))
    return work.select("_id", *PAIR, F.md5("content").alias("content_md5"))


@query(f"""WITH {KEYED_SQL} SELECT _id, user_id, post_id FROM keyed k
WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = k.doc_id)""")
def posts_with_tags(t: Given) -> DataFrame:
    tags = t.labels.join(t.documents.select("doc_id", "lang"), "doc_id").select(
        F.col("lang").alias("user_id"), F.col("doc_id").cast("string").alias("post_id")
    )
    return candidates.with_tags(candidates.posts_with_keys(inputs.post_docs(t), 1), tags)


TAGS_SQL = phrases_sql("documents", "string_split(text, '.')", text.TAG_WORDS, GENERIC, text.TAG_LIMIT, "tags")
BRANDS_SQL = phrases_sql("documents", "string_split(text, chr(10))", text.BRAND_WORDS, PROMOTION, text.BRAND_LIMIT, "brands")


@query(f"""WITH {TAGS_SQL}
SELECT d.doc_id, coalesce(len(items), 0)::INTEGER AS n_tags, coalesce(array_to_string(items, '|'), '') AS tags,
       coalesce(len(items), 0) = 10 AS accepted
FROM documents d LEFT JOIN tags ON tags.doc_id = d.doc_id""")
def tags_from_text(t: Given) -> DataFrame:
    """Every sentence of a text as a candidate tag."""
    tags = text.normalize_tags(F.split(text.split_camel_case(F.col("text")), r"\."))
    shown = t.documents.select("doc_id", tags.alias("tags"))
    return shown.select(
        "doc_id", F.size("tags").alias("n_tags"), F.array_join("tags", "|").alias("tags"),
        (F.size("tags") == responses.TAGS_WANTED).alias("accepted"),
    )


@query(f"""WITH {BRANDS_SQL}, {handles_sql("string_split(text, ' ')", "handles")}
SELECT d.doc_id, coalesce(array_to_string(b.items, '|'), '') AS brands, coalesce(array_to_string(h.items, '|'), '') AS handles
FROM documents d LEFT JOIN brands b ON b.doc_id = d.doc_id LEFT JOIN handles h ON h.doc_id = d.doc_id""")
def brands_handles(t: Given) -> DataFrame:
    """Lines as brands and words as handles."""
    brands = text.normalize_brands(F.split(text.split_camel_case(F.col("text")), "\n"))
    handles = text.normalize_handles(F.split("text", " "))
    return t.documents.select(
        "doc_id", F.array_join(brands, "|").alias("brands"), F.array_join(handles, "|").alias("handles")
    )


def _list_sql(items: str, quote: str) -> str:
    return f"'[{quote}' || array_to_string({items}, '{quote}, {quote}') || '{quote}]'"


@query(f"""WITH {TAGS_SQL}, {BRANDS_SQL}, {handles_sql("string_split(text, ' ')", "ab")},
{handles_sql("list_filter(string_split(text, ' '), lambda w: starts_with(w, 'a'))", "am")},
o AS (
  SELECT d.doc_id, d.doc_id % 11 AS kind, d.doc_id % 3 AS flag, t.items AS tags, b.items AS brands, ab.items AS abs, am.items AS ams,
    CASE WHEN d.doc_id % 11 = 6 OR NOT regexp_matches(text, '\\p{{L}}') OR lower(trim(text, {SPACE_SQL})) IN {("nan", *GENERIC)} THEN 'empty_input'
         WHEN d.doc_id % 11 = 10 THEN 'exception' WHEN d.doc_id % 11 = 7 THEN 'empty_output'
         WHEN d.doc_id % 11 = 8 OR coalesce(len(t.items), 0) <> 10 THEN 'not_10_tags' ELSE 'ok' END AS reason
  FROM documents d LEFT JOIN tags t ON t.doc_id = d.doc_id LEFT JOIN brands b ON b.doc_id = d.doc_id
    LEFT JOIN ab ON ab.doc_id = d.doc_id LEFT JOIN am ON am.doc_id = d.doc_id)
SELECT doc_id, reason, reason = 'empty_input' AS skip_retry, reason IN ('exception', 'empty_output') AS quota_fail,
  CASE WHEN reason = 'ok' THEN {_list_sql("tags", "''")} END AS topic_tags,
  CASE WHEN reason = 'ok' THEN (flag = 1)::INTEGER END AS is_sponsorship,
  CASE WHEN reason = 'ok' AND len(brands) > 0 THEN {_list_sql("brands", '"')} END AS brand_name,
  CASE WHEN reason = 'ok' AND len(abs) > 0 THEN {_list_sql("abs", '"')} END AS associated_brand,
  CASE WHEN reason = 'ok' AND len(ams) > 0 THEN {_list_sql("ams", '"')} END AS associated_mention
FROM o""")
def tag_outcome(t: Given) -> DataFrame:
    """Staged tag answers to reasons, retry flags and the rows to store."""
    results = responses.tag_outcome(inputs.tag_answers(t))
    stored = ["topic_tags", "is_sponsorship", "brand_name", "associated_brand", "associated_mention"]
    return results.select(
        "doc_id", "reason", "skip_retry", "quota_fail",
        *[F.when(F.col("ok"), F.col(c)).alias(c) for c in stored],
    )


@query(f"""WITH {TAGS_SQL}, o AS (
  SELECT CASE WHEN d.doc_id % 11 = 6 OR NOT regexp_matches(text, '\\p{{L}}') OR lower(trim(text, {SPACE_SQL})) IN {("nan", *GENERIC)} THEN 'empty_input'
         WHEN d.doc_id % 11 = 10 THEN 'exception' WHEN d.doc_id % 11 = 7 THEN 'empty_output'
         WHEN d.doc_id % 11 = 8 OR coalesce(len(t.items), 0) <> 10 THEN 'not_10_tags' ELSE 'ok' END AS reason
  FROM documents d LEFT JOIN tags t ON t.doc_id = d.doc_id)
SELECT reason, count(*) AS n FROM o GROUP BY reason""")
def tag_reasons(t: Given) -> DataFrame:
    return metrics.reason_histogram(responses.tag_outcome(inputs.tag_answers(t)))


def _stored_tags(t: Given) -> DataFrame:
    """Tag rows as stored; every fifth has one tag less, every 20th none."""
    tags = text.normalize_tags(F.split(text.split_camel_case(F.col("text")), r"\."))
    kept = F.when(F.col("doc_id") % 5 == 0, F.slice("tags", 1, 9)).otherwise(F.col("tags"))
    named = t.documents.select("doc_id", "lang", tags.alias("tags"))
    return named.select(
        F.col("lang").alias("user_id"), F.col("doc_id").cast("string").alias("post_id"), "doc_id",
        F.when(F.col("doc_id") % 20 != 7, text.python_list_text(kept)).alias("topic_tags"),
    )


STORED_SQL = f"""{TAGS_SQL},
stored AS (
  SELECT d.lang AS user_id, d.doc_id::VARCHAR AS post_id, d.doc_id, d.text,
    CASE WHEN d.doc_id % 20 = 7 THEN NULL WHEN d.doc_id % 5 = 0 THEN list_slice(coalesce(items, []), 1, 9)
         ELSE coalesce(items, []) END AS kept
  FROM documents d LEFT JOIN tags ON tags.doc_id = d.doc_id)"""


@query(f"""WITH {STORED_SQL}
SELECT user_id, post_id, array_to_string(kept, ', ') AS tag_text FROM stored WHERE len(kept) > 0""")
def tag_text_roundtrip(t: Given) -> DataFrame:
    """Stored list text back to arrays and to the text that is embedded."""
    return candidates.tag_texts(_stored_tags(t))


@query(f"""WITH {STORED_SQL} SELECT user_id, post_id FROM stored WHERE kept IS NULL OR len(kept) <> 10""")
def bad_tag_rows(t: Given) -> DataFrame:
    return candidates.bad_tag_pairs(_stored_tags(t))


@query(f"""WITH {STORED_SQL}
SELECT count(*) AS bad, count_if(user_id > 'en' OR (user_id = 'en' AND post_id > '5')) AS bad_left
FROM stored WHERE kept IS NULL OR len(kept) <> 10""")
def bad_tag_count(t: Given) -> DataFrame:
    """All bad rows, and those behind a resume key compared as text."""
    behind = candidates.behind_key(PAIR, ["en", "5"])
    return candidates.bad_tag_pairs(_stored_tags(t)).agg(
        F.count("*").alias("bad"), F.count_if(behind).alias("bad_left")
    )


@query(f"""WITH {STORED_SQL}, {CAPTIONS_SQL}
SELECT s.user_id, s.post_id, md5(coalesce(c.content, '')) AS content_md5
FROM stored s LEFT JOIN captions c ON c.user_id = s.user_id AND c.post_id = s.post_id
WHERE s.kept IS NULL OR len(s.kept) <> 10""")
def repair_work(t: Given) -> DataFrame:
    """Bad rows with the caption to ask about again."""
    bad = candidates.bad_tag_pairs(_stored_tags(t))
    captions = candidates.latest_captions(inputs.caption_posts(t))
    work = candidates.pairs_with_captions(bad, captions)
    return work.select(*PAIR, F.md5("content").alias("content_md5"))


# -- errors, ledgers, metrics -------------------------------------------------

MESSAGES = {
    "error": "429 RESOURCE_EXHAUSTED",
    "click": "Deadline exceeded",
    "view": "failed to generate",
    "signup": "Not Primary",
    "purchase": "",
}


def _messages(t: Given) -> DataFrame:
    message = F.lit(None).cast("string")
    for kind, shown in MESSAGES.items():
        message = F.when(F.col("event_type") == kind, F.concat(F.lit(shown), F.when(F.lit(shown) != "", F.concat(F.lit(" "), F.col("props"))).otherwise(""))).otherwise(message)
    return t.events.select("event_id", "user_id", "event_type", message.alias("message"))


MESSAGE_SQL = "CASE event_type " + " ".join(
    f"WHEN '{k}' THEN '{m}'" + (" || ' ' || props" if m else "") for k, m in MESSAGES.items()
) + " END"


def _like_any(parts: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(lower(m), '{p}')" for p in parts) + ")"


@query(f"""WITH m AS (SELECT event_type, {MESSAGE_SQL} AS m FROM events),
c AS (SELECT event_type, CASE WHEN trim(m) = '' THEN 'none' WHEN {_like_any(errors.QUOTA)} THEN 'quota'
  WHEN {_like_any(errors.TRANSIENT)} THEN 'transient' WHEN {_like_any(errors.STORE_RETRYABLE)} THEN 'store_retryable'
  WHEN {_like_any(errors.STOP)} THEN 'stop' ELSE 'other' END AS class,
  regexp_matches(lower(m), '\\b(resource_exhausted|429|quota|rate)\\b') AS strict_quota FROM m)
SELECT event_type, class, count(*) AS n, count_if(strict_quota) AS n_strict_quota FROM c GROUP BY event_type, class""")
def error_classes(t: Given) -> DataFrame:
    message = F.col("message")
    classed = _messages(t).select(
        "event_type", errors.error_class(message).alias("class"), errors.is_quota(message, True).alias("strict")
    )
    return classed.groupBy("event_type", "class").agg(
        F.count("*").alias("n"), F.count_if("strict").alias("n_strict_quota")
    )


def _failures(t: Given) -> DataFrame:
    """Error events as failed attempts of a pair."""
    pair = text.pair_key(F.concat(F.lit("u"), F.col("user_id").cast("string")), (F.col("event_id") % 4).cast("string"))
    return t.events.filter("event_type = 'error'").select(pair.alias("key"), "event_id")


FAILURES_SQL = """
a AS (SELECT 'u' || user_id::VARCHAR || '::' || (event_id % 4)::VARCHAR AS key FROM events WHERE event_type = 'error'),
n AS (SELECT key, count(*) AS n FROM a GROUP BY key)"""


@query(f"""WITH {FAILURES_SQL}
SELECT key, n::INTEGER AS attempts, CASE WHEN n >= 3 THEN 'dead' ELSE 'failed' END AS state,
       split_part(key, '::', 1) AS user_id, split_part(key, '::', 2) AS post_id FROM n""")
def retry_dead_letter(t: Given) -> DataFrame:
    """Attempts of an earlier ledger and of a new run; dead from the third on."""
    failures = _failures(t)
    nothing = failures.limit(0).select("key", F.lit(0).alias("attempts"), F.lit("").alias("state"))
    first = ledger.count_attempts(nothing, failures.filter("event_id % 2 = 0"), 3)
    after = ledger.count_attempts(first, failures.filter("event_id % 2 = 1"), 3)
    parts = text.split_pair_key(F.col("key"))
    return after.select("key", "attempts", "state", parts["user_id"].alias("user_id"), parts["post_id"].alias("post_id"))


@query("""WITH k AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN upper(event_type) ELSE event_type END
                    || '::' || user_id::VARCHAR AS key FROM events)
SELECT arg_min(key, event_id) AS key FROM k GROUP BY lower(key)""")
def distinct_keys(t: Given) -> DataFrame:
    kind = F.when(F.col("event_id") % 3 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    keys = t.events.select(text.pair_key(kind, F.col("user_id").cast("string")).alias("key"), "event_id")
    return ledger.distinct_keys(keys, "event_id")


@query("""WITH last AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)
SELECT user_id::VARCHAR AS video_id, 'failed ' || event_type AS error FROM last WHERE event_type <> 'purchase'
UNION ALL
SELECT user_id::VARCHAR, 'old' FROM (SELECT DISTINCT user_id + 100000 AS user_id FROM events)""")
def failure_ledger(t: Given) -> DataFrame:
    """Failed videos after a run: recorded, replaced or cleared by success."""
    last = last_wins(_events(t).select("user_id", "event_type", "ts_us", "event_id"), ["user_id"], ["ts_us", "event_id"])
    error = F.when(F.col("event_type") != "purchase", F.concat(F.lit("failed "), F.col("event_type"))).otherwise("")
    outcomes = last.select(F.col("user_id").cast("string").alias("video_id"), error.alias("error"))
    users = t.events.select("user_id").distinct()
    known = users.unionByName(users.select((F.col("user_id") + 100000).alias("user_id")))
    before = known.select(
        F.col("user_id").cast("string").alias("video_id"), F.lit("old").alias("error"), F.lit("2024-01-01").alias("updated_at")
    )
    return ledger.record_failures(before, outcomes, F.lit("2024-02-01")).select("video_id", "error")


RUN_STATUS = {"view": "CHECKPOINTED", "click": "CHECKPOINTED", "signup": "SKIPPED", "error": "ERROR", "purchase": "CHECKPOINTED"}


def _attempts(t: Given) -> DataFrame:
    status = F.lit(None).cast("string")
    for kind, shown in RUN_STATUS.items():
        status = F.when(F.col("event_type") == kind, shown).otherwise(status)
    stored = F.col("event_type").isin("view", "purchase")
    return t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"),
        status.alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).otherwise("").alias("error"),
        stored.alias("uploaded"),
        stored.alias("saved_index"),
        (F.col("event_type") == "view").alias("saved_source"),
    )


RUN_SQL = """
r AS (SELECT strftime(ts, '%Y-%m-%d') AS run_id, count(*) AS processed,
  count_if(event_type IN ('view', 'click', 'purchase')) AS fetched, count_if(event_type IN ('view', 'click', 'purchase')) AS checkpointed,
  count_if(event_type IN ('view', 'purchase')) AS uploaded, count_if(event_type IN ('view', 'purchase')) AS saved_index,
  count_if(event_type = 'view') AS saved_source, count_if(event_type = 'signup') AS skipped, count_if(event_type = 'error') AS errors
  FROM events GROUP BY 1)"""


@query(f"""WITH {RUN_SQL}
SELECT *, round(processed / 86400 * 60, 2) AS rate, greatest(0, least(400, 1000) - processed) AS remaining,
  CASE WHEN checkpointed > uploaded THEN 'DONE_WITH_PENDING' WHEN errors > 0 THEN 'DONE_WITH_ERRORS' ELSE 'DONE' END AS status,
  CASE WHEN errors > 0 THEN 'DONE_WITH_ERRORS' ELSE 'DONE' END AS summary_status,
  round(greatest(0, least(400, 1000) - processed) / (processed / 86400), 3) AS eta FROM r""")
def run_summary(t: Given) -> DataFrame:
    """Counters, rate, time left and final status of each day's run."""
    runs = metrics.run_counts(_attempts(t), ["run_id"])
    done, day, total = F.col("processed"), F.lit(86400), F.lit(1000).cast("bigint")
    return runs.withColumns(
        {
            "rate": metrics.rate_per_minute(done, day),
            "remaining": metrics.remaining(done, total, (0, 400)),
            "status": metrics.transcript_status(
                F.lit(False), F.col("checkpointed") - F.col("uploaded"), F.col("errors")
            ),
            "summary_status": metrics.summary_status(F.lit(False), F.col("errors")),
            "eta": F.round(metrics.eta_seconds(done, total, day, (0, 400)), 3),
        }
    )


@query("SELECT " + ", ".join(f"sum({c})::BIGINT AS cumulative_{c}" for c in metrics.COUNTS) + f" FROM (WITH {RUN_SQL} SELECT * FROM r)")
def run_totals(t: Given) -> DataFrame:
    return metrics.cumulative_counts(metrics.run_counts(_attempts(t), ["run_id"]), [])


@query("""SELECT count(*) AS candidates FROM documents WHERE doc_id % 50 <> 0 AND source <> 'src0'""")
def candidate_counts(t: Given) -> DataFrame:
    return metrics.candidate_count(candidates.posts_with_keys(inputs.post_docs(t), 1))


@query("SELECT count(*) AS candidates FROM documents WHERE source <> 'src0'")
def location_count(t: Given) -> DataFrame:
    """Candidates of the vector stage, counted by location alone."""
    return metrics.candidate_count(inputs.post_docs(t).filter("locationId = 1"))


@query("""SELECT doc_id::VARCHAR AS video_id, CASE WHEN doc_id % 2 = 0 THEN source END AS error, NULL::TIMESTAMP AS updated_at FROM documents""")
def ledger_defaults(t: Given) -> DataFrame:
    """A ledger kept with some columns and one that does not exist yet, read with one schema."""
    path = scratch_path(t.spark, "ledger")
    video = F.col("doc_id").cast("string").alias("video_id")
    t.documents.filter("doc_id % 2 = 0").select(video, F.col("source").alias("error")).write.parquet(f"{path}/even")
    t.documents.filter("doc_id % 2 = 1").select(video).write.parquet(f"{path}/odd")
    kept = [read_or_empty(t.spark, f"{path}/{name}", FAILED_VIDEO) for name in ("even", "odd", "absent")]
    return kept[0].unionByName(kept[1]).unionByName(kept[2])


def _records(t: Given) -> DataFrame:
    """Events as embedding records: the event type gives the status."""
    status = (
        F.when(F.col("event_type") == "error", "failed_embed").when(F.col("event_type") == "click", "failed_mongo_write")
        .when(F.col("event_type") == "signup", "embedded").when(F.col("event_type") == "purchase", "inserted")
        .otherwise("pending")
    )
    return t.events.select(
        F.when(F.col("event_id") % 20 == 0, " ").otherwise(F.col("user_id").cast("string")).alias("user_id"),
        F.col("event_id").cast("string").alias("post_id"),
        status.alias("status"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("updated_at"),
    )


RECORD_SQL = """
s AS (SELECT CASE WHEN event_id % 20 = 0 THEN ' ' ELSE user_id::VARCHAR END AS user_id, event_id::VARCHAR AS post_id,
  CASE event_type WHEN 'error' THEN 'failed_embed' WHEN 'click' THEN 'failed_mongo_write' WHEN 'signup' THEN 'embedded'
       WHEN 'purchase' THEN 'inserted' ELSE 'pending' END AS status, floor(epoch(ts))::BIGINT AS updated_at FROM events)"""


@query(f"""WITH {RECORD_SQL} SELECT status, count(*) AS n FROM s
WHERE status IN ('failed_embed', 'embedded', 'failed_mongo_write') AND user_id <> ' ' GROUP BY status""")
def retry_counts(t: Given) -> DataFrame:
    return metrics.status_counts(ledger.retryable_records(_records(t)))


PRUNED_SQL = f"""WITH {RECORD_SQL}, k AS (SELECT *, row_number() OVER (
  PARTITION BY status = 'inserted' ORDER BY updated_at DESC, user_id DESC, post_id DESC) AS rn FROM s)
SELECT user_id, post_id, status, updated_at FROM k WHERE status <> 'inserted' OR rn <= @N"""


@query(PRUNED_SQL.replace("@N", "200"))
def ledger_prune(t: Given) -> DataFrame:
    return ledger.prune_inserted(_records(t), 200)


# -- positions ----------------------------------------------------------------


@query("""SELECT o_orderkey, o_custkey::VARCHAR AS user_id, o_orderkey::VARCHAR AS post_id FROM orders
WHERE o_custkey::VARCHAR > '10' OR (o_custkey::VARCHAR = '10' AND o_orderkey::VARCHAR > '5')
ORDER BY user_id, post_id LIMIT 1000""")
def keyset_page(t: Given) -> DataFrame:
    """A page behind a pair of text keys, where '10' comes before '9'."""
    pairs = t.orders.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("post_id")
    )
    return candidates.key_page(pairs, PAIR, ["10", "5"], 1000)


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 500")
def keyset_page_id(t: Given) -> DataFrame:
    return candidates.key_page(t.orders.select("o_orderkey"), ["o_orderkey"], [1000], 500)


@query("""SELECT max(o_orderkey) AS o_orderkey, max((o_custkey::VARCHAR, o_orderkey::VARCHAR))[1] AS user_id,
  max((o_custkey::VARCHAR, o_orderkey::VARCHAR))[2] AS post_id FROM orders""")
def high_water(t: Given) -> DataFrame:
    """Resume positions: greatest id and greatest text pair."""
    keys = t.orders.select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("user_id"), F.col("o_orderkey").cast("string").alias("post_id")
    )
    return ledger.high_waters(keys, ["o_orderkey"], PAIR)


@query(f"""WITH {POSTS_SQL} SELECT channel_id FROM channels
WHERE channel_id NOT IN (SELECT channel_id FROM posts WHERE publishedAt < epoch_ms(TIMESTAMP '1995-06-01 00:00:00'))""")
def unfinished_channels(t: Given) -> DataFrame:
    """Channels not finished under the same parameters; another run's channels do not count."""
    key = ledger.run_key(LOCATION, START, END)
    early = F.unix_millis(F.to_timestamp(F.lit("1995-06-01T00:00:00Z")))
    done = inputs.posts(t).select(
        F.when(F.col("publishedAt") < early, key).otherwise("another run").alias("run_key"), "channel_id"
    )
    return ledger.unfinished_channels(_channels(t), done, key)


@query("""WITH p AS (SELECT DISTINCT user_id, event_type FROM events WHERE event_type = 'error' OR event_id % 2 = 0),
retry AS (SELECT DISTINCT user_id::VARCHAR AS user_id, 'x' AS post_id FROM events WHERE event_type = 'error' AND event_id % 3 = 0),
fresh AS (SELECT DISTINCT user_id::VARCHAR AS user_id, 'x' AS post_id FROM events)
SELECT user_id, post_id, 'retry' AS lane FROM retry
UNION ALL SELECT user_id, post_id, 'fresh' FROM fresh WHERE user_id NOT IN (SELECT user_id FROM retry)""")
def retry_and_fresh(t: Given) -> DataFrame:
    pair = [F.col("user_id").cast("string").alias("user_id"), F.lit("x").alias("post_id")]
    retry = t.events.filter("event_type = 'error' AND event_id % 3 = 0").select(*pair).distinct()
    fresh = t.events.select(*pair).distinct()
    return ledger.retry_and_fresh(retry, fresh, PAIR)


# -- vectors ------------------------------------------------------------------

DIM = 64


def _vectors(t: Given) -> DataFrame:
    """Every tenth stored vector is cut short, every 31st is missing."""
    vector = F.col("embedding").cast("array<double>")
    stored = F.when(F.col("vec_id") % 10 == 3, F.slice(vector, 1, 40)).when(F.col("vec_id") % 31 != 7, vector)
    return t.embeddings.select("vec_id", stored.alias("embedding"))


VECTOR_SIZE_SQL = f"CASE WHEN vec_id % 10 = 3 THEN 40 WHEN vec_id % 31 = 7 THEN NULL ELSE {DIM} END"


@query(f"""SELECT vec_id, {VECTOR_SIZE_SQL} IS NOT DISTINCT FROM {DIM} AS valid FROM embeddings""")
def embedding_validity(t: Given) -> DataFrame:
    return _vectors(t).select("vec_id", vectors.has_valid_vector(F.col("embedding"), DIM).alias("valid"))


@query(f"""WITH a AS (
  SELECT vec_id, vec_id // 8 AS b, {VECTOR_SIZE_SQL} AS size, (vec_id // 8) % 5 = 4 AS broken, (vec_id // 8) % 7 = 2 AS lost FROM embeddings),
r AS (SELECT *, CASE WHEN broken THEN '429 quota' WHEN size <> {DIM} THEN 'dim mismatch: got ' || size || ' expected {DIM}'
    WHEN lost THEN 'count mismatch: got 7 expected 8' WHEN size IS NULL THEN 'missing values' END AS reason FROM a),
f AS (SELECT b, min(reason) AS failure FROM r GROUP BY b)
SELECT vec_id, CASE WHEN failure IS NULL THEN size ELSE NULL END AS n_values, failure AS error FROM r JOIN f USING (b)""")
def embedding_requests(t: Given) -> DataFrame:
    """Answers of requests of eight texts: one bad vector fails its request."""
    batch = F.floor(F.col("vec_id") / 8)
    answers = _vectors(t).select(
        F.lit("u").alias("user_id"), F.col("vec_id").cast("string").alias("post_id"),
        batch.cast("string").alias("batch_id"), F.lit(8).alias("n_inputs"),
        F.when(batch % 7 == 2, 7).otherwise(8).alias("n_vectors"), "embedding",
        F.when(batch % 5 == 4, "429 quota").alias("error"),
    )
    checked = vectors.check_answers(answers, DIM)
    return checked.select(
        F.col("post_id").cast("bigint").alias("vec_id"),
        F.when(F.col("vector").isNotNull(), F.size("vector")).alias("n_values"), "error",
    )


def _disposition_inputs(t: Given) -> tuple[DataFrame, DataFrame, DataFrame]:
    pair = [
        F.when(F.col("doc_id") % 40 == 5, "").otherwise(F.concat(F.lit("u"), (F.col("doc_id") % 10).cast("string"))).alias("user_id"),
        F.col("doc_id").cast("string").alias("post_id"),
    ]
    texts = t.documents.select(*pair, F.when(F.col("doc_id") % 9 == 0, "").otherwise(F.col("source")).alias("tag_text"))
    status = F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "inserted").when(F.col("toxic") == 1, "embedded").otherwise("failed_embed")
    records = t.labels.select(*pair, status.alias("status"), F.when(F.col("doc_id") % 4 == 0, "own text").alias("text"))
    docs = _vectors(t).withColumn("doc_id", F.col("vec_id")).select(
        *pair, F.lpad(F.hex("vec_id"), 24, "0").alias("_id"), F.lit(1).alias("locationId"), "embedding"
    )
    copies = docs.filter("_id > repeat('0', 24)").withColumn("_id", F.concat(F.lit("0"), F.substring("_id", 1, 23))).withColumn("embedding", F.lit(None).cast("array<double>"))
    return texts, records, vectors.location_docs(docs.unionByName(copies), 1, DIM)


PAIR_SQL = "CASE WHEN doc_id % 40 = 5 THEN '' ELSE 'u' || (doc_id % 10)::VARCHAR END AS user_id, doc_id::VARCHAR AS post_id"
DISPOSITION_SQL = f"""
texts AS (SELECT {PAIR_SQL}, doc_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE source END AS tag_text FROM documents),
records AS (SELECT {PAIR_SQL}, doc_id, CASE WHEN quality = 1 AND toxic = 0 THEN 'inserted' WHEN toxic = 1 THEN 'embedded' ELSE 'failed_embed' END AS status,
            CASE WHEN doc_id % 4 = 0 THEN 'own text' END AS own FROM labels),
docs AS (SELECT vec_id AS doc_id, lpad(hex(vec_id), 24, '0') AS _id,
         {VECTOR_SIZE_SQL} IS NOT DISTINCT FROM {DIM} AS stored FROM embeddings)"""


@query(f"""WITH {DISPOSITION_SQL}
SELECT t.user_id, t.post_id, t.tag_text, d._id AS mongo_id,
  CASE WHEN r.status = 'inserted' THEN 'checkpoint_inserted' WHEN t.user_id = '' THEN 'blank_key' WHEN t.tag_text = '' THEN 'no_text'
       WHEN d._id IS NULL THEN 'mongo_doc_not_found' WHEN d.stored THEN 'embedding_exists_in_mongo' ELSE 'needs_embedding' END AS disposition
FROM texts t LEFT JOIN records r ON r.doc_id = t.doc_id LEFT JOIN docs d ON d.doc_id = t.doc_id""")
def embedding_disposition(t: Given) -> DataFrame:
    texts, records, docs = _disposition_inputs(t)
    return vectors.dispositions(texts, records, docs)


@query(f"""WITH {DISPOSITION_SQL}
SELECT t.user_id, t.post_id, t.tag_text, d._id AS mongo_id,
  CASE WHEN r.status = 'inserted' THEN 'checkpoint_inserted' WHEN t.user_id = '' THEN 'blank_key' WHEN t.tag_text = '' THEN 'no_text'
       WHEN d._id IS NULL THEN 'mongo_doc_not_found' ELSE 'needs_embedding' END AS disposition
FROM texts t LEFT JOIN records r ON r.doc_id = t.doc_id LEFT JOIN docs d ON d.doc_id = t.doc_id""")
def embedding_overwrite(t: Given) -> DataFrame:
    """The same pairs when stored vectors are to be replaced."""
    texts, records, docs = _disposition_inputs(t)
    return vectors.dispositions(texts, records, docs, overwrite=True)


@query(f"""WITH {DISPOSITION_SQL},
q AS (SELECT r.user_id, r.post_id, r.status, d._id, d.stored, coalesce(r.own, t.tag_text, '') AS tag_text
      FROM records r LEFT JOIN texts t ON t.doc_id = r.doc_id LEFT JOIN docs d ON d.doc_id = r.doc_id
      WHERE r.user_id <> '' AND r.status <> 'inserted')
SELECT user_id, post_id, tag_text, _id AS mongo_id,
  CASE WHEN _id IS NULL THEN 'mongo_doc_not_found' WHEN tag_text = '' AND status <> 'embedded' THEN 'no_text'
       WHEN stored THEN 'embedding_exists_in_mongo' ELSE 'needs_embedding' END AS disposition FROM q""")
def retry_disposition(t: Given) -> DataFrame:
    texts, records, docs = _disposition_inputs(t)
    return vectors.retry_dispositions(ledger.retryable_records(records), texts, docs)


@query(f"""SELECT vec_id, CASE WHEN vec_id % 31 = 7 AND vec_id % 10 <> 3 OR vec_id % 12 = 5 THEN 'missing_embedding_or_mongo_id'
    WHEN vec_id % 12 = 6 THEN 'invalid_mongo_id' WHEN label % 2 = 1 THEN 'no_document_matched' ELSE 'inserted' END AS write_status
FROM embeddings""")
def write_outcome(t: Given) -> DataFrame:
    """Whether each record's vector can be written to its document."""
    good = F.lpad(F.hex("vec_id"), 24, "0")
    mongo_id = F.when(F.col("vec_id") % 12 == 5, "").when(F.col("vec_id") % 12 == 6, "xyz").otherwise(good)
    records = _vectors(t).select(
        "vec_id", F.lit("u").alias("user_id"), F.col("vec_id").cast("string").alias("post_id"), mongo_id.alias("mongo_id"), "embedding"
    )
    docs = t.embeddings.filter("label % 2 = 0").select(good.alias("_id"))
    return vectors.write_outcome(records, docs).select("vec_id", "write_status")


@query(f"""SELECT vec_id, CASE WHEN vec_id % 4 = 3 THEN 'skip' WHEN vec_id % 4 IN (1, 2) AND {VECTOR_SIZE_SQL} IS NOT NULL THEN 'write' ELSE 'embed' END AS action
FROM embeddings""")
def record_actions(t: Given) -> DataFrame:
    kind = F.col("vec_id") % 4
    status = F.when(kind == 0, "failed_embed").when(kind == 1, "embedded").when(kind == 2, "failed_mongo_write").otherwise("inserted")
    action = ledger.next_action(status, F.col("embedding").isNotNull())
    return _vectors(t).select("vec_id", action.alias("action"))
