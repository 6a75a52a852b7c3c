"""The five stages and the incremental runner from end to end over the given tables.

Each run writes its tables to a fresh place in the shared folder and asks the
offline client.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig, scratch_path
from ..functions.text import GENERIC_WORDS, TAG_LIMIT, TAG_WORDS, object_key
from ..operators.candidates import PAIR
from ..plans import posts as posts_job
from ..plans import summaries as summaries_job
from ..plans import tags as tags_job
from ..plans import transcripts as transcripts_job
from ..plans import vectors as vectors_job
from ..schemas import (
    EMBEDDING_RECORD,
    FAILED_VIDEO,
    FINISHED_CHANNEL,
    IG_DOC,
    IG_POST,
    SINK_STATUS,
    TAG_FAILURE,
    TOPIC_TAGS,
    TRANSCRIPT_INDEX,
    VIDEO,
    VIDEO_SUMMARY,
)
from ..sources import payloads
from ..sources.tables import GivenTable, VersionedTable
from ..streaming.incremental import newest_handler, run_available
from . import inputs
from .inputs import (
    CAPTIONS_SQL,
    END,
    EXCLUDED,
    LOCATION,
    POSTS_SQL,
    SPACE_SQL,
    START,
    Given,
    phrases_sql,
)
from .offline import OfflineClient
from .queries import ISO_SQL, LAST_SQL, STORED_SQL, TAGS_SQL, _list_sql, _stored_tags, query

NOW = "2024-06-01 00:00:00"
PARTITIONS = 16


def _table(t: Given, root: str, name: str, schema, rows: DataFrame | None = None) -> VersionedTable:
    table = VersionedTable(t.spark, f"{root}/{name}", schema)
    if rows is not None:
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in rows.columns]
        table.replace(rows.select("*", *missing))
    return table


def _now():
    return F.to_timestamp(F.lit(NOW))


@query(f"""WITH {POSTS_SQL},
new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY publishedAt DESC) AS rn FROM found) WHERE rn = 1)
SELECT video_id, channel_id, {LOCATION} AS location_id, {ISO_SQL} AS published FROM new""")
def stage_posts(t: Given) -> DataFrame:
    root = scratch_path(t.spark, "posts")
    config = JobConfig(location_id=LOCATION, start_date=START, end_date=END, excluded_channels=EXCLUDED)
    videos = _table(t, root, "video", VIDEO)
    finished = _table(t, root, "finished", FINISHED_CHANNEL)
    for _ in range(2):  # the second run finds every channel finished
        posts_job.run(inputs.locations(t), inputs.bios(t), inputs.posts(t), videos, finished, config)
    return videos.read().select("video_id", "channel_id", "location_id", F.col("stats.publishedAt").alias("published"))


@query(f"""WITH v AS (SELECT d.doc_id, d.doc_id::VARCHAR AS video_id, ascii(right(d.doc_id::VARCHAR, 1)) % 4 AS kind,
  l.quality IS NOT NULL AND l.quality = 1 AS done, l.doc_id IS NOT NULL AS indexed, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT video_id,
  CASE WHEN done THEN NULL WHEN kind = 3 THEN 3 WHEN kind = 2 THEN 3 ELSE kind + 1 END AS srt_id,
  CASE WHEN done THEN NULL ELSE ['en', 'a.en', 'fr', ''][kind + 1] END AS language_code,
  CASE WHEN done THEN 'https://b.s3.r.amazonaws.com/' || video_id
       ELSE 'https://transcripts.s3.ap-southeast-1.amazonaws.com/transcript/' || video_id || '.json' END AS s3_url,
  CASE WHEN done THEN CASE WHEN toxic = 1 THEN 'no captions' ELSE '' END WHEN kind = 3 THEN 'HTTP 404 error' ELSE '' END AS error
FROM v""")
def stage_transcripts(t: Given) -> DataFrame:
    root = scratch_path(t.spark, "transcripts")
    tables = transcripts_job.TranscriptTables(
        videos=_table(t, root, "video", VIDEO, inputs.videos(t)),
        index=_table(t, root, "index", TRANSCRIPT_INDEX, inputs.transcript_index(t)),
        failures=_table(t, root, "failures", FAILED_VIDEO),
        sink_status=_table(t, root, "sinks", SINK_STATUS),
        staging=f"{root}/staging",
        objects=f"{root}/objects",
    )
    config = JobConfig(model_partitions=PARTITIONS)
    transcripts_job.run(tables, OfflineClient, config, _now())
    index = tables.index.read().select("video_id", "language_code", "s3_url", "error")
    return tables.videos.read().select("video_id", "srt_id").join(index, "video_id", "left")


@query(f"""WITH s AS (SELECT doc_id, doc_id::VARCHAR AS video_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE trim(text, {SPACE_SQL}) END AS content, lang FROM documents
  WHERE lang IN ('en', 'de') AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id))
SELECT video_id, CASE WHEN content = '' THEN '' ELSE trim(string_split(content, '.')[1], {SPACE_SQL}) END AS video_title,
  md5(content) AS summary_md5, CASE WHEN content = '' THEN 0 ELSE (len(string_split(content, '.')) % 2)::INTEGER END AS is_sponsorship,
  CASE WHEN content = '' THEN 'NO_TRANSCRIPT' ELSE '' END AS error FROM s""")
def stage_summaries(t: Given) -> DataFrame:
    root = scratch_path(t.spark, "summaries")
    config = JobConfig(model_partitions=PARTITIONS)
    video = F.col("doc_id").cast("string")
    index = t.documents.select(
        F.col("doc_id").alias("id"), video.alias("video_id"), inputs.language_code().alias("language_code"),
        F.concat(F.lit("s3://transcripts/"), object_key(video, config.key_prefix)).alias("s3_url"),
    )
    captions = t.documents.select(
        video.alias("video_id"), F.lit("").alias("language_code"), F.lit("").alias("language_name"), F.lit("srt").alias("format"),
        F.when(F.col("doc_id") % 9 == 0, " ").otherwise(F.col("text")).alias("content"), F.lit("").alias("error"),
    )
    payloads.write_payloads(captions, f"{root}/objects", config)
    done = t.labels.select(F.col("doc_id").cast("string").alias("video_id"), F.lit("done").alias("error"))
    tables = summaries_job.SummaryTables(
        index=_table(t, root, "index", TRANSCRIPT_INDEX, index),
        summaries=_table(t, root, "summaries", VIDEO_SUMMARY, done),
        failures=_table(t, root, "failures", FAILED_VIDEO),
        staging=f"{root}/staging",
    )
    objects = payloads.read_payloads(t.spark, f"{root}/objects")
    summaries_job.run(tables, objects, OfflineClient, config, _now())
    saved = tables.summaries.read().filter("error <> 'done'")
    return saved.select("video_id", "video_title", F.md5("summary").alias("summary_md5"), "is_sponsorship", "error")


def _tag_tables(t: Given, root: str, tags: DataFrame | None = None) -> tags_job.TagTables:
    return tags_job.TagTables(
        docs=_table(t, root, "docs", IG_DOC, inputs.post_docs(t)),
        captions=GivenTable(inputs.caption_posts(t), IG_POST),
        tags=_table(t, root, "tags", TOPIC_TAGS, tags),
        failures=_table(t, root, "failures", TAG_FAILURE),
        staging=f"{root}/staging",
    )


CAPTION_TAGS_SQL = TAGS_SQL.replace("FROM documents", "FROM captioned", 1)


@query(f"""WITH {CAPTIONS_SQL},
captioned AS (SELECT c.post_id::BIGINT AS doc_id, c.user_id, c.content AS text FROM captions c),
{CAPTION_TAGS_SQL}
SELECT c.user_id, c.doc_id::VARCHAR AS post_id, {_list_sql("g.items", "''")} AS topic_tags,
  (len(string_split(c.text, '.')) % 2)::INTEGER AS is_sponsorship
FROM captioned c JOIN tags g ON g.doc_id = c.doc_id JOIN documents d ON d.doc_id = c.doc_id
WHERE len(g.items) = 10 AND d.doc_id % 50 <> 0 AND d.source <> 'src0'""")
def stage_tags(t: Given) -> DataFrame:
    tables = _tag_tables(t, scratch_path(t.spark, "tags"))
    tags_job.run(tables, OfflineClient, JobConfig(model_partitions=PARTITIONS))
    return tables.tags.read().select(*PAIR, "topic_tags", "is_sponsorship")


REPAIRED_TAGS_SQL = phrases_sql(
    "captioned", "string_split(text, '.')", TAG_WORDS, GENERIC_WORDS, TAG_LIMIT, "again"
)


@query(f"""WITH {CAPTIONS_SQL}, {STORED_SQL},
captioned AS (SELECT c.post_id::BIGINT AS doc_id, c.content AS text FROM captions c),
{REPAIRED_TAGS_SQL}
SELECT s.user_id, s.post_id, CASE
  WHEN (s.kept IS NULL OR len(s.kept) <> 10) AND len(a.items) = 10 THEN {_list_sql("a.items", "''")}
  WHEN len(s.kept) = 0 THEN '[]'
  ELSE {_list_sql("s.kept", "''")} END AS topic_tags
FROM stored s LEFT JOIN again a ON a.doc_id = s.doc_id""")
def stage_repair(t: Given) -> DataFrame:
    """Bad tag rows asked about again; what passes the gate is overwritten."""
    root = scratch_path(t.spark, "repair")
    tables = _tag_tables(t, root, _stored_tags(t).drop("doc_id"))
    tags_job.repair(tables, OfflineClient, JobConfig(model_partitions=PARTITIONS))
    return tables.tags.read().select(*PAIR, "topic_tags")


@query(f"""WITH {STORED_SQL}, k AS (
  SELECT s.user_id, s.post_id, array_to_string(s.kept, ', ') AS tag_text FROM stored s
  WHERE len(s.kept) > 0 AND s.doc_id % 50 <> 0 AND EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = s.doc_id AND d.source <> 'src0'))
SELECT user_id, post_id, 8 AS n_values, length(tag_text)::DOUBLE AS first_value,
  (length(tag_text) - length(replace(tag_text, ',', '')))::DOUBLE AS second_value FROM k""")
def stage_vectors(t: Given) -> DataFrame:
    root = scratch_path(t.spark, "vectors")
    docs = inputs.post_docs(t).withColumn("user_id", F.trim("user_id"))
    tables = vectors_job.VectorTables(
        tags=_table(t, root, "tags", TOPIC_TAGS, _stored_tags(t).drop("doc_id")),
        docs=_table(t, root, "docs", IG_DOC, docs),
        records=_table(t, root, "records", EMBEDDING_RECORD),
        staging=f"{root}/staging",
    )
    config = JobConfig(model_partitions=PARTITIONS, embed_dim=8)
    vectors_job.run(tables, OfflineClient, config, F.unix_timestamp(_now()))
    filled = tables.docs.read().filter("embedding IS NOT NULL")
    return filled.select(
        *PAIR, F.size("embedding").alias("n_values"),
        F.col("embedding")[0].alias("first_value"), F.col("embedding")[1].alias("second_value"),
    )


@query(LAST_SQL)
def incremental_upsert(t: Given) -> DataFrame:
    """New files merged in micro-batches, resumed from the stream's checkpoint."""
    root = scratch_path(t.spark, "incremental")
    columns = ["user_id", "event_type", "event_id", "value", "ts_us"]
    events = t.events.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp"))).select(*columns)
    target = VersionedTable(t.spark, f"{root}/target", events.schema)
    handler = newest_handler(target, ["user_id", "event_type"], ["ts_us", "event_id"])
    for half in ("event_id % 2 = 0", "event_id % 2 = 1"):
        events.filter(half).write.mode("append").parquet(f"{root}/source")
        run_available(t.spark, f"{root}/source", events.schema, f"{root}/checkpoint", handler)
    return target.read()
