"""The given tables in the roles the jobs expect, and the same roles as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import tune

LOCATION = 2
EXCLUDED = ("UC000000002", "UC000000057", "UC000000112", "UC000000167")
START, END = "1996-01-01", "1999-06-30"


class Given:
    """The parquet tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")


def channel_id(key: str) -> Column:
    return F.concat(F.lit("UC"), F.lpad(F.col(key).cast("string"), 9, "0"))


# -- channels and posts -------------------------------------------------------


def locations(t: Given) -> DataFrame:
    """Every eleventh customer has an id that is no channel."""
    padded = F.lpad(F.col("c_custkey").cast("string"), 9, "0")
    prefix = F.when(F.col("c_custkey") % 11 == 0, "XX").otherwise("UC")
    return t.customer.select(
        F.concat(prefix, padded).alias("youtube_channel_id"),
        (F.col("c_nationkey") % 5).alias("locationId"),
    )


def bios(t: Given) -> DataFrame:
    return t.orders.select(channel_id("o_custkey").alias("channel_id"))


def posts(t: Given) -> DataFrame:
    """Orders as posts; an order key ending in 9 repeats the video id before it."""
    key = F.col("o_orderkey")
    day = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    video = F.when(key % 10 == 9, key - 1).otherwise(key)
    return t.orders.select(
        channel_id("o_custkey").alias("channel_id"),
        F.concat(F.lit("v"), video.cast("string")).alias("video_id"),
        (day + (key * 7919) % 86400000).alias("publishedAt"),
        F.floor("o_totalprice").alias("likeCount"),
        F.when(key % 13 != 0, key % 100).alias("dislikeCount"),
        (key % 1000).alias("commentCount"),
        (key * 3).alias("viewCount"),
        F.lit(0).cast("bigint").alias("favoriteCount"),
    )


POSTS_SQL = f"""
locations AS (
  SELECT CASE WHEN c_custkey % 11 = 0 THEN 'XX' ELSE 'UC' END
         || lpad(c_custkey::VARCHAR, 9, '0') AS youtube_channel_id,
         c_nationkey % 5 AS locationId
  FROM customer),
bios AS (SELECT 'UC' || lpad(o_custkey::VARCHAR, 9, '0') AS channel_id FROM orders),
posts AS (
  SELECT 'UC' || lpad(o_custkey::VARCHAR, 9, '0') AS channel_id,
         'v' || (CASE WHEN o_orderkey % 10 = 9 THEN o_orderkey - 1 ELSE o_orderkey END)::VARCHAR AS video_id,
         epoch_ms(o_orderdate) + (o_orderkey * 7919) % 86400000 AS publishedAt,
         floor(o_totalprice)::BIGINT AS likeCount,
         CASE WHEN o_orderkey % 13 <> 0 THEN o_orderkey % 100 END AS dislikeCount,
         o_orderkey % 1000 AS commentCount,
         o_orderkey * 3 AS viewCount,
         0::BIGINT AS favoriteCount
  FROM orders),
channels AS (
  SELECT DISTINCT l.youtube_channel_id AS channel_id
  FROM locations l JOIN bios b ON b.channel_id = l.youtube_channel_id
  WHERE l.locationId = {LOCATION} AND regexp_matches(l.youtube_channel_id, '^UC')
    AND l.youtube_channel_id NOT IN {EXCLUDED}),
found AS (
  SELECT p.* FROM posts p JOIN channels c ON c.channel_id = p.channel_id
  WHERE p.publishedAt BETWEEN epoch_ms(TIMESTAMP '{START} 00:00:00')
                          AND epoch_ms(TIMESTAMP '{END} 23:59:59'))
"""

# -- videos, transcripts, posts to tag ----------------------------------------

LANGUAGE_SQL = "CASE lang WHEN 'en' THEN 'en' WHEN 'de' THEN 'a.en' ELSE lang END"
SPACE_SQL = "(' ' || " + " || ".join(f"chr({n})" for n in (9, 10, 11, 12, 13, 133, 160, 12288)) + ")"


def language_code() -> Column:
    """German documents stand for automatic captions."""
    return F.when(F.col("lang") == "de", "a.en").otherwise(F.col("lang"))


def videos(t: Given) -> DataFrame:
    return t.documents.select(
        F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("_id"),
        F.col("doc_id").cast("string").alias("video_id"),
    )


def transcript_index(t: Given) -> DataFrame:
    """Labelled documents have an index row; its URL is blank where quality is 0."""
    doc = F.col("doc_id").cast("string")
    return t.labels.select(
        F.col("doc_id").alias("id"),
        doc.alias("video_id"),
        F.when(F.col("quality") == 1, F.concat(F.lit("https://b.s3.r.amazonaws.com/"), doc)).otherwise(" ").alias("s3_url"),
        F.when(F.col("toxic") == 1, "no captions").otherwise("").alias("error"),
    )


def captions_responses(t: Given) -> DataFrame:
    """A captions API response per document; every seventh has no body of use."""
    kind = F.col("doc_id") % 7
    data = F.struct(
        F.when(kind == 5, F.lit("  ")).otherwise(F.col("text")).alias("content"),
        language_code().alias("language_code"),
        F.upper("lang").alias("language_name"),
    )
    message = F.when(kind == 4, "partial captions")
    body = F.when(kind == 6, '{"data": [1, 2]}').otherwise(
        F.to_json(F.struct(message.alias("message"), data.alias("data")))
    )
    return t.documents.select(
        F.col("doc_id").cast("string").alias("video_id"),
        F.when(kind == 3, 404).otherwise(200).alias("status"),
        body.alias("body"),
    )


def post_docs(t: Given) -> DataFrame:
    """Documents as posts of their language; every 50th has a blank user id."""
    user = F.when(F.col("doc_id") % 50 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("lang")))
    return t.documents.select(
        F.lpad(F.hex("doc_id"), 24, "0").alias("_id"),
        user.alias("user_id"),
        F.col("doc_id").cast("string").alias("post_id"),
        F.when(F.col("source") == "src0", 2).otherwise(1).alias("locationId"),
    )


def caption_posts(t: Given) -> DataFrame:
    """Two caption versions per document; the newer one is undated for every sixth."""
    base = t.documents.select(
        F.col("lang").alias("ig_user_id"),
        F.col("doc_id").cast("string").alias("ig_post_id"),
        "text",
        "doc_id",
    )
    old = base.select(
        "ig_user_id", "ig_post_id",
        F.concat(F.lit("old "), F.col("text")).alias("content"),
        F.timestamp_seconds(F.lit(1700000000)).alias("postDate"),
    )
    date = F.when(F.col("doc_id") % 6 != 0, F.timestamp_seconds(F.lit(1710000000)))
    new = base.select("ig_user_id", "ig_post_id", F.col("text").alias("content"), date.alias("postDate"))
    return old.unionByName(new)


CAPTIONS_SQL = """
captions AS (
  SELECT lang AS user_id, doc_id::VARCHAR AS post_id,
         CASE WHEN doc_id % 6 <> 0 THEN text ELSE 'old ' || text END AS content
  FROM documents)
"""


def tag_answers(t: Given) -> DataFrame:
    """A tag answer built from all sentences and words of each document."""
    sentences = F.split("text", r"\.")
    words = F.split("text", " ")
    kind = F.col("doc_id") % 11
    answer = F.to_json(
        F.struct(
            sentences.alias("tags"),
            (F.col("doc_id") % 3).alias("is_sponsorship"),
            F.split("text", "\n").alias("brand_name"),
            words.alias("associated_brand"),
            F.filter(words, lambda w: w.startswith("a")).alias("associated_mention"),
        )
    )
    raw = (
        F.when(kind == 7, "")
        .when(kind == 8, "no list today")
        .when(kind == 9, F.concat(F.lit("Sure, here it is: "), answer, F.lit(" Anything else?")))
        .otherwise(answer)
    )
    error = F.when(kind == 10, "429 RESOURCE_EXHAUSTED")
    content = F.when(kind == 6, "Thank you").otherwise(F.col("text"))
    return t.documents.select(
        "doc_id",
        F.col("lang").alias("user_id"),
        F.col("doc_id").cast("string").alias("post_id"),
        content.alias("content"),
        F.when(kind != 10, raw).alias("raw"),
        error.alias("error"),
    )


def phrases_sql(source: str, parts: str, words: int, dropped: tuple[str, ...], limit: int, name: str) -> str:
    """CTEs giving ``name(doc_id, items)``: normalised phrases of a list column."""
    return f"""
{name}_e AS (SELECT doc_id, unnest({parts}) AS x, generate_subscripts({parts}, 1) AS i FROM {source}),
{name}_w AS (
  SELECT doc_id, i, string_split(trim(regexp_replace(
           regexp_replace(x, '([a-z])([A-Z])', '\\1 \\2', 'g'), '[^A-Za-z0-9]+', ' ', 'g')), ' ') AS w
  FROM {name}_e),
{name}_p AS (SELECT doc_id, i, array_to_string(list_slice(w, 1, {words}), ' ') AS p FROM {name}_w),
{name}_f AS (
  SELECT doc_id, min(i) AS i, arg_min(p, i) AS p FROM {name}_p
  WHERE p <> '' AND lower(p) NOT IN {dropped} GROUP BY doc_id, lower(p)),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM {name}_f),
{name} AS (SELECT doc_id, list(p ORDER BY i) AS items FROM {name}_r WHERE rn <= {limit} GROUP BY doc_id)
"""


def handles_sql(parts: str, name: str) -> str:
    """CTEs giving ``name(doc_id, items)``: handles among the items of a list."""
    return f"""
{name}_e AS (SELECT doc_id, unnest({parts}) AS x, generate_subscripts({parts}, 1) AS i FROM documents),
{name}_b AS (SELECT doc_id, i, trim(trim(x, {SPACE_SQL}), '()[]{{}}<>"''“”‘’.,:;!?') AS h FROM {name}_e),
{name}_f AS (
  SELECT doc_id, h, min(i) AS i FROM {name}_b
  WHERE regexp_matches(h, '^[a-z0-9][a-z0-9_.-]*$') AND h NOT IN ('link', 'code') GROUP BY doc_id, h),
{name}_r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS rn FROM {name}_f),
{name} AS (SELECT doc_id, list(h ORDER BY i) AS items FROM {name}_r WHERE rn <= 30 GROUP BY doc_id)
"""
