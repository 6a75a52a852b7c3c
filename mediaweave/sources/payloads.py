"""Transcript objects: JSON text in a shared folder."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.responses import is_object, strict_json, text_or_blank
from ..operators.merge import last_wins
from ..functions.text import clean_text, object_key, object_location, object_url

PAYLOAD_FIELDS = ("video_id", "language_code", "language_name", "format", "content", "error")
OBJECT_KEY = ["bucket", "s3_key"]
STORED_OBJECT = "bucket string, s3_key string, written_at string, body string"
READ_FIELDS = ("content", "language_code", "language_name", "format")


def payload_rows(captions: DataFrame) -> DataFrame:
    """The six trimmed fields of an object."""
    return captions.select([clean_text(F.col(c)).alias(c) for c in PAYLOAD_FIELDS])


def with_object_url(df: DataFrame, config: JobConfig) -> DataFrame:
    key = object_key(F.col("video_id"), config.key_prefix)
    return df.withColumn("s3_key", key).withColumn(
        "s3_url", object_url(F.col("s3_key"), config.bucket, config.region)
    )


def write_payloads(captions: DataFrame, path: str, config: JobConfig, now: Column | None = None) -> None:
    """Objects as rows (bucket, s3_key, written_at, body), many per file; the body is JSON text."""
    at = F.date_format(F.current_timestamp() if now is None else now, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    rows = with_object_url(payload_rows(captions), config)
    rows.select(
        F.lit(config.bucket).alias("bucket"), "s3_key", at.alias("written_at"),
        F.to_json(F.struct(*PAYLOAD_FIELDS)).alias("body"),
    ).write.mode("append").parquet(path)


def stored_objects(spark: SparkSession, path: str) -> DataFrame:
    """Every object written by ``write_payloads``, unread."""
    return spark.read.schema(STORED_OBJECT).parquet(path)


def newest_objects(stored: DataFrame) -> DataFrame:
    """The newest of each key, parsed."""
    newest = last_wins(stored, OBJECT_KEY, ["written_at", "body"], drop_seq=False)
    return _payload_columns(newest.select(*OBJECT_KEY, strict_json(F.col("body")).alias("_v")))


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Objects written by ``write_payloads``: the newest of each key."""
    return newest_objects(stored_objects(spark, path))


def read_object_files(spark: SparkSession, path: str, bucket: str, prefix: str = "") -> DataFrame:
    """Objects stored one per file below ``path``, keyed by ``prefix`` and their place below it.

    A file that is not a JSON object is not ``readable`` and has blank fields.
    """
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True)
    file = F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), "^[a-z0-9]+:/*", "/")
    root = re.sub("^[a-z0-9]+:/*", "/", path).rstrip("/") + "/"
    below = F.substring_index(file, root, -1)
    return _payload_columns(
        files.select(
            F.lit(bucket).alias("bucket"),
            F.concat(F.lit(f"{prefix.strip('/')}/" if prefix.strip("/") else ""), below).alias("s3_key"),
            strict_json(clean_text(F.col("value"))).alias("_v"),
        )
    )


def _payload_columns(df: DataFrame) -> DataFrame:
    readable = F.coalesce(is_object(F.col("_v")), F.lit(False))

    def field(name: str):
        value = text_or_blank(F.try_variant_get(F.col("_v"), f"$.{name}", "variant"))
        return F.when(readable, value).otherwise("")

    return df.select(*OBJECT_KEY, readable.alias("readable"), *[field(c).alias(c) for c in READ_FIELDS])


def locate_objects(index: DataFrame, config: JobConfig) -> DataFrame:
    """Index rows with the bucket and key their URL points to."""
    place = object_location(F.col("s3_url"), F.col("video_id"), config.bucket, config.key_prefix)
    return index.withColumn("_place", place).withColumns(
        {"bucket": F.col("_place.bucket"), "s3_key": F.col("_place.key")}
    ).drop("_place")


def wanted_objects(stored: DataFrame, index: DataFrame, config: JobConfig) -> DataFrame:
    """The stored objects that index rows point to, so that no other is parsed."""
    wanted = locate_objects(index, config).select(*OBJECT_KEY).distinct()
    return stored.join(wanted, OBJECT_KEY, "left_semi")


def attach_transcripts(index: DataFrame, objects: DataFrame, config: JobConfig) -> DataFrame:
    """Index rows with their object's content and, where it cannot be used, why.

    ``object_error`` is OBJECT_NOT_FOUND without an object in that bucket and
    INVALID_OBJECT for one that is no JSON object; the content is then NULL.
    """
    located = locate_objects(index, config)
    found = objects.select(*OBJECT_KEY, "readable", "content")
    joined = located.join(found, OBJECT_KEY, "left")
    error = F.when(F.col("readable").isNull(), "OBJECT_NOT_FOUND").when(~F.col("readable"), "INVALID_OBJECT")
    content = F.when(F.col("readable"), F.col("content"))
    return joined.withColumns({"object_error": error, "content": content}).drop("readable")
