"""Embedding stage: validity of vectors, disposition of candidates, write outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, is_blank
from .candidates import PAIR
from .ledger import WRITE_STATUSES, next_action
from .merge import last_wins

OBJECT_ID = "^[0-9a-fA-F]{24}$"


def has_valid_vector(c: Column, dim: int) -> Column:
    return F.coalesce(F.size(c) == dim, F.lit(False))


def location_docs(docs: DataFrame, location_id: int, dim: int) -> DataFrame:
    """One document per pair of a location (the last id wins), with the vector checked.

    The stored vector itself is left behind: only its validity takes part in the join.
    """
    here = docs.filter(F.col("locationId") == location_id).select(
        *PAIR, "_id", has_valid_vector(F.col("embedding"), dim).alias("vector_stored")
    )
    return last_wins(here, PAIR, ["_id"])


def dispositions(
    texts: DataFrame, records: DataFrame, docs: DataFrame, overwrite: bool = False
) -> DataFrame:
    """Fresh lane: what happens to each pair with tags; the first rule that applies.

    ``texts``: pair, tag_text. ``records``: ledger, one row per pair.
    ``docs``: see ``location_docs``.
    """
    inserted = records.filter(F.col("status") == "inserted").select(
        *PAIR, F.lit(True).alias("_inserted")
    )
    found = texts.join(inserted, PAIR, "left").join(docs, PAIR, "left")
    stored = F.lit(False) if overwrite else F.coalesce(F.col("vector_stored"), F.lit(False))
    blank = is_blank(F.col("user_id")) | is_blank(F.col("post_id"))
    return found.select(
        *PAIR,
        "tag_text",
        F.col("_id").alias("mongo_id"),
        F.when(F.col("_inserted").isNotNull(), "checkpoint_inserted")
        .when(blank, "blank_key")
        .when(F.col("tag_text") == "", "no_text")
        .when(F.col("_id").isNull(), "mongo_doc_not_found")
        .when(stored, "embedding_exists_in_mongo")
        .otherwise("needs_embedding")
        .alias("disposition"),
    )


def retry_dispositions(
    records: DataFrame, texts: DataFrame, docs: DataFrame, overwrite: bool = False
) -> DataFrame:
    """Retry lane: the record's own text counts before the current tag text."""
    current = texts.filter(F.col("tag_text") != "").select(*PAIR, "tag_text")
    found = records.select(*PAIR, "status", "text").join(current, PAIR, "left").join(docs, PAIR, "left")
    own = clean_text(F.col("text"))
    text = F.when(own != "", own).otherwise(clean_text(F.col("tag_text")))
    stored = F.lit(False) if overwrite else F.coalesce(F.col("vector_stored"), F.lit(False))
    may_hold_vector = F.col("status").isin(*WRITE_STATUSES)
    return found.select(
        *PAIR,
        text.alias("tag_text"),
        F.col("_id").alias("mongo_id"),
        F.when(F.col("_id").isNull(), "mongo_doc_not_found")
        .when((text == "") & ~may_hold_vector, "no_text")
        .when(stored, "embedding_exists_in_mongo")
        .otherwise("needs_embedding")
        .alias("disposition"),
    )


def check_answers(answers: DataFrame, dim: int) -> DataFrame:
    """Add ``vector`` and ``error`` to staged embedding answers.

    ``answers``: pair, batch_id, n_inputs, n_vectors, embedding, error.  One bad
    vector, or a count that differs from the inputs, fails its whole request.
    """
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("embedding").isNull() & (F.col("n_vectors") == 0), "no embeddings")
        .when(
            F.col("embedding").isNotNull() & (F.size("embedding") != dim),
            F.format_string("dim mismatch: got %d expected %d", F.size("embedding"), F.lit(dim)),
        )
        .when(
            F.col("n_vectors") != F.col("n_inputs"),
            F.format_string(
                "count mismatch: got %d expected %d", F.col("n_vectors"), F.col("n_inputs")
            ),
        )
        .when(F.col("embedding").isNull(), "missing values")
    )
    judged = answers.withColumn("_reason", reason)
    failed = (
        judged.filter(F.col("_reason").isNotNull())
        .groupBy("batch_id")
        .agg(F.min("_reason").alias("_failure"))
    )
    joined = judged.join(failed, "batch_id", "left")
    return joined.select(
        *PAIR,
        "batch_id",
        F.when(F.col("_failure").isNull(), F.col("embedding")).alias("vector"),
        F.col("_failure").alias("error"),
    )


def write_outcome(records: DataFrame, docs: DataFrame) -> DataFrame:
    """Add ``write_status``: whether a record's vector can be and was written to its document."""
    ids = docs.select(F.col("_id").alias("mongo_id"), F.lit(True).alias("_found")).distinct()
    present = (
        ~is_blank(F.col("user_id"))
        & ~is_blank(F.col("post_id"))
        & ~is_blank(F.col("mongo_id"))
        & F.col("embedding").isNotNull()
    )
    joined = records.join(ids, "mongo_id", "left")
    return joined.withColumn(
        "write_status",
        F.when(~present, "missing_embedding_or_mongo_id")
        .when(~F.col("mongo_id").rlike(OBJECT_ID), "invalid_mongo_id")
        .when(F.col("_found").isNull(), "no_document_matched")
        .otherwise("inserted"),
    ).drop("_found")


def queued_records(work: DataFrame, records: DataFrame) -> DataFrame:
    """Work items with their record's state and the ``action`` still needed."""
    held = records.select(
        *PAIR, "status", "embed_retry_count", "mongo_write_retry_count", "embedding"
    )
    joined = work.join(held, PAIR, "left")
    status = F.coalesce(F.col("status"), F.lit("pending"))
    return joined.withColumns(
        {
            "status": status,
            "embed_retry_count": F.coalesce("embed_retry_count", F.lit(0)),
            "mongo_write_retry_count": F.coalesce("mongo_write_retry_count", F.lit(0)),
            "action": next_action(status, F.col("embedding").isNotNull()),
        }
    )
