"""The stages of the corpus pipeline: (spark, docs, folder) to the rows that go on.

All but the last return the columns they are given, extra ones included, whatever their names.
Null texts count as empty ones, null ids and sources are values of their own, repeated rows are
rows each unless a stage says otherwise, and no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import minhash, secret_scan
from . import mixing as mixing_operator
from . import packing as packing_operator
from . import quality as quality_operator
from .common import prepare, table
from .token_ids import tokenizer_path

#: Bytes of a batch to or from Python.  A task holds several copies of one outside the heap, and
#: an executor that ran one stage after the other keeps what its largest batches took.
BATCH_BYTES = 1 << 20


def small_batches(spark: SparkSession) -> None:
    """The operators' session options, with smaller batches: stages follow each other on the same executors."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the classifier, fitted on the labels of these documents, accepts.

    Without a label of these documents all stay.  Rows of equal texts go or stay together.
    """
    labels = table(spark, folder, "labels")
    small_batches(spark)
    return quality_operator.good_documents(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest doc_id (null last).

    Rows that repeat text and id are one class; of several equal in both one stays.  Empty texts
    are one class, as are texts that are equal without holding a word.
    """
    small_batches(spark)
    return minhash.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document, its secrets replaced by a mark; null texts stay null, n_chars follows the text."""
    small_batches(spark)
    return secret_scan.redacted(docs)


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents as the mix takes them: left out, once or twice.  Texts without words are left out."""
    small_batches(spark)
    return mixing_operator.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents and their places in sequences; an empty text is one piece, its end id."""
    small_batches(spark)
    return packing_operator.packed(docs, tokenizer_path())
