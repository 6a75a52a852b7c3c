"""The corpus pipeline: five stages from raw documents to packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediaweave.llm import stages
from mediaweave.llm.common import prepare, stored

STAGES = [
    ("quality classifier", stages.quality),
    ("near-duplicates", stages.near_duplicates),
    ("secret scans", stages.secrets),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

#: The classifier and the packer are not expressible in SQL; tests/llm compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again before the next."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
