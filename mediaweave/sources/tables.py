"""Readers for the stores, and keyed tables kept as versions in a shared folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..config import checked_identifier, shuffles_dropped


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet with a declared schema: no inference, missing columns are NULL."""
    return spark.read.schema(schema).parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """As ``read_parquet``; a table that does not exist yet has no rows."""
    try:
        return read_parquet(spark, path, schema)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, which Spark knows when it plans: the other side of a join is not shuffled."""
    return spark.createDataFrame([], schema).limit(0)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    columns: list[str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Relational scan of some columns, split into ranges of an integer key.

    Filters on the result are pushed into the database by Spark.
    """
    reader = spark.read.format("jdbc").options(**(options or {}))
    reader = reader.option("url", url).option("dbtable", checked_identifier(table))
    if split_on and bounds:
        reader = (
            reader.option("partitionColumn", checked_identifier(split_on))
            .option("lowerBound", str(bounds[0]))
            .option("upperBound", str(bounds[1]))
            .option("numPartitions", str(partitions))
        )
    return reader.load().select(*[checked_identifier(c) for c in columns])


def read_connector(
    spark: SparkSession, source: str, options: dict[str, str], schema: StructType
) -> DataFrame:
    """Scan through an installed connector (document store, search index) with a declared
    schema, so that only its columns are fetched and filters can be pushed down."""
    return spark.read.format(source).schema(schema).options(**options).load()


def write_connector(df: DataFrame, sink: str, options: dict[str, str]) -> None:
    df.write.format(sink).mode("append").options(**options).save()


def save(df: DataFrame, path: str, mode: str) -> None:
    """Parquet in zstd: an answer repeats its text, and only a codec that sees further back than a
    few kB shortens that."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back: later steps start from the files instead of
    computing it again.  A rerun replaces what a lost run left there."""
    save(df, path, "overwrite")
    return read_parquet(df.sparkSession, path, df.schema)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system; a missing one is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def as_schema(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


class GivenTable:
    """Rows that lie elsewhere, for a job that only reads them: they are not copied."""

    def __init__(self, rows: DataFrame, schema: StructType):
        self.rows, self.schema = as_schema(rows, schema), schema

    def read(self) -> DataFrame:
        return self.rows


class VersionedTable:
    """A keyed table whose every state is a folder of its own.

    A reader takes the newest version that has been committed; a version is
    committed by a one-row append after its files are complete, so a lost
    driver or executor leaves the previous state in place.  The path being read
    is never overwritten.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema

    def version(self) -> int:
        """Newest committed version, 0 before the first."""
        commits = read_or_empty(
            self.spark, f"{self.path}/commits", StructType().add("version", LongType())
        )
        return commits.agg(F.max("version")).first()[0] or 0

    def read(self) -> DataFrame:
        """The current state; empty with the declared schema before the first write."""
        version = self.version()
        if version == 0:
            return empty(self.spark, self.schema)
        return read_parquet(self.spark, f"{self.path}/v{version}", self.schema)

    def replace(self, df: DataFrame) -> DataFrame:
        """Write ``df`` as the next version and return it as read back."""
        version = self.version() + 1
        # overwrite: files of a write that never got its commit
        save(as_schema(df, self.schema), f"{self.path}/v{version}", "overwrite")
        commit = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"))
        commit.coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        return read_parquet(self.spark, f"{self.path}/v{version}", self.schema)

    def vacuum(self, keep: int = 2) -> None:
        """Delete all versions but the newest ``keep`` (one at least); no reader may be on them."""
        version = self.version()
        for old in range(version - max(keep, 1), 0, -1):
            remove(self.spark, f"{self.path}/v{old}")

    def update(self, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Replace the state by ``change(state)``."""
        return self.replace(change(self.read()))


class StagedResults:
    """Answers of outside services, appended once per request and never recomputed."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.schema)

    def append(self, df: DataFrame) -> None:
        save(df.select([f.name for f in self.schema]), self.path, "append")
