"""First-N and running totals over a total order, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..config import shared_dir

# Up to this many rows a top-N is left to the built-in sort-and-limit.
SMALL_LIMIT = 10_000
_ROW_BITS = 1 << 33


def _partition_offsets(placed: DataFrame, total: Column) -> DataFrame:
    """Rows before each range partition: one row per partition, so a plain window is enough."""
    sums = placed.groupBy("_part").agg(total.alias("_sum"))
    before = F.sum("_sum").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    return sums.select("_part", F.coalesce(before, F.lit(0)).alias("_offset"))


def _best(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """A superset of the first ``limit`` rows: the first of each of a few buckets.

    Every task sends at most ``limit`` rows to its bucket and every bucket passes
    on at most ``limit``, so the last step does not depend on the number of tasks.
    """
    buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_bucket", F.spark_partition_id() % buckets)
    rank = F.row_number().over(W.partitionBy("_bucket").orderBy(*order))
    return placed.withColumn("_rank", rank).filter(F.col("_rank") <= limit).select(df.columns)


def _placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows range-partitioned and sorted, their place fixed by a checkpoint.

    The row number taken from a first checkpoint makes every sort key unique,
    so copies of one row spread over partitions like any other rows.
    """
    spark = df.sparkSession
    shared_dir(spark)
    numbered = df.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        numbered.repartitionByRange(parts, *order, F.col("_row"))
        .sortWithinPartitions(*order, F.col("_row"))
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() % _ROW_BITS)
        .checkpoint()
    )


def first_rows(
    df: DataFrame, order: list[Column], limit: int | Column, bound: int | None = None
) -> DataFrame:
    """Exactly the first ``limit`` rows of ``df`` in ``order``.

    ``limit`` may be a column that is the same on all rows; ``bound`` is then
    its largest possible value.
    """
    most = limit if isinstance(limit, int) else bound
    if most is not None and most <= SMALL_LIMIT:
        top = _best(df, order, most).orderBy(*order).limit(most)
        if isinstance(limit, int):
            return top
        numbered = top.withColumn("_pos", F.row_number().over(W.orderBy(*order)))
        return numbered.filter(F.col("_pos") <= limit).drop("_pos")
    placed = _placed(df, order)
    offsets = _partition_offsets(placed, F.count("*"))
    kept = placed.join(F.broadcast(offsets), "_part").filter(
        F.col("_offset") + F.col("_pos") < limit
    )
    return kept.select(df.columns)


def running_total(df: DataFrame, order: list[Column], weight: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over all rows before this one."""
    placed = _placed(df, order)
    offsets = _partition_offsets(placed, F.sum(weight))
    inside = F.sum(weight).over(
        W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, -1)
    )
    total = placed.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(
        F.broadcast(offsets), "_part"
    )
    return total.withColumn(name, F.col("_offset") + F.col("_inside")).select(*df.columns, name)


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add ``name``: the row's place from 0 in ``order``, fixed by a checkpoint."""
    placed = _placed(df, order)
    offsets = _partition_offsets(placed, F.count("*"))
    found = placed.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_offset") + F.col("_pos"))
    return found.select(*df.columns, name)


def first_rows_by_group(
    df: DataFrame, group: str, order: list[Column], limit: int, small: int = SMALL_LIMIT
) -> DataFrame:
    """The first ``limit`` rows in the order (group, ``order``).

    Groups before the cut pass whole through a lookup join; only the one group
    the cut falls into is sorted.
    """
    sizes = df.groupBy(group).agg(F.count("*").alias("_size"))
    if limit <= small:
        # every group has a row, so no group beyond the first `limit` can take part
        near = _best(sizes, [F.col(group)], limit).orderBy(group).limit(limit)
        before = F.sum("_size").over(W.orderBy(group).rowsBetween(W.unboundedPreceding, -1))
        totals = near.withColumn("_before", F.coalesce(before, F.lit(0)))
    else:
        totals = running_total(sizes, [F.col(group)], "_size", "_before")
    quota = totals.filter(F.col("_before") < limit).select(
        group,
        F.least(F.col("_size"), F.lit(limit) - F.col("_before")).alias("_quota"),
        (F.col("_size") + F.col("_before") > limit).alias("_cut"),
    )
    # up to `limit` groups hold a quota: few enough to broadcast on the small path
    taken = df.join(F.broadcast(quota) if limit <= small else quota, group)
    whole = taken.filter(~F.col("_cut"))
    cut = first_rows(
        taken.filter("_cut"), order, F.col("_quota"), limit if limit <= small else None
    )
    return whole.unionByName(cut).drop("_quota", "_cut")
