"""Incremental runs: new files of a source folder, merged batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.merge import last_wins, merge
from ..sources.tables import VersionedTable, read_or_empty, remove


def run_available(
    spark: SparkSession,
    source: str,
    schema: StructType,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
    files_per_batch: int = 100,
) -> None:
    """Give all rows that arrived since the last run to ``handle`` in micro-batches.

    The stream's checkpoint is the resume position.  A batch may be given twice
    after a failure, so ``handle`` has to be idempotent, as a keyed merge is.
    """
    rows = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
    )
    query = (
        rows.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def merge_handler(
    target: VersionedTable,
    keys: list[str],
    seq: list[str],
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
    set_columns: list[str] | None = None,
    insert: bool = True,
) -> Callable[[DataFrame, int], None]:
    """A handler that merges the last row of each key into ``target``: arrival order wins."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        updates = last_wins(shape(batch), keys, seq)
        target.update(lambda old: merge(old, updates, keys, set_columns, insert))

    return handle


class DeltaTable:
    """A versioned table whose micro-batches are kept beside it until they are compacted.

    A batch writes its newest rows only, whatever the size of the table; a batch that is given
    twice replaces its own folder.  Reading takes the row with the greatest ``seq`` of each key,
    so order of arrival does not matter.
    """

    def __init__(self, base: VersionedTable, keys: list[str], seq: list[str]):
        self.base, self.keys, self.seq = base, keys, seq
        self.deltas = f"{base.path}/deltas"

    def append(self, batch: DataFrame, batch_id: int) -> None:
        names = [f.name for f in self.base.schema]
        rows = last_wins(batch.select(names), self.keys, self.seq)
        rows.write.mode("overwrite").parquet(f"{self.deltas}/batch={batch_id}")

    def read(self) -> DataFrame:
        schema = StructType([*self.base.schema.fields, StructField("batch", LongType())])
        late = read_or_empty(self.base.spark, self.deltas, schema).drop("batch")
        return last_wins(self.base.read().unionByName(late), self.keys, self.seq)

    def compact(self) -> DataFrame:
        """Fold the batches into the table's next version; no stream may be writing."""
        merged = self.base.replace(self.read())
        remove(self.base.spark, self.deltas)
        return merged

    def handler(self, shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> Callable[[DataFrame, int], None]:
        return lambda batch, batch_id: self.append(shape(batch), batch_id)


def newest_handler(
    target: VersionedTable,
    keys: list[str],
    seq: list[str],
    shape: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> Callable[[DataFrame, int], None]:
    """A handler for files that may arrive out of order: the row with the greatest
    ``seq`` wins, wherever it is."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = shape(batch)
        target.update(lambda old: last_wins(old.unionByName(rows), keys, seq))

    return handle
