"""Counters of all runs of all stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.merge import merge
from ..operators.metrics import COUNTS, cumulative_counts
from ..sources.tables import VersionedTable


def record_run(runs: VersionedTable, counts: DataFrame, stage: str, run_id: str) -> None:
    """Enter a run's counters; entering the same run again replaces them."""
    row = counts.select(
        F.lit(run_id).alias("run_id"), F.lit(stage).alias("stage"), *COUNTS, "status"
    )
    runs.update(lambda old: merge(old, row, ["run_id", "stage"]))


def cumulative(runs: VersionedTable) -> DataFrame:
    """Counters of each stage over all its runs."""
    return cumulative_counts(runs.read(), ["stage"])
