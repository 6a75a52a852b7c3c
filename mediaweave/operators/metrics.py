"""Counts, progress, throughput and final status as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNTS = (
    "processed",
    "fetched",
    "checkpointed",
    "uploaded",
    "saved_index",
    "saved_source",
    "skipped",
    "errors",
)


def post_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("channel_id").agg(F.count("*").alias("posts"))


def channel_progress(channels: DataFrame, posts: DataFrame) -> DataFrame:
    """One row: channels, channels with saved posts, saved posts and percent done."""
    per_channel = post_counts(posts)
    joined = channels.select("channel_id").join(per_channel, "channel_id", "left")
    totals = joined.agg(
        F.count("*").alias("total_channels"),
        F.count("posts").alias("processed_channels"),
        F.coalesce(F.sum("posts"), F.lit(0)).alias("saved_posts"),
    )
    return totals.withColumn(
        "progress_pct", percent(F.col("processed_channels"), F.col("total_channels"))
    )


def percent(done: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(done / total * 100, 2)).otherwise(F.lit(0.0))


def candidate_count(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("candidates"))


def status_counts(records: DataFrame, column: str = "status") -> DataFrame:
    return records.groupBy(column).agg(F.count("*").alias("n"))


def reason_histogram(outcomes: DataFrame) -> DataFrame:
    reason = F.coalesce(F.nullif(F.col("reason"), F.lit("")), F.lit("unknown"))
    return outcomes.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


def run_counts(attempts: DataFrame, by: list[str]) -> DataFrame:
    """Run counters from one row per attempt.

    ``attempts``: status text, error text, and the flags uploaded, saved_index,
    saved_source.
    """
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    fetched = F.col("status") == "CHECKPOINTED"
    return attempts.groupBy(*by).agg(
        F.count_if(F.col("status") != "STOPPED").alias("processed"),
        F.count_if(fetched).alias("fetched"),
        F.count_if(fetched).alias("checkpointed"),
        F.count_if("uploaded").alias("uploaded"),
        F.count_if("saved_index").alias("saved_index"),
        F.count_if("saved_source").alias("saved_source"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
        F.count_if(failed).alias("errors"),
    )


def cumulative_counts(runs: DataFrame, by: list[str]) -> DataFrame:
    """Counters over all runs."""
    return runs.groupBy(*by).agg(*[F.sum(c).alias(f"cumulative_{c}") for c in COUNTS])


def rate_per_minute(done: Column, elapsed_seconds: Column) -> Column:
    return F.round(done / F.greatest(elapsed_seconds, F.lit(1)) * 60, 2)


def remaining(done: Column, total: Column, caps: tuple[int, ...] = ()) -> Column:
    target = total
    for cap in caps:
        if cap > 0:
            target = F.least(target, F.lit(cap))
    return F.greatest(F.lit(0), target - done)


def eta_seconds(done: Column, total: Column, elapsed: Column, caps: tuple[int, ...] = ()) -> Column:
    """Seconds left at the rate so far; NULL without progress."""
    rate = F.when(elapsed > 0, done / elapsed).otherwise(F.lit(0.0))
    return F.when(rate > 0, remaining(done, total, caps) / rate)


def transcript_status(stopped: Column, pending: Column, errors: Column) -> Column:
    return (
        F.when(stopped, "STOPPED_SERVER_ERROR")
        .when(pending > 0, "DONE_WITH_PENDING")
        .when(errors > 0, "DONE_WITH_ERRORS")
        .otherwise("DONE")
    )


def summary_status(stopped: Column, errors: Column) -> Column:
    return (
        F.when(stopped, "STOPPED_IMMEDIATE_ERROR")
        .when(errors > 0, "DONE_WITH_ERRORS")
        .otherwise("DONE")
    )
