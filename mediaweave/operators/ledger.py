"""Work ledgers: failed keys, dead keys, finished work, embedding records."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, is_blank, strip
from .candidates import PAIR
from .merge import keyed_union
from .ranking import first_rows

RETRY_STATUSES = ("failed_embed", "embedded", "failed_mongo_write")
WRITE_STATUSES = ("embedded", "failed_mongo_write")

# -- failed and dead keys -----------------------------------------------------


def distinct_keys(df: DataFrame, seq: str) -> DataFrame:
    """First spelling of each key, compared without case; blank keys go."""
    keyed = df.select(strip(F.col("key")).alias("key"), seq).filter(~is_blank(F.col("key")))
    firsts = keyed.groupBy(F.lower("key").alias("_k")).agg(
        F.min_by("key", F.struct(seq, "key")).alias("key")
    )
    return firsts.select("key")


def count_attempts(previous: DataFrame, failures: DataFrame, max_attempts: int) -> DataFrame:
    """Ledger after new failures: attempts summed per key, dead from ``max_attempts`` on.

    ``previous`` is the ledger (key, attempts, state), ``failures`` has one row
    per failed attempt.
    """
    new = failures.select(strip(F.col("key")).alias("key")).filter(F.col("key") != "")
    counted = previous.select("key", "attempts").unionByName(new.withColumn("attempts", F.lit(1)))
    total = counted.groupBy("key").agg(F.sum("attempts").cast("int").alias("attempts"))
    return total.withColumn(
        "state", F.when(F.col("attempts") >= max_attempts, "dead").otherwise("failed")
    )


def keys_in_state(ledger: DataFrame, state: str) -> DataFrame:
    return ledger.filter(F.col("state") == state)


def clear_finished(ledger: DataFrame, finished: DataFrame, keys: list[str]) -> DataFrame:
    """Drop ledger rows whose work has succeeded since."""
    return ledger.join(finished.select(*keys).distinct(), keys, "left_anti")


def record_failures(ledger: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """Failed-video ledger after a run: errors recorded or replaced, successes cleared.

    ``outcomes`` has one row per processed video with its error text.
    """
    bad = outcomes.filter(~is_blank(F.col("error"))).select(
        "video_id", "error", now.cast("string").alias("updated_at")
    )
    good = outcomes.filter(is_blank(F.col("error")))
    kept = clear_finished(ledger, good, ["video_id"])
    return keyed_union(kept, bad, ["video_id"], ["updated_at", "error"])


def capped_work(todo: DataFrame, failures: DataFrame, order: str, cap: int) -> DataFrame:
    """The next ``cap`` open videos (0: all); those that failed before come last, so that
    a capped run always gets on."""
    if cap <= 0:
        return todo
    failed = failures.select("video_id").distinct().withColumn("_failed", F.lit(1))
    marked = todo.join(failed, "video_id", "left").withColumn("_failed", F.coalesce("_failed", F.lit(0)))
    return first_rows(marked, [F.col("_failed").asc(), F.col(order).asc()], cap).drop("_failed")


def last_place(outcomes: DataFrame, place: str, ok: Column, cap: int) -> int | None:
    """The place of the ``cap``-th success, None if there are fewer.  Only one number is collected."""
    hits = first_rows(outcomes.filter(ok).select(place), [F.col(place).asc()], cap)
    found = hits.agg(F.count("*").alias("n"), F.max(place).alias("place")).first()
    return found["place"] if found["n"] >= cap else None


def until_successes(outcomes: DataFrame, place: str, ok: Column, cap: int) -> DataFrame:
    """The outcomes up to the ``cap``-th success in the order of ``place`` (0: all).

    What lies behind it was not reached by a run that counts successes, whatever its outcome.
    """
    last = None if cap <= 0 else last_place(outcomes, place, ok, cap)
    return outcomes if last is None else outcomes.filter(F.col(place) <= last)


def success_pages(cap: int, total: int) -> Iterator[tuple[int, int]]:
    """Ranges of places to try one after the other until enough have succeeded, each twice the last."""
    low, size = 0, max(cap, 1)
    while low < total:
        yield low, min(low + size, total)
        low, size = low + size, 2 * size


# -- positions ----------------------------------------------------------------


def run_key(location_id: int, start_date: str, end_date: str) -> str:
    """Identifies the parameters a list of finished channels belongs to."""
    return f"{location_id}|{start_date}|{end_date}"


def unfinished_channels(channels: DataFrame, finished: DataFrame, key: str) -> DataFrame:
    """Channels not finished under the same parameters; other parameters start anew."""
    done = finished.filter(F.col("run_key") == key).select("channel_id").distinct()
    return channels.join(done, "channel_id", "left_anti")


def high_water(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the greatest key of ``df``."""
    return high_waters(df, columns)


def high_waters(df: DataFrame, *keys: list[str]) -> DataFrame:
    """One row: the greatest of each of several keys, in one pass."""
    tops = df.agg(*[F.max(F.struct(*columns)).alias(f"_top{n}") for n, columns in enumerate(keys)])
    return tops.select(*[F.col(f"_top{n}.{c}").alias(c) for n, columns in enumerate(keys) for c in columns])


def retry_and_fresh(retry: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """Both lanes in one pass; a key in both is taken from the retry lane."""
    only_fresh = fresh.join(retry.select(*keys).distinct(), keys, "left_anti")
    return retry.withColumn("lane", F.lit("retry")).unionByName(
        only_fresh.withColumn("lane", F.lit("fresh"))
    )


# -- embedding records --------------------------------------------------------


def retryable_records(records: DataFrame, statuses: tuple[str, ...] = RETRY_STATUSES) -> DataFrame:
    keyed = ~is_blank(F.col("user_id")) & ~is_blank(F.col("post_id"))
    return records.filter(F.col("status").isin(*statuses) & keyed)


def newest_inserted(records: DataFrame, keep: int) -> DataFrame:
    """The ``keep`` newest inserted records by time, then key, both descending."""
    order = [F.coalesce("updated_at", F.lit(0)).desc(), *[F.col(c).desc() for c in PAIR]]
    return first_rows(records.filter(F.col("status") == "inserted"), order, keep)


def prune_inserted(records: DataFrame, keep: int) -> DataFrame:
    """Ledger without the inserted records beyond the newest ``keep``; negative keeps all."""
    if keep < 0:
        return records
    rest = records.filter(F.coalesce(F.col("status"), F.lit("")) != "inserted")
    return rest.unionByName(newest_inserted(records, keep))


def next_action(status: Column, has_vector: Column) -> Column:
    """What a queued record still needs."""
    return (
        F.when(status == "inserted", "skip")
        .when(status.isin(*WRITE_STATUSES) & has_vector, "write")
        .otherwise("embed")
    )


def record_key_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: clean_text(F.col(c)) for c in PAIR})
