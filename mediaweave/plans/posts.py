"""Stage A: posts of eligible channels become video documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig, scratch_path
from ..operators import candidates, ledger
from ..operators.merge import last_wins, merge
from ..operators.metrics import channel_progress
from ..sources.tables import VersionedTable, written

SET_COLUMNS = ["channel_id", "location_id", "stats"]


def channels_to_process(
    locations: DataFrame, bios: DataFrame, config: JobConfig, finished: DataFrame | None = None
) -> DataFrame:
    channels = candidates.eligible_channels(
        locations, bios, config.location_id, config.excluded_channels
    )
    if finished is None or config.reprocess:
        return channels
    key = ledger.run_key(config.location_id, config.start_date, config.end_date)
    return ledger.unfinished_channels(channels, finished, key)


def documents_to_save(channels: DataFrame, posts: DataFrame, config: JobConfig) -> DataFrame:
    """Documents of the channels' posts, copies included."""
    found = candidates.posts_in_range(
        posts, channels, config.start_date, config.end_date, config.excluded_channels
    )
    return candidates.post_documents(candidates.capped_posts(found, config.cap), config.location_id)


def one_per_video(documents: DataFrame) -> DataFrame:
    """Of several posts with one video id the newest counts."""
    dated = documents.withColumn("_at", F.col("stats.publishedAt_ts"))
    return last_wins(dated, ["video_id"], ["_at", "channel_id", "stats"]).drop("_at")


def merge_documents(videos: DataFrame, documents: DataFrame) -> DataFrame:
    return merge(videos, one_per_video(documents), ["video_id"], SET_COLUMNS)


def run(
    locations: DataFrame, bios: DataFrame, posts: DataFrame,
    videos: VersionedTable, finished: VersionedTable, config: JobConfig,
) -> DataFrame:
    """Save the posts; without a cap the channels are recorded as finished. Returns progress.

    The documents are selected once and written; what is merged and what is counted is read from there.
    """
    done_before = finished.read()
    channels = written(
        channels_to_process(locations, bios, config, done_before),
        scratch_path(videos.spark, "channels"),
    )
    documents = written(
        documents_to_save(channels, posts, config), scratch_path(videos.spark, "documents")
    )
    progress = channel_progress(channels, documents.select("channel_id"))
    videos.replace(merge_documents(videos.read(), documents))
    if config.cap == 0:
        key = ledger.run_key(config.location_id, config.start_date, config.end_date)
        now_done = channels.select(F.lit(key).alias("run_key"), "channel_id")
        finished.replace(done_before.unionByName(now_done).distinct())
    return progress
