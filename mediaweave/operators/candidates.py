"""Which rows each stage works on: filters, anti-joins and newest-row lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    clean_text,
    epoch_millis_to_iso,
    is_blank,
    join_tags,
    let,
    parse_list_text,
)
from ..schemas import COUNTERS
from .lookups import BROADCAST_ROWS, checked_lookup, perhaps_among
from .merge import last_wins
from .ranking import SMALL_LIMIT, first_rows, first_rows_by_group

PAIR = ["user_id", "post_id"]
# Transcript languages that are summarised.
SUMMARY_LANGUAGES = ("en", "a.en")
# Fixed value: quote characters in the text of ten single-quoted tags.
TEN_TAGS_QUOTES = 20

# -- posts --------------------------------------------------------------------


def eligible_channels(
    locations: DataFrame, bios: DataFrame, location_id: int, excluded: tuple[str, ...]
) -> DataFrame:
    """Distinct channel ids of a location that look like channels and have a bio."""
    channel = F.col("youtube_channel_id")
    wanted = (F.col("locationId") == location_id) & channel.rlike("^UC")
    if excluded:
        wanted = wanted & ~channel.isin(*excluded)
    here = locations.filter(wanted).select(channel.alias("channel_id")).distinct()
    return here.join(bios.select("channel_id").distinct(), "channel_id", "left_semi")


def day_range_millis(start_date: str, end_date: str) -> tuple[Column, Column]:
    """First and last instant of a date range; the last second counts only at its start."""
    return (
        F.unix_millis(F.to_timestamp(F.lit(f"{start_date}T00:00:00.000Z"))),
        F.unix_millis(F.to_timestamp(F.lit(f"{end_date}T23:59:59.000Z"))),
    )


def posts_in_range(
    posts: DataFrame,
    channels: DataFrame,
    start_date: str,
    end_date: str,
    excluded: tuple[str, ...] = (),
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Posts of the given channels published in the range."""
    first, last = day_range_millis(start_date, end_date)
    wanted = F.col("publishedAt").between(first, last)
    if excluded:
        wanted = wanted & ~F.col("channel_id").isin(*excluded)
    recent = posts.filter(wanted).select("channel_id", "video_id", "publishedAt", *COUNTERS)
    return checked_lookup(recent, channels, ["channel_id"], "left_semi", broadcast_rows)


def newest_first() -> list[Column]:
    """A total order: posts that tie on time and id are ordered by their counters."""
    return [F.col("publishedAt").desc(), F.col("video_id").asc(), *[F.col(c).asc() for c in COUNTERS]]


def capped_posts(posts: DataFrame, cap: int, small: int = SMALL_LIMIT) -> DataFrame:
    """The first ``cap`` posts by channel, newest first; 0 keeps all."""
    if cap <= 0:
        return posts
    return first_rows_by_group(posts, "channel_id", newest_first(), cap, small)


def post_documents(posts: DataFrame, location_id: int) -> DataFrame:
    stats = F.struct(
        epoch_millis_to_iso(F.col("publishedAt")).alias("publishedAt"),
        F.col("publishedAt").alias("publishedAt_ts"),
        *COUNTERS,
    )
    return posts.select(
        "channel_id", "video_id", F.lit(location_id).alias("location_id"), stats.alias("stats")
    )


# -- transcripts and summaries ------------------------------------------------


def videos_with_id(videos: DataFrame) -> DataFrame:
    """Source videos; an empty id passes, a missing one does not."""
    return videos.filter(F.col("video_id").isNotNull())


def videos_marked_done(
    videos: DataFrame, index: DataFrame, reprocess: bool = False, redo_failed: bool = False
) -> DataFrame:
    """Add ``done``: the index already holds an object for the video.

    ``redo_failed`` also redoes videos whose stored object records an error.
    """
    if reprocess:
        return videos.withColumn("done", F.lit(False))
    finished = index.filter(~is_blank(F.col("s3_url")))
    if redo_failed:
        finished = finished.filter(is_blank(F.col("error")))
    finished = finished.select("video_id").distinct().withColumn("_done", F.lit(True))
    marked = videos.join(finished, "video_id", "left")
    return marked.withColumn("done", F.col("_done").isNotNull()).drop("_done")


def videos_to_fetch(
    videos: DataFrame, index: DataFrame, reprocess: bool = False, redo_failed: bool = False
) -> DataFrame:
    wanted = videos_with_id(videos)
    if reprocess:
        return wanted
    finished = index.filter(~is_blank(F.col("s3_url")))
    if redo_failed:
        finished = finished.filter(is_blank(F.col("error")))
    return wanted.join(finished.select("video_id").distinct(), "video_id", "left_anti")


def transcripts_to_summarise(
    index: DataFrame, summaries: DataFrame, reprocess: bool = False
) -> DataFrame:
    usable = (
        (F.col("video_id") != "")
        & (F.col("s3_url") != "")
        & F.col("language_code").isin(*SUMMARY_LANGUAGES)
    )
    wanted = index.filter(usable)
    if reprocess:
        return wanted
    return wanted.join(summaries.select("video_id").distinct(), "video_id", "left_anti")


# -- posts to tag -------------------------------------------------------------


def posts_with_keys(docs: DataFrame, location_id: int) -> DataFrame:
    """Documents of a location with both ids, trimmed."""
    trimmed = docs.filter(F.col("locationId") == location_id).select(
        "_id", *[clean_text(F.col(c)).alias(c) for c in PAIR]
    )
    return trimmed.filter((F.col("user_id") != "") & (F.col("post_id") != ""))


def without_tags(docs: DataFrame, tags: DataFrame, dead: DataFrame | None = None) -> DataFrame:
    """Pairs that have no tag row yet and have not been given up."""
    todo = docs.join(tags.select(*PAIR).distinct(), PAIR, "left_anti")
    return todo if dead is None else todo.join(dead.select(*PAIR).distinct(), PAIR, "left_anti")


def with_tags(docs: DataFrame, tags: DataFrame) -> DataFrame:
    return docs.join(tags.select(*PAIR).distinct(), PAIR, "left_semi")


def latest_captions(
    posts: DataFrame, tiebreak: list[str] | None = None, wanted: DataFrame | None = None
) -> DataFrame:
    """Newest caption per pair; undated rows come last, a missing caption is empty.

    With ``wanted`` only the captions of its pairs are gathered, however long the history is: the
    newest dates are found without the texts, and most other texts are left out before the shuffle.
    """
    trimmed = posts.select(
        clean_text(F.col("ig_user_id").cast("string")).alias("user_id"),
        clean_text(F.col("ig_post_id").cast("string")).alias("post_id"),
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        "postDate",
        *(tiebreak or []),
    ).filter((F.col("user_id") != "") & (F.col("post_id") != ""))
    if wanted is not None:
        pairs = wanted.select(*[clean_text(F.col(c).cast("string")).alias(c) for c in PAIR]).distinct()
        dated = trimmed.select(*PAIR, "postDate").join(pairs, PAIR, "left_semi")
        newest = dated.groupBy(*PAIR).agg(F.max("postDate").alias("postDate"))
        # a semi join would be pushed below the look-up, and every text be shuffled again
        trimmed = perhaps_among(trimmed, [*PAIR, "postDate"], newest).join(pairs, PAIR)
    order = ["postDate", *(tiebreak or ["content"])]
    return last_wins(trimmed, PAIR, order).select(*PAIR, "content")


def keyed_posts(docs: DataFrame) -> DataFrame:
    """Trimmed keys; rows with a blank one go."""
    trimmed = docs.withColumns({c: clean_text(F.col(c)) for c in PAIR})
    return trimmed.filter((F.col("user_id") != "") & (F.col("post_id") != ""))


def attach_captions(docs: DataFrame, captions: DataFrame) -> DataFrame:
    """Left join to the newest captions; documents keep their copies, blank keys go."""
    joined = keyed_posts(docs).join(captions.select(*PAIR, "content"), PAIR, "left")
    return joined.withColumn("content", F.coalesce("content", F.lit("")))


def pairs_with_captions(pairs: DataFrame, captions: DataFrame) -> DataFrame:
    """Distinct pairs as documents without an id, with their newest caption."""
    distinct = pairs.select(*[clean_text(F.col(c)).alias(c) for c in PAIR]).distinct()
    return attach_captions(distinct.withColumn("_id", F.lit("")), captions)


def is_bad_tag_text(c: Column) -> Column:
    """Missing tags, or not exactly ten single-quoted ones."""

    def bad(t: Column) -> Column:
        quotes = F.length(t) - F.length(F.replace(t, F.lit("'"), F.lit("")))
        return F.coalesce(t.isin("", "[]") | (quotes != TEN_TAGS_QUOTES), F.lit(True))

    return let(c, bad)


def bad_tag_pairs(tags: DataFrame) -> DataFrame:
    return tags.filter(is_bad_tag_text(F.col("topic_tags"))).select(
        *[F.col(c).cast("string").alias(c) for c in PAIR]
    )


# -- tags to embed ------------------------------------------------------------


def has_tag_text(c: Column) -> Column:
    return ~F.coalesce(c, F.lit("")).isin("", "[]")


def tag_texts(tags: DataFrame) -> DataFrame:
    """Trimmed pair and the one text its tags make (possibly empty)."""
    stored = tags.filter(has_tag_text(F.col("topic_tags")))
    return parse_list_text(stored, "topic_tags", "_tags").select(
        *[clean_text(F.col(c).cast("string")).alias(c) for c in PAIR],
        join_tags(F.col("_tags")).alias("tag_text"),
    )


# -- pages --------------------------------------------------------------------


def behind_key(columns: list[str], last: list) -> Column:
    """Whether a row is behind a resume key, compared column by column (text ids as text)."""
    behind = F.lit(False)
    equal = F.lit(True)
    for name, value in zip(columns, last):
        behind = behind | (equal & (F.col(name) > value))
        equal = equal & (F.col(name) == value)
    return behind


def after_key(df: DataFrame, columns: list[str], last: list | None) -> DataFrame:
    """Rows behind a resume key; all without one."""
    return df if last is None else df.filter(behind_key(columns, last))


def key_page(df: DataFrame, columns: list[str], last: list | None, size: int) -> DataFrame:
    """The next ``size`` rows in key order behind ``last``; 0 takes all."""
    rest = after_key(df, columns, last)
    return rest if size <= 0 else first_rows(rest, [F.col(c).asc() for c in columns], size)
