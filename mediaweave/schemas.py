"""Fixed schemas of the tables, declared once."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in columns.items()])


S, I, L, D, T = StringType(), IntegerType(), LongType(), DoubleType(), TimestampType()
COUNTERS = ("likeCount", "dislikeCount", "commentCount", "viewCount", "favoriteCount")

CHANNEL_LOCATION = _table(youtube_channel_id=S, locationId=I)
CHANNEL_BIOS = _table(channel_id=S)
POSTS = _table(channel_id=S, video_id=S, publishedAt=L, **{name: L for name in COUNTERS})
STATS = _table(publishedAt=S, publishedAt_ts=L, **{name: L for name in COUNTERS})
VIDEO = _table(
    _id=S, channel_id=S, video_id=S, location_id=I, stats=STATS, srt_id=I, srt_updated_at=T
)
CAPTIONS_RESPONSE = _table(video_id=S, request_hash=S, status=I, body=S, error=S)
TRANSCRIPT_PAYLOAD = _table(
    video_id=S, language_code=S, language_name=S, format=S, content=S, error=S
)
TRANSCRIPT_INDEX = _table(
    id=L, video_id=S, language_code=S, s3_url=S, error=S, created_at=T, updated_at=T
)
VIDEO_SUMMARY = _table(
    video_id=S,
    video_title=S,
    brand_mentioned=ArrayType(S),
    product_mentioned=ArrayType(S),
    topic_tags=ArrayType(S),
    summary=S,
    key_topics=S,
    is_sponsorship=I,
    sponsorship_name=ArrayType(S),
    error=S,
    updated_at=T,
)
IG_POST = _table(ig_user_id=S, ig_post_id=S, content=S, postDate=T)
IG_DOC = _table(_id=S, user_id=S, post_id=S, locationId=I, embedding=ArrayType(D))
TOPIC_TAGS = _table(
    user_id=S,
    post_id=S,
    topic_tags=S,
    is_sponsorship=I,
    brand_name=S,
    associated_brand=S,
    associated_mention=S,
)
EMBEDDING_RECORD = _table(
    user_id=S,
    post_id=S,
    mongo_id=S,
    status=S,
    embed_retry_count=I,
    mongo_write_retry_count=I,
    last_error=S,
    text=S,
    embedding=ArrayType(D),
    updated_at=L,
)
TAG_FAILURE = _table(key=S, attempts=I, state=S)
FAILED_VIDEO = _table(video_id=S, error=S, updated_at=S)
SINK_STATUS = _table(video_id=S, sink=S, run=I, status=S, error=S)
RUN_COUNTERS = _table(
    run_id=S,
    stage=S,
    processed=L,
    fetched=L,
    checkpointed=L,
    uploaded=L,
    saved_index=L,
    saved_source=L,
    skipped=L,
    errors=L,
    status=S,
)
FINISHED_CHANNEL = _table(run_key=S, channel_id=S)
