"""Job settings and the Spark session settings every job relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Channels never processed.
EXCLUDED_CHANNEL_IDS = (
    "UC6of7UYhctnYmqABjUqzuxw",
    "UCiYZw0h6hA5ENlPhTZFTHTA",
    "UC0XODJg0WPxMqPA5bCGAQlw",
    "UCoAf_IAZKhnUb0AajE5VSyA",
    "UCbmZSNWyEoM2xtWhbHRPo3w",
    "UCAQsetoOYIHCbceCTJuu5sg",
    "UCW77C9aYkZv_i4Rt6cQW_kA",
    "UCU-sdeH9IMsk_IBOtIFGYFg",
    "UCpxjO7o1McAQR0XLZHxfqWg",
    "UCOsFUU8EtJGDd6-AouF_MwQ",
    "UCqz7Q8gOavVi_ZiGHePvLug",
    "UCKh2nOrPXCW4nXuhr_ZTIzg",
    "UCmMV_kEiVCf8Mgsep0Ncfqw",
    "UClNwEARJfRxBZ4hplFEHRlA",
    "UCXf8jlTSP9kp6g4ROCfgvbQ",
    "UCr_L9cZdbBU_XDsKDHBBlew",
    "UCUqHVR5kzBR4zjoof3PWP_g",
    "UCLYWo70xBDrPYJgJsxoX7Qg",
    "UCQRdJCdUVkXYPvWZ6_Omkag",
    "UCFgvtFvTFRjqhGC1XfIB02w",
    "UClRaYVzu5DIh3kRZkXIX9WA",
)

_IDENTIFIER = re.compile(r"[A-Za-z0-9_]+")


def checked_identifier(name: str) -> str:
    """Accept only plain table and column names."""
    if not name or not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


@dataclass(frozen=True)
class JobConfig:
    """Settings shared by the five stages. A cap of 0 means no cap."""

    location_id: int = 1
    start_date: str = "2025-01-01"
    end_date: str = "2025-12-31"
    excluded_channels: tuple[str, ...] = EXCLUDED_CHANNEL_IDS
    max_rows: int = 0
    max_total: int = 0
    reprocess: bool = False
    redo_failed: bool = False
    bucket: str = "transcripts"
    key_prefix: str = "transcript"
    region: str = "ap-southeast-1"
    subtitle_format: str = "srt"
    prompt_template: str = "{TRANSCRIPT}"
    embed_dim: int = 1536
    request_size: int = 100
    max_attempts: int = 3
    keep_inserted: int = -1
    model_partitions: int = 64
    requests_per_task: int = 10_000
    requests_per_commit: int = 10_000_000
    server_error_limit: int = 0

    @property
    def cap(self) -> int:
        caps = [n for n in (self.max_rows, self.max_total) if n > 0]
        return min(caps) if caps else 0


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the operators depend on.

    Timestamps are UTC.  AQE splits a hot join partition; the force flag keeps
    that split even where it costs one more shuffle further up the plan.  A
    top-N of the size left to windows is cut down before its shuffle.  Batches
    that go to Python are bounded in rows and bytes, whatever a partition holds.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action go when it has ended, not when the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, used for checkpoints and staged tables.

    It is the cluster's ``spark.checkpoint.dir``.  Only a local session without
    that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="mediaweave-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
