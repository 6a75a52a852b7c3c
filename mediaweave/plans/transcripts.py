"""Stage B: captions of videos without a transcript, saved to three places."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..config import JobConfig
from ..functions.responses import with_captions
from ..functions.text import caption_class, clean_text, is_blank, stored_caption_class
from ..operators import candidates, ledger
from ..operators.merge import merge
from ..operators.metrics import run_counts, transcript_status
from ..schemas import CAPTIONS_RESPONSE
from ..sources.clients import (
    ClientFactory,
    best_answers,
    fetch_captions,
    request_hash,
    stage_once,
)
from ..sources.payloads import with_object_url, write_payloads
from ..sources.tables import StagedResults, VersionedTable, read_or_empty, written

INDEX_COLUMNS = ["language_code", "s3_url", "error"]
SINKS = ("object", "index", "source")


@dataclass
class TranscriptTables:
    videos: VersionedTable
    index: VersionedTable
    failures: VersionedTable
    sink_status: VersionedTable
    staging: str
    objects: str


def to_payload(responses: DataFrame, config: JobConfig) -> DataFrame:
    """Payload and class of each staged response; the requested id is kept."""
    parsed = with_captions(responses.drop("error"), config.subtitle_format)
    return parsed.withColumns(
        {
            "srt_id": caption_class(F.col("language_code"), F.col("content"), F.col("status")),
            "http_ok": F.col("status") == 200,
        }
    )


def video_status(done: Column, error: Column, http_status: Column) -> Column:
    """Outcome of one video, from the skip flag and the staged response."""
    return (
        F.when(done, "SKIPPED")
        .when(error.isNotNull(), "ERROR")
        .when(http_status >= 500, "STOPPED")
        .otherwise("CHECKPOINTED")
    )


def index_rows(payloads: DataFrame, config: JobConfig) -> DataFrame:
    located = with_object_url(payloads, config)
    return located.select("video_id", *[clean_text(F.col(c)).alias(c) for c in INDEX_COLUMNS])


def merge_index(index: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    return merge(index, rows, ["video_id"], INDEX_COLUMNS, touch={"updated_at": now})


def source_rows(payloads: DataFrame, now: Column) -> DataFrame:
    return payloads.filter(~is_blank(F.col("video_id"))).select(
        "video_id",
        stored_caption_class(F.col("srt_id")).alias("srt_id"),
        now.alias("srt_updated_at"),
    )


def merge_source(videos: DataFrame, rows: DataFrame) -> DataFrame:
    return merge(videos, rows, ["video_id"], ["srt_id", "srt_updated_at"], insert=False)


# -- sinks --------------------------------------------------------------------


def queue(tables: TranscriptTables, answers: DataFrame, run: int) -> None:
    """Enter the answers of a run as pending for each sink.

    Rows of this run keep their state (a lost run goes on where it stopped);
    of earlier runs only what is still pending stays in the ledger.
    """
    sinks = F.explode(F.array(*[F.lit(s) for s in SINKS])).alias("sink")
    rows = answers.select("video_id", sinks, F.lit(run).alias("run"))
    names = ["video_id", "sink", "run"]

    def enter(old: DataFrame) -> DataFrame:
        open_rows = old.filter((F.col("status") == "pending") | (F.col("run") == run))
        new = rows.join(open_rows.select(*names), names, "left_anti")
        state = new.withColumns({"status": F.lit("pending"), "error": F.lit(None).cast("string")})
        return merge(open_rows, state, ["video_id", "sink"])

    tables.sink_status.update(enter)


def _in_state(tables: TranscriptTables, sink: str, status: str) -> DataFrame:
    wanted = (F.col("sink") == sink) & (F.col("status") == status)
    return tables.sink_status.read().filter(wanted).select("video_id", "run")


def pending_payloads(tables: TranscriptTables, config: JobConfig) -> DataFrame:
    """Payloads some sink still waits for, from the staged answers of their runs only."""
    spark = tables.videos.spark
    pending = tables.sink_status.read().filter("status = 'pending'").select("video_id", "run")
    with_run = StructType([*CAPTIONS_RESPONSE, StructField("run", IntegerType())])
    staged = read_or_empty(spark, tables.staging, with_run)
    asked = staged.filter(usable_answer()).join(pending.distinct(), ["video_id", "run"], "left_semi")
    answers = best_answers(asked, ["video_id", "run"])
    return written(to_payload(answers, config), f"{tables.staging}-payloads")


def usable_answer() -> Column:
    return F.col("error").isNull() & (F.col("status") < 500)


def flush(tables: TranscriptTables, payloads: DataFrame, config: JobConfig, now: Column) -> list[str]:
    """Write pending payloads to the object folder, then index and source independently.

    Index and source take only payloads whose object was written.  What a sink
    could not take stays pending for its next flush.  Returns the errors.
    """
    errors = []
    request = ["video_id", "run"]

    def attempt(sink: str, write) -> None:
        pending = _in_state(tables, sink, "pending")
        if sink != "object":
            unwritten = _in_state(tables, "object", "pending")
            pending = pending.join(unwritten, request, "left_anti")
        if not pending.limit(1).count():
            return
        error = None
        try:
            write(payloads.join(pending, request, "left_semi"))
        except Exception as problem:
            error = str(problem)
            errors.append(f"{sink}: {error}")
        state = pending.select(
            *request,
            F.lit(sink).alias("sink"),
            F.lit("saved" if error is None else "pending").alias("status"),
            F.lit(error).cast("string").alias("error"),
        )
        tables.sink_status.update(lambda old: merge(old, state, ["video_id", "sink"]))

    attempt("object", lambda rows: write_payloads(rows, tables.objects, config, now))
    attempt("index", lambda rows: tables.index.replace(
        merge_index(tables.index.read(), index_rows(rows, config), now)
    ))
    attempt("source", lambda rows: tables.videos.replace(
        merge_source(tables.videos.read(), source_rows(rows, now))
    ))
    return errors


def run(
    tables: TranscriptTables, factory: ClientFactory, config: JobConfig, now: Column
) -> DataFrame:
    """Fetch, stage and save the captions of all videos still without them. Returns run counters.

    More server errors than ``config.server_error_limit`` stop the run before
    anything is saved; what was fetched stays staged.
    """
    # the index changes with every finished run: a lost run comes back to its own folder
    number = tables.index.version()
    videos = candidates.videos_with_id(tables.videos.read()).select("_id", "video_id")
    marked = candidates.videos_marked_done(
        videos.withColumn("video_id", clean_text(F.col("video_id"))),
        tables.index.read(), config.reprocess, config.redo_failed,
    )
    if config.cap:
        still_open = ledger.capped_work(
            marked.filter(~F.col("done")), tables.failures.read(), "_id", config.cap
        )
        marked = marked.filter("done").unionByName(still_open)
    marked = written(marked, f"{tables.staging}-work")
    todo = marked.filter(~F.col("done") & (F.col("video_id") != "")).select("video_id").distinct()
    requests = todo.withColumn("request_hash", request_hash(F.col("video_id")))
    staged = StagedResults(tables.videos.spark, f"{tables.staging}/run={number}", CAPTIONS_RESPONSE)
    answers = stage_once(
        requests, ["video_id"], staged,
        lambda df, parts: fetch_captions(df, ["video_id"], factory, parts), config, usable_answer(),
    )
    answers = written(answers, f"{tables.staging}-answers")
    broken = answers.filter("status >= 500").limit(config.server_error_limit + 1).count()
    stopped = broken > config.server_error_limit
    errors = []
    if not stopped:
        queue(tables, answers.filter(usable_answer()), number)
        errors = flush(tables, pending_payloads(tables, config), config, now)

    attempts = written(_attempts(tables, marked, answers, number), f"{tables.staging}-attempts")
    tables.failures.update(lambda old: ledger.record_failures(old, attempts, now))
    pending = tables.sink_status.read().filter("status = 'pending'").limit(1).count()
    failed = F.col("errors") + len(errors)
    return run_counts(attempts, []).withColumns(
        {"errors": failed, "status": transcript_status(F.lit(stopped), F.lit(pending), failed)}
    )


def _attempts(
    tables: TranscriptTables, marked: DataFrame, answers: DataFrame, run: int
) -> DataFrame:
    """One row per video of this run: status, error and what was saved."""
    fetched = with_captions(answers.withColumnRenamed("error", "_call")).select(
        "video_id",
        video_status(F.lit(False), F.col("_call"), F.col("status")).alias("status"),
        F.coalesce("_call", "error").alias("error"),
    )
    saved = tables.sink_status.read().filter(F.col("run") == run).groupBy("video_id").agg(
        *[F.max((F.col("sink") == s) & (F.col("status") == "saved")).alias(s) for s in SINKS]
    )
    flags = [
        F.coalesce(F.col(s), F.lit(False)).alias(name)
        for s, name in zip(SINKS, ("uploaded", "saved_index", "saved_source"))
    ]
    done = fetched.join(saved, "video_id", "left").select(
        "video_id", "status", "error", *flags
    )
    nothing = [F.lit(False).alias(name) for name in ("uploaded", "saved_index", "saved_source")]
    skipped = marked.filter("done").select(
        "video_id", F.lit("SKIPPED").alias("status"), F.lit("").alias("error"), *nothing
    )
    return done.unionByName(skipped)
