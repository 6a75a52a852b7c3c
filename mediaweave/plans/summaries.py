"""Stage C: transcripts become structured summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.responses import summary_outcome, with_analysis, with_object
from ..functions.text import clean_text, fill_prompt, is_blank
from ..operators import candidates, ledger
from ..operators.merge import merge
from ..operators.metrics import run_counts, summary_status
from ..sources.clients import (
    ClientFactory, answer_schema, generate_answers, request_hash, stage_once,
)
from ..sources.payloads import attach_transcripts
from ..sources.tables import StagedResults, VersionedTable, written

KEY = ["video_id"]
ANALYSIS = [
    "video_title", "brand_mentioned", "product_mentioned", "topic_tags", "summary",
    "key_topics", "is_sponsorship", "sponsorship_name",
]


@dataclass
class SummaryTables:
    index: VersionedTable
    summaries: VersionedTable
    failures: VersionedTable
    staging: str


def summary_requests(transcripts: DataFrame, template: str) -> DataFrame:
    """Prompts of transcripts that have text; the others need no model."""
    prompt = fill_prompt(template, F.col("content"))
    return transcripts.filter(~is_blank(F.col("content"))).select(
        *KEY, prompt.alias("prompt"), request_hash(prompt).alias("request_hash")
    )


def summary_results(transcripts: DataFrame, answers: DataFrame) -> DataFrame:
    """One row per transcript: its analysis and its outcome in ``error``."""
    if "object_error" not in transcripts.columns:
        transcripts = transcripts.withColumn("object_error", F.lit(None).cast("string"))
    joined = transcripts.select(*KEY, "content", "object_error").join(
        answers.select(*KEY, "raw", F.col("error").alias("_call")), KEY, "left"
    )
    parsed = with_analysis(with_object(joined, "raw", "_data"), "_data")
    error = summary_outcome(F.col("content"), F.col("raw"), F.col("_data"), F.col("_call"), F.col("object_error"))
    return parsed.withColumn("error", error).select(*KEY, *ANALYSIS, "error")


def is_saved() -> Column:
    """A failed call or an object that could not be read writes no row; a blank transcript does."""
    return F.col("error").isin("", "NO_TRANSCRIPT")


def rows_to_save(results: DataFrame) -> DataFrame:
    return results.filter(is_saved())


def merge_summaries(summaries: DataFrame, rows: DataFrame, now: Column) -> DataFrame:
    return merge(summaries, rows, KEY, [*ANALYSIS, "error"], touch={"updated_at": now})


def run(
    tables: SummaryTables, objects: DataFrame, factory: ClientFactory, config: JobConfig, now: Column
) -> DataFrame:
    """Summarise every usable transcript without a summary. Returns run counters."""
    spark = tables.index.spark
    todo = candidates.transcripts_to_summarise(
        tables.index.read(), tables.summaries.read(), config.reprocess
    )
    todo = ledger.capped_work(todo, tables.failures.read(), "id", config.cap)
    trimmed = todo.withColumn("video_id", clean_text(F.col("video_id")))
    # a run that was lost finds its answers again, a later run asks anew
    folder = f"{tables.staging}/{tables.summaries.version()}"
    found = attach_transcripts(trimmed, objects, config).select(*KEY, "content", "object_error")
    transcripts = written(found, f"{tables.staging}-work")
    requests = summary_requests(transcripts, config.prompt_template)
    staged = StagedResults(spark, folder, answer_schema(requests, KEY))
    answers = stage_once(
        requests, KEY, staged,
        lambda df, parts: generate_answers(df, KEY, factory, parts), config,
    )
    results = written(summary_results(transcripts, answers), f"{tables.staging}-results")
    rows = rows_to_save(results)
    tables.summaries.replace(merge_summaries(tables.summaries.read(), rows, now))
    tables.failures.update(
        lambda old: ledger.record_failures(old, results.select("video_id", "error"), now)
    )
    saved = is_saved()
    attempts = results.select(
        F.when(saved, "CHECKPOINTED").otherwise("STOPPED").alias("status"),
        "error",
        F.lit(False).alias("uploaded"),
        saved.alias("saved_index"),
        F.lit(False).alias("saved_source"),
    )
    counts = run_counts(attempts, [])
    failed = results.filter(~saved).limit(1).count() > 0
    return counts.withColumn("status", summary_status(F.lit(failed), F.col("errors")))
