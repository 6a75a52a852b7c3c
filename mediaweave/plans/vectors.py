"""Stage E: tag texts become vectors on the post documents."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators import candidates, ledger, vectors
from ..operators.candidates import PAIR
from ..operators.merge import last_wins, merge
from ..operators.metrics import status_counts
from ..operators.ranking import numbered
from ..sources.clients import (
    ClientFactory, best_answers, embed_texts, request_hash, stage_once, vector_schema,
)
from ..sources.tables import StagedResults, VersionedTable, written

PLACE = "_place"
RECORD_COLUMNS = [
    "mongo_id", "status", "embed_retry_count", "mongo_write_retry_count", "last_error",
    "text", "embedding", "updated_at",
]


@dataclass
class VectorTables:
    tags: VersionedTable
    docs: VersionedTable
    records: VersionedTable
    staging: str


def work_items(
    tags: DataFrame, docs: DataFrame, records: DataFrame, config: JobConfig
) -> DataFrame:
    """Dispositions of both lanes; a pair in the retry lane is not taken twice."""
    texts = candidates.tag_texts(tags)
    here = vectors.location_docs(docs, config.location_id, config.embed_dim)
    again = ledger.retryable_records(records)
    retry = vectors.retry_dispositions(again, texts, here, config.reprocess)
    fresh_texts = texts.join(again.select(*PAIR).distinct(), PAIR, "left_anti")
    fresh = vectors.dispositions(fresh_texts, records, here, config.reprocess)
    return retry.unionByName(fresh)


def records_after_embedding(queued: DataFrame, checked: DataFrame, now: Column) -> DataFrame:
    """Records of the queue with their new status and vector."""
    joined = queued.join(
        checked.select(*PAIR, "vector", F.col("error").alias("_error")), PAIR, "left"
    )
    asked = F.col("action") == "embed"
    got = F.col("vector").isNotNull()
    return joined.select(
        *PAIR,
        "mongo_id",
        F.when(asked & got, "embedded").when(asked, "failed_embed").otherwise(F.col("status")).alias("status"),
        (F.col("embed_retry_count") + asked.cast("int")).alias("embed_retry_count"),
        "mongo_write_retry_count",
        F.when(asked & ~got, F.coalesce("_error", F.lit("no answer"))).alias("last_error"),
        F.col("tag_text").alias("text"),
        F.when(asked, F.col("vector")).otherwise(F.col("embedding")).alias("embedding"),
        now.alias("updated_at"),
    )


def records_after_write(records: DataFrame, docs: DataFrame, now: Column) -> DataFrame:
    """Records with a vector get the outcome of writing it to their document."""
    judged = vectors.write_outcome(records, docs)
    tried = F.col("status").isin(*ledger.WRITE_STATUSES)
    good = F.col("write_status") == "inserted"
    return judged.withColumns(
        {
            "status": F.when(tried & good, "inserted").when(tried, "failed_mongo_write").otherwise(F.col("status")),
            "mongo_write_retry_count": F.col("mongo_write_retry_count") + tried.cast("int"),
            "last_error": F.when(tried & good, F.lit(None)).when(tried, F.col("write_status")).otherwise(F.col("last_error")),
            "updated_at": now,
        }
    ).drop("write_status")


def merge_vectors(docs: DataFrame, records: DataFrame) -> DataFrame:
    """Documents with the vectors of inserted records."""
    rows = records.filter(F.col("status") == "inserted").select(
        F.col("mongo_id").alias("_id"), "embedding", "updated_at", *PAIR
    )
    newest = last_wins(rows, ["_id"], ["updated_at", *PAIR]).select("_id", "embedding")
    return merge(docs, newest, ["_id"], ["embedding"], insert=False)


def run(tables: VectorTables, factory: ClientFactory, config: JobConfig, now: Column) -> DataFrame:
    """Embed and write every pair that needs it. Returns the number of records per status.

    A cap counts written vectors: pairs that fail on the way do not use it up.  The ledger takes
    the vectors once, before any document is touched; pairs behind the cap are left as they were.
    """
    records = tables.records.read()
    found = work_items(tables.tags.read(), tables.docs.read(), records, config)
    items = written(found, f"{tables.staging}-work")
    todo = items.filter("disposition = 'needs_embedding'")
    before, behind = tables.records.version(), None
    if config.cap > 0:
        embedded, behind = _embed_until(todo, records, tables, factory, config, now)
    else:
        embedded = _embed(todo, records, tables, factory, config, now)
    stored = items.filter("disposition = 'embedding_exists_in_mongo'")
    already = vectors.queued_records(stored, records).select(
        *PAIR, "mongo_id", F.lit("inserted").alias("status"), "embed_retry_count",
        "mongo_write_retry_count", F.lit(None).cast("string").alias("last_error"),
        F.col("tag_text").alias("text"), "embedding", now.alias("updated_at"),
    )
    rows = embedded.unionByName(already)
    tables.records.update(lambda old: merge(old, rows, PAIR, RECORD_COLUMNS))
    counts = drain(tables, config, now)
    if behind is not None:
        _keep_surplus(tables, behind, before)
    return counts


def _staged(tables: VectorTables, pairs: DataFrame, version: int) -> StagedResults:
    return StagedResults(tables.docs.spark, f"{tables.staging}/{version}", vector_schema(pairs, PAIR))


def _keep_surplus(tables: VectorTables, behind: DataFrame, version: int) -> None:
    """Vectors behind the cap go to the next run's folder, so that they are not paid for again."""
    good = behind.filter("status = 'embedded'").select(*PAIR)
    spare = best_answers(_staged(tables, behind, version).read(), [*PAIR, "request_hash"]).join(good, PAIR, "left_semi")
    _staged(tables, behind, tables.records.version()).append(spare)


def _embed(
    todo: DataFrame, records: DataFrame, tables: VectorTables, factory: ClientFactory, config: JobConfig, now: Column
) -> DataFrame:
    """The pairs' records with their vectors; answers are staged before anything else."""
    queued = vectors.queued_records(todo, records).filter("action <> 'skip'")
    requests = queued.filter("action = 'embed'").select(
        *PAIR, F.col("tag_text").alias("prompt"), request_hash(F.col("tag_text")).alias("request_hash")
    )
    answers = stage_once(
        requests, PAIR, _staged(tables, requests, tables.records.version()),
        lambda df, parts: embed_texts(
            df, PAIR, factory, parts, config.request_size, config.embed_dim
        ),
        config,
    )
    checked = vectors.check_answers(answers, config.embed_dim)
    return records_after_embedding(queued, checked, now)


def _embed_until(
    todo: DataFrame, records: DataFrame, tables: VectorTables, factory: ClientFactory, config: JobConfig, now: Column
) -> tuple[DataFrame, DataFrame]:
    """Records up to the capped number of vectors that can be written, in one fixed order, and those behind it.

    Pairs are numbered once; pages of places are embedded, each twice the last, until enough
    vectors have a document to go to.
    """
    placed = written(numbered(todo, [F.col(c).asc() for c in PAIR], PLACE), f"{tables.staging}-order")
    done = None
    for page, (low, high) in enumerate(ledger.success_pages(config.cap, placed.count())):
        part = placed.filter((F.col(PLACE) >= low) & (F.col(PLACE) < high))
        part = _embed(part.drop(PLACE), records, tables, factory, config, now)
        part = part.join(placed.select(*PAIR, PLACE), PAIR)
        part = written(part, f"{tables.staging}-embedded-{page}")
        done = part if done is None else done.unionByName(part)
        outcome = vectors.write_outcome(done, tables.docs.read())
        good = (F.col("status") == "embedded") & (F.col("write_status") == "inserted")
        last = ledger.last_place(outcome, PLACE, good, config.cap)
        if last is not None:
            return done.filter(F.col(PLACE) <= last).drop(PLACE), done.filter(F.col(PLACE) > last).drop(PLACE)
    done = _embed(todo, records, tables, factory, config, now) if done is None else done.drop(PLACE)
    return done, done.limit(0)


def drain(tables: VectorTables, config: JobConfig, now: Column) -> DataFrame:
    """Write every vector the ledger still holds for a document; leftovers stay in the ledger."""
    held = tables.records.read().filter(F.col("status").isin(*ledger.WRITE_STATUSES))
    judged = records_after_write(held, tables.docs.read(), now)
    tables.docs.replace(merge_vectors(tables.docs.read(), judged))
    tables.records.update(
        lambda old: ledger.prune_inserted(
            merge(old, judged, PAIR, RECORD_COLUMNS), config.keep_inserted
        )
    )
    return status_counts(tables.records.read())
