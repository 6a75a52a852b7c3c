"""Stage D: captions become topic tags; and the repair of bad tag rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.responses import TAG_FIELDS, answer_outcome, tag_answer, unanswered
from ..functions.text import fill_prompt, is_meaningful, pair_key, split_pair_key
from ..operators import candidates, ledger
from ..operators.candidates import PAIR
from ..operators.merge import merge
from ..operators.metrics import reason_histogram
from ..operators.ranking import numbered
from ..sources.clients import (
    ClientFactory, answer_schema, best_answers, generate_answers, request_hash, stage_once,
)
from ..sources.tables import GivenTable, StagedResults, VersionedTable, written

PLACE = "_place"
TAG_COLUMNS = [
    "topic_tags", "is_sponsorship", "brand_name", "associated_brand", "associated_mention",
]


@dataclass
class TagTables:
    docs: VersionedTable
    captions: VersionedTable | GivenTable
    tags: VersionedTable
    failures: VersionedTable
    staging: str


def tag_requests(docs: DataFrame, template: str, unique: bool = False) -> DataFrame:
    """Prompts of meaningful captions, one per pair; pairs that are ``unique`` already stay in place."""
    prompt = fill_prompt(template, F.col("content"))
    meaningful = docs.filter(is_meaningful(F.col("content")))
    meaningful = meaningful if unique else meaningful.dropDuplicates(PAIR)
    return meaningful.select(*PAIR, prompt.alias("prompt"), request_hash(prompt).alias("request_hash"))


def read_answers(staged: DataFrame) -> DataFrame:
    """What staged answers say, without their texts."""
    return tag_answer(staged).drop("raw")


def tag_results(docs: DataFrame, answers: DataFrame) -> DataFrame:
    """Outcomes of posts with captions and their answers from ``read_answers``; no text is shuffled."""
    marked = docs.withColumn("_meaningful", is_meaningful(F.col("content"))).drop("content")
    joined = marked.join(answers.select(*PAIR, *TAG_FIELDS, "silent", "error"), PAIR, "left")
    return answer_outcome(unanswered(joined), F.col("_meaningful")).drop("_meaningful")


def merge_tags(tags: DataFrame, results: DataFrame) -> DataFrame:
    rows = results.filter("ok").select(*PAIR, *TAG_COLUMNS).dropDuplicates(PAIR)
    return merge(tags, rows, PAIR, TAG_COLUMNS)


def dead_pairs(failures: DataFrame) -> DataFrame:
    parts = split_pair_key(F.col("key"))
    return ledger.keys_in_state(failures, "dead").select(
        parts["user_id"].alias("user_id"), parts["post_id"].alias("post_id")
    )


def failed_pairs(failures: DataFrame) -> DataFrame:
    parts = split_pair_key(F.col("key"))
    pairs = ledger.keys_in_state(failures, "failed").select(
        parts["user_id"].alias("user_id"), parts["post_id"].alias("post_id")
    )
    return pairs.filter((F.col("user_id") != "") & (F.col("post_id") != ""))


def _staged(tables: TagTables, requests: DataFrame, version: int) -> StagedResults:
    """The answers' folder goes with the state of the tag table, so that a lost run
    finds its answers again and a later run asks anew."""
    return StagedResults(tables.docs.spark, f"{tables.staging}/{version}", answer_schema(requests, PAIR))


def _ask(
    work: DataFrame, tables: TagTables, factory: ClientFactory, config: JobConfig, page: int = 0,
    unique: bool = False, posts: DataFrame | None = None,
) -> DataFrame:
    """Results for posts with captions; posts, answers and results are each written once.

    Where ``work`` has ``unique`` pairs, its texts are shuffled for the calls only.  With ``posts``
    there is a result for each of these, copies of a pair included.
    """
    work = written(work, f"{tables.staging}-work-{page}")
    requests = tag_requests(work, config.prompt_template, unique)
    staged = _staged(tables, requests, tables.tags.version())
    answers = stage_once(
        requests, PAIR, staged,
        lambda df, parts: generate_answers(df, PAIR, factory, parts), config, read=read_answers,
    )
    results = tag_results(work, answers)
    if posts is not None:
        results = candidates.keyed_posts(posts).select("_id", *PAIR).join(results.drop("_id"), PAIR, "left")
    kept = ["_id", *PAIR, "ok", "reason", "skip_retry", "quota_fail", *TAG_COLUMNS]
    kept = [c for c in [*kept, PLACE] if c in kept or c in work.columns]
    return written(results.select(*kept), f"{tables.staging}-results-{page}")


def _ask_until(
    lanes: DataFrame, tables: TagTables, factory: ClientFactory, config: JobConfig
) -> tuple[DataFrame, DataFrame]:
    """Results up to the capped number of tagged posts, in one fixed order, and those behind it.

    Posts are numbered once.  Pages of places are asked, each twice the last, until enough
    answers pass the gate; so the number of pages grows with the logarithm of the posts tried.
    """
    placed = numbered(lanes, [F.col(c).asc() for c in ("_id", *PAIR)], PLACE)
    captions = candidates.latest_captions(tables.captions.read(), wanted=placed)
    work = written(candidates.attach_captions(placed, captions), f"{tables.staging}-order")
    results, last = None, None
    for page, (low, high) in enumerate(ledger.success_pages(config.cap, placed.count())):
        part = work.filter((F.col(PLACE) >= low) & (F.col(PLACE) < high))
        part = _ask(part, tables, factory, config, page)
        results = part if results is None else results.unionByName(part)
        last = ledger.last_place(results, PLACE, F.col("ok"), config.cap)
        if last is not None:
            break
    if results is None:
        results = _ask(work, tables, factory, config)
    reached = F.lit(True) if last is None else F.col(PLACE) <= last
    return results.filter(reached).drop(PLACE), results.filter(~reached).drop(PLACE)


def _keep_surplus(tables: TagTables, behind: DataFrame, version: int) -> None:
    """Good answers behind the cap go to the next run's folder, so that they are not paid for again."""
    old = _staged(tables, behind, version)
    names = [*PAIR, "request_hash"]
    good = behind.filter("ok").select(*PAIR)
    spare = best_answers(old.read(), names).join(good, PAIR, "left_semi")
    _staged(tables, behind, tables.tags.version()).append(spare)


def _failure_keys(results: DataFrame) -> DataFrame:
    retried = results.filter(~F.col("ok") & ~F.col("skip_retry"))
    return retried.select(pair_key(F.col("user_id"), F.col("post_id")).alias("key"))


def run(tables: TagTables, factory: ClientFactory, config: JobConfig) -> DataFrame:
    """Tag every post without tags, failed ones again, dead ones not. Returns reasons.

    A cap counts tagged posts: posts that fail on the way do not use it up.  The tag table and
    the ledger are written once; posts behind the cap are left as they were.
    """
    failures = tables.failures.read()
    docs = candidates.posts_with_keys(tables.docs.read(), config.location_id)
    todo = candidates.without_tags(docs, tables.tags.read(), dead_pairs(failures))
    retry = failed_pairs(failures).withColumn("_id", F.lit(""))
    retry = candidates.without_tags(retry, tables.tags.read()).select("_id", *PAIR)
    lanes = ledger.retry_and_fresh(retry, todo, PAIR).drop("lane")
    before = tables.tags.version()
    if config.cap > 0:
        results, behind = _ask_until(lanes, tables, factory, config)
    else:
        lanes = written(lanes, f"{tables.staging}-posts")
        captions = candidates.latest_captions(tables.captions.read(), wanted=lanes)
        work = candidates.pairs_with_captions(lanes, captions)
        results, behind = _ask(work, tables, factory, config, unique=True, posts=lanes), None
    tables.tags.replace(merge_tags(tables.tags.read(), results))
    if behind is not None:
        _keep_surplus(tables, behind, before)
    counted = ledger.count_attempts(failures, _failure_keys(results), config.max_attempts)
    fixed = results.filter("ok").select(pair_key(F.col("user_id"), F.col("post_id")).alias("key"))
    tables.failures.replace(ledger.clear_finished(counted, fixed, ["key"]))
    return reason_histogram(results)


def repair(tables: TagTables, factory: ClientFactory, config: JobConfig) -> DataFrame:
    """Ask again for every pair with a bad tag row and overwrite what passes the gate."""
    bad = candidates.bad_tag_pairs(tables.tags.read())
    captions = candidates.latest_captions(tables.captions.read(), wanted=bad)
    work = candidates.pairs_with_captions(bad, captions)
    results = _ask(work, tables, factory, config, unique=True)
    tables.tags.replace(merge_tags(tables.tags.read(), results))
    return results.agg(
        F.count_if("ok").alias("repaired_ok"), F.count_if(~F.col("ok")).alias("repaired_failed")
    )
