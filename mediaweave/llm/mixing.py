"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source sends its documents, shuffled by a hash, to one queue.  A document's virtual finish
time is the number of its source's tokens up to and with it, divided by the source's target; the
queue is served in the order of finish times until the total budget is used up.  A source may be
served twice over, its second pass behind the first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Runs of characters other than blank and the ASCII controls 9 to 13 are words.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
PASSES = 2
#: Equal rows that one task writes out of a run.
RUN = 4096
SLICES = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size, place, weight, target) for sized documents.

    Sources are placed by code point, null last, and weigh ``weights`` in turn.  Together they get
    ``share`` of all sizes in proportion to their weights; a target stops at ``passes`` times its
    source's size and the excess goes to the others by weight, until none is above.  The stopped
    sources are those with the lowest size for their weight, so one ordered sum finds the level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("place", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.element_at(kinds, (F.col("place") % len(weights) + 1).cast("int")))
    per = per.withColumn("full", F.col("source_size") * float(passes))
    per = per.withColumn("ratio", F.col("full") / F.col("weight"))
    order = Window.orderBy("ratio", "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    per = per.withColumn("budget", F.sum("source_size").over(every) * float(share))
    per = per.withColumn("stopped_size", F.coalesce(F.sum("full").over(before), F.lit(0.0)))
    per = per.withColumn("open_weight", F.sum("weight").over(after))
    per = per.withColumn("level", (F.col("budget") - F.col("stopped_size")) / F.col("open_weight"))
    fits = F.when(F.col("level") <= F.col("ratio"), F.col("level"))
    per = per.withColumn("level", F.max(fits).over(every))
    target = F.least("full", F.col("level") * F.col("weight"))
    return per.select("source", "source_size", "place", "weight", F.coalesce(target, "full").alias("target"))


def _identity() -> Column:
    """A digest of what the mix reads of a row; equal rows share it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("-null-")) for c in ("doc_id", "source", "text")]
    return F.md5(F.concat_ws("\x1f", *parts))


def _expanded(runs: DataFrame) -> DataFrame:
    """The rows of runs (n equal rows, nth_before and earlier), with nth and cumulative size.

    A run of more than ``RUN`` rows is cut into stretches that are dealt out first.
    """

    def rows(stretches: DataFrame, first: Column, last: Column) -> DataFrame:
        every = stretches.withColumn("k", F.explode(F.sequence(first, last)))
        every = every.withColumn("nth", F.col("nth_before") + F.col("k"))
        every = every.withColumn("cumulative", F.col("earlier") + F.col("k") * F.col("size"))
        return every.drop("k", "n", "nth_before", "earlier")

    short = rows(runs.where(F.col("n") <= RUN), F.lit(1).cast("long"), F.col("n"))
    cut = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))
    long = runs.where(F.col("n") > RUN).withColumn("stretch", F.explode(cut)).repartition("identity", "stretch")
    first = F.col("stretch") * RUN
    return short.unionByName(rows(long, first + 1, F.least(first + RUN, "n")).drop("stretch"))


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    passes: int = PASSES,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, copies, identity.

    Documents are taken whole: ``copies`` is 0 to ``passes`` and ``taken`` is copies * size, so a
    source's sum is within about one document of its target.  Null and empty texts have size 0
    and are never taken.  Rows are shuffled by md5 of seed and doc_id, ties by doc_id (null
    first), size and identity; repeated rows are rows of their own.  Only doc_id, text and source
    are read, so other columns cannot clash.  An empty table gives an empty result.  Texts are
    read once; the narrow work tables are written to the shared folder.  Equal rows travel as one
    row and its number; the others are sorted by ranges of their whole order, so that rows that
    share an id, or have none, are dealt over many ranges.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), _identity().alias("identity"))
    order = ("key", "doc_id", "size", "identity")
    # Equal rows are one run of consecutive places; a run is counted before the shuffle.
    runs = sized.groupBy("source", *order).agg(F.count(F.lit(1)).alias("n"))
    runs = runs.repartitionByRange("source", *order).withColumn("range", F.spark_partition_id())
    runs = stored(runs, "mix-sizes")
    whole_run = F.col("n") * F.col("size")
    targets = source_targets(runs.select("source", whole_run.alias("size")), weights, share, passes)
    budget = (runs.agg(F.sum(whole_run)).first()[0] or 0) * float(share)

    # Sums before each range of a source: one row per source and range, whatever the number of rows.
    ranges = runs.groupBy("source", "range").agg(F.sum(whole_run).alias("in_range"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
    facts = ranges.alias("r").join(targets.alias("t"), F.col("r.source").eqNullSafe(F.col("t.source")))
    facts = facts.select("r.source", "r.range", "before", "source_size", "place", "target")

    own = Window.partitionBy("source", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("within", F.coalesce(F.sum(whole_run).over(own), F.lit(0)))
    runs = runs.withColumn("nth_before", F.coalesce(F.sum("n").over(own), F.lit(0)))
    here = F.col("d.source").eqNullSafe(F.col("f.source")) & (F.col("d.range") == F.col("f.range"))
    runs = runs.alias("d").join(facts.alias("f"), here)
    runs = runs.select("d.*", "source_size", "place", "target", (F.col("before") + F.col("within")).alias("earlier")).drop("within")
    rows = stored(_expanded(runs), "mix-queue")

    def finish(turn: int) -> Column:
        return F.try_divide(F.lit(turn) * F.col("source_size") + F.col("cumulative"), F.col("target"))

    # Serve the queue: whole slices of virtual time in order; the slice with the cut is sorted.
    turns = F.inline(F.array(*[F.struct(F.lit(n).alias("turn"), finish(n).alias("finish")) for n in range(passes)]))
    queue = rows.where("size > 0").select("place", "range", "nth", *order, turns)
    queue = queue.withColumn("slice", F.floor(F.col("finish") * SLICES))
    slices = queue.groupBy("slice").agg(F.sum("size").alias("in_slice"))
    slices = slices.withColumn("total", F.sum("in_slice").over(Window.orderBy("slice")))
    cut = slices.where(F.col("total") > budget).orderBy("slice").first()
    cut_slice, served = (cut["slice"], cut["total"] - cut["in_slice"]) if cut else (1 << 62, 0)
    line = Window.partitionBy("slice").orderBy("finish", "place", "turn", *order).rowsBetween(Window.unboundedPreceding, 0)
    at_cut = queue.where(F.col("slice") == cut_slice).withColumn("running", F.sum("size").over(line) + served)
    at_cut = at_cut.where(F.col("running") <= budget).groupBy("place", "range", "nth").agg(F.count(F.lit(1)).alias("at_cut"))
    whole = sum(((F.floor(finish(n) * SLICES) < cut_slice).cast("int") for n in range(passes)), F.lit(0))
    out = rows.join(at_cut, ["place", "range", "nth"], "left")
    copies = F.when(F.col("size") > 0, whole + F.coalesce("at_cut", F.lit(0))).otherwise(0).cast("int")
    out = out.withColumn("copies", copies).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "copies", "identity")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: left out, once, or repeated.

    The choice is joined back by a digest of doc_id, source and text, as the number of rows that
    take each number of copies.  Rows equal in all three share it; where they take different
    numbers, they are written with the part they came in, numbered within it, and the numbers of
    the parts before are added, so that no task holds all of them.  A source's order has
    ``passes`` such places at most.  All columns are kept as they are.
    """
    counts = mix(docs, **settings).groupBy("identity", "copies").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "mix-copies")
    kept = docs.select(_identity().alias("identity"), F.struct("*").alias("row"))
    kinds = counts.groupBy("identity").agg(F.count(F.lit(1)).alias("kinds"), F.max("copies").alias("copies"))
    alike = kept.join(kinds.where("kinds = 1 and copies > 0").select("identity", "copies"), "identity").select("row", "copies")

    split = kinds.where("kinds > 1").select("identity")
    rows = kept.join(F.broadcast(split), "identity").withColumn("part", F.spark_partition_id())
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id()), "mix-split")
    earlier = Window.partitionBy("identity").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("identity", "part").agg(F.count(F.lit(1)).alias("n"))
    parts = parts.select("identity", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    upto = Window.partitionBy("identity").orderBy("copies").rowsBetween(Window.unboundedPreceding, 0)
    ranges = counts.join(F.broadcast(split), "identity").withColumn("last", F.sum("n").over(upto))
    ranges = ranges.select("identity", "copies", (F.col("last") - F.col("n")).alias("first"), "last")
    nth = F.row_number().over(Window.partitionBy("identity", "part").orderBy("at"))
    rows = rows.withColumn("nth", nth).join(F.broadcast(parts), ["identity", "part"]).withColumn("nth", F.col("nth") + F.col("before"))
    rows = rows.join(F.broadcast(ranges), "identity").where("nth > first and nth <= last and copies > 0").select("row", "copies")
    both = alike.unionByName(rows)
    return both.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
