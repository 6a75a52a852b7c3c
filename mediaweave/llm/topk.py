"""Exact top-k by inner product: columnar branch and bound.

Candidates lie in blocks, one column per dimension.  A query adds its products dimension block by
dimension block; after each, the mass that is left (the norms of the remaining dimensions) bounds
how far every score can still move, and candidates that can no longer reach the k-th lower bound
are compacted away.

Candidate blocks are dealt to groups of a bounded size and stay there; query blocks are sent to
every group.  A group goes through its blocks with each query's k-th score so far as the bound to
beat, and sends on k rows per query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

K = 10
SCALE = 1024
DIMENSIONS = 16
CANDIDATE_BYTES, QUERY_BYTES = 2 << 20, 256 << 10
#: Candidate blocks of a group, on average; a group's blocks are held in memory while queries pass.
GROUP_BLOCKS = 8
#: Beyond this component products no longer fit a long; such vectors are multiplied as exact integers.
SAFE = 1 << 26
LONG = (-(1 << 63), (1 << 63) - 1)

_PACKED = "dimension int, rows int, ids binary, vectors binary"


def _pack(limit: int, scale: int):
    """Blocks of vectors of one dimension: row ids and the components, dimension by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def block(dimension: int) -> pa.RecordBatch:
            ids, vectors = held.pop(dimension)
            columns = np.ascontiguousarray(np.stack(vectors).T if dimension else np.zeros((0, len(ids))), dtype=np.float64)
            return pa.record_batch(
                [
                    pa.array([dimension], pa.int32()), pa.array([len(ids)], pa.int32()),
                    pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()), pa.array([columns.tobytes()], pa.binary()),
                ],
                names=["dimension", "rows", "ids", "vectors"],
            )

        for batch in batches:
            for name, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = np.floor(np.array(vector.values.to_numpy(zero_copy_only=False), dtype=np.float64) * scale)
                ids, vectors = held.setdefault(len(values), ([], []))
                ids.append(name)
                vectors.append(values)
                if len(ids) * (len(values) + 1) * 8 >= limit:
                    yield block(len(values))
        for dimension in list(held):
            yield block(dimension)

    return run


def best_of_block(query: np.ndarray, columns: np.ndarray, rest: np.ndarray, k: int, bar: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of at least the k best candidates of a block that may reach ``bar``.

    ``rest[b]`` holds the candidates' norms from dimension block b on.
    """
    alive = np.arange(columns.shape[1])
    score = np.zeros(len(alive), dtype=np.int64)
    squares = (query.astype(np.float64) ** 2)[::-1].cumsum()[::-1]
    for b, start in enumerate(range(0, len(query), DIMENSIONS)):
        stop = min(start + DIMENSIONS, len(query))
        part = columns[start:stop]
        part = part if len(alive) == columns.shape[1] else part[:, alive]
        score = score + query[start:stop] @ part
        if stop < len(query) and len(alive):
            slack = np.ceil(np.sqrt(squares[stop]) * rest[b + 1][alive] * (1 + 1e-9)) + 1
            if len(alive) > k:
                bar = max(bar, np.partition(score - slack, len(alive) - k)[len(alive) - k])
            keep = score + slack >= bar
            if not keep.all():
                alive, score = alive[keep], score[keep]
    keep = score >= bar
    return alive[keep], score[keep]


class _Block:
    """Candidates of one dimension: ids, components by dimension, and norms of the rest from each dimension block on."""

    def __init__(self, dimension: int, ids: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, dtype=np.int64)
        self.raw = np.frombuffer(vectors, dtype=np.float64).reshape(dimension, len(self.ids))
        self.small = not self.raw.size or np.abs(self.raw).max() <= SAFE
        self.columns = self.raw.astype(np.int64) if self.small else self.raw
        squares = (self.raw**2)[::-1].cumsum(axis=0)[::-1] if dimension else self.raw
        self.rest = [np.sqrt(squares[d]) for d in range(0, dimension, DIMENSIONS)]

    def scores(self, query: np.ndarray, k: int, bar: float) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of at least the k best that may reach ``bar``; exact integers beyond what a long holds."""
        if self.small and (not query.size or np.abs(query).max() <= SAFE):
            alive, score = best_of_block(query.astype(np.int64), self.columns, self.rest, k, bar)
            top = np.lexsort((self.ids[alive], -score))[:k]
            return self.ids[alive[top]], score[top].tolist()
        parts = [int(x) for x in query]
        return self.ids, [_long(sum(q * int(c) for q, c in zip(parts, self.raw[:, i]))) for i in range(len(self.ids))]


def _long(x: int) -> int:
    """Scores stop at the ends of a long."""
    return min(max(x, LONG[0]), LONG[1])


_FOUND = "query_id long, query_block long, nth long, vec_id long, score long, own boolean"


def _meet(k: int):
    """Rows of a group come together, its candidate blocks before the query blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, blocks = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["dimension"], row["group"]) != group:
                    group, blocks = (row["dimension"], row["group"]), []
                if row["query_block"] is None:
                    blocks.append(_Block(row["dimension"], row["ids"], row["vectors"]))
                    continue
                names = np.frombuffer(row["ids"], dtype=np.int64)
                queries = np.frombuffer(row["vectors"], dtype=np.float64).reshape(row["dimension"], len(names)).T
                found: list[tuple] = []
                for n, (name, query) in enumerate(zip(names.tolist(), queries)):
                    best: list[tuple[int, int]] = []
                    for block in blocks:
                        bar = -best[k - 1][0] if len(best) >= k else -np.inf
                        ids, scores = block.scores(query, k, bar)
                        best = sorted(best + [(-x, i) for x, i in zip(scores, ids.tolist())])[:k]
                    self_score = _long(sum(int(x) * int(x) for x in query))
                    found += [(name, row["query_block"], n, i, -x, i == name and -x == self_score) for x, i in best]
                columns = list(zip(*found)) or [()] * 6
                kinds = [pa.int64()] * 5 + [pa.bool_()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "query_block", "nth", "vec_id", "score", "own"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best rows of ``vectors`` (vec_id, embedding).

    ``queries`` are rows of ``vectors``.  Components become floor(scale * x).  Every row but the
    query's own is a candidate, also one that repeats it; ties go to the smaller vec_id.  Vectors
    that are null or hold null or non-finite components, and rows without a vec_id, take no part.
    Vectors meet only vectors of their own dimension.  Rows that repeat count each, as candidates
    and as queries.  Scores beyond a long stop at its ends.  No candidates, no rows.
    """

    def usable(df: DataFrame) -> DataFrame:
        fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = df.where("vec_id is not null and embedding is not null").where(fine)
        return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))

    packed = stored(usable(vectors).mapInArrow(_pack(CANDIDATE_BYTES, scale), _PACKED), "candidates")
    asked = stored(usable(queries).mapInArrow(_pack(QUERY_BYTES, scale), _PACKED).withColumn("query_block", F.monotonically_increasing_id()), "queries")
    # Of each dimension so many groups that one holds a few blocks; a query block goes to each of them.
    groups = packed.groupBy("dimension").agg(F.ceil(F.count(F.lit(1)) / GROUP_BLOCKS).alias("groups"))
    here = packed.join(groups, "dimension").select(
        "dimension", F.pmod(F.xxhash64("ids", "vectors"), F.col("groups")).alias("group"), F.lit(None).cast("long").alias("query_block"), "ids", "vectors"
    )
    sent = asked.join(groups, "dimension").select(
        "dimension", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"), "query_block", "ids", "vectors"
    )
    parts = int(packed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = here.unionByName(sent).repartition(parts, "dimension", "group").sortWithinPartitions("dimension", "group", F.col("query_block").asc_nulls_first())
    found = met.select("dimension", "group", "query_block", "ids", "vectors").mapInArrow(_meet(k + 1), _FOUND)
    # One more than k, so that the query's own row can go; a row equal to it is as good as it.
    each = Window.partitionBy("query_id", "query_block", "nth")
    ranked = found.withColumn("rank", F.row_number().over(each.orderBy(F.col("score").desc(), "vec_id"))).where(F.col("rank") <= k + 1)
    ranked = ranked.withColumn("mine", F.min(F.when(F.col("own"), F.col("rank"))).over(each)).where("mine is null or rank <> mine")
    ranked = ranked.withColumn("rank", F.col("rank") - F.coalesce((F.col("rank") > F.col("mine")).cast("int"), F.lit(0))).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
