"""Packing tokenised documents into sequences by non-negative least squares.

Documents are cut at full windows; each leaves at most one shorter rest.  The histogram of piece
lengths (at most ``window`` numbers, whatever the input) is all the driver sees.  It enumerates
combinations of up to three lengths that fill a window exactly, solves how often each is to be
repeated, rounds down, and packs what is left greedily, by length and number.  Pieces then find
their place by their rank among pieces of the same length: their number within the part that cut
them, and the number of such pieces in the parts before.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .token_ids import worker_ids

WINDOW = 2048
END_ID = 1
#: Third lengths tried for each pair of a length and a second length.
SECONDS = 24
STEPS = 400
_PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "within"]


def filled_windows(window: int) -> list[int]:
    """Sizes that need no padding: the window, and smaller powers of two."""
    return [window] + [1 << k for k in range(window.bit_length() - 1, -1, -1) if 1 << k < window]


def combinations(lengths: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths (0: none) that fill the window, or half of it, exactly."""
    there = np.zeros(window + 1, dtype=bool)
    there[lengths] = True
    found = []
    for size in filled_windows(window)[:2]:
        if there[size]:
            found.append(np.array([[size, 0, 0]]))
        a = lengths[(lengths <= size // 2) & (lengths < size)]
        pairs = a[there[size - a]]
        found.append(np.stack([size - pairs, pairs, np.zeros_like(pairs)], axis=1))
        for k in range(SECONDS):
            # For each shortest length a middle one, spread over those it may have.
            low, high = np.searchsorted(lengths, a), np.searchsorted(lengths, (size - a) // 2, side="right") - 1
            ok = high >= low
            b = lengths[np.minimum(low + (high - low) * k // max(SECONDS - 1, 1), len(lengths) - 1)]
            c = size - a - b
            ok &= (c >= b) & (c > 0)
            ok[ok] &= there[c[ok]]
            found.append(np.stack([c[ok], b[ok], a[ok]], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), dtype=np.int64)


def repeats(combos: np.ndarray, counts: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative x that brings the lengths used by x times each combination near ``counts``.

    Accelerated projected gradient steps; column 0 of the lengths stands for "none".
    """
    size = len(counts)
    target = counts.astype(float)
    target[0] = 0
    x = np.zeros(len(combos))
    if not len(combos):
        return x
    degree = np.bincount(combos.ravel(), minlength=size).astype(float)
    degree[0] = 0
    bound = max(float(degree[combos].sum(axis=1).max()), 1.0)
    y, t = x, 1.0
    for _ in range(steps):
        used = np.bincount(combos.ravel(), weights=np.repeat(y, combos.shape[1]), minlength=size)
        used[0] = 0
        gradient = (used - target)[combos].sum(axis=1)
        new = np.maximum(y - gradient / bound, 0)
        later = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / later * (new - x)
        x, t = new, later
    return x


def pack_plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, number of such sequences) that use every piece exactly once."""
    counts = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    plan = [((window,), int(counts[window]))] if counts[window] else []
    counts[window] = 0
    combos = combinations(np.flatnonzero(counts), window)
    times = repeats(combos, counts)
    for k in np.argsort(-times, kind="stable"):
        lengths = tuple(int(x) for x in combos[k] if x)
        n = int(min([times[k] + 1e-9] + [counts[x] // lengths.count(x) for x in lengths]))
        if n > 0:
            plan.append((lengths, n))
            for x in lengths:
                counts[x] -= n
    # What is left: fill a window with the longest pieces that fit, and repeat that sequence.
    while counts.any():
        lengths, gap = [], window
        left = counts.copy()
        while gap and (fit := np.flatnonzero(left[: gap + 1])).size:
            lengths.append(int(fit[-1]))
            left[fit[-1]] -= 1
            gap -= int(fit[-1])
        n = int(min(counts[x] // lengths.count(x) for x in lengths))
        plan.append((tuple(lengths), n))
        for x in lengths:
            counts[x] -= n
    return plan


def places(plan: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset) of the plan's slots."""
    ranks: dict[int, int] = {}
    out, sequence = [], 0
    for lengths, n in plan:
        offset = 0
        for x in lengths:
            rank = ranks.get(x, 0)
            out.append((x, rank, rank + n, sequence, offset))
            ranks[x] = rank + n
            offset += x
        sequence += n
    return out


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, part, within): every document's ids, cut at full windows.

    ``within`` numbers the pieces of one length in the part (task) that cut them, from 0.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part_id, seen = worker_ids(path), TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows: list[tuple] = []
            for i, ids in tokens.each(texts):
                ids = np.append(ids, end_id).astype("<u4")
                for a in range(0, len(ids), window):
                    part = ids[a : a + window]
                    rows.append((names[i], a, len(part), zlib.crc32(part.tobytes()), len(ids), part_id, int(seen[len(part)])))
                    seen[len(part)] += 1
            columns = list(zip(*rows)) or [()] * len(_PIECE)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=_PIECE)

    schema = ", ".join(f"{c} long" for c in _PIECE)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, schema)


def packed(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``path`` is the tokenizer's file.  Every id lies in exactly one piece.  Null and empty texts
    are the end id alone.  Repeated rows, also with one doc_id, are packed each.  Only doc_id and
    text are read.  An empty table gives an empty result.  The plan's slots, at most three for
    each combination and one for each left length and step, are the plan's only broadcast.  Pieces
    are numbered where they are cut and written with their part, so that a length, an id or a row
    that many share is never sorted in one task.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, window, end_id), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(
        places(pack_plan(histogram, window)),
        "slot_length long, first_rank long, end_rank long, first_sequence long, offset long",
    )
    counts = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(counts, ["length", "part"]).withColumn("rank", F.col("before") + F.col("within"))
    here = (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank"))
    found = ranked.join(F.broadcast(slots), here)
    return found.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first_sequence") + F.col("rank") - F.col("first_rank")).alias("sequence_id"), "offset",
    )
