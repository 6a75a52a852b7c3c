"""Repeated passages by a compacted de Bruijn graph of words.

Nodes are sequences of ``window - 1`` words, edges the windows of ``window`` words.  A window's
anchor is its least k-mer (by hash, the leftmost of equals), so equal windows have equal anchors
at equal places.  Consecutive windows with one anchor occurrence are a path, which stands for all
its edges: one row for about a dozen windows, with source coordinates (text key, first word).

An anchor met once has edges that occur once, and its paths go.  Where all paths of an anchor met
several times are the same, nothing branches: they are compacted, every edge repeats, and no edge
is looked at.  Where paths differ the anchor branches: equal paths are compacted first, and the
edges of each different path are read once, at the source coordinates of one occurrence, counted,
and joined back to the paths that occur once.  Spans are verified against the words at their
coordinates before anything is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Words, discard, portions, span_hashes, stored

WINDOW = 35
ANCHOR = 8
#: Text keys that may be broadcast to pick texts: 8 bytes each; beyond it the join is shuffled.
BROADCAST_KEYS = 500_000
#: Windows whose anchors are looked for at a time.
BLOCK = 50_000
#: A place is first word * SPAN + windows of the path; a path has fewer windows than this.
SPAN = 1 << 10


def _anchors(h: np.ndarray, windows: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each window (first words, ascending): the place of its least k-mer, and that k-mer's hash."""
    place, key = np.empty(len(windows), dtype=np.int64), np.empty(len(windows), dtype=np.uint64)
    steps = window - anchor + 1
    for a in range(0, len(windows), BLOCK):
        x = windows[a : a + BLOCK]
        first, last = int(x[0]), int(x[-1]) + window
        starts = np.arange(first, last - anchor + 1)
        grams = span_hashes(h, starts, starts + anchor)
        least = np.lib.stride_tricks.sliding_window_view(grams, steps)[x - first].argmin(axis=1) + x
        place[a : a + BLOCK], key[a : a + BLOCK] = least, grams[least - first]
    return place, key


class Paths:
    """The paths of some texts: text number, first word in the text, windows, anchor and path hash."""

    def __init__(self, words: Words, window: int = WINDOW, anchor: int = ANCHOR):
        count = np.diff(words.first)
        doc = np.repeat(np.arange(len(count)), count)
        left = np.repeat(words.first[1:], count) - np.arange(len(doc))
        x = np.flatnonzero(left >= window)
        place, key = _anchors(words.hash, x, window, anchor)
        new = np.ones(len(x), dtype=bool)
        new[1:] = (place[1:] != place[:-1]) | (x[1:] != x[:-1] + 1)
        new = np.flatnonzero(new)
        starts = x[new]
        self.size = np.diff(np.append(new, len(x)))
        self.doc = doc[starts]
        self.start = starts - words.first[self.doc]
        self.anchor = key[new].view(np.int64)
        self.path = span_hashes(words.hash, starts, starts + self.size + window - 1).view(np.int64)


def _joined(words: Words, i: int, keep: np.ndarray | None = None) -> bytes:
    """The (kept) words of text i joined by one space."""
    starts, ends = (w[words.first[i] : words.first[i + 1]] for w in (words.starts, words.ends))
    if keep is not None:
        starts, ends = starts[keep], ends[keep]
    if not len(starts):
        return b""
    # Each word with the byte behind it, which separates words and is written as a space.
    size = ends - starts + 1
    at = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
    data = words.data[at]
    data[np.cumsum(size) - 1] = 32
    return data[:-1].tobytes()


_FOUND = "doc_id long, key long, n_words long, sha string, anchor long, path long, place long"


def _find(window: int, anchor: int) -> Callable:
    """A row for each text (anchor null) and a row for each path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in portions(texts):
                words = Words(texts[a:b], WHITE)
                paths = Paths(words, window, anchor)
                keys = batch.column(1).slice(a, b - a)
                n, m = b - a, len(paths.doc)
                shas = [hashlib.sha256(_joined(words, i)).hexdigest() for i in range(n)]
                yield pa.record_batch(
                    [
                        pa.concat_arrays([batch.column(0).slice(a, n), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([keys, keys.take(pa.array(paths.doc))]),
                        pa.concat_arrays([pa.array(np.diff(words.first)), pa.nulls(m, pa.int64())]),
                        pa.concat_arrays([pa.array(shas, pa.string()), pa.nulls(m, pa.string())]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(paths.anchor)]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(paths.path)]),
                        pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(paths.start * SPAN + paths.size)]),
                    ],
                    names=["doc_id", "key", "n_words", "sha", "anchor", "path", "place"],
                )

    return run


def _verified(words: Words, i: int, spans: list[dict], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, windows, which span) of the spans whose words at their coordinates are those of the path."""
    place = np.array([s["place"] for s in spans], dtype=np.int64)
    wanted = np.array([s["path"] for s in spans], dtype=np.int64)
    start, size = place // SPAN, place % SPAN
    first, count = words.first[i], words.first[i + 1] - words.first[i]
    order = np.argsort(start, kind="stable")
    order = order[start[order] + size[order] + window - 1 <= count]
    ends = first + start[order] + size[order] + window - 1
    ok = np.empty(len(order), dtype=bool)
    # Ends need not ascend with starts here, so each span is hashed by itself where they do not.
    if np.all(np.diff(ends) >= 0):
        ok = span_hashes(words.hash, first + start[order], ends).view(np.int64) == wanted[order]
    else:
        for k, (o, e) in enumerate(zip(order, ends)):
            s = np.array([first + start[o]])
            ok[k] = span_hashes(words.hash, s, np.array([e])).view(np.int64)[0] == wanted[o]
    order = order[ok]
    return start[order], size[order], order


_EDGES = "anchor long, edge long, key long, at long, weight int"


def _read_edges(window: int) -> Callable:
    """The edges of branching paths, read at the source: weight 1 of a path that occurs once, else 2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, lists = (c.to_pylist() for c in batch.columns)
            for a, b in portions(texts):
                words = Words(texts[a:b], WHITE)
                columns: list[list[np.ndarray]] = [[], [], [], [], []]
                for i in range(b - a):
                    spans = lists[a + i]
                    start, size, which = _verified(words, i, spans, window)
                    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    at = np.repeat(start, size) + nth
                    first = words.first[i] + at
                    order = np.argsort(first, kind="stable")
                    edges = np.empty(len(at), dtype=np.int64)
                    edges[order] = span_hashes(words.hash, first[order], first[order] + window).view(np.int64)
                    anchors = np.array([spans[k]["anchor"] for k in which], dtype=np.int64)
                    weights = np.array([spans[k]["weight"] for k in which], dtype=np.int32)
                    for column, values in zip(columns, (np.repeat(anchors, size), edges, np.full(len(at), keys[a + i]), at, np.repeat(weights, size))):
                        column.append(values)
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in columns], names=["anchor", "edge", "key", "at", "weight"])

    return run


_RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _remove(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts, lists = (c.to_pylist() for c in batch.columns)
            rows: list[tuple] = []
            for a, b in portions(texts):
                words = Words(texts[a:b], WHITE)
                for i in range(b - a):
                    n = int(words.first[i + 1] - words.first[i])
                    start, size, _ = _verified(words, i, lists[a + i], window)
                    change = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(change, start, 1)
                    np.add.at(change, start + size + window - 1, -1)
                    keep = np.cumsum(change)[:n] == 0
                    rows.append((names[a + i], n, int(n - keep.sum()), hashlib.sha256(_joined(words, i, keep)).hexdigest()))
            columns = list(zip(*rows)) or [()] * 4
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return run


def _with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """The texts that have spans, each with all of them; texts without are left before the shuffle if few have any."""
    lists = stored(spans, "spans")
    keys = lists.select("key")
    chosen = texts.join(F.broadcast(keys), "key", "left_semi") if lists.count() <= BROADCAST_KEYS else texts
    return chosen.join(lists, "key")


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, spans, texts): a row for each text, repeated spans by text key, and keyed texts.

    ``rows`` has doc_id, key, n_words and the digest of all words; ``spans`` has key, path (hash of the words) and place: ``first word * SPAN + windows``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = rows.select("doc_id", F.xxhash64("text").alias("key"), "text")
    found = stored(texts.mapInArrow(_find(window, anchor), _FOUND), "paths")
    whole = stored(found.where("anchor is null").select("doc_id", "key", "n_words", "sha"), "texts")
    paths = found.where("anchor is not null").select("key", "anchor", "path", "place")

    # Compaction: an anchor met several times either has one path, or branches.
    met = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("low"), F.max("path").alias("high"))
    met = stored(met.where("n > 1").select("anchor", (F.col("low") < F.col("high")).alias("branches")), "anchors")
    repeated = stored(paths.join(met, "anchor"), "occurrences")
    discard(found)
    discard(met)

    # Equal paths of a branching anchor are compacted to one occurrence, the first by a hash of its coordinates.
    branching = repeated.where("branches").drop("branches").withColumn("source", F.xxhash64("key", "place"))
    different = branching.groupBy("anchor", "path").agg(F.count(F.lit(1)).alias("n"), F.min("source").alias("first"))
    marked = branching.join(stored(different, "branches"), ["anchor", "path"])
    marked = stored(marked.select("key", "anchor", "path", "place", (F.col("n") > 1).alias("several"), (F.col("source") == F.col("first")).alias("read")), "marked")

    weight = F.when(F.col("several"), 2).otherwise(1).alias("weight")
    wanted = marked.where("read").groupBy("key").agg(F.collect_set(F.struct("place", "path", "anchor", weight)).alias("spans"))
    source = _with_spans(texts.select("key", "text"), wanted).select("key", "text", "spans")
    edges = stored(source.mapInArrow(_read_edges(window), _EDGES), "edges")
    again = edges.groupBy("anchor", "edge").agg(F.sum("weight").alias("n")).where("n > 1").select("anchor", "edge")
    again = edges.where("weight = 1").join(stored(again, "repeated-edges"), ["anchor", "edge"])

    spans = repeated.where("not branches").select("key", "path", "place").unionByName(marked.where("several").select("key", "path", "place"))
    return whole, spans.unionByName(again.select("key", F.col("edge").alias("path"), (F.col("at") * SPAN + 1).alias("place"))), texts


def without_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row, repeated passages removed.

    Words are runs without ASCII white space, unchanged.  A word goes if a window of ``window``
    consecutive words that covers it occurs at another place, too, in the same or another row;
    repeated rows are other places.  Null texts have no words, as empty ones; texts of fewer words
    keep them all.  Only doc_id and text are read, whatever other columns there are; null and
    repeated ids do no harm, as texts are told apart by a digest.  No rows, no result.
    """
    rows, spans, texts = repeated_spans(docs, window, anchor)
    lists = stored(spans.groupBy("key").agg(F.collect_set(F.struct("place", "path")).alias("spans")), "spans")
    few = lists.count() <= BROADCAST_KEYS
    keys = F.broadcast(lists.select("key")) if few else lists.select("key")
    changed = (texts.join(keys, "key", "left_semi") if few else texts).join(lists, "key")
    changed = changed.select("doc_id", "text", "spans").mapInArrow(_remove(window), _RESULT)
    whole = rows.join(keys, "key", "left_anti")
    return changed.unionByName(whole.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256")))
