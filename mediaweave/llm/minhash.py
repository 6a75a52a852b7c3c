"""Near-duplicates by BagMinHash: weighted-Jaccard signatures of multisets of word shingles.

Texts are lower-cased; words are runs of letters, digits, underscores and non-ASCII characters;
a shingle is five words in a row and weighs as often as it occurs.  Each shingle's weight is cut
into strips (0,1], (1,2], (2,4], (4,8] ...; every strip carries a Poisson process over time whose
points fall on a level of the strip and on a component of the signature.  A point counts if its
level is within the weight.  The earliest point of each component is the signature: two texts
agree in a component with the probability of their weighted Jaccard similarity.

Equal texts are one node.  Signatures are cut into bands; texts that share a band are compared
with the band's leader first, then, where a bucket still holds several components, in blocks.
Every link is verified on the whole multisets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import MASK, NOT_WORD, Words, mixed, portions, stored
from .components import components

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
#: Rows and bytes of text of a chunk when an open bucket is compared in blocks of two chunks.
BLOCK_ROWS, BLOCK_TEXT = 1024, 2 << 20
#: Node ids that may be broadcast: 16 bytes each, 8 MB; beyond it the join is shuffled.
BROADCAST_NODES = 500_000
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def node_id(text: str) -> bytes:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:16]


def _node(text: Column) -> Column:
    """The same id as a column: 16 bytes of the text's digest."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def _row_key(doc_id: Column, node: Column) -> Column:
    return F.concat(F.coalesce(doc_id.cast("string"), F.lit("-")), F.lit(":"), F.hex(node))


def shingle_bags(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, weight) of the distinct shingles, by text.

    A text of fewer words is one shingle of all of them; a text without words has none.
    """
    found = Words([t.lower() for t in texts], NOT_WORD)
    h, count = found.hash, np.diff(found.first)
    doc = np.repeat(np.arange(len(texts)), count)
    place = np.arange(len(h)) - found.first[:-1][doc]
    left = count[doc] - place
    sums = h * _ODD[0]
    for k in range(1, words):
        more = np.zeros(len(h), dtype=np.uint64)
        more[: max(len(h) - k, 0)] = h[k:] * (_ODD[k % 5] + np.uint64(2 * (k // 5)))
        inside = left > k
        sums[inside] += more[inside]
    use = (left >= words) | (place == 0)
    use &= (place == 0) | (count[doc] >= words)
    doc, key = doc[use], mixed(sums[use] + np.minimum(left[use], words).astype(np.uint64))
    _, index, weight = np.unique(key ^ mixed(doc.astype(np.uint64) + np.uint64(77)), return_index=True, return_counts=True)
    order = index[np.argsort(doc[index], kind="stable")]
    by_index = np.zeros(len(doc), dtype=np.int64)
    by_index[index] = weight
    return doc[order], key[order], by_index[order]


def _uniform(z: np.ndarray) -> np.ndarray:
    return ((z >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_signatures(n: int, doc: np.ndarray, key: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    """The n x size earliest times; a row without shingles stays infinite."""
    out = np.full((n, size), np.inf)
    if not len(doc):
        return out
    total = np.bincount(doc, weights=weight, minlength=n)
    limit = np.zeros(n)
    limit[total > 0] = (np.log(size) + 2.0) / total[total > 0]
    strips = 1 + np.ceil(np.log2(weight)).astype(np.int64)
    which = np.repeat(np.arange(len(doc)), strips)
    strip = np.arange(len(which)) - np.repeat(np.cumsum(strips) - strips, strips)
    base = np.where(strip > 0, 2 ** np.maximum(strip - 1, 0), 0)
    width = np.where(strip > 0, base, 1)
    seed = mixed(key[which] + strip.astype(np.uint64) * _ODD[2])
    own, heavy = doc[which], weight[which]
    todo = np.arange(len(which))
    while len(todo):
        # All points up to each text's limit, the k-th points of all strips together.
        live, at, k = todo, np.zeros(len(todo)), 0
        while len(live):
            z = mixed(seed[live] + np.uint64(k * int(_ODD[0]) & MASK))
            at = at - np.log(_uniform(z)) / (size * width[live])
            within = at <= limit[own[live]]
            live, at, z = live[within], at[within], z[within]
            z = mixed(z ^ _ODD[3])
            component = ((z >> np.uint64(40)) * np.uint64(size)) >> np.uint64(24)
            level = base[live] + 1 + (_uniform(mixed(z)) * width[live]).astype(np.int64)
            counts = level <= heavy[live]
            np.minimum.at(out, (own[live][counts], component[counts].astype(np.int64)), at[counts])
            k += 1
        # Texts with an empty component are drawn anew up to twice the time: the same points and more.
        open_ = np.isinf(out).any(axis=1) & (total > 0)
        limit[open_] *= 2
        todo = todo[open_[own[todo]]]
    return out


_SIGNED = "doc_id long, node binary, bands array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = BANDS * ROWS
    for batch in batches:
        ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        for a, b in portions(texts):
            part = texts[a:b]
            doc, key, weight = shingle_bags(part)
            times = bag_signatures(len(part), doc, key, weight, size)
            marks = mixed(times.view(np.uint64))
            rows = marks.reshape(len(part), BANDS, ROWS)
            bands = np.full((len(part), BANDS), 1, dtype=np.uint64) * np.arange(1, BANDS + 1, dtype=np.uint64)
            for r in range(ROWS):
                bands = mixed(bands * _ODD[1] + rows[:, :, r])
            some = ~np.isinf(times[:, 0])
            yield pa.record_batch(
                [
                    ids.slice(a, b - a),
                    pa.array([node_id(t) for t in part], pa.binary()),
                    pa.array([x if ok else None for x, ok in zip(bands.view(np.int64), some)], pa.list_(pa.int64())),
                ],
                names=["doc_id", "node", "bands"],
            )


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser by sum of the greater weights of two bags (sorted keys, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    least = np.minimum(a[1][i], b[1][j]).sum()
    return float(least / (a[1].sum() + b[1].sum() - least)) if len(a[0]) or len(b[0]) else 0.0


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    _, key, weight = shingle_bags([text])
    order = np.argsort(key)
    return key[order], weight[order]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, bag = None, None
    for batch in batches:
        rows = batch.to_pydict()
        kept = []
        for a, b, text_a, text_b in zip(rows["a"], rows["b"], rows["text_a"], rows["text_b"]):
            if b != last:  # pairs of one leader mostly come together
                last, bag = b, _bag(text_b)
            kept.append(overlap(_bag(text_a), bag))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(kept, pa.float64())], names=["a", "b", "similarity"])


def _linked(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose multisets overlap enough."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify, "a binary, b binary, similarity double").where(F.col("similarity") >= similarity).select("a", "b")


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, token): the n-th occurrence of a shingle is a token of its own.

    The overlap of two multisets is then that of two sets.
    """
    doc, key, weight = shingle_bags(texts)
    nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    return np.repeat(doc, weight), mixed(np.repeat(key, weight) + nth.astype(np.uint64) * _ODD[4])


def _close(similarity: float):
    """Links between the components of a block: at most one less than the block has components."""

    def run(keys, members):
        import pandas as pd

        members = members.sort_values("node")
        parent: dict[bytes, bytes] = {r: r for r in members["root"]}
        found: list[tuple[bytes, bytes]] = []

        def top(r: bytes) -> bytes:
            while parent[r] != r:
                parent[r] = r = parent[parent[r]]
            return r

        chunk, nodes, roots = members["chunk"].to_numpy(), members["node"].tolist(), members["root"].tolist()
        left, right = np.flatnonzero(chunk == keys[1]), np.flatnonzero(chunk == keys[2])
        if len(parent) > 1 and len(left) and len(right):
            doc, token = _tokens(members["text"].tolist())
            count = np.bincount(doc, minlength=len(nodes))
            first = np.concatenate([[0], np.cumsum(count)])
            known, code = np.unique(token, return_inverse=True)
            inside = np.isin(doc, right)
            order = np.argsort(code[inside], kind="stable")
            posted = doc[inside][order]
            begin = np.searchsorted(code[inside][order], np.arange(len(known) + 1))
            for x in left:
                mine = code[first[x] : first[x + 1]]
                sizes = begin[mine + 1] - begin[mine]
                at = np.repeat(begin[mine] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
                both = np.bincount(posted[at], minlength=len(nodes))
                alike = both >= similarity * (count[x] + count - both)
                for y in np.flatnonzero(alike & (both > 0)):
                    a, b = top(roots[x]), top(roots[y])
                    if a != b:
                        parent[max(a, b)] = min(a, b)
                        found.append((nodes[x], nodes[y]))
        return pd.DataFrame(found, columns=["a", "b"])

    return run


def _labelled(nodes: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
    """``nodes`` with the root of ``node``; a node without links is its own."""
    named = roots.select(F.col("node").alias(node), F.col("root").alias(root))
    return nodes.join(named, node, "left").withColumn(root, F.coalesce(root, node))


def _classes(docs: DataFrame, similarity: float) -> DataFrame:
    spark = docs.sparkSession
    signed = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sign, _SIGNED), "signed")
    nodes = signed.where("bands is not null").groupBy("node").agg(F.max("bands").alias("bands"))
    banded = stored(nodes.select("node", F.explode("bands").alias("bucket")), "banded")
    leaders = banded.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(banded.join(leaders, "bucket"), "buckets")

    suspects = shared.select("node").distinct()
    few = suspects.count() <= BROADCAST_NODES
    texts = docs.select(_node(F.col("text")).alias("node"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(suspects) if few else suspects, "node", "left_semi")
    texts = stored(texts.dropDuplicates(["node"]), "texts")

    stars = shared.where("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b"))
    first = stored(stars.groupBy("a").agg(F.min("b").alias("b")), "pairs")
    links = stored(_linked(first, texts, similarity), "verified")
    roots = stored(components(links), "roots")

    open_ = _labelled(_labelled(stars.distinct(), roots, "a", "root_a"), roots, "b", "root_b").where("root_a <> root_b")
    second = stored(open_.join(first, ["a", "b"], "left_anti").select("a", "b"), "pairs")
    links = stored(links.unionByName(_linked(second, texts, similarity)), "verified")
    roots = stored(components(links), "roots")

    # Buckets that still hold several components: their rows meet in blocks, where only links
    # that join two components are sent on.  Buckets of the same rows are compared once.
    sizes = texts.select("node", F.octet_length("text").alias("bytes"))
    members = _labelled(shared.select("bucket", "node"), roots, "node", "root").join(sizes, "node")
    split = members.groupBy("bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"),
        F.bit_xor(F.xxhash64("node")).alias("mark"), F.bit_xor(F.xxhash64(F.lit(1), F.col("node"))).alias("other"),
    ).where("low <> high")
    split = split.groupBy("n", "mark", "other").agg(F.min("bucket").alias("bucket"), F.max("bytes").alias("total"))
    members = stored(members.join(split.select("bucket", "n", "total"), "bucket"), "open")
    chunks = F.greatest(F.ceil(F.col("n") / BLOCK_ROWS), F.ceil(F.col("total") / BLOCK_TEXT)).cast("int")
    members = members.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    blocks = members.join(texts, "node").withColumn("with", F.explode(F.sequence(F.lit(0), chunks - 1))).select(
        "bucket", F.least("chunk", "with").alias("i"), F.greatest("chunk", "with").alias("j"), "chunk", "node", "root", "text"
    )
    third = blocks.groupBy("bucket", "i", "j").applyInPandas(_close(similarity), "a binary, b binary")
    links = links.unionByName(third)
    roots = stored(components(links), "roots")

    rows = _labelled(signed.select("doc_id", "node"), roots, "node", "root")
    classes = rows.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(classes, "root")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, node, class_id, class_size.

    ``class_id`` is the smallest doc_id of the class (null if none has one), ``class_size`` its
    number of rows.  Classes are the connected components of texts with a similarity of at least
    ``similarity``.  Null texts count as empty; texts without words are alike only if equal, and
    texts of one to four words only if their words are the same.  Repeated rows are members each.
    Only doc_id and text are read.  An empty table gives an empty result.
    """
    return _classes(docs, similarity).select("doc_id", "node", "class_id", "class_size")


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stand for their class: the first by doc_id (null last), one copy."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "node")).alias("first")
    keepers = _classes(docs, similarity).groupBy("root").agg(first)
    keepers = keepers.select(_row_key(F.col("first.doc_id"), F.col("first.node")).alias("key"))
    rows = docs.select(_row_key(F.col("doc_id"), _node(F.col("text"))).alias("key"), F.struct("*").alias("row"))
    return rows.join(keepers, "key", "left_semi").groupBy("key").agg(F.first("row").alias("row")).select("row.*")
