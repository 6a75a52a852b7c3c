"""Document fingerprints by SpotSigs: content words that follow common words.

Every common word of a text is an anchor; it and the next two content words, common words left
out, make a signature.  A text's fingerprint is its set of signatures.  Sets are compared by Jaccard
similarity.  Where a least likeness is wanted, sets are partitioned by length, so that sets more
than one partition apart are not compared, nor those whose lengths alone forbid it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_WORD, Words, mixed, stored

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to in is it that for as with was on are be by this an or at from not a but have had his they you which one were all "
    "le la les des du un une et est que qui dans pour pas sur au avec se ce il elle ne en ou son plus par "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "el los del y las por con no una su para lo como más pero sus le ya o fue este ha sí porque esta entre"
).split()
CHAIN = 2
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _anchor_hashes() -> np.ndarray:
    return np.unique(Words([" ".join(ANCHORS)], NOT_WORD).hash)


_STOP = _anchor_hashes()


def _chains(h: np.ndarray, last: np.ndarray, anchors: np.ndarray, content: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of anchors; content[after[i]] is the first content word behind word i."""
    sums = h[anchors] * _ODD[0]
    some = np.zeros(len(anchors), dtype=bool)
    for k in range(CHAIN):
        at = after[anchors] + k
        inside = at < len(content)
        word = content[np.minimum(at, max(len(content) - 1, 0))] if len(content) else np.zeros(len(anchors), dtype=np.int64)
        inside &= word < last[anchors]
        sums[inside] += h[word[inside]] * (_ODD[1] + np.uint64(2 * k))
        some |= inside
    return mixed(sums), some


def spot_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted signatures of each text.

    A text without an anchor that a content word follows takes all its words as anchors; a text
    without words is one signature of itself; the empty text has none.
    """
    words = Words([t.lower() for t in texts], NOT_WORD)
    h, count = words.hash, np.diff(words.first)
    doc = np.repeat(np.arange(len(texts)), count)
    last = words.first[1:][doc]
    stop = _STOP[np.minimum(np.searchsorted(_STOP, h), len(_STOP) - 1)] == h if len(h) else np.zeros(0, dtype=bool)
    content = np.flatnonzero(~stop)
    anchors = np.flatnonzero(stop)
    found, some = _chains(h, last, anchors, content, np.cumsum(~stop))
    owner, key = doc[anchors[some]], found[some]
    bare = np.bincount(owner, minlength=len(texts)) == 0
    rest = np.flatnonzero(bare[doc]) if len(doc) else np.zeros(0, dtype=np.int64)
    if len(rest):
        every = np.arange(len(h))
        found, _ = _chains(h, last, rest, every, every + 1)
        owner, key = np.concatenate([owner, doc[rest]]), np.concatenate([key, found])
    _, index = np.unique(key ^ mixed(owner.astype(np.uint64) + np.uint64(77)), return_index=True)
    owner, key = owner[index], key[index]
    order = np.lexsort((key, owner))
    owner, key = owner[order], key[order]
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    sets = [key[bounds[i] : bounds[i + 1]] for i in range(len(texts))]
    for i in np.flatnonzero(count == 0):
        raw = texts[i].encode("utf-8", "surrogatepass")
        sets[i] = np.frombuffer(hashlib.sha256(raw).digest()[:8], dtype=np.uint64) if raw else key[:0]
    return sets


def partition(size: int, least: float) -> int:
    """The length partition of a set; sets at least ``least`` alike are in one or in neighbouring partitions."""
    return 0 if size == 0 else 1 + int(math.log(size) / math.log(1 / least))


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two sorted sets; two empty sets are alike.

    With ``least`` above 0, sets whose lengths alone keep them below it are not compared and
    give 0, as do sets that turn out below it.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if 0 < least < 1 and (abs(partition(len(a), least) - partition(len(b), least)) > 1 or min(len(a), len(b)) < least * max(len(a), len(b))):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    value = both / (len(a) + len(b) - both)
    return value if value >= least else 0.0


def fingerprint(signatures: np.ndarray) -> str:
    """The set's length and a digest of its sorted signatures."""
    return f"{len(signatures)}:{hashlib.sha256(signatures.astype('<u8').tobytes()).hexdigest()[:32]}"


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by as many first ones of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [c.split(" ")[0] for c in _RESULT.split(", ")]


def _compared(names: list, texts: list[str], following: str) -> list[tuple]:
    """Result rows of consecutive texts; ``following`` comes after the last."""
    after = texts[1:] + [following]
    changed = [edited(t, n) for t, n in zip(texts, after)]
    sets = spot_sets(texts + [following] + changed)
    own, new = sets[: len(texts) + 1], sets[len(texts) + 1 :]
    return [
        (
            names[i], len(texts[i]), hashlib.sha256(changed[i].encode("utf-8", "surrogatepass")).hexdigest(),
            fingerprint(own[i]), fingerprint(new[i]), likeness(own[i], new[i]), likeness(own[i], own[i + 1]),
        )
        for i in range(len(texts))
    ]


_STEP = _RESULT + ", part int, text string, role string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 10
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=[*_NAMES, "part", "text", "role"])


def _consecutive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the partition's last, which is handed on with the first as text."""
    part, names, texts, size, head = TaskContext.get().partitionId(), [], [], 0, True
    for batch in batches:
        for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            text = text or ""
            if head:
                yield _batch([(name, *[None] * 6, part, text, "head")])
                head = False
            if texts and size > 1 << 20:
                yield _batch([(*r, part, None, "row") for r in _compared(names, texts, text)])
                names, texts, size = [], [], 0
            names.append(name)
            texts.append(text)
            size += len(text)
    if len(texts) > 1:
        yield _batch([(*r, part, None, "row") for r in _compared(names[:-1], texts[:-1], texts[-1])])
    if texts:
        yield _batch([(names[-1], *[None] * 6, part, texts[-1], "tail")])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        found = [r for n, t, f in zip(rows["doc_id"], rows["text"], rows["following"]) for r in _compared([n], [t], f)]
        yield pa.record_batch([pa.array(c) if c else pa.array([], pa.string()) for c in (list(zip(*found)) or [()] * 7)], names=_NAMES)


def _ranged(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in order: descending ids, null last, equal ids by the text's hash, equal texts by place.

    Equal rows give equal results in any order, so their place may cut them into ranges.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("place", F.monotonically_increasing_id())
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text"), F.col("place")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each text's fingerprint, that of its edited text, and their likeness; see the columns.

    The next document is the one with the next smaller doc_id (null ids last, equal ids by the text's hash);
    after the last comes the first.  An edited text keeps the first half and takes the second
    from the next document.  Null texts count as empty; repeated rows are rows of their own; a
    single row is its own next document.  Only doc_id and text are read.  Texts are shuffled
    once, by ranges of doc_id, the text's hash and the row's place, so that rows of one id, or
    equal rows, are dealt over as many ranges as they fill; only a partition's first and last
    texts travel further.
    """
    found = stored(_ranged(docs).mapInArrow(_consecutive, _STEP), "spots")
    heads = found.where("role = 'head'").select("part", F.col("text").alias("following"))
    turn = Window.orderBy("part")
    ring = heads.select("part", F.lead("part").over(turn).alias("onward"), F.min("part").over(Window.partitionBy()).alias("least"))
    ring = ring.select("part", F.coalesce("onward", "least").alias("onward"))
    tails = found.where("role = 'tail'").select("doc_id", "text", "part").join(ring, "part")
    tails = tails.join(heads.withColumnRenamed("part", "onward"), "onward")
    last = tails.select("doc_id", "text", "following").mapInArrow(_edges, _RESULT)
    return found.where("role = 'row'").select(*_NAMES).unionByName(last)
