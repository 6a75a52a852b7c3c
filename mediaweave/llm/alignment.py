"""Alignment of two tokenizers' tokens by the bytes they cover, with diagonal run skipping.

Both tokenizers cut a text's bytes into tokens; groups end where tokens of both end.  Seen from an
index shift, long stretches are one to one: the two arrays of token ends are equal along the
diagonal.  Such a stretch is measured by exponential probing (1, 2, 4 ... ends compared at once,
then halving back); an irregular group is walked end by end, and the shift it leaves is the next
diagonal.

Tokens never reach over a space that follows a character other than white space, so a text falls
into units there; each distinct unit is tokenised and aligned once by a worker's bounded table, as
tokens of both end where it ends.  Texts are put together from their units in slices.

How often a pair of ids is linked is counted over the whole corpus.  Documents travel in blocks:
a block names its distinct pairs once, only those are shuffled to their counts and back.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import portions, stored

#: Characters of a slice and of a block of documents, and bytes of units kept by a worker.
SLICE, BLOCK_CHARS, TABLE_BYTES = 1 << 18, 1 << 20, 24 << 20
#: Characters of new units tokenised in a row.
ROW = 1 << 12
#: A unit begins with a space and has more than that: a space alone at the end stays with the unit before.
_UNITS = re.compile(r" (?<=\S )(?=[\s\S])")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, the bytes of every token, and a bounded table of the units seen so far.

    Unit number n has the A ids ``flat[0][first[0][n]:][:size[0][n]]``, and so on with 1 for B, 2 and
    3 for the numbers of A and B tokens in each of its groups; a unit whose bytes a tokenizer does
    not give back is marked in ``broken``.
    """

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.byte = Tokenizer.from_file(byte_path)
        self.byte.encode_special_tokens = True
        letters = byte_letters()
        names = self.byte.get_vocab()
        self.byte_tokens = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.byte_tokens[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        self.piece = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.piece.id_to_piece(i) for i in range(self.piece.get_piece_size())]
        self.piece_tokens = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        #: Units may be cut apart only if no piece holds a space behind another character.
        self.splits = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lengths = [np.array([len(t) for t in tokens], dtype=np.int64) for tokens in (self.byte_tokens, self.piece_tokens)]
        self.spelling = [pa.array(tokens, pa.binary()) for tokens in (self.byte_tokens, self.piece_tokens)]
        # How ids are written: A ids before "," and "|", then B ids before "," and ";".
        counts = (len(self.byte_tokens), len(pieces))
        written = [f"{i}{end}".encode() for n, ends in zip(counts, (",|", ",;")) for end in ends for i in range(n)]
        self.written = pa.array(written, pa.binary())
        self.written_from = (0, counts[0], 2 * counts[0], 2 * counts[0] + counts[1])
        self._empty()

    def _empty(self) -> None:
        self.rows: dict[str, int] = {}
        self.first = [np.zeros(0, dtype=np.int64) for _ in range(4)]
        self.size = [np.zeros(0, dtype=np.int64) for _ in range(4)]
        self.flat = [np.zeros(0, dtype=np.int64) for _ in range(4)]
        self.broken = np.zeros(0, dtype=bool)
        self.again = np.zeros(0, dtype=bool)
        self.spelled = 0

    def held(self) -> int:
        """Bytes of the table, about: the units with their dictionary entries, and the arrays."""
        return 150 * len(self.rows) + self.spelled + 66 * len(self.broken) + 8 * sum(map(len, self.flat))

    def _make_room(self) -> None:
        """Keep the units that were met again since the last time; none if they are too many."""
        keep = np.flatnonzero(self.again)
        units = [u for u, n in self.rows.items() if self.again[n]]
        first, size, flat, broken = self.first, self.size, self.flat, self.broken
        self._empty()
        if 150 * len(units) > TABLE_BYTES // 2:
            return
        self.rows = {u: n for n, u in enumerate(units)}
        self.spelled = sum(map(len, units))
        self.broken, self.again = broken[keep], np.zeros(len(keep), dtype=bool)
        for k in range(4):
            self.flat[k] = _gathered(flat[k], first[k][keep], size[k][keep])
            self.size[k] = size[k][keep]
            self.first[k] = np.cumsum(self.size[k]) - self.size[k]

    def units(self, text: str) -> list[str]:
        if not self.splits:
            return [text]
        first, *rest = _UNITS.split(text)
        return [first, *[" " + u for u in rest]]

    def learn(self, units: list[str]) -> None:
        """Tokenise the units that the table does not hold; each begins with a space."""
        if self.held() > TABLE_BYTES:
            self._make_room()
        distinct = dict.fromkeys(units)
        known = [self.rows.get(u, -1) for u in distinct]
        self.again[[n for n in known if n >= 0]] = True
        new = [u for u, n in zip(distinct, known) if n < 0]
        if not new:
            return
        # Units that end in a character other than white space may be tokenised in a row.
        self._add([u for u in new if not u[-1].isspace()], ROW)
        self._add([u for u in new if u[-1].isspace()], 0)

    def _add(self, units: list[str], limit: int) -> None:
        """Enter units, tokenised in rows of about ``limit`` characters."""
        if not units:
            return
        bounds = _rows_of(units, limit)
        rows = ["".join(units[x:y]) for x, y in zip(bounds, bounds[1:])]
        a = [e.ids for e in self.byte.encode_batch_fast(rows, add_special_tokens=False)]
        b = self.piece.encode([r[1:] for r in rows], num_threads=1)
        raw = [u.encode("utf-8", "surrogatepass") for u in units]
        size = np.array([len(r) for r in raw], dtype=np.int64)
        ends, whole = np.cumsum(size), b"".join(raw)
        flat = [np.fromiter(chain.from_iterable(ids), dtype=np.int64, count=sum(map(len, ids))) for ids in (a, b)]
        up_to = [np.cumsum(self.lengths[k][flat[k]]) for k in range(2)]
        cut = [np.searchsorted(u, ends, side="right") for u in up_to]
        good = all(len(u) and u[-1] == ends[-1] and (u[c - 1] == ends).all() for u, c in zip(up_to, cut))
        if not (good and all(self._spelled(k, flat[k]) == whole for k in range(2))):
            # Some bytes are not given back: find out which units' are not.
            if len(units) > 1:
                self._add(units[: len(units) // 2], limit)
                self._add(units[len(units) // 2 :], limit)
                return
            cut = [np.array([len(f)]) for f in flat] + [np.array([0])] * 2
            flat += [np.zeros(0, dtype=np.int64)] * 2
        else:
            # Tokens of both end with each unit, so the groups of a row of units are theirs one by one.
            grouped = _group_ends(groups(up_to[0].tolist(), up_to[1].tolist()), *up_to)
            cut += [np.searchsorted(grouped[0], cut[0], side="right")] * 2
            flat += [np.diff(g, prepend=0) for g in grouped]
        self.rows.update(zip(units, range(len(self.broken), len(self.broken) + len(units))))
        self.spelled += len(whole)
        self.broken = np.append(self.broken, np.full(len(units), not good))
        self.again = np.append(self.again, np.zeros(len(units), dtype=bool))
        for k in range(4):
            first = np.concatenate([[0], cut[k][:-1]])
            self.first[k] = np.append(self.first[k], len(self.flat[k]) + first)
            self.size[k] = np.append(self.size[k], cut[k] - first)
            self.flat[k] = np.append(self.flat[k], flat[k])

    def _spelled(self, k: int, ids: np.ndarray) -> bytes:
        """The bytes of some tokens in a row."""
        taken = self.spelling[k].take(pa.array(ids))
        end = np.frombuffer(taken.buffers()[1], dtype=np.int32, count=len(taken) + 1)[-1]
        return taken.buffers()[2][:end].to_pybytes()

    def ids(self, units: list[str]) -> list[np.ndarray] | None:
        """The A and the B ids of consecutive units and how many of each their groups have; None if bytes differ in one."""
        try:
            at = np.fromiter(map(self.rows.__getitem__, units), dtype=np.int64, count=len(units))
        except KeyError:
            self.learn(units)
            at = np.fromiter(map(self.rows.__getitem__, units), dtype=np.int64, count=len(units))
        if self.broken[at].any():
            return None
        return [_gathered(self.flat[k], self.first[k][at], self.size[k][at]) for k in range(4)]


def _rows_of(units: list[str], limit: int) -> list[int]:
    """Bounds of rows of about ``limit`` characters, one unit at least."""
    ends = np.cumsum([len(u) for u in units])
    at, row = [0], limit
    while at[-1] < len(units):
        stop = max(at[-1] + 1, int(np.searchsorted(ends, row, side="right")))
        at.append(stop)
        row = int(ends[stop - 1]) + limit
    return at


def _gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """flat[first[i]:first[i] + size[i]] of all i in a row."""
    return flat[np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())]


def groups(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int, int]]:
    """Stretches (first a, end a, first b, end b): as many one-to-one groups as tokens where both are equally long, else one group.

    Both lists ascend and have the same last end.  A stretch of one token each is a run of one.
    """
    out: list[tuple[int, int, int, int]] = []
    i = j = 0
    n = len(ends_a)
    while i < n:
        # The run along this diagonal: probe ever longer stretches, then halve back to the last equal end.
        if ends_a[i] == ends_b[j]:
            start, step = i, 2
            i += 1
            j += 1
            while i < n and ends_a[i : i + step] == ends_b[j : j + step]:
                i += step
                j += step
                step *= 2
            while step > 2 and i < n:
                step //= 2
                if ends_a[i : i + step] == ends_b[j : j + step]:
                    i += step
                    j += step
            if i < n and ends_a[i] == ends_b[j]:
                i += 1
                j += 1
            if i > n:  # stretches at the end are shorter than a step
                j -= i - n
                i = n
            out.append((start, i, j - (i - start), j))
            if i >= n:
                break
        # An irregular group: the side that is behind goes on until the ends meet; the shift is then a new one.
        a, b = i, j
        x, y = ends_a[a], ends_b[b]
        while x != y:
            if x < y:
                a += 1
                x = ends_a[a]
            else:
                b += 1
                y = ends_b[b]
        out.append((i, a + 1, j, b + 1))
        i, j = a + 1, b + 1
    return out


def _group_ends(stretches: list[tuple[int, int, int, int]], ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many A and B tokens lie up to the end of each group."""
    p, q, r, s = np.fromiter(chain.from_iterable(stretches), dtype=np.int64, count=4 * len(stretches)).reshape(-1, 4).T
    # A stretch is a run if its first tokens end together; an irregular group's do not, unless it is over with them.
    run = (ends_a[p] == ends_b[r]) & (q - p == s - r)
    n = np.where(run, q - p, 1)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + 1
    run = np.repeat(run, n)
    return np.where(run, np.repeat(p, n) + nth, np.repeat(q, n)), np.where(run, np.repeat(r, n) + nth, np.repeat(s, n))


class Aligned:
    """What the alignment of one text gives: counts, the digest of its groups, its links."""

    def __init__(self, tokenizers: Tokenizers, text: str, units: list[str] | None = None):
        self.n_a = self.n_b = self.n_groups = 0
        self.sha = ""
        self.links = np.zeros(0, dtype=np.int64)
        if not text:
            return
        digest, links, n_a, n_b, start = hashlib.sha256(), [], 0, 0, 0
        units = tokenizers.units(" " + text) if units is None else units
        while start < len(units):
            stop, size = (len(units), 0) if len(text) < SLICE else (start, 0)
            while stop < len(units) and (size == 0 or size + len(units[stop]) <= SLICE):
                size += len(units[stop])
                stop += 1
            found = tokenizers.ids(units[start:stop])
            if found is None:
                return
            a, b, own_a, own_b = found
            up_to_a, up_to_b = np.cumsum(own_a), np.cumsum(own_b)
            # Each id as it is written, the A ids of a group before its B ids.
            last_a, last_b = np.zeros(len(a), dtype=bool), np.zeros(len(b), dtype=bool)
            last_a[up_to_a - 1], last_b[up_to_b - 1] = True, True
            shown = np.empty(len(a) + len(b), dtype=np.int64)
            at = tokenizers.written_from
            shown[np.arange(len(a)) + np.repeat(up_to_b - own_b, own_a)] = a + np.where(last_a, at[1], at[0])
            shown[np.arange(len(b)) + np.repeat(up_to_a, own_b)] = b + np.where(last_b, at[3], at[2])
            written = tokenizers.written.take(pa.array(shown))
            end = np.frombuffer(written.buffers()[1], dtype=np.int32, count=len(written) + 1)[-1]
            start = stop
            digest.update(memoryview(written.buffers()[2])[: end - (start == len(units))])  # no ";" behind the last group
            links.append((a[up_to_a - 1] << 32) | b[up_to_b - 1])
            n_a, n_b = n_a + len(a), n_b + len(b)
        self.links = np.concatenate(links)
        self.n_a, self.n_b, self.n_groups, self.sha = n_a, n_b, len(self.links), digest.hexdigest()


@functools.lru_cache(maxsize=1)
def worker_tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    """One for each Python worker; it stays while the worker is reused."""
    return Tokenizers(byte_path, piece_path)


_DOC = pa.struct([
    ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("sha", pa.string()),
    ("places", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
])
_BLOCKS = (
    "block binary, docs array<struct<doc_id:long,n_a:long,n_b:long,n_groups:long,sha:string,places:array<int>,times:array<int>>>, "
    "pairs array<long>, totals array<long>"
)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(parts) + 1, dtype=np.int32)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.zeros(0), kind))


def _block(names: list, found: list[Aligned]) -> pa.RecordBatch:
    """One row: the documents of a block, their pairs by place in the block's list of distinct pairs."""
    own = [np.unique(f.links, return_counts=True) for f in found]
    pairs, at = np.unique(np.concatenate([o[0] for o in own]), return_inverse=True)
    times = np.concatenate([o[1] for o in own])
    totals = np.bincount(at, weights=times, minlength=len(pairs)).astype(np.int64)
    bounds = np.cumsum([0, *[len(o[0]) for o in own]])
    docs = pa.StructArray.from_arrays(
        [
            pa.array(names, pa.int64()), pa.array([f.n_a for f in found], pa.int64()), pa.array([f.n_b for f in found], pa.int64()),
            pa.array([f.n_groups for f in found], pa.int64()), pa.array([f.sha for f in found], pa.string()),
            _lists([at[x:y].astype(np.int32) for x, y in zip(bounds, bounds[1:])], pa.int32()), _lists([o[1].astype(np.int32) for o in own], pa.int32()),
        ],
        fields=list(_DOC),
    )
    return pa.record_batch(
        [
            pa.array([uuid.uuid4().bytes], pa.binary()), pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), docs),
            _lists([pairs], pa.int64()), _lists([totals], pa.int64()),
        ],
        names=["block", "docs", "pairs", "totals"],
    )


def _align(byte_path: str, piece_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = worker_tokenizers(byte_path, piece_path)
        names, found, size = [], [], 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, b in portions(texts, BLOCK_CHARS):
                if found and size + sum(map(len, texts[a:b])) > BLOCK_CHARS:
                    yield _block(names, found)
                    names, found, size = [], [], 0
                # The units of a block are learned together; those of a very long text slice by slice.
                units = [tokenizers.units(" " + t) for t in texts[a:b]]
                if b > a + 1:
                    tokenizers.learn(list(chain.from_iterable(units)))
                for i in range(a, b):
                    names.append(ids[i])
                    found.append(Aligned(tokenizers, texts[i], units[i - a]))
                    size += len(texts[i])
        if found:
            yield _block(names, found)

    return run


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with the corpus-wide counts of their pairs to rows by document."""
    for batch in batches:
        for k in range(batch.num_rows):
            docs = batch.column(0)[k].values
            counted = batch.column(1)[k].values
            counts = np.zeros(0, dtype=np.int64)
            best = np.zeros(0, dtype=bool)
            if counted is not None and len(counted):
                place = counted.field("place").to_numpy(zero_copy_only=False)
                counts, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=bool)
                counts[place] = counted.field("count").to_numpy(zero_copy_only=False)
                best[place] = counted.field("best").to_numpy(zero_copy_only=False)
            n = len(docs)
            places, times = docs.field("places"), docs.field("times")
            size = np.array(places.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
            owner = np.repeat(np.arange(n), size)
            at, weight = places.flatten().to_numpy(zero_copy_only=False), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            sums, hits, links = (np.zeros(n, dtype=np.int64) for _ in range(3))
            np.add.at(sums, owner, weight * counts[at])
            np.add.at(hits, owner, weight * best[at])
            np.add.at(links, owner, weight)
            yield pa.record_batch(
                [docs.field("doc_id"), docs.field("n_a"), docs.field("n_b"), docs.field("n_groups"), pa.array(links), pa.array(hits), pa.array(sums), docs.field("sha")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
            )


def blocks(docs: DataFrame, byte_path: str, piece_path: str) -> tuple[DataFrame, DataFrame]:
    """The aligned documents in blocks, and the links by block: block, place, pair (a << 32 | b), times."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    aligned_blocks = stored(rows.mapInArrow(_align(byte_path, piece_path), _BLOCKS), "aligned")
    links = aligned_blocks.select("block", F.posexplode(F.arrays_zip("pairs", "totals")).alias("place", "link"))
    return aligned_blocks, links.select("block", "place", F.col("link.pairs").alias("pair"), F.col("link.totals").alias("times"))


def aligned(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row.

    A link is an A and a B token that end at the same byte, so a group has one.  Its count is how
    often its two ids are linked in all rows; it is best if no A id is linked with its B id more
    often.  Null and empty texts, and texts whose bytes a tokenizer does not give back (with the
    space put in front), have zeros and an empty digest.  Repeated rows are rows each, and count
    each.  Only doc_id and text are read, whatever other columns there are.  No rows, no result.
    """
    found, links = blocks(docs, byte_path, piece_path)
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    counts = stored(counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))), "pair-counts")
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    judged = stored(counts.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "judged")
    back = links.join(judged, "pair").groupBy("block").agg(F.collect_list(F.struct("place", "count", "best")).alias("counted"))
    return found.join(back, "block", "left").select("docs", "counted").mapInArrow(_scored, _RESULT)
