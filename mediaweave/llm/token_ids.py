"""Token ids of whole texts by a given tokenizer, each distinct word encoded once per worker.

The tokenizer's pattern never crosses white space, so a text's ids are those of its white-space
separated words in a row.  Words are told apart by a 64-bit hash of their bytes; a bounded table
of the words seen so far turns the words of a megabyte of text into ids in a few array steps.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np

from .common import WHITE, Words, text_slices

#: Bytes of a worker's table of words and of its table of parts.  A full table drops the words it
#: was not asked for since it was last full, oldest first: that costs time only.
TABLE_BYTES = 24 << 20
PARTS_KEPT = 20_000
_SIMPLE = re.compile(r"[!-~]+")
#: What the tokenizer's pattern finds in lower-case ASCII without white space.
_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """The place of an installed public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class TokenIds:
    """Ids by a tokenizer that lower-cases, drops white space and splits by the pattern above."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.parts: dict[str, list[int]] = {}
        self._empty()

    def _empty(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)
        self.starts = np.zeros(0, dtype=np.int64)
        self.lengths = np.zeros(0, dtype=np.int64)
        self.asked = np.zeros(0, dtype=bool)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.used = 0

    def held(self) -> int:
        """Bytes of the table: the words' hashes, places, lengths and marks, and their ids."""
        return 25 * len(self.keys) + 4 * self.used

    def _make_room(self) -> None:
        """Drop what was not met again since the last time, then the older half, until half the bytes are free."""
        self._keep(self.asked)
        if self.held() > TABLE_BYTES // 2:
            self._keep(self.starts >= self.used // 2)
        self.asked[:] = False

    def _keep(self, mask: np.ndarray) -> None:
        keep = np.flatnonzero(mask)
        order = np.argsort(self.starts[keep], kind="stable")  # ids stay in the order they were learned
        lengths = self.lengths[keep][order]
        ends = np.cumsum(lengths)
        used = int(ends[-1]) if len(ends) else 0
        self.flat = self.flat[np.repeat(self.starts[keep][order] - ends + lengths, lengths) + np.arange(used)]
        places = np.empty(len(keep), dtype=np.int64)
        places[order] = ends - lengths
        self.keys, self.starts, self.lengths, self.asked, self.used = self.keys[keep], places, self.lengths[keep], self.asked[keep], used

    def word(self, word: str) -> list[int]:
        """The ids of one word; what is not plain ASCII goes through the whole tokenizer."""
        if "<|" in word or not _SIMPLE.fullmatch(word):
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        out: list[int] = []
        for part in _PARTS.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                if len(self.parts) >= PARTS_KEPT:
                    self.parts.clear()
                ids = self.parts[part] = [t.id for t in self.model.tokenize(part)]
            out += ids
        return out

    def _learn(self, words: Words, keys: np.ndarray, where: np.ndarray) -> None:
        data = words.data
        spelled = [data[words.starts[i] : words.ends[i]].tobytes().decode("utf-8", "surrogatepass") for i in where]
        found = [self.word(w) for w in spelled]
        lengths = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        more = int(lengths.sum())
        if self.used + more > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(max(len(self.flat) // 2, more), dtype=np.uint32)])
        self.flat[self.used : self.used + more] = np.fromiter((x for ids in found for x in ids), dtype=np.uint32, count=more)
        at = np.searchsorted(self.keys, keys)
        self.starts = np.insert(self.starts, at, self.used + np.cumsum(lengths) - lengths)
        self.lengths = np.insert(self.lengths, at, lengths)
        self.keys = np.insert(self.keys, at, keys)
        self.asked = np.insert(self.asked, at, False)
        self.used += more

    def many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each text has."""
        words = Words(texts, WHITE)
        if self.held() > TABLE_BYTES:
            self._make_room()
        keys, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), dtype=bool)
        self.asked[at[~new]] = True
        if new.any():
            self._learn(words, keys[new], first[new])
        at = np.searchsorted(self.keys, keys)
        starts, lengths = self.starts[at][inverse], self.lengths[at][inverse]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.flat[np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])]
        return ids, before[words.first[1:]] - before[words.first[:-1]]

    def each(self, texts: list[str]):
        """(text number, ids) of every text; memory is bounded by the longest text's ids."""
        held: list[np.ndarray] = []
        owner, batch, owners, size = None, [], [], 0

        def flush():
            ids, counts = self.many(batch)
            ends = np.cumsum(counts)
            return [(o, ids[e - c : e]) for o, c, e in zip(owners, counts, ends)]

        def whole(parts):
            nonlocal owner, held
            for o, ids in parts:
                if o != owner and owner is not None:
                    yield owner, np.concatenate(held)
                    held = []
                owner = o
                held.append(ids)

        for i, part in text_slices(texts):
            if batch and size + len(part) > 1 << 20:
                yield from whole(flush())
                batch, owners, size = [], [], 0
            batch.append(part)
            owners.append(i)
            size += len(part)
        if batch:
            yield from whole(flush())
        if owner is not None:
            yield owner, np.concatenate(held)


@functools.lru_cache(maxsize=2)
def worker_ids(path: str) -> TokenIds:
    """One table per Python worker; it stays while the worker is reused."""
    return TokenIds(path)
