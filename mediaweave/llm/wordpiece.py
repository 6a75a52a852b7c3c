"""Token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes.  Where a byte cannot be followed, a failure link leads to
the node for what is left after the longest pieces have been cut off the front; how many pieces
that pops is computed beforehand, so a word's greedy longest-match pieces are counted in one pass
over its bytes without being built.  Words of a megabyte of text take their steps together.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Words, text_slices

VOCABULARY = "piece_bpe_32k.model"
WORD_MARK = "▁"


def piece_vocabulary(name: str = VOCABULARY) -> list[bytes]:
    """The pieces of an installed public vocabulary, byte and control pieces left out."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return [
        model.id_to_piece(i).encode()
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
    ]


class Automaton:
    """Dense steps: (state, byte) to the next state and the pieces popped on the way.

    Every single byte is a piece, so each word has pieces.  ``ends[state]`` is the number of
    pieces a word's rest at that state makes.  State 0 is the root.
    """

    def __init__(self, vocabulary: list[bytes], mark: bytes = WORD_MARK.encode()):
        pieces = {p for p in vocabulary if p} | {bytes([b]) for b in range(256)}
        child: list[dict[int, int]] = [{}]
        depth_of: list[int] = [0]
        final: list[bool] = [False]
        for piece in sorted(pieces):
            state = 0
            for byte in piece:
                if byte not in child[state]:
                    child[state][byte] = len(child)
                    child.append({})
                    depth_of.append(depth_of[state] + 1)
                    final.append(False)
                state = child[state][byte]
            final[state] = True
        size = len(child)
        self.next = np.zeros((size, 256), dtype=np.int32)
        self.pops = np.zeros((size, 256), dtype=np.uint16)
        fail, popped = np.zeros(size, dtype=np.int32), np.zeros(size, dtype=np.int32)
        for byte, state in child[0].items():
            self.next[0, byte] = state
        # By depth: a node's link is known before its children's, and its row is its link's row
        # (with the pops of the link added) but for the children it has.
        level = list(child[0].values())
        for state in level:
            fail[state], popped[state] = 0, 1
        while level:
            for state in level:
                row, count = self.next[fail[state]].copy(), self.pops[fail[state]].astype(np.int32) + popped[state]
                for byte, below in child[state].items():
                    if final[below]:
                        fail[below], popped[below] = 0, 1
                    else:
                        fail[below], popped[below] = row[byte], count[byte]
                    row[byte], count[byte] = below, 0
                self.next[state], self.pops[state] = row, count
            level = [below for state in level for below in child[state].values()]
        self.ends = np.zeros(size, dtype=np.int64)
        for state in np.argsort(depth_of, kind="stable")[1:]:
            self.ends[state] = popped[state] + self.ends[fail[state]]
        self.start, self.before = self._walk(0, mark)

    def _walk(self, state: int, data: bytes) -> tuple[int, int]:
        count = 0
        for byte in data:
            count += int(self.pops[state, byte])
            state = int(self.next[state, byte])
        return state, count

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end] behind the word mark."""
        total = np.full(len(starts), self.before, dtype=np.int64)
        state = np.full(len(starts), self.start, dtype=np.int32)
        order = np.argsort(starts - ends, kind="stable")  # longest first: those still running are a prefix
        lengths = (ends - starts)[order]
        at, total_, state_ = starts[order], total[order], state[order]
        running, step = len(order), 0
        while running:
            while running and lengths[running - 1] <= step:
                running -= 1
            if not running:
                break
            if running < 8:  # few long words: byte by byte without arrays
                for i in range(running):
                    found, count = self._walk(int(state_[i]), data[at[i] + step : at[i] + lengths[i]].tobytes())
                    state_[i], total_[i] = found, total_[i] + count
                break
            byte = data[at[:running] + step]
            total_[:running] += self.pops[state_[:running], byte]
            state_[:running] = self.next[state_[:running], byte]
            step += 1
        total[order] = total_ + self.ends[state_]
        return total


@functools.lru_cache(maxsize=1)
def worker_automaton(name: str) -> Automaton:
    """One automaton per Python worker; it stays while the worker is reused."""
    return Automaton(piece_vocabulary(name))


def text_counts(automaton: Automaton, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words and pieces of each text."""
    words_of, pieces_of = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
    owners: list[int] = []
    parts: list[str] = []

    def flush() -> None:
        words = Words(parts, WHITE)
        _, index, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        counts = automaton.counts(words.data, words.starts[index], words.ends[index])[inverse]
        sums = np.concatenate([[0], np.cumsum(counts)])
        np.add.at(words_of, owners, np.diff(words.first))
        np.add.at(pieces_of, owners, np.diff(sums[words.first]))
        owners.clear()
        parts.clear()

    size = 0
    for owner, part in text_slices(texts):
        if parts and size + len(part) > 1 << 20:
            flush()
            size = 0
        owners.append(owner)
        parts.append(part)
        size += len(part)
    if parts:
        flush()
    return words_of, pieces_of


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_words, n_tokens of every row: greedy longest-match pieces of its words.

    Words are what ASCII white space separates, each behind the word mark; bytes that no longer
    piece covers count one each.  Null and empty texts have none.  Rows are counted one by one,
    so repeated rows and skew change nothing.  Only doc_id and text are read.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_automaton(vocabulary)
        for batch in batches:
            words, tokens = text_counts(automaton, [t or "" for t in batch.column(1).to_pylist()])
            yield pa.record_batch([batch.column(0), pa.array(words), pa.array(tokens)], names=["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long")
