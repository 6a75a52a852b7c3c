"""Document quality by a byte-level convolutional network, written in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it.  Learned filters over
a few bytes each run along every chunk and are max-pooled; a small layer turns a chunk's maxima
into features, whose mean over all chunks gives one probability.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import portions

CHUNK, OVERLAP = 512, 64
WIDTH, FILTERS, HIDDEN = 6, 32, 24
#: Chunks that are copied out of their texts, and that the filters run along, at a time.
ROWS = 16
KEEP = 0.7
#: Bound of the training sample: labelled rows by the order of their digest, chunks of each text.
TRAINING_ROWS = 6000
TRAINING_CHUNKS = 6
EPOCHS, BATCH, RATE, SEED = 8, 64, 0.01, 7
#: Fewer rows are gone through more often, for this many steps at least.
LEAST_STEPS = 400


def chunk_places(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in a row (each padded with zero bytes), where each chunk starts, and the number of each text's first chunk."""
    step = CHUNK - OVERLAP
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    counts = 1 + np.maximum(sizes - CHUNK + step - 1, 0) // step
    first = np.cumsum(counts) - counts
    begin = np.cumsum(sizes + CHUNK) - sizes - CHUNK
    data = np.zeros(int(sizes.sum()) + CHUNK * len(texts), dtype=np.uint8)
    for text, at in zip(texts, begin):
        data[at : at + len(text)] = np.frombuffer(text, dtype=np.uint8)
    nth = np.arange(counts.sum()) - np.repeat(first, counts)
    return data, np.repeat(begin, counts) + nth * step, first


def cut_out(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The chunks that start there, one a row."""
    return data[starts[:, None] + np.arange(CHUNK)]


def chunk_matrix(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The chunks of all texts (padded with zero bytes) and the number of each text's first one."""
    data, starts, first = chunk_places(texts)
    return cut_out(data, starts), first


class ByteNetwork:
    """Filters, one hidden layer and a logistic output; plain arrays, so it travels with a task."""

    def __init__(self, seed: int = SEED):
        random = np.random.default_rng(seed)
        self.filters = random.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32)
        self.inner = random.normal(0, (2 / FILTERS) ** 0.5, (FILTERS, HIDDEN)).astype(np.float32)
        self.shift = np.zeros(HIDDEN, dtype=np.float32)
        self.outer = random.normal(0, HIDDEN**-0.5, HIDDEN).astype(np.float32)
        self.bias = np.zeros(1, dtype=np.float32)
        self.learned = False

    def pooled(self, chunks: np.ndarray, where: bool = False):
        """Each filter's maximum over each chunk; with ``where`` also its place."""
        top = np.empty((len(chunks), FILTERS), dtype=np.float32)
        at = np.empty((len(chunks), FILTERS), dtype=np.int64) if where else None
        for a in range(0, len(chunks), ROWS):
            part = chunks[a : a + ROWS]
            last = CHUNK - WIDTH + 1
            values = self.filters[0][part[:, 0:last]]
            for k in range(1, WIDTH):
                values += self.filters[k][part[:, k : k + last]]
            if where:
                at[a : a + ROWS] = values.argmax(axis=1)
                top[a : a + ROWS] = np.take_along_axis(values, at[a : a + ROWS][:, None, :], axis=1)[:, 0]
            else:
                values.max(axis=1, out=top[a : a + ROWS])
        return top, at

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1, to six digits, so that equal texts score alike; an empty text is one chunk of padding.

        Chunks are copied out a few at a time: the texts' own bytes are all that is held whole.
        """
        data, starts, first = chunk_places(texts)
        top = np.empty((len(starts), FILTERS), dtype=np.float32)
        for a in range(0, len(starts), ROWS):
            top[a : a + ROWS] = self.pooled(cut_out(data, starts[a : a + ROWS]))[0]
        hidden = np.maximum(np.tanh(top) @ self.inner + self.shift, 0)
        counts = np.diff(np.append(first, len(starts)))
        mean = np.add.reduceat(hidden.astype(np.float64), first, axis=0) / counts[:, None]
        return np.round(1 / (1 + np.exp(-(mean @ self.outer.astype(np.float64) + float(self.bias[0])))), 6)

    def fit(self, chunks: np.ndarray, owner: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> None:
        """Adam steps on the log loss; chunks[i] belongs to text owner[i], owners ascending."""
        names = ("filters", "inner", "shift", "outer", "bias")
        self.learned = True
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        begin = np.searchsorted(owner, np.arange(len(labels) + 1))
        random, step = np.random.default_rng(SEED), 0
        epochs = max(epochs, -(-LEAST_STEPS // -(-len(labels) // BATCH)))
        for epoch in range(epochs):
            order = random.permutation(len(labels))
            rate = RATE * (1 - epoch / epochs) + RATE / 20
            for a in range(0, len(order), BATCH):
                texts = order[a : a + BATCH]
                rows = np.concatenate([np.arange(begin[t], begin[t + 1]) for t in texts])
                counts = begin[texts + 1] - begin[texts]
                text = np.repeat(np.arange(len(texts)), counts)
                share = (1 / counts[text]).astype(np.float32)
                top, at = self.pooled(chunks[rows], where=True)
                bent = np.tanh(top)
                hidden = np.maximum(bent @ self.inner + self.shift, 0)
                mean = np.zeros((len(texts), HIDDEN), dtype=np.float32)
                np.add.at(mean, text, hidden * share[:, None])
                error = 1 / (1 + np.exp(-(mean @ self.outer + self.bias[0]))) - labels[texts]
                error = (error / len(texts)).astype(np.float32)
                back = (error[text] * share)[:, None] * self.outer * (hidden > 0)
                to_top = (back @ self.inner.T) * (1 - bent**2)
                to_filters = np.zeros_like(self.filters)
                columns = np.arange(FILTERS)
                for k in range(WIDTH):
                    seen = np.take_along_axis(chunks[rows], at + k, axis=1)
                    np.add.at(to_filters[k], (seen, columns[None, :]), to_top)
                gradients = {
                    "filters": to_filters, "inner": bent.T @ back, "shift": back.sum(axis=0),
                    "outer": mean.T @ error, "bias": np.array([error.sum()], dtype=np.float32),
                }
                step += 1
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * gradients[n]
                    second[n] = 0.999 * second[n] + 0.001 * gradients[n] ** 2
                    move = first[n] / (1 - 0.9**step) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-7)
                    setattr(self, n, (getattr(self, n) - rate * move).astype(np.float32))


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _training_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some whole chunks of each text, spread over it."""
    for batch in batches:
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        out = []
        for text in texts:
            data, starts, _ = chunk_places([text])
            few = np.unique(np.linspace(0, len(starts) - 1, min(len(starts), TRAINING_CHUNKS)).astype(np.int64))
            out.append(cut_out(data, starts[few]).tobytes())
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["doc_id", "quality", "chunks"])


def trained(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> ByteNetwork:
    """A network fitted on at most ``rows`` labelled texts outside the held-out part.

    A doc_id with several labels counts with the lowest, one with several texts with the first in
    order; null ids and labels do not count.  Labels of other documents take no place in the
    sample.  Without a labelled text the network keeps a score of one half for every text.
    """
    known = labels.where("doc_id is not null and quality is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    known = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    texts = texts.select(F.col("doc_id").cast("long"), "quality", "text")
    found = texts.mapInArrow(_training_chunks, "doc_id long, quality int, chunks binary").toPandas()
    network = ByteNetwork()
    if found.empty:
        network.outer[:] = 0
        return network
    found = found.sort_values("doc_id")
    parts = [np.frombuffer(c, dtype=np.uint8).reshape(-1, CHUNK) for c in found["chunks"]]
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    network.fit(np.concatenate(parts), owner, found["quality"].to_numpy(dtype=np.float32))
    return network


def _text_scores(network: ByteNetwork, texts: list[str | None]) -> np.ndarray:
    raw = [t or "" for t in texts]
    parts = [network.scores([t.encode("utf-8", "surrogatepass") for t in raw[a:b]]) for a, b in portions(raw)]
    return np.concatenate(parts) if parts else np.zeros(0)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; a null text scores as an empty one.

    Only the text enters the score, so repeated texts score alike.  Only doc_id and text are read.
    """
    network = trained(docs, labels)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(_text_scores(network, batch.column(2).to_pylist()), pa.float64())
            yield pa.record_batch([batch.column(0), batch.column(1), found], names=["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    out = rows.mapInArrow(score, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= KEEP).cast("int"))


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores KEEP or more; all rows where no label could be learned.

    Null and empty texts are judged by what the network gives for padding alone; equal rows go or
    stay together.
    """
    network = trained(docs, labels)
    if not network.learned:
        return docs
    place = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_text_scores(network, batch.column(place).to_pylist()) >= KEEP))

    return docs.mapInArrow(keep, docs.schema)
