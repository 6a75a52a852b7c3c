"""Small helpers shared by the operators: session options, scratch tables, word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import scratch_path

MASK = (1 << 64) - 1
BLOCK_BYTES = 1 << 20
#: Bytes that are hashed at a time; a worker keeps 32 times as many for the powers of twice that length.
HASH_BYTES = 1 << 17
_STEP = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_STEP, -1, 1 << 64)


def prepare(spark: SparkSession) -> None:
    """Session options of the operators: AQE splits hot join keys, Arrow batches stay small."""
    for key, value in (
        ("spark.sql.adaptive.enabled", "true"),
        ("spark.sql.adaptive.skewJoin.enabled", "true"),
        ("spark.sql.adaptive.forceOptimizeSkewedJoin", "true"),
        ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"),
        ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20)),
    ):
        spark.conf.set(key, value)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: later steps start from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`stored` that no later step reads."""
    context = df.sparkSession.sparkContext
    for file in df.inputFiles()[:1]:
        path = context._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """A text column with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


# -- vectorised words ---------------------------------------------------------


def separator_table(extra: bytes = b"") -> np.ndarray:
    """True for the bytes that end a word: ASCII white space and the given bytes."""
    out = np.zeros(256, dtype=bool)
    out[[9, 10, 11, 12, 13, 32, *extra]] = True
    return out


WHITE = separator_table()
#: Letters, digits, underscore and every byte of a non-ASCII character make words.
NOT_WORD = np.ones(256, dtype=bool)
NOT_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that every output bit depends on all input bits."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = {"n": 0}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n <= 2 * HASH_BYTES:
        if not _POWERS["n"]:
            _POWERS.update(n=2 * HASH_BYTES, up=_powers(_STEP, 2 * HASH_BYTES + 1), down=_powers(_INVERSE, 2 * HASH_BYTES + 1))
        return _POWERS["up"], _POWERS["down"]
    return _powers(_STEP, n + 1), _powers(_INVERSE, n + 1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for ascending spans, in blocks of HASH_BYTES."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        first = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, first + HASH_BYTES, side="right")))
        last = ends[j - 1]
        up, down = _power_tables(int(last - first))
        sums = np.zeros(last - first + 1, dtype=np.uint64)
        np.cumsum((data[first:last].astype(np.uint64) + np.uint64(1)) * up[: last - first], out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


class Words:
    """The words of some texts: hash (if wanted), start and end byte of each, and the words of text i at first[i]:first[i+1]."""

    def __init__(self, texts: list[str], breaks: np.ndarray, hashed: bool = True):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        inside = np.zeros(len(self.data) + 1, dtype=np.int8)
        inside[1:] = ~breaks[self.data]
        edges = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = edges[0::2], edges[1::2]
        self.hash = span_hashes(self.data, self.starts, self.ends) if hashed else None
        bounds = np.zeros(len(raw) + 1, dtype=np.int64)
        np.cumsum([len(r) + 1 for r in raw], out=bounds[1:])
        self.bounds = bounds
        self.first = np.searchsorted(self.starts, bounds)


def portions(texts: list[str], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts hold about ``limit`` characters together, one row at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if i > start and held + len(text) > limit:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)


def text_slices(texts: list[str], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, str]]:
    """(text number, part): texts whole, very long ones cut at ASCII white space.

    The parts hold about ``limit`` characters; a longer run without white space stays whole.
    """
    for i, text in enumerate(texts):
        start = 0
        while len(text) - start > limit:
            cut = start + limit
            while cut < len(text) and text[cut] not in " \t\n\x0b\x0c\r":
                cut += 1
            yield i, text[start:cut]
            start = cut
        yield i, text[start:]
