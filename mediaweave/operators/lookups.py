"""Joins from a large table to a table with one row per key.

The large side may hold one key in a third of its rows.  A lookup side that
has been counted and found small is broadcast, so the large side is not
shuffled at all.  Beyond that bound both sides are shuffled by key and AQE cuts
the hot partition into pieces (``config.tune`` keeps that rule on).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import shuffles_dropped

BROADCAST_ROWS = 1_000_000
# Bits that mark a wanted key, and the most words of 64 such bits that are broadcast.
MARK_BITS, MARK_WORDS = 8, 1 << 21


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than one row beyond."""
    return df.limit(rows + 1).count() <= rows


def perhaps_among(large: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """Rows of ``large`` before a shuffle, without most of those whose ``keys`` are not in ``wanted``.

    All rows whose keys are there stay (NULLs equal NULLs) and about one in nine of the others, so the
    exact join still follows.  What is broadcast are ``MARK_BITS`` bits for each distinct key, up to
    ``MARK_WORDS`` words; with more keys than these hold, fewer rows are left out.  Keys are compared
    by hash, so both sides have them in the same types.
    """
    hashed = F.xxhash64(*keys)
    with shuffles_dropped(wanted.sparkSession):
        number = wanted.agg(F.approx_count_distinct(hashed)).first()[0]
    words = min(MARK_WORDS, max(1, number * MARK_BITS // 64))
    placed = wanted.select(F.pmod(hashed, F.lit(64 * words)).alias("_place"))
    word, bit = F.expr("_place div 64").alias("_word"), F.expr("shiftleft(1L, cast(_place % 64 as int))")
    marks = placed.select(word, bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_marks"))
    looked = large.withColumn("_place", F.pmod(hashed, F.lit(64 * words))).withColumn("_word", word)
    found = looked.join(F.broadcast(marks), "_word").filter(F.expr("getbit(_marks, cast(_place % 64 as int)) = 1"))
    return found.select(large.columns)


def checked_lookup(
    large: DataFrame, lookup: DataFrame, keys: list[str], how: str, rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Join to a narrow lookup table, broadcast only after its rows were counted."""
    if fits(lookup, rows):
        return large.join(F.broadcast(lookup), keys, how)
    return large.join(lookup, keys, how)
