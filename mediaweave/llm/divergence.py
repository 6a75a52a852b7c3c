"""Source divergence audit: how far the word use of a language's sources lies apart.

Texts that are equal within a language are collapsed first: one row for each (language, text) with
the number of times that each source has it.  Each collapsed text is split into terms once; its
counts go to every source that has it, weighted by the source's number, and so do its document
frequencies.  Terms in at least ``least`` documents of a language are kept.

A source's p of a term depends on the term's count there alone.  A pair's sum over all kept terms
is therefore V times the value of two absent terms, plus corrections: for the terms of one source,
taken from the source's table of counts (so many terms occur so often), and for the terms that both
have.  Terms that neither has are never visited.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, portions, stored, text_slices

LEAST_DOCUMENTS = 3
TERM_RANKS = 200
#: p is a share of this many parts, and one part more.
PARTS = 1_000_000_000
SLICE = 1 << 20
#: Digests of repeated texts that may be broadcast: about 60 bytes each; beyond it texts are shuffled to them.
BROADCAST_TEXTS = 300_000

#: Letters A-Z, a-z and every byte of a non-ASCII character make terms.
_BREAK = np.ones(256, dtype=bool)
_BREAK[[*range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _terms(texts: list[str]) -> tuple[np.ndarray, pa.Array]:
    """The text number of each term, in order, and the terms (binary, lower-cased)."""
    words = Words(texts, _BREAK, hashed=False)
    size = words.ends - words.starts
    inside = ~_BREAK[words.data]
    data = np.frombuffer(words.data[inside].tobytes().translate(_LOWER), dtype=np.uint8)
    offsets = np.zeros(len(size) + 1, dtype=np.int32)
    np.cumsum(size, out=offsets[1:])
    terms = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return np.repeat(np.arange(len(texts)), np.diff(words.first)), terms


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(text number, term number, times) of the distinct terms of each text, and the terms."""
    owner, terms = _terms(texts)
    coded = terms.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(coded.dictionary), 1)
    keys, times = np.unique(owner * width + code, return_counts=True)
    return keys // width, keys % width, times, coded.dictionary


def _long_counts(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The same of one very long text, slice by slice; slices end at white space, so terms stay whole."""
    found = None
    for _, part in text_slices([text], SLICE):
        _, code, times, terms = _counted([part])
        new = pa.table({"term": terms.take(pa.array(code)), "times": times})
        found = new if found is None else pa.concat_tables([found, new]).group_by("term").aggregate([("times", "sum")]).rename_columns(["term", "times"])
    terms, times = found["term"].combine_chunks(), found["times"].to_numpy()
    return np.zeros(len(terms), dtype=np.int64), np.arange(len(terms)), times, terms


_COUNTS = "lang string, source string, term string, count long, documents long"
_COUNTS_SCHEMA = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("count", pa.int64()), ("documents", pa.int64())])


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of collapsed texts (lang, text, sources) by language, source and term, added up by portion."""
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        lists = batch.column(2)
        held = np.diff(lists.offsets.to_numpy())
        first = lists.offsets.to_numpy()[:-1] - lists.offsets.to_numpy()[0]
        entries = lists.flatten()
        sources = entries.field("source").to_pylist()
        copies = entries.field("copies").to_numpy(zero_copy_only=False)
        for a, b in portions(texts, SLICE):
            long = b == a + 1 and len(texts[a]) > SLICE
            owner, code, times, terms = _long_counts(texts[a]) if long else _counted(texts[a:b])
            if not len(owner):
                continue
            groups: dict[tuple[str, str], int] = {}
            group = np.array([groups.setdefault((langs[i], sources[j]), len(groups)) for i in range(a, b) for j in range(first[i], first[i] + held[i])])
            names = list(groups)
            start, own = np.cumsum(held[a:b]) - held[a:b], held[a:b][owner]
            # Every distinct term of a text once for each source that has the text.
            at = np.repeat(np.arange(len(owner)), own)
            entry = np.repeat(start[owner], own) + np.arange(len(at)) - np.repeat(np.cumsum(own) - own, own)
            weight = copies[first[a] : first[a] + held[a:b].sum()][entry]
            keys, inverse = np.unique(group[entry] * len(terms) + code[at], return_inverse=True)
            count, documents = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
            np.add.at(count, inverse, weight * times[at])
            np.add.at(documents, inverse, weight)
            which = keys // len(terms)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in names]).take(pa.array(which)), pa.array([x[1] for x in names]).take(pa.array(which)),
                    terms.take(pa.array(keys % len(terms))).cast(pa.string()), pa.array(count), pa.array(documents),
                ],
                schema=_COUNTS_SCHEMA,
            )


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, sources) of the distinct texts of each language; sources are (source, copies).

    Only digests are counted by source, so a text in a third of all rows is one row of each task
    before anything is shuffled; the array has an entry for each source, not for each copy.  Texts
    that occur once stay where they are as long as the others' digests are few enough to send.
    """
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("digest", F.unhex(F.substring(F.sha2("text", 256), 1, 32)))
    copies = rows.groupBy("lang", "digest", "source").agg(F.count(F.lit(1)).alias("copies"))
    copies = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "copies")).alias("sources"), F.sum("copies").alias("n"))
    several = stored(copies.where("n > 1").select("lang", "digest", "sources"), "copies")
    keys = several.select("lang", "digest")
    keys = F.broadcast(keys) if several.count() <= BROADCAST_TEXTS else keys
    once = rows.join(keys, ["lang", "digest"], "left_anti")
    once = once.select("lang", "text", F.array(F.struct("source", F.lit(1).cast("long").alias("copies"))).alias("sources"))
    texts = rows.join(keys, ["lang", "digest"], "left_semi").groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return once.unionByName(texts.join(several, ["lang", "digest"]).select("lang", "text", "sources"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(PARTS * (count + 1) / (total + kept)) in exact arithmetic."""
    up = F.lit(PARTS).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", up, (total + kept).cast("decimal(20,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); p and q lie between 1 and PARTS + 1, so a long holds it."""
    return F.call_function("div", (p - q) * (p - q), q)


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if most is not None:
        ranked = ranked.where(F.col("rank") <= most)
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def term_counts(docs: DataFrame, least: int = LEAST_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """The groups (lang, source, terms, kept, none) and the kept terms (lang, source, term, count, overall, share).

    ``terms`` is the group's number of occurrences of kept terms, ``kept`` the language's number
    of kept terms, ``none`` the share of a term that the group does not have; ``overall`` is the
    term's share in the language.
    """
    counts = collapsed(docs).mapInArrow(_weighted, _COUNTS).groupBy("lang", "source", "term")
    counts = stored(counts.agg(F.sum("count").alias("count"), F.sum("documents").alias("documents")), "term-counts")
    known = counts.groupBy("lang", "term").agg(F.sum("count").alias("everywhere"), F.sum("documents").alias("documents"))
    known = known.where(F.col("documents") >= least).select("lang", "term", "everywhere")
    kept = stored(counts.drop("documents").join(known, ["lang", "term"]), "kept-terms")

    # Groups are counted from the documents, so that one without terms has a row, too.
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    sums = kept.groupBy("lang", "source").agg(F.sum("count").alias("terms"))
    vocabulary = known.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("everywhere").alias("spoken"))
    groups = every.join(sums, ["lang", "source"], "left").join(vocabulary, "lang", "left").fillna(0, ["terms", "kept", "spoken"])
    none = F.when(F.col("kept") > 0, _share(F.lit(0), F.col("terms"), F.greatest("kept", F.lit(1)))).otherwise(1)
    groups = stored(groups.withColumn("none", none), "groups")
    rows = kept.join(groups, ["lang", "source"])
    return groups, rows.select(
        "lang", "source", "term", "count", "none",
        _share(F.col("everywhere"), F.col("spoken"), F.col("kept")).alias("overall"),
        _share(F.col("count"), F.col("terms"), F.col("kept")).alias("share"),
    )


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """lang, source, part, item, value, rank: how sources differ, by pair and by term.

    Part ``pair`` holds each other source of the language, part ``term`` the terms that the source
    uses more often than its language, up to ``ranks``.  Null langs, sources and texts are read
    as ''.  Repeated rows are documents each.  A group without terms takes part in pairs; a
    language without kept terms has pairs of value 0; one source alone has none.  Only lang,
    source and text are read, whatever other columns there are.  No documents, no rows.
    """
    groups, terms = term_counts(docs, least)
    terms = stored(terms, "shares")
    over = terms.where("share > overall").select("lang", "source", F.col("term").alias("item"), _apart(F.col("share"), F.col("overall")).alias("value"))

    # Terms of one source against a source without them: by count, not by term.
    tables = terms.groupBy("lang", "source", "none", "share").agg(F.count(F.lit(1)).alias("n"))
    other = groups.select("lang", F.col("source").alias("other"), F.col("none").alias("absent"))
    met = tables.join(other, "lang").where("source <> other")
    p, x, y, n = F.col("share"), F.col("none"), F.col("absent"), F.col("n")
    met = met.groupBy("lang", "source", "other").agg(
        F.sum(n * (_apart(p, y) - _apart(x, y))).alias("there"), F.sum(n * (_apart(y, p) - _apart(y, x))).alias("back")
    )
    alone = met.select("lang", "source", "other", F.col("there").alias("value")).unionByName(
        met.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("back").alias("value"))
    )
    # Terms of both: each pair of sources is met once and counts for both directions.
    left = terms.select("lang", "term", "source", F.col("share").alias("p"), F.col("none").alias("x"))
    right = terms.select("lang", "term", F.col("source").alias("other"), F.col("share").alias("q"), F.col("none").alias("y"))

    def correction(p: str, x: str, q: str, y: str) -> Column:
        p, x, q, y = map(F.col, (p, x, q, y))
        return F.sum(_apart(p, q) - _apart(p, y) - _apart(x, q) + _apart(x, y))

    both = left.join(right, ["lang", "term"]).where("source < other").groupBy("lang", "source", "other").agg(
        correction("p", "x", "q", "y").alias("there"), correction("q", "y", "p", "x").alias("back")
    )
    both = both.select("lang", "source", "other", F.col("there").alias("value")).unionByName(
        both.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), F.col("back").alias("value"))
    )
    absent = groups.join(other, "lang").where("source <> other")
    absent = absent.select("lang", "source", "other", (F.col("kept") * _apart(F.col("none"), F.col("absent"))).alias("value"))
    pairs = absent.unionByName(alone).unionByName(both).groupBy("lang", "source", F.col("other").alias("item")).agg(F.sum("value").alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(over, "term", ranks))
