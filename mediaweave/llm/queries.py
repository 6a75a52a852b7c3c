"""The registered queries of the training-data operators, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import alignment, divergence, minhash, mixing, packing, quality, repeats, secret_scan, spotsigs, topk, urlfilter, warc, wordpiece
from .common import table
from .token_ids import tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


@query()
def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return minhash.near_duplicates(table(spark, folder, "documents")).drop("node")


TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS place, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.place, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
  FROM v q JOIN v c ON q.place <> c.place AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query(TOP_K_SQL)
def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best vectors for every hundredth vector."""
    vectors = table(spark, folder, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"))


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document."""
    return quality.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op4_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.packed(table(spark, folder, "documents"), tokenizer_path())


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5('mix' || coalesce(doc_id::VARCHAR, '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, ([3.0, 1.0, 2.0]::DOUBLE[])[place % 3 + 1] AS weight, source_size * 2.0::DOUBLE AS full_size FROM per),
levels AS (
  SELECT *, full_size / weight AS ratio,
         (sum(source_size) OVER () * 1.5::DOUBLE
          - coalesce(sum(full_size) OVER (ORDER BY full_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY full_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, place,
         least(full_size, (SELECT max(level) FROM levels WHERE level <= ratio) * weight) AS target
  FROM levels),
summed AS (
  SELECT s.*, t.source_size, t.place, t.target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS cumulative
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
queue AS (
  SELECT *, (turn * source_size + cumulative) / target AS finish
  FROM summed CROSS JOIN (SELECT unnest([0, 1]) AS turn) WHERE size > 0),
served AS (
  SELECT doc_id, size FROM (
    SELECT *, sum(size) OVER (ORDER BY finish, place, turn, key, doc_id, size ROWS UNBOUNDED PRECEDING) AS running FROM queue)
  WHERE running <= (SELECT sum(size) * 1.5::DOUBLE FROM sized))
SELECT s.doc_id, s.source, s.size, s.source_size, s.target,
       coalesce(c.taken, 0)::BIGINT AS taken, coalesce(c.copies, 0)::INTEGER AS copies
FROM summed s LEFT JOIN (SELECT doc_id, sum(size) AS taken, count(*) AS copies FROM served GROUP BY doc_id) c USING (doc_id)
"""


@query(MIX_SQL)
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents mixed to the sources' targets."""
    return mixing.mix(table(spark, folder, "documents")).drop("identity")


@query()
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of every document."""
    return secret_scan.digests(table(spark, folder, "documents"))


@query()
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The word pieces of every document, counted."""
    return wordpiece.token_counts(table(spark, folder, "documents"))


@query()
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """The fingerprints of every document and of its edited text."""
    return spotsigs.fingerprints(table(spark, folder, "documents"))


@query()
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """The verdict on every page's url."""
    return urlfilter.filtered(table(spark, folder, "pages"))


WARC_SQL = """
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
hashed AS (SELECT *, sha1(body) AS h FROM rows)
SELECT page_id, strlen(body)::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::INTEGER >> (15 - 5 * (i % 4))) & 31) + 1, 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM hashed
"""


@query(WARC_SQL)
def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    """All pages archived and read back."""
    return warc.round_trip(table(spark, folder, "pages"))


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
occurring AS (
  SELECT id, lang, source,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM occurring GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM occurring JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT lang, source FROM docs),
sums AS (SELECT lang, source, sum(n)::HUGEINT AS n FROM counts GROUP BY lang, source),
whole AS (SELECT lang, sum(n)::HUGEINT AS n, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (coalesce(s.n, 0) + w.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (w.n + w.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN whole w USING (lang)
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (((p - q) * (p - q)) // q)::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM every)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query(DIVERGENCE_SQL)
def op11_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """How far the sources of each language lie apart."""
    return divergence.divergence(table(spark, folder, "documents"))


REPEATS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
starts AS (SELECT id, words, unnest(range(1, len(words) - 33)) AS place FROM docs),
windows AS (SELECT id, place, md5(array_to_string(list_slice(words, place, place + 34), ' ')) AS mark FROM starts),
repeated AS (SELECT id, place FROM windows WHERE mark IN (SELECT mark FROM windows GROUP BY mark HAVING count(*) > 1)),
removed AS (SELECT DISTINCT id, unnest(range(place, place + 35)) AS place FROM repeated),
placed AS (SELECT id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM docs),
kept AS (SELECT id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM placed ANTI JOIN removed USING (id, place) GROUP BY id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (id)
"""


@query(REPEATS_SQL)
def op12_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages of 35 words and more that occur elsewhere, too."""
    return repeats.without_repeats(table(spark, folder, "documents"))


@query()
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """The tokens of two tokenizers aligned in every document."""
    return alignment.aligned(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
