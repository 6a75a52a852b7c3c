"""Registered queries of what a run does with given answers: success caps, request groups, keyless rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import ledger, vectors
from ..operators.merge import last_wins, merge
from ..operators.ranking import numbered
from ..sources.clients import request_groups as grouped
from .inputs import Given
from .queries import DIM, VECTOR_SIZE_SQL, _vectors, query

TAG_CAP, VECTOR_CAP, REQUEST = 100, 60, 100


@query(f"""WITH a AS (
  SELECT d.doc_id, d.source, l.quality = 1 AND d.doc_id % 10 <> 3 AS ok,
         row_number() OVER (ORDER BY d.source, d.doc_id) - 1 AS place
  FROM documents d JOIN labels l USING (doc_id)),
b AS (SELECT *, sum(ok::INT) OVER (ORDER BY place ROWS UNBOUNDED PRECEDING) - ok::INT AS earlier FROM a)
SELECT doc_id, place, ok FROM b WHERE earlier < {TAG_CAP}""")
def tagged_until_cap(t: Given) -> DataFrame:
    """Posts in one fixed order with given answers, up to the capped number that passed the gate."""
    ok = (F.col("quality") == 1) & (F.col("doc_id") % 10 != 3)
    posts = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id")
    placed = numbered(posts.select("doc_id", "source", ok.alias("ok")), [F.col("source").asc(), F.col("doc_id").asc()], "place")
    return ledger.until_successes(placed, "place", F.col("ok"), TAG_CAP).select("doc_id", "place", "ok")


@query(f"""WITH v AS (SELECT vec_id, vec_id // 8 AS batch, {VECTOR_SIZE_SQL} AS size FROM embeddings),
a AS (SELECT vec_id, bool_and(size IS NOT NULL AND size = {DIM}) OVER (PARTITION BY batch) AND vec_id % 4 <> 1 AS ok FROM v),
b AS (SELECT *, sum(ok::INT) OVER (ORDER BY vec_id ROWS UNBOUNDED PRECEDING) - ok::INT AS earlier FROM a)
SELECT vec_id, ok FROM b WHERE earlier < {VECTOR_CAP}""")
def written_until_cap(t: Given) -> DataFrame:
    """Pairs in key order with given vectors, up to the capped number that a document took."""
    size = F.lit(8).alias("n_inputs")
    answers = _vectors(t).select(
        F.lit("u").alias("user_id"), F.col("vec_id").cast("string").alias("post_id"), F.floor(F.col("vec_id") / 8).cast("string").alias("batch_id"),
        size, size.alias("n_vectors"), "embedding", F.lit(None).cast("string").alias("error"),
    )
    mongo = F.lpad(F.hex(F.col("post_id").cast("bigint")), 24, "0")
    records = vectors.check_answers(answers, DIM).select("user_id", "post_id", mongo.alias("mongo_id"), F.col("vector").alias("embedding"))
    docs = t.embeddings.where("vec_id % 4 <> 1").select(F.lpad(F.hex("vec_id"), 24, "0").alias("_id"))
    judged = vectors.write_outcome(records, docs)
    placed = numbered(judged.select(F.col("post_id").cast("bigint").alias("vec_id"), (F.col("write_status") == "inserted").alias("ok")), [F.col("vec_id").asc()], "place")
    return ledger.until_successes(placed, "place", F.col("ok"), VECTOR_CAP).select("vec_id", "ok")


@query(f"""SELECT lang, doc_id, (row_number() OVER (ORDER BY lang, doc_id) - 1) // {REQUEST} AS request FROM documents""")
def request_groups(t: Given) -> DataFrame:
    """Which texts share a request: the same however they are partitioned."""
    return grouped(t.documents.select("lang", "doc_id").repartition(7), ["lang", "doc_id"], REQUEST, "request").select("lang", "doc_id", "request")


@query("""WITH target AS (
  SELECT CASE WHEN doc_id % 3 = 0 THEN '' WHEN doc_id % 15 = 1 THEN NULL WHEN doc_id % 15 = 2 THEN '  ' ELSE doc_id::VARCHAR END AS video_id,
         n_chars, lang FROM documents),
updates AS (
  SELECT CASE WHEN doc_id % 50 = 4 THEN ' ' ELSE doc_id::VARCHAR END AS video_id, max(quality + 1000 * doc_id) AS n_chars FROM labels GROUP BY 1)
SELECT t.video_id, coalesce(u.n_chars, t.n_chars) AS n_chars, t.lang FROM target t
LEFT JOIN updates u ON u.video_id = t.video_id AND trim(t.video_id) <> ''
UNION ALL SELECT video_id, n_chars, NULL FROM updates u
WHERE trim(video_id) = '' OR NOT EXISTS (SELECT 1 FROM target t WHERE t.video_id = u.video_id)""")
def upsert_keyless(t: Given) -> DataFrame:
    """A target of which a third and more has no usable key: those rows stay as they are."""
    doc = F.col("doc_id")
    name = F.when(doc % 3 == 0, "").when(doc % 15 == 2, "  ").when(doc % 15 != 1, doc.cast("string"))
    target = t.documents.select(name.alias("video_id"), F.col("n_chars").cast("bigint").alias("n_chars"), "lang")
    own = F.when(doc % 50 == 4, " ").otherwise(doc.cast("string"))
    updates = t.labels.select(own.alias("video_id"), (F.col("quality") + 1000 * doc).cast("bigint").alias("n_chars"))
    return merge(target, last_wins(updates, ["video_id"], ["n_chars"]), ["video_id"])
