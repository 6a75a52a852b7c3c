"""Exact top-k, URL filter and WARC round trip against plain versions, and the pipeline."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mediaweave.llm import quality, stages, topk, urlfilter, warc
from mediaweave.llm.common import prepare
from mediaweave.llm.token_ids import TokenIds, tokenizer_path
from test_near_duplicates import plain_classes
from test_text_operators import base_spans, entropy_spans, plain_mix


# -- top-k --------------------------------------------------------------------


def plain_top(rows, queries, k):
    usable = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    whole = lambda v: [math.floor(1024 * float(x)) for x in v]
    rows = [(i, tuple(v)) for i, v in rows if i is not None and usable(v)]
    out = Counter()
    for q, v in [(i, tuple(v)) for i, v in queries if i is not None and usable(v)]:
        others = rows.copy()
        others.remove((q, v))  # its own row; rows that repeat it stay
        scores = sorted((-sum(a * b for a, b in zip(whole(v), whole(w))), i) for i, w in others if len(w) == len(v))
        for rank, (s, i) in enumerate(scores[:k], 1):
            out[(q, rank, i, min(max(-s, -(1 << 63)), (1 << 63) - 1))] += 1
    return out


@pytest.mark.parametrize("dimension", [1, 16, 40])
def test_top_k(spark, dimension, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATE_BYTES", 3000)  # many blocks and groups
    monkeypatch.setattr(topk, "GROUP_BLOCKS", 2)
    random.seed(dimension)
    rows = [(i, [random.choice([-1.0, 0.5, random.gauss(0, 1)]) for _ in range(dimension)]) for i in range(300)]
    rows += [(300, rows[3][1]), (301, rows[3][1]), (7, rows[8][1]), rows[9], rows[20], rows[20], (40, rows[41][1]), (302, None), (None, rows[1][1]), (303, [float("nan")] * dimension), (304, [None] * dimension), (305, [1.0]), (306, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1))
    got = topk.top_k(df, df.where("vec_id % 20 = 0"), k=5)
    assert Counter(map(tuple, got.collect())) == plain_top(rows, [r for r in rows if r[0] is not None and r[0] % 20 == 0], 5)


def test_top_k_at_the_edges(spark):
    rows = [(0, [1e6, -3e9]), (100, [2e9, 5e12]), (1, [1e300, 1.0]), (2, [-1e6, 2e9])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, topk.top_k(df, df.where("vec_id % 100 = 0")).collect())) == plain_top(rows, rows[:2], 10)
    alone = df.where("vec_id = 0")
    assert topk.top_k(alone, alone).count() == 0 and topk.top_k(df.where("vec_id = -1"), alone).count() == 0


def test_candidates_are_dealt_once(spark, monkeypatch):
    """Every candidate block is in one group; each query block goes to every group, not to every block."""
    monkeypatch.setattr(topk, "CANDIDATE_BYTES", 2000)
    monkeypatch.setattr(topk, "QUERY_BYTES", 1000)
    met = []
    monkeypatch.setattr(topk, "_meet", lambda k, f=topk._meet: met.append(k) or f(k))
    rows = [(i, [float(i % 7), 1.0, float(i)]) for i in range(1000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert Counter(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0"), k=3).collect())) == plain_top(rows, rows[::50], 3)
    assert met == [4]
    plan = topk.top_k(df, df.where("vec_id % 50 = 0"), k=3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Cartesian" not in plan


def test_bounds_keep_the_best():
    rng = np.random.default_rng(1)
    columns = rng.integers(-50, 50, (64, 500))
    columns[:16] *= 20
    rest = [np.sqrt((columns[d:].astype(float) ** 2).sum(axis=0)) for d in range(0, 64, 16)]
    for q in range(20):
        query = columns[:, q]
        alive, score = topk.best_of_block(query, columns, rest, 10)
        full = query @ columns
        bar = np.sort(full)[-4]
        assert set(topk.best_of_block(query, columns, rest, 10, bar)[0]) == set(np.flatnonzero(full >= bar))
        assert len(alive) < 500 and set(np.argsort(-full, kind="stable")[:10]) <= set(alive)
        assert (score == full[alive]).all()


# -- urls ---------------------------------------------------------------------

URLS = [
    None, "nope", "", "http://EXAMPLE.com/en/x", "http://www.example.com/en/", "x://a.www.example.com/en/?q=1", "http://net/es/",
    "http://xnet/es/", "http://a.com", "http://a.com?x", "http://a.com/#/en", "a://b://c/d", "http://badexample.com/en/",
    "HTTP://ÀÉ.NET/fr/é\n/x?y#z", "http://a.net/fr/1", "http://a.org/de/1",
]


def plain_url(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", "", None
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    rest = rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r, _ in urlfilter.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return host, path, max(fits, key=len) if fits else None


def test_urls(spark):
    given = URLS + [f"https://x{i}.example.{'org' if i % 3 else 'net'}/{['es', 'de', 'fr'][i % 3]}/{i}" for i in range(200)]
    df = spark.createDataFrame([(i, u, "h", 1.0) for i, u in enumerate(given)], "page_id long, url string, host string, score double")
    got = {r.page_id: r for r in urlfilter.filtered(df).collect()}
    assert len(got) == len(given)
    for i, url in enumerate(given):
        host, path, rule = plain_url(url)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (dict(urlfilter.RULES)[rule] if rule else "block" if got[i].score >= 0.5 else "allow")
    assert urlfilter.filtered(df.limit(0)).count() == 0


def test_trees_learn_from_labelled_urls(spark):
    spam = lambda i: i % 2 == 0
    rows = [(f"http://{'cheap-pills-' if spam(i) else 'news'}{i % 50}.example.org/{'buy/now/x' if spam(i) else 'a'}?{'a=1&b=2&c=3' if spam(i) else ''}{i}", int(spam(i)) if i % 4 < 2 else None, i) for i in range(400)]
    df = spark.createDataFrame(rows, "url string, label int, n int")
    unseen = urlfilter.classified(df).where("label is null").collect()
    assert sum((r.score >= 0.5) == spam(r.n) for r in unseen) / len(unseen) > 0.95


def test_columns_of_urls_are_kept(spark):
    names = ["entropy", "fold", "suffix", "known", "row", "learned", "x", "odd name"]
    rows = [(f"http://{'buy-' if i % 2 else ''}h{i}.org/{i}", i % 2, *[i] * len(names)) for i in range(40)]
    rows += [(None, None, *[None] * len(names))] * 2 + rows[:3]
    df = spark.createDataFrame(rows, "url string, label int, " + ", ".join(f"`{n}` int" for n in names))
    got = urlfilter.classified(df)
    assert got.columns == ["url", "label", *names, "host", "path", "held_out", "score"]
    assert Counter(map(tuple, got.select(df.columns).collect())) == Counter(rows)
    twice = urlfilter.classified(got)
    assert twice.columns == got.columns and twice.count() == len(rows)


def test_held_out_labels_are_not_learned(spark):
    """Turning every held-out label round moves no score; a label that weighs little still counts."""
    rows = [(f"http://{'cheap-pills' if i % 8 == 0 else 'news'}{i}.example.org/{i}", int(i % 8 == 0)) for i in range(800)]
    df = spark.createDataFrame(rows, "url string, label int")
    first = {r.url: r for r in urlfilter.classified(df).collect()}
    held = [u for u, r in first.items() if r.held_out]
    assert 100 < len(held) < 300
    assert all((first[u].score >= 0.5) == bool(dict(rows)[u]) for u in held)
    turned = spark.createDataFrame([(u, 1 - n if first[u].held_out else n) for u, n in rows], "url string, label int")
    assert {r.url: r.score for r in urlfilter.classified(turned).collect()} == {u: r.score for u, r in first.items()}


def test_undecided_urls_get_both_verdicts(spark):
    """What no rule decides is not blocked for its suffix alone."""
    word = lambda i: hashlib.md5(str(i).encode()).hexdigest()[: 4 + i % 9]
    rows = [(i, f"http://{word(i)}.example.{('com', 'net', 'org')[i % 3]}/{('en', 'fr', 'es', 'de')[i // 3 % 4]}/{i * 37 % 1000}{('', '?a=1&b=2', '.html')[i % 7 % 3]}") for i in range(1200)]
    got = urlfilter.filtered(spark.createDataFrame(rows, "page_id long, url string")).where("rule is null").collect()
    counts = Counter(r.verdict for r in got if r.host.endswith("org"))
    assert set(counts) == {"allow", "block"}


def test_entropy(spark):
    texts = ["", "a", "aab", "abcdabcd", "ééx"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", urlfilter.entropy(F.col("t")).alias("e")).collect()
    for r in got:
        counts = Counter(r.t).values()
        assert math.isclose(r.e, -sum(n / len(r.t) * math.log2(n / len(r.t)) for n in counts), abs_tol=1e-9)


# -- archives -----------------------------------------------------------------

FAKE = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nHTTP/\r\n\r\n"


@pytest.mark.parametrize("split", ["16m", "2k"])
def test_round_trip(spark, split):
    rows = [
        (1, "http://a", "x"), (2, "http://b", "x"), (3, None, None), (4, "u\r\nv", ""), (5, "u", "WARC/1.1\r\n"), (6, "u", FAKE),
        (7, "u", f"pre {FAKE * 3} WARC/1.1\r\npost é"), (8, "u", FAKE), (9, "u", "é" * 1000), (None, "u", "only"), (-5, "u", "neg"),
        (10, "u", "\r\n\r\n"), (11, "u", "WARC/1.1\r\n\r\n\r\nWARC/1.1\r\n"), (1, "http://a", "x"),
    ] + [(i, "u", FAKE * (i % 5) + "z" * i) for i in range(100, 300)]
    prepare(spark)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int").coalesce(2)
        for least in (0, 2):
            first = {}
            for i, _, h in rows:
                if i is not None:
                    first[h or ""] = min(i, first.get(h or "", i))
            wanted = Counter()
            for i, _, h in rows:
                raw = (h or "").encode()
                again = len(raw) >= least and first.get(h or "", i) != i
                digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
                wanted[(i, len(raw), digest, "revisit" if again else "response", first[h or ""] if again else None)] += 1
            assert Counter(map(tuple, warc.round_trip(df, least).collect())) == wanted
        assert warc.round_trip(df.where("page_id = -77")).count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def test_archives_are_plain_records(spark, tmp_path):
    df = spark.createDataFrame([(1, "http://a", "é"), (2, "http://b", "é")], "page_id long, url string, html string").coalesce(1)
    warc.write_archive(df, str(tmp_path / "w"))
    data = b"".join(p.read_bytes() for p in sorted((tmp_path / "w").glob("part-*")))
    kinds = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        size = int(fields[b"Content-Length"])
        kinds.append(fields[b"WARC-Type"])
        assert head.startswith(b"WARC/1.1\r\n") and rest[size : size + 4] == b"\r\n\r\n"
        data = rest[size + 4 :]
    assert sorted(kinds) == [b"response", b"revisit"]


# -- pipeline -----------------------------------------------------------------


def plain_redaction(text):
    """The text with base and entropy spans found by plain patterns replaced, and the spans' number."""
    out, at = "", 0
    spans = sorted(base_spans(text) + entropy_spans(text))
    for start, _, end in spans:
        if start >= at:
            out += text[at:start] + "[SECRET]"
        at = max(at, end)
    return out + text[at:], len(spans)


def plain_copies(rows):
    """How often the mix takes each document: the whole queue in one sort."""
    sized, total, target = plain_mix(rows)
    queue, passed = [], Counter()
    for d, _, s, n in sorted(sized, key=lambda r: (hashlib.md5(f"mix{r[0]}".encode()).hexdigest(), r[0])):
        passed[s] += n
        if n:
            queue += [((turn * total[s] + passed[s]) / target[s], d, n) for turn in range(2)]
    taken, budget = Counter(), 1.5 * sum(total.values())
    for _, d, n in sorted(queue):
        budget -= n
        if budget < 0:
            break
        taken[d] += 1
    return taken


def test_pipeline(spark, monkeypatch):
    """Each stage against a plain version on the rows that it was given."""
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert [f for _, f in corpus_pipeline.STAGES] == [stages.quality, stages.near_duplicates, stages.secrets, stages.mixing, stages.packing]
    seen = []

    def noted(stage):
        return lambda spark, docs, folder: seen.append(docs) or stage(spark, docs, folder)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [(n, noted(f)) for n, f in corpus_pipeline.STAGES])
    pieces = corpus_pipeline.run(spark, folder).collect()
    assert all(df.columns == docs.columns for df in seen)
    given, good, apart, clean, mixed = (df.collect() for df in seen)

    network, marks = quality.trained(docs, labels), {r.doc_id: r.quality for r in labels.collect()}
    judged = {r.doc_id: network.scores([(r.text or "").encode()])[0] >= quality.KEEP for r in given}
    assert Counter(good) == Counter(r for r in given if judged[r.doc_id])
    unseen = [d for d in judged if d in marks and zlib.crc32(str(d).encode()) % 4 == 2]
    assert len(unseen) > 10 and all(judged[d] for d in unseen if marks[d] == 1)

    classes = {}
    for row, top in zip(good, plain_classes([(r.doc_id, r.text) for r in good])):
        classes[top] = min(row, classes.get(top, row), key=lambda r: r.doc_id)
    assert Counter(apart) == Counter(classes.values()) and len(apart) < len(good)

    wanted, spans = Counter(), 0
    for r in apart:
        text, n = plain_redaction(r.text or "")
        wanted[(r.doc_id, r.source, r.lang, text, len(text))] += 1
        spans += n
    assert spans and Counter((r.doc_id, r.source, r.lang, r.text, r.n_chars) for r in clean) == wanted

    copies = plain_copies([(r.doc_id, r.text, r.source) for r in clean])
    assert Counter(mixed) == +Counter({r: copies[r.doc_id] for r in clean})

    tokenizer, wanted = TokenIds(tokenizer_path()).tokenizer, Counter()
    for r in mixed:
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [1], dtype="<u4")
        for a in range(0, len(ids), 2048):
            wanted[(r.doc_id, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes()), len(ids))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces) == wanted
    filled = Counter()
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    total = sum(filled.values())
    padded = sum(2048 - n for n in filled.values() if n & (n - 1))  # none at a power of two
    assert max(filled.values()) <= 2048 and padded <= 0.02 * total


def test_stages_bound_the_bytes_of_a_batch(spark):
    """What Python is sent at a time once a stage's rows are computed: of 3 MB of texts at most a third or so."""
    texts = spark.range(12).selectExpr("id as doc_id", "repeat('word ', 50000) as text", "'a' as source")

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    for stage in (stages.quality, stages.near_duplicates, stages.secrets, stages.mixing, stages.packing):
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, texts, "/root/testdata/sf0.001")
        assert texts.coalesce(1).mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 3 << 19
    prepare(spark)


def test_stages_of_odd_rows(spark, odd_documents, no_documents):
    """Nulls, empty texts, repeated rows, clashing names and no rows at all, in every stage."""
    folder = "/root/testdata/sf0.001"
    kept = {}
    for stage in (stages.quality, stages.near_duplicates, stages.secrets, stages.mixing):
        for df in (odd_documents, no_documents):
            out = stage(spark, df, folder)
            assert out.columns == df.columns
            kept[stage, df is no_documents] = out.collect()
    assert all(not rows for (_, empty), rows in kept.items() if empty)
    given = odd_documents.collect()
    assert Counter(kept[stages.quality, False]) <= Counter(given)
    classes = {}
    for row, top in zip(given, plain_classes([(r.doc_id, r.text) for r in given])):
        classes[top] = min((row.doc_id is None, row.doc_id or 0), classes.get(top, (True, 0)))
    assert Counter((r.doc_id is None, r.doc_id or 0) for r in kept[stages.near_duplicates, False]) == Counter(classes.values())
    assert len(kept[stages.secrets, False]) == len(given)
    assert all(re.search(r"[^\x20\x09-\x0D]", r.text or "") for r in kept[stages.mixing, False])
    texts = Counter((r.doc_id, len(TokenIds(tokenizer_path()).tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1) for r in given)
    pieces = stages.packing(spark, odd_documents, folder).collect()
    assert Counter((r.doc_id, r.doc_tokens) for r in pieces if r.start == 0) == texts
    assert stages.packing(spark, no_documents, folder).count() == 0
