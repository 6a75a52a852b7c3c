"""Near-duplicates against all pairs compared by plain counters."""

import re
from collections import Counter

import numpy as np
import pytest

from mediaweave.llm import minhash
from mediaweave.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def bag(text):
    words = re.findall(r"[a-z0-9_\u0080-\U0010ffff]+", (text or "").lower())
    if len(words) < 5:
        return Counter([tuple(words)] if words else [])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain_classes(rows):
    """Row number to the smallest row number of its class."""
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bags = [bag(t) for _, t in rows]
    for i in range(len(rows)):
        for j in range(i):
            least = sum((bags[i] & bags[j]).values())
            most = sum(bags[i].values()) + sum(bags[j].values()) - least
            if (rows[i][1] or "") == (rows[j][1] or "") or (least and least >= 0.8 * most):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(rows))]


def expected(rows):
    tops = plain_classes(rows)
    ids = {}
    for (doc, _), t in zip(rows, tops):
        if doc is not None:
            ids[t] = min(doc, ids.get(t, doc))
    return Counter((doc, ids.get(t), tops.count(t)) for (doc, _), t in zip(rows, tops))


def found(df):
    return Counter((r.doc_id, r.class_id, r.class_size) for r in minhash.near_duplicates(df).collect())


def test_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(docs) == expected(rows)
    kept = minhash.one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(plain_classes(rows)))


def test_odd_rows(odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert found(odd_documents) == expected(rows)
    kept = minhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == len(set(plain_classes(rows)))
    assert not found(no_documents) and minhash.one_of_each(no_documents).count() == 0


SHORT = ["one", "one!", "One two!", "one two", "one two three", "one, two, three", "a b c d", "A b c D", "a b c d e", "a b c d e f"]


def test_short_texts(spark):
    """Pairs of one to six words, alone in a batch, beside a longer text and in verification."""
    longer = "some longer text of more than five words " * 3
    for texts in (SHORT, SHORT[2:4], SHORT[4:6], SHORT[6:8], [*SHORT, longer, longer.upper()]):
        rows = list(enumerate(texts))
        assert found(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == expected(rows)
    for text in SHORT:
        doc, key, weight = minhash.shingle_bags([text])
        assert len(doc) == max(len(bag(text)), 1) and weight.sum() == sum(bag(text).values())


def test_open_buckets_lose_no_link(spark):
    """A chain of edited copies: neighbours are alike, the ends are not."""
    words = [f"w{i}" for i in range(200)]
    rows = [(n, " ".join([f"n{n - k}x{i}" if i < 4 * k else w for k in [n] for i, w in enumerate(words)])) for n in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == expected(rows)


def test_blocks_find_all_links():
    import pandas as pd

    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[:50] + [f"t{n}", f"u{n}"] * (n % 4)) for n in range(30)]
    nodes = [minhash.node_id(t) for t in texts]
    frame = pd.DataFrame({"node": nodes, "root": nodes, "text": texts, "chunk": [n % 2 for n in range(30)]})
    links = [minhash._close(0.8)((b"", i, j), frame[frame.chunk.isin([i, j])]) for i, j in ((0, 0), (0, 1), (1, 1))]
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pd.concat(links)[["a", "b"]].itertuples(index=False):
        parent[top(a)] = top(b)
    assert sum(len(x) for x in links) < 3 * 30
    wanted = plain_classes(list(enumerate(texts)))
    assert len({top(n) for n in nodes}) == len(set(wanted))


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_signatures_are_unbiased(share):
    many = int(2000 * share)
    a = " ".join(["x y z"] * 40 + [f"a{i}" for i in range(2000)])
    b = " ".join(["x y z"] * 80 + [f"a{i}" for i in range(many)] + [f"b{i}" for i in range(2000 - many)])
    doc, key, weight = minhash.shingle_bags([a, b])
    times = minhash.bag_signatures(2, doc, key, weight, 4096)
    true = minhash.overlap(minhash._bag(a), minhash._bag(b))
    assert abs((times[0] == times[1]).mean() - true) < 4 * np.sqrt(true * (1 - true) / 4096)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 1), (5, 4), (5, 6), (9, 9), (7, 8), (8, 10), (10, 11), (11, 12), (2, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 7, 8: 7, 10: 7, 11: 7, 12: 7}
