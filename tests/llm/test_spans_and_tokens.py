"""Source divergence, repeated passages and token alignment against plain versions."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from mediaweave.llm import alignment, divergence, repeats
from mediaweave.llm.token_ids import tokenizer_path

FOLDER = "/root/testdata/sf0.001"
BYTE, PIECE = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def hot(rows, n):
    """A third of all rows and more are one null row."""
    return rows + [(None,) * len(rows[0])] * n


# -- source divergence --------------------------------------------------------


def plain_divergence(rows, least=3, ranks=200):
    """rows: (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    split = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for _, _, t in rows]
    out = Counter()
    for lang in {r[0] for r in rows}:
        here = [(r[1], terms) for r, terms in zip(rows, split) if r[0] == lang]
        often = Counter(t for _, terms in here for t in set(terms))
        kept = sorted(t for t, n in often.items() if n >= least)
        counts = defaultdict(Counter)
        for source, terms in here:
            counts[source].update(t for t in terms if often[t] >= least)
        whole = sum(counts.values(), Counter())

        def p(counter, term):
            return 1 + 1000000000 * (counter[term] + 1) // (sum(counter.values()) + len(kept))

        table = {s: {t: p(c, t) for t in kept} for s, c in counts.items()}
        q = {t: p(whole, t) for t in kept}
        for s in table:
            pairs = [(-sum((table[s][t] - table[o][t]) ** 2 // table[o][t] for t in kept), o.encode()) for o in table if o != s]
            terms = [(-((table[s][t] - q[t]) ** 2 // q[t]), t.encode()) for t in kept if counts[s][t] and table[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:ranks])):
                out.update((lang, s, part, item.decode(), -value, i + 1) for i, (value, item) in enumerate(found))
    return out


def divergent(df, **options):
    return Counter(tuple(r) for r in divergence.divergence(df, **options).select("lang", "source", "part", "item", "value", "rank").collect())


def test_divergence(spark, documents, monkeypatch):
    rows = [tuple(r) for r in documents.select("lang", "source", "text").collect()]
    assert divergent(documents) == plain_divergence(rows)
    monkeypatch.setattr(divergence, "SLICE", 300)  # many portions, long texts in slices
    assert divergent(documents, ranks=7) == plain_divergence(rows, ranks=7)


def test_divergence_of_odd_rows(spark):
    texts = ["Ab ab AB É é x1y", "ab É", "", None, "1 2 3", "É ab c " * 40, "z", "z", "z", "[a]b`c{d}"]
    rows = [("en", "s1", t) for t in texts] + [(None, None, t) for t in texts[:3]] + [("en", None, "ab ab"), ("fr", "s1", "only two"), ("fr", "s2", "only two"), ("de", "s9", "alone")]
    rows += [("en", f"s{i % 3}", "the same text again") for i in range(60)] + [("en", "empty", "")]
    df = spark.createDataFrame([(*r, 1, "x") for r in hot(rows, 40)], "lang string, source string, text string, term int, count string")
    assert divergent(df) == plain_divergence(hot(rows, 40))
    assert not divergent(df.where("lang = 'none'"))


def test_equal_texts_are_split_once(spark):
    rows = [("en", f"s{i % 4}", "the same text") for i in range(200)] + [("fr", "s0", "the same text")]
    found = divergence.collapsed(spark.createDataFrame(rows, "lang string, source string, text string")).collect()
    assert {(r.lang, tuple(sorted(tuple(x) for x in r.sources))) for r in found} == {
        ("en", (("s0", 50), ("s1", 50), ("s2", 50), ("s3", 50))), ("fr", (("s0", 1),)),
    }


# -- repeated passages --------------------------------------------------------


def plain_repeats(rows, window=35):
    """rows: (doc_id, text)."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = Counter()
    for (name, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[(name, len(words), len(gone), hashlib.sha256(kept.encode("utf-8", "surrogatepass")).hexdigest())] += 1
    return out


def removed(df, **options):
    return Counter(tuple(r) for r in repeats.without_repeats(df, **options).select("doc_id", "n_words", "n_removed", "kept_sha256").collect())


def test_repeats_of_documents(documents):
    assert removed(documents) == plain_repeats([(r.doc_id, r.text) for r in documents.collect()])


@pytest.mark.parametrize("seed", range(3))
def test_repeats_of_few_words(spark, seed, monkeypatch):
    """Few different words: branching anchors, ties between k-mers, passages that overlap themselves."""
    monkeypatch.setattr(repeats, "BLOCK", 17)
    random.seed(seed)
    words = [f"w{i}" for i in range([2, 5, 60][seed])]
    passages = [[random.choice(words) for _ in range(random.choice([9, 10, 11, 40]))] for _ in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(random.randrange(5)):
            text += random.choice([random.choice(passages), [random.choice(words) for _ in range(random.randrange(20))], [words[0]] * random.randrange(25)])
        rows.append((i % 50, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert removed(df, window=10, anchor=3) == plain_repeats(rows, 10)


def test_repeats_of_odd_rows(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert removed(odd_documents) == plain_repeats(rows)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = hot([(i, f"a{i} b{i}\n{passage}\tc{i}  d{i}" if i % 2 else None) for i in range(30)], 10) + [(None, f"own {passage}")] * 50
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, key int, spans string")
    assert removed(df) == plain_repeats(rows)
    assert not removed(no_documents)


def test_spans_of_another_text_are_not_removed():
    """Coordinates are checked against the words: a span that is not there is left alone."""
    words = repeats.Words([" ".join(f"w{i}" for i in range(50))], repeats.WHITE)
    paths = repeats.Paths(words)
    spans = [{"place": int(s * repeats.SPAN + n), "path": int(p)} for s, n, p in zip(paths.start, paths.size, paths.path)]
    assert len(repeats._verified(words, 0, spans, 35)[0]) == len(spans)
    wrong = [s | {"path": s["path"] + 1} for s in spans] + [spans[0] | {"place": 49 * repeats.SPAN + 3}]
    assert len(repeats._verified(words, 0, wrong, 35)[0]) == 0


def test_paths_cover_every_window_once():
    random.seed(1)
    texts = [" ".join(random.choice("abc") for _ in range(n)) for n in (0, 34, 35, 36, 400)]
    paths = repeats.Paths(repeats.Words(texts, repeats.WHITE))
    covered = Counter((d, s + k) for d, s, n in zip(paths.doc, paths.start, paths.size) for k in range(n))
    assert covered == Counter((d, k) for d, t in enumerate(texts) for k in range(len(t.split()) - 34))


# -- alignment of tokens ------------------------------------------------------


def plain_tokens(text, byte, pieces, letters):
    if not text:
        return None
    a = byte.encode(" " + text, add_special_tokens=False).ids
    b = pieces.encode(text)
    bytes_a = [bytes(letters[c] for c in byte.id_to_token(i)) for i in a]
    bytes_b = []
    for i in b:
        piece = pieces.id_to_piece(i)
        bytes_b.append(bytes([int(piece[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", piece) else piece.replace("▁", " ").encode())
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    return a, b, np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()


def plain_alignment(rows):
    import sentencepiece
    from tokenizers import Tokenizer

    byte = Tokenizer.from_file(tokenizer_path(BYTE))
    byte.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE))
    letters = alignment.byte_letters()
    found = []
    for name, text in rows:
        tokens = plain_tokens(text, byte, pieces, letters)
        if tokens is None:
            found.append((name, 0, 0, [], ""))
            continue
        a, b, ends_a, ends_b = tokens
        both = sorted(set(ends_a) & set(ends_b))
        links = [(a[ends_a.index(e)], b[ends_b.index(e)]) for e in both]
        shown, low = [], 0
        for e in both:
            shown.append(",".join(str(i) for i, x in zip(a, ends_a) if low < x <= e) + "|" + ",".join(str(i) for i, x in zip(b, ends_b) if low < x <= e))
            low = e
        found.append((name, len(a), len(b), links, hashlib.sha256(";".join(shown).encode()).hexdigest()))
    counts = Counter(x for f in found for x in f[3])
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return Counter(
        (name, n_a, n_b, len(links), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), sha)
        for name, n_a, n_b, links, sha in found
    )


def align(df):
    columns = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return Counter(tuple(r) for r in alignment.aligned(df, tokenizer_path(BYTE), tokenizer_path(PIECE)).select(*columns).collect())


def test_alignment_of_documents(documents):
    some = documents.where("length(text) < 2500")
    assert align(some) == plain_alignment([(r.doc_id, r.text) for r in some.collect()])


ODD = [
    None, "", " ", "  ", "a  b", "a\n b \n c\t\t d", "a \n\n  b  ", "x y   z w \x1c q", "<|endoftext|> <s></s> <unk> <0x41>",
    "▁ piece", "né́e 中文 한국어 😀😀", "I'll don't we've 'S", "a\x00b", "1234567890 12 345.6", "=" * 70 + " " * 70, "supercalifragilistic" * 30,
]


def test_alignment_of_odd_rows(spark, odd_documents, no_documents, monkeypatch):
    rows = hot([(i % 12, t) for i, t in enumerate(ODD)] + [(1, "the same")] * 3, 12)
    df = spark.createDataFrame([(*r, b"x", 1) for r in rows], "doc_id long, text string, block binary, pair int")
    assert align(df) == plain_alignment(rows)
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert align(odd_documents) == plain_alignment(rows)
    assert not align(no_documents)


def test_slices_and_small_tables_give_the_same_rows(spark, documents, monkeypatch):
    texts = [r.text for r in documents.limit(12).collect()] + ODD
    whole = alignment.Tokenizers(tokenizer_path(BYTE), tokenizer_path(PIECE))
    wanted = [alignment.Aligned(whole, t or "") for t in texts]
    monkeypatch.setattr(alignment, "SLICE", 50)
    monkeypatch.setattr(alignment, "TABLE_BYTES", 40_000)
    small = alignment.Tokenizers(tokenizer_path(BYTE), tokenizer_path(PIECE))
    for text, w in zip(texts, wanted):
        got = alignment.Aligned(small, text or "")
        assert (got.n_a, got.n_b, got.n_groups, got.sha) == (w.n_a, w.n_b, w.n_groups, w.sha)
        assert got.links.tolist() == w.links.tolist()


@pytest.mark.parametrize("seed", range(20))
def test_groups_are_the_common_ends(seed):
    random.seed(seed)
    last = random.choice([1, 5, 60, 3000])
    share = random.choice([0.02, 0.5, 0.98])
    shared = [x for x in range(1, last) if random.random() < 0.6]
    a = sorted({*(x for x in shared if random.random() < share), *shared[: len(shared) // 2], last})
    b = sorted({*(x for x in shared if random.random() < share), *shared[: len(shared) // 2], last})
    ends, next_a, next_b = [], 0, 0
    for p, q, r, s in alignment.groups(a, b):
        assert (p, r) == (next_a, next_b)
        next_a, next_b = q, s
        if q - p == s - r and a[p] == b[r]:
            assert a[p:q] == b[r:s]
            ends += a[p:q]
        else:
            ends.append(a[q - 1])
    assert ends == sorted(set(a) & set(b)) and (next_a, next_b) == (len(a), len(b))


def test_units_are_aligned_once(monkeypatch):
    """op13: every text was aligned anew, though its units lay in the table."""
    aligned = []
    whole = alignment.groups
    monkeypatch.setattr(alignment, "groups", lambda a, b: aligned.append(len(a)) or whole(a, b))
    tokenizers = alignment.Tokenizers(tokenizer_path(BYTE), tokenizer_path(PIECE))
    text = "The unbelievable misalignment of tokenizers, \u4f60\u597d \U0001f600  two  spaces\n lines "
    first = alignment.Aligned(tokenizers, text * 50)
    assert 0 < sum(aligned) < first.n_a / 10
    aligned.clear()
    again = alignment.Aligned(tokenizers, text * 50)
    assert not aligned and again.sha == first.sha and (again.links == first.links).all()
    # The groups are those of the whole text's tokens.
    whole_text = (" " + text * 50).encode()
    a = tokenizers.byte.encode(whole_text.decode(), add_special_tokens=False).ids
    b = tokenizers.piece.encode(text * 50)
    ends_a, ends_b = (list(itertools.accumulate(int(tokenizers.lengths[k][i]) for i in ids)) for k, ids in enumerate((a, b)))
    assert ends_a[-1] == ends_b[-1] == len(whole_text)
    assert (first.n_a, first.n_b, first.n_groups) == (len(a), len(b), len(set(ends_a) & set(ends_b)))
