"""URL filters: rules first, gradient-boosted trees on lexical features for what no rule decides.

Features are column expressions over host, path and query: lengths, depth, shares of digits and
symbols, character entropy, parameter counts, and statistics of the host's suffix.  The trees are
small histogram trees fitted in numpy on a bounded sample of labelled URLs, both labels weighing
the same; a quarter of the labelled URLs is held out.  In a filter with rules, the URLs that rules
decide are the labelled ones, and the features that repeat what the rules test are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

#: (host and path, verdict); a rule fits its host and subdomains where the path starts with its path.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
#: Bound of the training sample: labelled URLs by the order of their digest.
TRAINING_ROWS = 20_000
TREES, DEPTH, RATE, BINS, LEAST_ROWS = 40, 3, 0.2, 32, 20
LEXICAL = (
    "url_length", "host_length", "path_length", "labels", "longest_label", "depth", "digit_ratio", "symbol_ratio",
    "hyphens", "entropy", "host_entropy", "parameters", "query_length", "fragment", "https", "dotted_end", "numeric_part", "language_part",
)
SUFFIX = ("suffix_share", "suffix_rate")
FEATURES = LEXICAL + SUFFIX
#: Features that tell a rule's suffix and first folder: trees fitted on rules would only repeat them.
RULE_FEATURES = ("language_part", "suffix_share", "suffix_rate")
HOLD_OUT = 4
_ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """Behind the first "://" up to "/", "?", "#" or the end, A-Z lowered; empty without one."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, _ASCII_UPPER, _ASCII_UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits; of equally long ones the first by code point."""

    def fits(rule: str) -> Column:
        name, _, rest = rule.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)

    ordered = sorted({r for r, _ in rules}, key=lambda r: (-len(r), r))
    return F.coalesce(*[F.when(fits(r), F.lit(r)) for r in ordered], F.lit(None).cast("string"))


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for an empty text.

    Equal characters stand together in the sorted array, so the runs are counted in one pass.
    """
    letters = F.array_sort(F.split(text, ""))
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("sum"))
    term = lambda n: F.when(n > 0, n * F.log2(F.greatest(n, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))

    def step(acc: Column, x: Column) -> Column:
        same = acc["last"] == x
        return F.struct(
            x.alias("last"), F.when(same, acc["run"] + 1).otherwise(F.lit(1)).alias("run"),
            F.when(same, acc["sum"]).otherwise(acc["sum"] + term(acc["run"])).alias("sum"),
        )

    n = F.length(text)
    return F.when(n > 0, F.aggregate(letters, start, step, lambda a: F.log2(F.greatest(n, F.lit(1)).cast("double")) - (a["sum"] + term(a["run"])) / F.greatest(n, F.lit(1)))).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """The rows (with url, host, path) and their lexical features; a null url is empty."""
    url = F.coalesce("url", F.lit(""))
    host, path = F.col("host"), F.col("path")
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    labels = F.split(host, r"\.")
    whole = F.greatest(F.length(url), F.lit(1)).cast("double")
    found = {
        "url_length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "labels": F.size(labels),
        "longest_label": F.array_max(F.transform(labels, F.length)), "depth": count(path, "/[^/]"),
        "digit_ratio": count(url, "[0-9]") / whole, "symbol_ratio": count(url, r"[^A-Za-z0-9./:]") / whole,
        "hyphens": count(host, "-"), "entropy": entropy(url), "host_entropy": entropy(host),
        "parameters": count(query, "[^&;]+"), "query_length": F.length(query), "fragment": url.contains("#"),
        "https": url.startswith("https:"), "dotted_end": path.rlike(r"\.[A-Za-z0-9]+$"), "numeric_part": path.rlike(r"/[0-9]+(/|$|\.)"),
        "language_part": path.rlike(r"^/[a-z]{2}(/|$)"),
    }
    return urls.select("*", *[found[name].cast("double").alias(name) for name in LEXICAL])


class BoostedTrees:
    """Depth-wise histogram trees on the log loss; scores are probabilities of label 1 (block).

    Rows are weighted so that both labels weigh the same.  With labels of one kind all scores are
    their mean.
    """

    def __init__(self) -> None:
        self.base = 0.0
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        mean = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
        if not len(y) or y.min() == y.max():
            self.base = math.log(mean / (1 - mean))
            return self
        share = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]
        binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)], axis=1)
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            gradient, weight = share * (y - p), share * p * (1 - p)
            nodes = (1 << DEPTH) - 1
            feature, cut = np.zeros(nodes, dtype=np.int64), np.full(nodes, np.inf)
            place = np.zeros(len(y), dtype=np.int64)
            for level in range(DEPTH):
                for node in range((1 << level) - 1, (2 << level) - 1):
                    rows = np.flatnonzero(place == node)
                    best = 1e-9
                    total_g, total_w = gradient[rows].sum(), weight[rows].sum() + 1.0
                    for f in range(x.shape[1]):
                        size = len(cuts[f]) + 1
                        n = np.bincount(binned[rows, f], minlength=size).cumsum()[:-1]
                        g = np.bincount(binned[rows, f], weights=gradient[rows], minlength=size).cumsum()[:-1]
                        w = np.bincount(binned[rows, f], weights=weight[rows], minlength=size).cumsum()[:-1] + 1.0
                        gain = g**2 / w + (total_g - g) ** 2 / (total_w - w + 1.0) - total_g**2 / total_w
                        gain[(n < LEAST_ROWS) | (len(rows) - n < LEAST_ROWS)] = 0
                        if len(gain) and gain.max() > best:
                            best, feature[node], cut[node] = gain.max(), f, cuts[f][gain.argmax()]
                    place[rows] = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            leaf = place - nodes
            g = np.bincount(leaf, weights=gradient, minlength=nodes + 1)
            w = np.bincount(leaf, weights=weight, minlength=nodes + 1) + 1.0
            self.trees.append((feature, cut, RATE * g / w))
            score += self.trees[-1][2][leaf]
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        for feature, cut, leaves in self.trees:
            place = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                place = 2 * place + 1 + (x[np.arange(len(x)), feature[place]] > cut[place])
            score += leaves[place - len(feature)]
        return 1 / (1 + np.exp(-score))


def _suffixed(rows: DataFrame) -> DataFrame:
    """The rows with their suffix's share of all rows and its smoothed rate of label 1.

    Statistics are over all rows, but labels that are held out.  A row's rate is that of the urls
    of the other fold, so that trees cannot read a row's own label back from it.
    """
    rows = rows.withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(2))).withColumn("learned", F.when(~F.col("held_out"), F.col("label")))
    total = F.sum(F.lit(1))
    of_fold = lambda n: F.when(F.col("fold") == n, F.col("learned"))
    stats = rows.groupBy("suffix").agg(
        total.alias("suffix_rows"),
        F.array(*[F.count(of_fold(n)) for n in (1, 0)]).alias("known"),
        F.array(*[F.coalesce(F.sum(of_fold(n)), F.lit(0)) for n in (1, 0)]).alias("ones"),
    )
    everything = rows.agg(total.alias("all_rows"), F.avg("learned").alias("mean")).first()
    count, mean = max(everything["all_rows"] or 0, 1), everything["mean"] if everything["mean"] is not None else 0.5
    other = lambda c: F.element_at(c, F.col("fold").cast("int") + 1)
    rate = (other("ones") + 10 * mean) / (other("known") + 10)
    joined = rows.join(stats, "suffix")
    return joined.withColumn("suffix_share", F.col("suffix_rows") / float(count)).withColumn("suffix_rate", rate)


def classified(urls: DataFrame, sample_rows: int = TRAINING_ROWS, features: Sequence[str] = FEATURES) -> DataFrame:
    """``urls`` (url, label 0, 1 or null, any other columns) with host, path, held_out and score.

    One labelled url in four, by the checksum of the url, is held out: ``held_out`` is true and
    its label is not learned.  The trees learn from at most ``sample_rows`` other rows with a
    label, in the order of the url's digest, and score every row.  Without labels of both kinds
    all scores are the labels' mean, without any 0.5.  A null url counts as empty; repeated rows are
    scored each; an empty table gives an empty result.  Columns of ``urls`` named host, path,
    held_out or score are replaced, all others kept whatever their name.
    """
    added = ("host", "path", "held_out", "score")
    given = [F.col(f"`{c}`") for c in urls.columns if c not in added]
    url = F.coalesce("url", F.lit(""))
    held = F.col("label").isNotNull() & (F.crc32(url) % HOLD_OUT == HOLD_OUT - 1)
    rows = urls.select(F.struct(*given).alias("row"), "url", F.col("label").cast("int").alias("label"), held.alias("held_out"))
    rows = rows.withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    rows = rows.withColumn("suffix", F.element_at(F.split("host", r"\."), -1))
    rows = _suffixed(lexical(rows)).withColumn("x", F.array(*features))
    sample = rows.where("learned is not null").select("learned", "x", F.md5(url).alias("key"))
    sample = sample.orderBy("key", "learned").limit(sample_rows).toPandas()
    x = np.array(sample["x"].tolist(), dtype=np.float64).reshape(len(sample), len(features))
    trees = BoostedTrees().fit(x, sample["learned"].to_numpy(dtype=np.float64))

    kept = rows.select("row", "host", "path", "held_out", "x")
    schema = StructType([*kept.schema.fields[:-1], StructField("score", DoubleType())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(4).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(features))
            found = pa.array(trees.predict(values), pa.float64())
            yield pa.record_batch([*batch.columns[:4], found], names=schema.names)

    return kept.mapInArrow(score, schema).select("row.*", *added)


def filtered(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score, held_out of every row.

    The verdict is the rule's; where none fits, the trees', which block from a score of one half.
    URLs that a rule decides are the labelled ones; a quarter of them is held out, so that score
    and rule there tell the trees' error.  The trees do not see RULE_FEATURES.  A null url, or
    one without "://", has an empty host and path and fits no rule.  Repeated rows are judged
    each.  Only page_id and url are read.
    """
    rule = rule_of(host_of(F.col("url")), path_of(F.col("url")), rules)
    blocks = F.col("rule").isin([r for r, v in rules if v == "block"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", rule.alias("rule"))
    rows = rows.withColumn("label", F.when(F.col("rule").isNotNull(), blocks.cast("int")))
    found = classified(rows, features=[f for f in FEATURES if f not in RULE_FEATURES])
    block = F.coalesce(F.col("label") == 1, F.col("score") >= 0.5)
    return found.select(
        "page_id", "host", "path", "rule", F.when(block, "block").otherwise("allow").alias("verdict"), "score", "held_out"
    )
