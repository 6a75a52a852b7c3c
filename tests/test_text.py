"""Golden cases of the text functions."""

import pytest
from pyspark.sql import functions as F

from mediaweave.functions import errors, text

def evaluate(spark, values, kind, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(build(F.col("v"))).collect()]


def test_strip_takes_all_whitespace(spark):
    assert evaluate(spark, ["　\t a b \n\xa0", None], "string", text.clean_text) == ["a b", ""]


def test_iso_times(spark):
    got = evaluate(spark, [0, 1735689599999, -1, None], "bigint", text.epoch_millis_to_iso)
    assert got == [
        "1970-01-01T00:00:00.000+00:00",
        "2024-12-31T23:59:59.999+00:00",
        "1969-12-31T23:59:59.999+00:00",
        None,
    ]


def test_object_locations(spark):
    urls = [
        "s3://my_bucket//a/b.json?x=1", "https://data_1.s3.r.amazonaws.com/t/v.json?sig=a#f",
        "http://h/a;b/c;d", " /plain/key.json ", "", None,
    ]
    got = evaluate(
        spark, urls, "string", lambda c: text.object_location(c, F.lit("vid"), "own", "pre")
    )
    assert [tuple(r) for r in got] == [
        ("my_bucket", "a/b.json"), ("data_1", "t/v.json"), ("h", "a;b/c"),
        ("own", "plain/key.json"), ("own", "pre/vid.json"), ("own", "pre/vid.json"),
    ]


def test_object_key_without_prefix(spark):
    assert evaluate(spark, ["v"], "string", lambda c: text.object_key(c, "")) == ["v.json"]


@pytest.mark.parametrize(
    "caption, wanted",
    [("Hi", False), (" THANK you ", False), ("nan", False), ("😀 12!", False), ("你好", True), ("hi there", True), (None, False)],
)
def test_meaningful(spark, caption, wanted):
    assert evaluate(spark, [caption], "string", text.is_meaningful) == [wanted]


def test_caption_classes(spark):
    rows = [("en", "x", 200), ("a.en", "x", 200), ("zh", "x", 200), ("en", " ", 200), ("en", "x", 404), ("en", "x", None)]
    df = spark.createDataFrame(rows, "lang string, content string, status int")
    srt = text.caption_class(F.col("lang"), F.col("content"), F.col("status"))
    got = df.select(srt.alias("a"), text.stored_caption_class(srt).alias("b")).collect()
    assert [r.a for r in got] == [1, 2, 0, 3, 3, 3]
    assert [r.b for r in got] == [1, 2, 3, 3, 3, 3]


def test_tags_truncate_then_drop_repeats(spark):
    given = ["One two three four five", "one TWO three four six", "Hello", "  ", "é!", "C++ & more", None, "x" * 3]
    got = evaluate(spark, [given, [str(i) for i in range(15)]], "array<string>", text.normalize_tags)
    assert got == [["One two three four", "C more", "xxx"], [str(i) for i in range(10)]]


def test_brands(spark):
    given = ["Sponsored", "A b c d e f g", "a B C D E F z", "Shop!", "Acme’s"]
    assert evaluate(spark, [given], "array<string>", text.normalize_brands) == [["A b c d e f", "Acme s"]]


def test_handles(spark):
    given = ["@abc", '"foo.bar"', "Foo", "foo.bar", "link", "(code)", "a_b-c", "_x", " ok!", ""]
    assert evaluate(spark, [given], "array<string>", text.normalize_handles) == [["foo.bar", "a_b-c", "ok"]]


def test_normalisers_are_idempotent(spark):
    given = [["Ab cD ef gh ij", "AB CD ef gh", "Ünïcode text here", "q"]]
    once = evaluate(spark, given, "array<string>", text.normalize_tags)
    assert evaluate(spark, once, "array<string>", text.normalize_tags) == once


def test_long_list_keeps_first_spelling(spark):
    given = [f"{'W' if i % 2 else 'w'}{i % 5000}" for i in range(20000)]
    seen, wanted = set(), []
    for item in given:
        if item.lower() not in seen:
            seen.add(item.lower())
            wanted.append(item)
    got = evaluate(spark, [given], "array<string>", lambda c: text.ordered_distinct(c, F.lower))
    assert got == [wanted]


def test_list_texts(spark):
    assert evaluate(spark, [["a", "b"], []], "array<string>", text.python_list_text) == ["['a', 'b']", "[]"]
    got = evaluate(spark, [['q"', "é\n"], []], "array<string>", text.json_list_text)
    assert got == ['["q\\"", "é\\n"]', "[]"]
    assert evaluate(spark, [[]], "array<string>", lambda c: text.json_list_text(c, None)) == [None]
    assert evaluate(spark, [" [1] ", " x "], "string", text.stored_list_text) == ["[1]", " x "]


def test_stored_lists_read_back(spark):
    stored = [
        "['a', ' b ', '']", '["a", "b"]', "[1, 2]", "['it\\'s', None]", "", "no list", "{'a': 1}",
        "[['x']]", '["a"], ["b"]', None, '[null, "z"]', "[true, false]", "[NaN]", '["a\\"]b", "c"]',
    ]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stored)], "i int, s string")
    got = [r.out for r in text.parse_list_text(df, "s", "out").orderBy("i").collect()]
    assert got == [
        ["a", "b"], ["a", "b"], ["1", "2"], ["it's", "None"], [], [], [], ["['x']"], [], [], ["None", "z"],
        ["True", "False"], ["nan"], ['a"]b', "c"],
    ]


def test_join_tags(spark):
    assert evaluate(spark, [[" A", "a", "b ", ""]], "array<string>", text.join_tags) == ["A, b"]


def test_pair_keys(spark):
    got = evaluate(spark, ["u::p::q", "none", "::p"], "string", text.split_pair_key)
    assert [tuple(r) for r in got] == [("u", "p::q"), ("", ""), ("", "p")]


def test_camel_case(spark):
    assert evaluate(spark, ["iPhone fooBarBaz ABc"], "string", text.split_camel_case) == ["i Phone foo Bar Baz ABc"]


def test_prompt(spark):
    assert evaluate(spark, ["a\\1$"], "string", lambda c: text.fill_prompt("<{TRANSCRIPT}>{TRANSCRIPT}", c)) == ["<a\\1$>a\\1$"]


def test_error_classes(spark):
    given = ["429", "failed to generate", "Deadline exceeded", "not primary", "Unauthorized", "boom", None, "i/o Timed Out"]
    assert evaluate(spark, given, "string", errors.error_class) == [
        "quota", "quota", "transient", "store_retryable", "stop", "other", "none", "store_retryable",
    ]
    assert evaluate(spark, given[:2], "string", lambda c: errors.is_quota(c, True)) == [True, False]
    assert evaluate(spark, ["not found", "x"], "string", errors.is_stop) == [True, False]
    assert evaluate(spark, ["rate", "timeout", "x"], "string", errors.is_quota_or_transient) == [True, True, False]
