"""Model and API responses: JSON text to typed columns through VARIANT."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .errors import is_quota
from .text import (
    clean_text,
    is_meaningful,
    json_list_text,
    let,
    normalize_brands,
    normalize_handles,
    normalize_tags,
    ordered_distinct,
    python_list_text,
    split_camel_case,
    strip,
)

TAGS_WANTED = 10
TAG_FIELDS = ("tags", "is_sponsorship", "brands", "associated_brands", "associated_mentions")

# Texts that mean "sponsored", strict for summaries, lenient for tags.
STRICT_TRUE = ("1", "true", "yes")
LENIENT_TRUE = ("1", "true", "yes", "y", "t")

SUMMARY_LISTS = ("brand_mentioned", "product_mentioned", "topic_tags", "sponsorship_name")


# -- reading JSON -------------------------------------------------------------


def _wrapped(text: Column) -> Column:
    """VARIANT with the value of ``text`` in ``v``, and ``end`` if nothing follows that value.

    ``try_parse_json`` ignores what follows the first value; a second field
    behind the text makes such a rest invalid.
    """
    return F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit(',"end":0}')))


def _unwrapped(w: Column) -> Column:
    return F.when(
        F.try_variant_get(w, "$.end", "int") == 0, F.try_variant_get(w, "$.v", "variant")
    )


def strict_json(text: Column) -> Column:
    """VARIANT when the whole text is one JSON value, else NULL."""
    return let(_wrapped(text), _unwrapped)


_BRACKET = re.compile(r"[\[\]{}]")
_CLOSING = {"[": "]", "{": "}"}


def _json_candidates(text: str) -> Iterator[str]:
    """Parts of a text that may be JSON, from the likeliest: all of it, the widest bracketed part,
    and the part that ends where the brackets opened so far are closed for the first time."""
    yield text
    marks = [m for m in _BRACKET.finditer(text)]
    while marks and marks[0][0] not in _CLOSING:
        marks.pop(0)
    if not marks:
        return
    first = marks[0].start()
    if closers := [m.end() for m in marks if m[0] not in _CLOSING]:
        yield text[first : closers[-1]]
    expected = ""
    for mark in marks:
        if mark[0] in _CLOSING:
            expected += _CLOSING[mark[0]]
        elif expected.endswith(mark[0]):
            expected = expected[:-1]
        if not expected:
            yield text[first : mark.end()]
            return


@F.pandas_udf(StringType())
def _python_json(texts: pd.Series, tolerant: pd.Series) -> pd.Series:
    """Canonical JSON of text Spark's parser refuses: repeated keys, NaN, a cut-off rest."""
    import json

    special = {"NaN": "nan", "Infinity": "inf", "-Infinity": "-inf"}

    def read(text, parts):
        for part in (() if text is None else _json_candidates(text) if parts else (text,)):
            try:
                return json.dumps(json.loads(part, parse_constant=special.get), ensure_ascii=False)
            except (ValueError, RecursionError):
                continue
        return None

    return pd.Series([read(t, p) for t, p in zip(texts, tolerant)], dtype="object")


def _read(df: DataFrame, text: str, out: str, unless: str | None = None) -> DataFrame:
    """Add VARIANT ``out`` of text column ``text``; rows that have ``unless`` keep that value.

    Each step is a column of its own, so long texts are read once.
    """
    parsed = _wrapped(F.col(text))
    if unless is not None:
        parsed = F.when(F.col(unless).isNull(), parsed)
    value = _unwrapped(F.col("_wrapped"))
    if unless is not None:
        value = F.coalesce(F.col(unless), value)
    return df.withColumn("_wrapped", parsed).withColumn(out, value).drop("_wrapped")


def _read_in_python(df: DataFrame, text: str, out: str, unless: str, tolerant: bool) -> DataFrame:
    """As ``_read`` for text with a bracket that Spark refused; other rows send NULL."""
    left = F.when(F.col(unless).isNull() & F.col(text).rlike(r"[\[{]"), F.col(text))
    parsed = F.try_parse_json(_python_json(left, F.lit(tolerant)))
    return df.withColumn(out, F.coalesce(F.col(unless), parsed))


def with_object(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Add VARIANT ``out``: the JSON object in a summary answer; NULL is a failed answer.

    Code fences are removed and the part from the first ``{`` to the last ``}`` is read.
    """
    opened = strip(F.regexp_replace("_text", "^```(?i:json)?", ""))
    bare = F.when(
        F.col("_text").startswith("```"), strip(F.regexp_replace(opened, "```$", ""))
    ).otherwise(F.col("_text"))
    span = F.regexp_extract("_bare", r"(?s)\{.*\}", 0)
    cut = (
        df.withColumn("_text", clean_text(F.col(raw)))
        .withColumn("_bare", bare)
        .withColumn("_span", span)
        .withColumn("_part", F.when(F.col("_span") != "", F.col("_span")).otherwise(F.col("_bare")))
    )
    native = _read(cut, "_part", "_native")
    return _read_in_python(native, "_part", out, "_native", False).drop(
        "_text", "_bare", "_span", "_part", "_native"
    )


def with_tolerant_json(df: DataFrame, text: Column, out: str) -> DataFrame:
    """Add VARIANT ``out``: whole text, else widest bracketed part, else a balanced part."""
    cut = df.withColumn("_text", clean_text(text))
    whole = _read(cut, "_text", "_whole")
    part = F.when(F.col("_whole").isNull(), F.regexp_extract("_text", r"(?s)[\[{].*[\]}]", 0))
    native = _read(whole.withColumn("_part", part), "_part", "_native", "_whole")
    return _read_in_python(native, "_text", out, "_native", True).drop(
        "_text", "_whole", "_part", "_native"
    )


# -- VARIANT helpers ----------------------------------------------------------


def _kind(v: Column) -> Column:
    """``VOID``, ``BOOLEAN``, ``BIGINT``, ``DECIMAL``, ``DOUBLE``, ``STRING``, ``ARRAY``, ``OBJECT``."""
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def item_text(v: Column) -> Column:
    """Text of any JSON value: null is ``None``, true is ``True``, containers are JSON."""

    def render(schema: Column) -> Column:
        whole_decimal = schema.rlike(r"^DECIMAL\((\d|1[0-8]),0\)$")
        return (
            F.when(schema == "VOID", "None")
            .when(schema == "BOOLEAN", F.initcap(_text(v)))
            .when(whole_decimal, F.concat(_text(v), F.lit(".0")))
            .otherwise(_text(v))
        )

    return let(F.schema_of_variant(v), render)


def text_or_blank(v: Column) -> Column:
    """``item_text`` trimmed, with every empty value (null, false, 0, empty container) blank."""
    shown = let(item_text(v), lambda t: F.when(t.isin("None", "False", "0", "0.0", "[]", "{}") & (_kind(v) != "STRING"), "").otherwise(t))
    return F.coalesce(strip(F.when(v.isNotNull(), shown)), F.lit(""))


def is_object(v: Column) -> Column:
    return F.coalesce(_kind(v) == "OBJECT", F.lit(False))


def list_or_empty(v: Column) -> Column:
    """Items of a JSON list; anything else has none."""
    return F.coalesce(
        F.try_variant_get(v, "$", "array<variant>"), F.array().cast("array<variant>")
    )


def as_list(v: Column) -> Column:
    """A list stays, NULL and empty text give no items, any other value is one item."""
    items = F.try_variant_get(v, "$", "array<variant>")
    empty = v.isNull() | F.is_variant_null(v) | ((_kind(v) == "STRING") & (_text(v) == ""))
    single = F.when(empty, F.array().cast("array<variant>")).otherwise(F.array(v))
    return F.coalesce(items, single)


def _texts(v: Column, null: str, slow: Column) -> Column:
    """Texts of a JSON list: a list of nothing but strings is read in one step, any other
    one item by item (``slow``), because the type of an item decides its text."""
    plain = F.transform(
        F.try_variant_get(v, "$", "array<string>"), lambda x: F.coalesce(x, F.lit(null))
    )
    return F.when(F.schema_of_variant(v) == "ARRAY<STRING>", plain).otherwise(slow)


def item_texts(v: Column) -> Column:
    """``item_text`` of the items of a list; anything else has no items."""
    return _texts(v, "None", F.transform(list_or_empty(v), item_text))


def item_texts_or_blank(v: Column) -> Column:
    return _texts(v, "", F.transform(list_or_empty(v), text_or_blank))


def distinct_texts(v: Column) -> Column:
    """Texts of ``as_list`` items, first of each trimmed key, blank keys dropped.

    Plain values are compared without case; an object or a list is compared as its JSON, and never
    equals a text that reads the same.
    """

    def tagged(x: Column) -> Column:
        """The text behind a letter for its kind: repeats of plain texts are found by hash, those of structs by comparing all pairs."""
        return F.concat(F.when(_kind(x).isin("OBJECT", "ARRAY"), "j").otherwise("t"), item_text(x))

    def tagged_key(x: Column) -> Column:
        text = strip(F.substring(x, F.lit(2), F.length(x)))
        return F.when(text == "", "").when(x.startswith("j"), F.concat(F.lit("json:"), text)).otherwise(F.concat(F.lit("text:"), F.lower(text)))

    def read(v: Column) -> Column:
        strings = F.try_variant_get(v, "$", "array<string>")
        plain = ordered_distinct(F.transform(strings, lambda x: F.coalesce(x, F.lit("None"))), lambda x: F.lower(strip(x)), "")
        mixed = ordered_distinct(F.transform(as_list(v), tagged), tagged_key, "")
        untagged = F.transform(mixed, lambda x: F.substring(x, F.lit(2), F.length(x)))
        return F.when(F.schema_of_variant(v) == "ARRAY<STRING>", plain).otherwise(untagged)

    return let(v, read)


# -- summaries ----------------------------------------------------------------


def strict_flag(v: Column) -> Column:
    kind = _kind(v)
    true_text = F.lower(strip(_text(v))).isin(*STRICT_TRUE)
    return F.coalesce(
        F.when(kind.isin("BOOLEAN", "STRING", "BIGINT") & true_text, 1).otherwise(0), F.lit(0)
    )


def lenient_flag(v: Column) -> Column:
    kind = _kind(v)
    number = F.try_variant_get(v, "$", "double")
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("int"))
        .when(kind.isin("BIGINT", "DECIMAL", "DOUBLE"), ((number >= 1) & (number < 2)).cast("int"))
        .when(F.lower(strip(_text(v))).isin(*LENIENT_TRUE), 1)
        .otherwise(0),
        F.lit(0),
    )


def with_analysis(df: DataFrame, data: str) -> DataFrame:
    """Add the eight analysis columns read from VARIANT column ``data`` (not an object: all empty)."""

    def field(name: str) -> Column:
        return F.try_variant_get(F.col(data), f"$.{name}", "variant")

    def plain(name: str) -> Column:
        value = field(name)
        as_is = F.when(_kind(value) == "STRING", _text(value))
        return F.coalesce(as_is, text_or_blank(value))

    flagged = df.withColumn("is_sponsorship", strict_flag(field("is_sponsorship")))
    no_names = F.array().cast("array<string>")
    names = F.when(F.col("is_sponsorship") == 1, distinct_texts(field("sponsorship_name")))
    return flagged.withColumns(
        {
            "video_title": strip(plain("video_title")),
            "brand_mentioned": distinct_texts(field("brand_mentioned")),
            "product_mentioned": distinct_texts(field("product_mentioned")),
            "topic_tags": distinct_texts(field("topic_tags")),
            "summary": strip(plain("summary")),
            "key_topics": json_items_text(as_list(field("key_topics"))),
            "sponsorship_name": F.coalesce(names, no_names),
        }
    )


def json_items_text(items: Column) -> Column:
    """JSON array text of VARIANT items."""
    return F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: F.to_json(x)), ", "), F.lit("]"))


def summary_outcome(
    content: Column, raw: Column, data: Column, error: Column, object_error: Column | None = None
) -> Column:
    """Outcome of one video: only an object that was read and is blank has no transcript."""
    unread = F.lit(None).cast("string") if object_error is None else object_error
    return (
        F.when(unread.isNotNull(), unread)
        .when(clean_text(content) == "", "NO_TRANSCRIPT")
        .when(error.isNotNull(), error)
        .when(raw.isNull(), "NO_RESPONSE")
        .when(data.isNull(), "INVALID_JSON")
        .otherwise("")
    )


# -- tags ---------------------------------------------------------------------


def response_text(v: Column) -> Column:
    """Text of a response body: its non-blank ``text``, else the first candidate's parts."""
    direct = F.try_variant_get(v, "$.text", "variant")
    own = F.when(_kind(direct) == "STRING", strip(_text(direct)))
    parts = list_or_empty(F.try_variant_get(v, "$.candidates[0].content.parts", "variant"))
    texts = F.transform(
        parts,
        lambda p: let(
            F.try_variant_get(p, "$.text", "variant"),
            lambda t: F.when(_kind(t) == "STRING", strip(_text(t))),
        ),
    )
    joined = F.array_join(F.filter(texts, lambda t: t.isNotNull() & (t != "")), "\n")
    return F.coalesce(F.when(own != "", own), strip(joined), F.lit(""))


def with_tag_data(df: DataFrame, raw: str, out: str) -> DataFrame:
    """Add VARIANT ``out`` of a tag answer: camel case is split before parsing; where that
    broke the JSON, the text is parsed as it came."""
    split = split_camel_case(clean_text(F.col(raw)))
    read = with_tolerant_json(df, split, "_split")
    return _read(read.withColumn("_raw", clean_text(F.col(raw))), "_raw", out, "_split").drop(
        "_split", "_raw"
    )


def with_tag_payload(df: DataFrame, data: str) -> DataFrame:
    """Add the five normalised fields of a tag answer held in VARIANT column ``data``."""

    def field(name: str) -> Column:
        return F.try_variant_get(F.col(data), f"$.{name}", "variant")

    return df.withColumns(
        {
            "tags": normalize_tags(item_texts(field("tags"))),
            "is_sponsorship": lenient_flag(field("is_sponsorship")),
            "brands": normalize_brands(item_texts(field("brand_name"))),
            "associated_brands": normalize_handles(item_texts_or_blank(field("associated_brand"))),
            "associated_mentions": normalize_handles(
                item_texts_or_blank(field("associated_mention"))
            ),
        }
    )


def tag_answer(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Add what an answer says: the five fields, and ``silent`` if it has no text.

    Row by row and short, so that answers are read where they lie and no text is shuffled.
    """
    parsed = with_tag_payload(with_tag_data(df, raw, "_data"), "_data")
    return parsed.withColumn("silent", clean_text(F.col(raw)) == "").drop("_data")


def unanswered(df: DataFrame) -> DataFrame:
    """The fields of ``tag_answer`` filled in for rows that found no answer."""
    blank = {c: F.array().cast("array<string>") for c in TAG_FIELDS if c != "is_sponsorship"}
    blank |= {"is_sponsorship": F.lit(0), "silent": F.lit(True)}
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in blank.items()})


def tag_outcome(
    df: DataFrame, content: str = "content", raw: str = "raw", error: str = "error",
    require_all_tags: bool = True,
) -> DataFrame:
    """Reason, retry flags and the row to store for each post and its staged answer."""
    answered = tag_answer(df, raw)
    return answer_outcome(answered, is_meaningful(F.col(content)), error, require_all_tags)


def answer_outcome(
    parsed: DataFrame, meaningful: Column, error: str = "error", require_all_tags: bool = True
) -> DataFrame:
    """``tag_outcome`` of answers read by ``tag_answer``, beside captions worth a call or not."""
    short = (F.size("tags") != TAGS_WANTED) if require_all_tags else F.lit(False)
    reason = (
        F.when(~meaningful, "empty_input")
        .when(F.col(error).isNotNull(), "exception")
        .when(F.col("silent"), "empty_output")
        .when(short, "not_10_tags")
        .otherwise("ok")
    )
    quota_error = is_quota(F.col(error))
    return (
        parsed.withColumn("reason", reason)
        .withColumns(
            {
                "ok": F.col("reason") == "ok",
                "skip_retry": F.col("reason") == "empty_input",
                "quota_fail": (F.col("reason") == "empty_output")
                | ((F.col("reason") == "exception") & quota_error),
                "topic_tags": python_list_text(F.col("tags")),
                "brand_name": json_list_text(F.col("brands"), None),
                "associated_brand": json_list_text(F.col("associated_brands"), None),
                "associated_mention": json_list_text(F.col("associated_mentions"), None),
            }
        )
        .drop("silent")
    )


# -- captions -----------------------------------------------------------------


def with_captions(df: DataFrame, default_format: str = "srt") -> DataFrame:
    """Payload columns of a captions response (``video_id, status, body``)."""

    def field(name: str) -> Column:
        return F.try_variant_get(F.col("_body"), f"$.data.{name}", "variant")

    message = text_or_blank(F.try_variant_get(F.col("_body"), "$.message", "variant"))
    data_format = text_or_blank(field("format"))
    return (
        df.withColumn("_body", strict_json(clean_text(F.col("body"))))
        .withColumns(
            {
                "content": text_or_blank(field("content")),
                "language_code": text_or_blank(field("language_code")),
                "language_name": text_or_blank(field("language_name")),
                "format": F.when(data_format == "", default_format).otherwise(data_format),
                "_message": message,
            }
        )
        .withColumn(
            "error",
            F.when(
                (F.col("_message") == "") & (F.col("status") != 200),
                F.concat(F.lit("HTTP "), F.col("status").cast("string"), F.lit(" error")),
            ).otherwise(F.col("_message")),
        )
        .drop("_body", "_message")
    )
