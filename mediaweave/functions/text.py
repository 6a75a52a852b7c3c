"""Text, key and array expressions as plain columns (no Python at run time)."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# The characters str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Greetings that make neither a caption nor a tag.
GENERIC_WORDS = (
    "hello",
    "hi",
    "hey",
    "welcome",
    "thanks",
    "thank",
    "thank you",
    "subscribe",
    "follow",
)
# Promotion words that are no brand names.
PROMOTION_WORDS = (
    "ad",
    "sponsored",
    "sponsor",
    "shop",
    "link",
    "code",
    "promo",
    "discount",
    "affiliate",
)
# Words that are no handles, and what surrounds a handle in prose.
NON_HANDLES = ("link", "code")
HANDLE_WRAPPING = "()[]{}<>\"'“”‘’.,:;!?"
HANDLE_PATTERN = r"^[a-z0-9][a-z0-9_.-]*$"
# Word limits and list limits of the three normalisers.
TAG_WORDS, TAG_LIMIT = 4, 10
BRAND_WORDS, BRAND_LIMIT = 6, 12
HANDLE_LIMIT = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it any number of times in ``body``.

    Inside a lambda an outer expression is evaluated again for each element;
    a lambda variable is not, so linear work stays linear.
    """
    return F.transform(F.array(value), body)[0]


def strip(c: Column) -> Column:
    """Remove all surrounding whitespace; ``F.trim`` alone removes blanks only."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """NULL-safe trimmed text."""
    return strip(F.coalesce(c, F.lit("")))


def is_blank(c: Column) -> Column:
    return clean_text(c) == ""


def ordered_distinct(items: Column, key: Callable[[Column], Column], blank: str | None = None) -> Column:
    """Keep the first item of each key, in order: two sorts instead of n² look-ups.

    Exact repeats go first, by hash, so that only different spellings are sorted.  The items are
    texts: of structs ``array_distinct`` compares all pairs.  Items without a key, or with the
    ``blank`` one, are dropped where one is given.
    """
    keyed = F.transform(
        F.array_distinct(items), lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x"))
    )
    if blank is not None:
        keyed = F.filter(keyed, lambda e: e["k"] != blank)

    def firsts(run: Column) -> Column:
        kept = F.filter(run, lambda e, i: (i == 0) | (run[i - 1]["k"] != e["k"]))
        by_position = F.sort_array(
            F.transform(kept, lambda e: F.struct(e["i"].alias("i"), e["x"].alias("x")))
        )
        return F.transform(by_position, lambda e: e["x"])

    return let(F.sort_array(keyed), firsts)


# -- times, keys and locations ------------------------------------------------


def epoch_millis_to_iso(c: Column) -> Column:
    """Epoch milliseconds as ISO-8601 text with millisecond precision, in UTC."""
    return F.date_format(F.timestamp_millis(c.cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss.SSSxxx")


def object_key(video_id: Column, prefix: str) -> Column:
    parts = [F.lit(prefix)] if prefix else []
    return F.concat_ws("/", *parts, F.concat(video_id, F.lit(".json")))


def object_url(key: Column, bucket: str, region: str) -> Column:
    return F.concat(F.lit(f"https://{bucket}.s3.{region}.amazonaws.com/"), key)


def object_location(url: Column, video_id: Column, bucket: str, prefix: str) -> Column:
    """``struct(bucket, key)`` an object URL, a bare key or a blank text points to."""
    text = clean_text(url)
    is_s3 = text.startswith("s3://")
    is_http = text.startswith("http://") | text.startswith("https://")
    host = F.regexp_extract(text, r"^[a-z0-9]+://([^/?#]*)", 1)
    path = F.regexp_extract(text, r"^[a-z0-9]+://[^/?#]*([^?#]*)", 1)
    http_path = F.regexp_replace(path, r";[^/]*$", "")
    return F.struct(
        F.when(is_s3, host)
        .when(is_http, F.substring_index(host, ".", 1))
        .otherwise(F.lit(bucket))
        .alias("bucket"),
        F.when(is_s3, F.ltrim(path, F.lit("/")))
        .when(is_http, F.ltrim(http_path, F.lit("/")))
        .when(text != "", F.ltrim(text, F.lit("/")))
        .otherwise(object_key(video_id, prefix))
        .alias("key"),
    )


def pair_key(user_id: Column, post_id: Column) -> Column:
    return F.concat(user_id, F.lit("::"), post_id)


def split_pair_key(key: Column) -> Column:
    """``struct(user_id, post_id)`` split at the first separator; both blank without one."""
    at = F.instr(key, "::")
    return F.struct(
        F.when(at > 0, F.substring(key, F.lit(1), at - 1)).otherwise("").alias("user_id"),
        F.when(at > 0, F.substring(key, at + 2, F.length(key))).otherwise("").alias("post_id"),
    )


# -- captions -----------------------------------------------------------------


def is_meaningful(c: Column) -> Column:
    """Text worth a model call: has a letter and is neither ``nan`` nor a greeting."""
    text = clean_text(c)
    return (
        text.rlike(r"\p{L}")
        & ~F.lower(text).isin("nan", *GENERIC_WORDS)
    )


def caption_class(language_code: Column, content: Column, status: Column) -> Column:
    """1 ``en``, 2 automatic ``a.en``, 0 another language, 3 nothing usable."""
    code = clean_text(language_code)
    return (
        F.when(F.coalesce(status, F.lit(0)) != 200, 3)
        .when(is_blank(content), 3)
        .when(code == "en", 1)
        .when(code == "a.en", 2)
        .otherwise(0)
    )


def stored_caption_class(srt_id: Column) -> Column:
    """What the source table stores: 0 and NULL are both saved as 3."""
    return F.when(F.coalesce(srt_id, F.lit(0)) == 0, 3).otherwise(srt_id)


def split_camel_case(c: Column) -> Column:
    return F.regexp_replace(c, "(?<=[a-z])(?=[A-Z])", " ")


# -- tags, brands, handles ----------------------------------------------------


def ascii_words(c: Column) -> Column:
    """Only ASCII letters and digits, words separated by one blank."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), "[^A-Za-z0-9]+", " "))


def phrase(c: Column, max_words: int) -> Column:
    return F.substring_index(ascii_words(c), " ", max_words)


def _phrases(items: Column, words: int, dropped: Iterable[str], limit: int) -> Column:
    short = F.transform(F.array_distinct(items), lambda x: phrase(x, words))
    kept = F.filter(short, lambda x: (x != "") & ~F.lower(x).isin(*dropped))
    return F.slice(ordered_distinct(kept, F.lower), 1, limit)


def normalize_tags(items: Column) -> Column:
    return _phrases(items, TAG_WORDS, GENERIC_WORDS, TAG_LIMIT)


def normalize_brands(items: Column) -> Column:
    return _phrases(items, BRAND_WORDS, PROMOTION_WORDS, BRAND_LIMIT)


def normalize_handles(items: Column) -> Column:
    bare = F.transform(F.array_distinct(items), lambda x: F.btrim(clean_text(x), F.lit(HANDLE_WRAPPING)))
    kept = F.filter(bare, lambda x: x.rlike(HANDLE_PATTERN) & ~x.isin(*NON_HANDLES))
    return F.slice(F.array_distinct(kept), 1, HANDLE_LIMIT)


# -- list text ----------------------------------------------------------------


def python_list_text(items: Column) -> Column:
    """``['a', 'b']`` for items without quotes, as the normalisers return them."""
    joined = F.array_join(F.transform(items, lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", ")
    return F.concat(F.lit("["), joined, F.lit("]"))


def stored_list_text(c: Column) -> Column:
    """List text that is already bracketed is stored trimmed, other text as it is."""
    text = strip(c)
    return F.when(text.startswith("[") & text.endswith("]"), text).otherwise(c)


def json_list_text(items: Column, empty: str | None = "[]") -> Column:
    """JSON array text with ``", "`` between items; ``empty`` stands for an empty list."""
    quoted = F.transform(items, lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    text = F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    return text if empty == "[]" else let(text, lambda t: F.when(t != "[]", t).otherwise(empty))


@F.pandas_udf(ArrayType(StringType()))
def _literal_list(texts: pd.Series) -> pd.Series:
    import ast
    import json

    def read(text):
        if text is None:
            return None
        for parse in (json.loads, ast.literal_eval):
            try:
                value = parse(text)
            except Exception:
                continue
            if isinstance(value, list):
                return [str(x) for x in value]
        return []

    return texts.map(read)


def parse_list_text(df: DataFrame, stored: str, out: str) -> DataFrame:
    """Add ``out``: stored list text (JSON or Python literal) as an array of non-blank
    trimmed items.

    A list of nothing but double-quoted texts is read by ``from_json``; only other text reaches
    Python, which shows values its own way (True, nan).
    """
    text = F.col("_text")
    quoted = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
    flat = text.rlike(rf"^\[\s*+(?:{quoted}\s*+(?:,\s*+{quoted}\s*+)*+)?\]$")
    read = df.withColumn("_text", clean_text(F.col(stored))).withColumn(
        "_native", F.when(flat, F.from_json(text, "array<string>"))
    )
    other = _literal_list(F.when((text != "") & F.col("_native").isNull(), text))
    items = F.transform(
        F.coalesce("_native", other), lambda x: strip(F.coalesce(x, F.lit("None")))
    )
    kept = F.coalesce(F.filter(items, lambda x: x != ""), F.array().cast("array<string>"))
    return read.withColumn(out, kept).drop("_text", "_native")


def join_tags(items: Column) -> Column:
    """Trimmed tags without case-insensitive repeats as one text."""
    kept = F.filter(F.transform(items, clean_text), lambda x: x != "")
    return F.array_join(ordered_distinct(kept, F.lower), ", ")


def fill_prompt(template: str, text: Column) -> Column:
    return F.replace(F.lit(template), F.lit("{TRANSCRIPT}"), text)
