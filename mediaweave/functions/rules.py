"""Rules on texts that need no model: topics, cues, audits, sponsorship phrases, handles."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let

# Strong sponsorship phrases of a transcript.
SPONSOR_PHRASES = (
    "sponsored by", "thanks to", "in partnership with", "partnered with", "paid partnership", "ad", "advertisement",
    "this video is sponsored", "sponsor of today's video", "brought to you by", "collaborated with",
    "collaboration with", "ambassador", "affiliate", "gifted by", "PR package", "sent by", "provided by", "hosted by",
    "invited by", "complimentary stay", "complimentary meal", "media invite", "press invite", "use my code",
    "discount code", "promo code", "referral code", "affiliate link", "link in description", "special offer",
    "limited offer", "exclusive deal", "get discount", "sign up using", "check out Brand", "buy from Brand",
    "shop Brand", "download Brand app", "book with Brand", "visit Brand website", "order from Brand",
    "use Brand service", "today's sponsor", "this portion is sponsored", "our sponsor",
)

# Promotional intent of a caption, by kind.
CALLS = (
    "shop", "order", "buy", "purchase", "pre order", "available now", "drop", "launch", "link in bio", "check out", "tap",
    "click", "swipe", "DM to order", "dm me", "inbox", "whatsapp", "book now", "booking", "appointment", "reserve",
)
OFFERS = (
    "$", "%", "off", "discount", "promo", "voucher", "deal", "sale", "limited time", "special offer", "free delivery",
    "code", "use code", "referral",
)
PUSHES = (
    "try this", "must have", "highly recommend", "new product", "new menu", "new treatment", "package", "set", "combo",
    "best seller",
)
PLACES = ("available at", "now at", "in store", "online", "website", "hotline")
THANKS = ("感謝", "多謝", "thanks", "thank you", "shoutout")
PARTNERS = (
    "ad", "sponsored", "paid partnership", "collab", "collaboration", "partnered with", "ambassador", "affiliate", "gifted",
    "PR", "sent me",
)
SECONDARY = (
    "ad", "sponsored", "paid partnership", "collab", "ambassador", "affiliate", "gifted", "PR", "code", "discount", "voucher",
    "referral", "link in bio", "shop", "order", "book now", "DM to order", "whatsapp",
)

# What a handle or the text around it says about its owner.
BRAND_PARTS = (
    "hk", "hkg", "official", "shop", "store", "mall", "hotel", "restaurant", "cafe", "bar", "dining", "studio", "salon",
    "clinic", "spa", "beauty", "skincare", "makeup", "cosmetics", "fashion", "jewelry", "watch", "travel", "tours", "airline",
    "bank", "insurance", "comms", "pr", "agency", "media",
)
BRAND_CONTEXT = (
    "shop", "link in bio", "code", "discount", "book", "reservation", "available at", "now at", "menu", "treatment", "package",
    "launch", "drop",
)
CREATOR_PARTS = (
    "mua", "makeupartist", "artist", "photographer", "photo", "videographer", "editor", "stylist", "hair", "nails", "coach",
    "trainer", "dancer", "actor", "singer", "model", "dj", "yoga",
)

# Tags that say nothing.
FILLER_TAGS = (
    "Video", "YouTube", "Content", "Trending", "General Topic", "Creator Content", "Social Media", "Lifestyle",
    "Trending Topic", "Pop Culture", "Daily Life", "Video Content", "Entertainment",
)

TOPICS_TYPE = "array<struct<topic:string,subtopics:array<struct<subtopic:string,timestamp:string,detail:string>>>>"


# -- phrases ------------------------------------------------------------------


def _pattern(phrases: tuple[str, ...]) -> str:
    """One pattern for any of the phrases as whole words, without case; ``Brand`` is any word.

    The test for the start of a word stands before the alternatives, so a text is walked once and
    the phrases are tried at the starts of words only.
    """

    def ascii_word(c: str) -> bool:
        return c.isalnum() and ord(c) < 128

    def body(phrase: str) -> str:
        escaped = "".join(f"\\{c}" if not c.isalnum() and ord(c) < 128 and c != " " else c for c in phrase)
        end = r"(?![\p{L}\p{N}])" if ascii_word(phrase[-1]) else ""
        return escaped.replace("Brand", r"[^\s]+").replace(" ", r"\s+") + end

    words = "|".join(body(p) for p in phrases if ascii_word(p[0]))
    marks = [body(p) for p in phrases if not ascii_word(p[0])]
    return "(?i)(?:" + "|".join(([rf"(?<![\p{{L}}\p{{N}}])(?:{words})"] if words else []) + marks) + ")"


def has_phrase(text: Column, *phrases: str) -> Column:
    """Whether any of the phrases stands in the text as whole words, without case; ``Brand`` is any word."""
    if not phrases:
        return F.lit(False)
    return F.coalesce(text.rlike(_pattern(tuple(dict.fromkeys(phrases)))), F.lit(False))


def _may_start_together(a: str, b: str) -> bool:
    """Whether both phrases could be found at one place: one begins as the other, up to the first ``Brand``."""
    a, b = (p.split("Brand")[0].lower() for p in (a, b))
    return a.startswith(b) or b.startswith(a)


def _layers(phrases: tuple[str, ...]) -> list[tuple[str, ...]]:
    """The phrases in few groups; of a group at most one is found at any place of a text."""
    groups: list[list[str]] = []
    for phrase in phrases:
        free = (g for g in groups if not any(_may_start_together(phrase, p) for p in g))
        group = next(free, None)
        if group is None:
            groups.append(group := [])
        group.append(phrase)
    return [tuple(g) for g in groups]


def phrases_in(text: Column, phrases: tuple[str, ...] = SPONSOR_PHRASES) -> Column:
    """The phrases found, in the order of the list; they may overlap in the text.  NULL has none.

    A layer of phrases is one pass that looks ahead from every place; the parts found are short and
    are then told apart by their words.
    """
    parts = F.concat(*[F.regexp_extract_all(text, F.lit(f"(?=({_pattern(layer)}))"), F.lit(1)) for layer in _layers(phrases)])
    spaced = F.array_distinct(F.transform(parts, lambda x: F.lower(F.regexp_replace(x, r"\s+", " "))))

    def among(found: Column, phrase: str) -> Column:
        if "Brand" not in phrase:
            return F.array_contains(found, " ".join(phrase.lower().split()))
        shape = r"[^\s]+".join(re.escape(p.lower()) for p in phrase.split("Brand"))
        return F.exists(found, lambda x: x.rlike(f"^{shape}$"))

    hits = let(spaced, lambda found: F.array(*[F.when(among(found, p), F.lit(p)) for p in phrases]))
    kept = F.when(has_phrase(text, *phrases), F.filter(hits, lambda x: x.isNotNull()))
    return F.coalesce(kept, F.array().cast("array<string>"))


def _any(text: Column, *groups: tuple[str, ...]) -> Column:
    return has_phrase(text, *[p for g in groups for p in g])


def caption_sponsorship(text: Column, handles: Column, names: Column) -> Column:
    """1 for a brand handle with any promotional word, or a brand name with an explicit one."""
    primary = (F.size(handles) > 0) & _any(text, CALLS, OFFERS, PUSHES, PLACES, THANKS, PARTNERS)
    secondary = (F.size(names) > 0) & _any(text, SECONDARY)
    return F.coalesce((primary | secondary).cast("int"), F.lit(0))


# -- handles ------------------------------------------------------------------


TOKEN = r"""[^\s,;:!?()\[\]{}<>"'|]+"""
HANDLE = r"^[a-z0-9]+(?:[_.]+[a-z0-9]+)+$"
THANKED = r"(?:同|感謝)\s*([a-z][a-z0-9_.]{2,})"


def handle_candidates(text: Column) -> Column:
    """Lower-case tokens with ``_`` or ``.`` inside, and those behind 同 or 感謝; first of each."""
    bare = lambda xs: F.transform(xs, lambda x: F.regexp_replace(x, r"^\.+|\.+$", ""))
    joined = F.filter(bare(F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))), lambda x: x.rlike(HANDLE))
    thanked = bare(F.regexp_extract_all(text, F.lit(THANKED), F.lit(1)))
    lettered = F.filter(F.concat(joined, thanked), lambda h: h.rlike("[a-z]"))
    return F.coalesce(F.array_distinct(lettered), F.array().cast("array<string>"))


def handle_class(handle: Column, text: Column) -> Column:
    """``brand`` by its own parts, ``mention`` by a creator's, else by the text; ``mention`` if unsure."""
    parts = F.split(handle, r"[_.0-9]+")
    of = lambda words: F.arrays_overlap(parts, F.array(*[F.lit(w) for w in words]))
    return F.when(of(BRAND_PARTS), "brand").when(of(CREATOR_PARTS), "mention").when(_any(text, BRAND_CONTEXT), "brand").otherwise("mention")


# -- topics and cues ----------------------------------------------------------


SUBTOPIC = "struct<subtopic:string,timestamp:string,detail:string>"


def _items(value: Column) -> Column:
    """The items of a VARIANT as an array: a list's own, any other value as the one item, none of NULL and ''."""
    several = F.try_variant_get(value, "$", "array<variant>")
    none = value.isNull() | F.is_variant_null(value) | F.coalesce(F.try_variant_get(value, "$", "string") == "", F.lit(False))
    return F.filter(
        F.coalesce(several, F.when(none, F.array().cast("array<variant>")).otherwise(F.array(value))),
        lambda x: x.isNotNull() & ~F.is_variant_null(x),
    )


def _part(item: Column, name: str) -> Column:
    """A named part of an object item as text; of a plain item nothing."""
    return F.try_variant_get(item, f"$.{name}", "string")


def _is_object(item: Column) -> Column:
    return F.schema_of_variant(item).startswith("OBJECT")


def typed_topics(text: Column) -> Column:
    """Key topics stored as JSON text, as typed values, item by item.

    An item that is no object is a topic (or subtopic) of that name; a missing list, or one of
    another type, is read as ``normalize_list`` reads it: none, or the one value.  An item of an
    unexpected shape never costs its neighbours.  Text that is no JSON has no topics.
    """

    def subtopic(item: Column) -> Column:
        plain = F.try_variant_get(item, "$", "string")
        return F.struct(
            F.when(_is_object(item), _part(item, "subtopic")).otherwise(plain).alias("subtopic"),
            F.when(_is_object(item), _part(item, "timestamp")).alias("timestamp"),
            F.when(_is_object(item), _part(item, "detail")).alias("detail"),
        )

    def topic(item: Column) -> Column:
        parts = F.transform(_items(F.try_variant_get(item, "$.subtopics", "variant")), subtopic)
        return F.struct(
            F.when(_is_object(item), _part(item, "topic")).otherwise(F.try_variant_get(item, "$", "string")).alias("topic"),
            F.when(_is_object(item), parts).otherwise(F.array().cast(f"array<{SUBTOPIC}>")).alias("subtopics"),
        )

    found = F.transform(_items(F.try_parse_json(text)), topic)
    return F.coalesce(found, F.array().cast(TOPICS_TYPE))


def flat_topics(summaries: DataFrame, topics: str = "key_topics") -> DataFrame:
    """A row per subtopic: video_id, topic, subtopic, timestamp, detail; a topic without any has one."""
    topic = summaries.select("video_id", F.explode(typed_topics(F.col(topics))).alias("t"))
    part = topic.select("video_id", F.col("t.topic").alias("topic"), F.explode_outer("t.subtopics").alias("s"))
    return part.select("video_id", "topic", "s.subtopic", clock(F.col("s.timestamp")).alias("timestamp"), "s.detail")


def clock(text: Column) -> Column:
    """``HH:MM:SS`` of a time with or without hours and milliseconds; anything else is NULL."""
    pattern = r"^\s*(?:(\d{1,2}):)?(\d{1,2}):(\d{2})(?:[,.]\d+)?\s*$"
    part = lambda n: F.lpad(F.regexp_extract(text, pattern, n), 2, "0")
    return F.when(text.rlike(pattern), F.concat_ws(":", part(1), part(2), part(3)))


def srt_cues(text: Column) -> Column:
    """The cues of a subtitle text: number, start and end as ``HH:MM:SS``, and the words."""
    head = r"(?m)^(\d+)[ \t]*\r?\n([\d:]+[,.]\d+)[ \t]*-->[ \t]*([\d:]+[,.]\d+)[^\n]*\n"
    find = lambda n: F.regexp_extract_all(text, F.lit(head), F.lit(n))
    bodies = F.slice(F.split(text, head), 2, F.size(find(0)) + 1)
    cues = F.arrays_zip(find(1).alias("n"), find(2).alias("a"), find(3).alias("b"), bodies.alias("body"))
    return F.transform(
        cues,
        lambda c: F.struct(
            c["n"].cast("int").alias("number"), clock(c["a"]).alias("start"), clock(c["b"]).alias("end"),
            F.trim(F.regexp_replace(c["body"], r"\s+", " ")).alias("words"),
        ),
    )


# -- audit --------------------------------------------------------------------


def tag_audit(tags: Column, least: int = 10, most: int | None = 10) -> dict[str, Column]:
    """What of a tag list keeps the rules: its number, and how many tags break each rule.

    Captions have exactly ten tags; transcripts twenty and up (``least=20, most=None``).
    """

    def broken(test) -> Column:
        return F.size(F.filter(tags, lambda x: ~test(x)))

    words = lambda x: F.size(F.split(F.trim(x), r"\s+"))
    return {
        "n_tags": F.size(tags),
        "right_number": (F.size(tags) >= least) & (F.lit(True) if most is None else F.size(tags) <= most),
        "bad_words": broken(lambda x: words(x).between(1, 4)),
        "bad_case": broken(lambda x: x.rlike(r"^(?:[A-Z0-9]\S*)(?: [A-Z0-9]\S*)*$")),
        "bad_charset": broken(lambda x: x.rlike("^[A-Za-z0-9 ]+$")),
        "fillers": broken(lambda x: ~F.lower(x).isin(*[f.lower() for f in FILLER_TAGS])),
        "repeats": F.size(tags) - F.size(F.array_distinct(F.transform(tags, F.lower))),
    }


# Shortened words whose full stop ends no sentence.
SHORTENED = "Mr|Mrs|Ms|Dr|Prof|St|Sr|Jr|vs|No|Vol|e\\.g|i\\.e|a\\.m|p\\.m"
#: What ends a sentence: a mark, perhaps a closing quote or bracket, space, and a capital, a digit or a letter without case.
SENTENCE_END = r"""([.!?]["')\]]?)\s+(["'(\[]?[\p{Lu}\p{Lo}\p{N}])"""


def sentences(text: Column) -> Column:
    """The sentences of a text; full stops of numbers and of shortened words do not end one."""
    plain = F.regexp_replace(text, rf"\b({SHORTENED})\.(\s)", "$1$2")
    parts = F.split(F.regexp_replace(F.regexp_replace(plain, SENTENCE_END, "$1\u0001$2"), "([。！？])", "$1\u0001"), "\u0001")
    return F.filter(parts, lambda x: x.rlike(r"[\p{L}\p{N}]"))


def topics_audit(topics: Column, summary: Column) -> dict[str, Column]:
    """What of typed topics and a summary keeps the rules."""
    parts = F.flatten(F.transform(topics, lambda t: F.coalesce(t["subtopics"], F.array().cast("array<struct<subtopic:string,timestamp:string,detail:string>>"))))
    names = F.transform(parts, lambda s: F.lower(F.trim(s["subtopic"])))
    return {
        "topics_in_range": F.size(topics).between(1, 10),
        "subtopics_in_range": F.forall(topics, lambda t: F.coalesce(F.size(t["subtopics"]), F.lit(0)) <= 10),
        "subtopics_unique": F.size(names) == F.size(F.array_distinct(names)),
        "bad_times": F.size(F.filter(parts, lambda s: s["timestamp"].isNotNull() & ~s["timestamp"].rlike(r"^\d{2}:\d{2}:\d{2}$"))),
        "summary_in_range": let(F.size(sentences(summary)), lambda n: n.between(2, 5)),
    }
