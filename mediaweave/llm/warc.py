"""WARC archives written and read by Spark: revisit records, and a verified chain of boundaries.

Records are uncompressed WARC 1.1, one after another.  Reading never trusts the magic line alone:
tasks cut the files at every magic, each piece proposes where its record would end, and only the
pieces that the chain from the start of the file reaches are records.  Chains are first followed
within a block of a file, then across blocks by pointer jumping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import scratch_path
from .common import stored

#: The format's marks and the base 32 alphabet.
MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
#: Repeated digests that may be broadcast: about 60 bytes each, 12 MB.
BROADCAST_DIGESTS = 200_000
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: every five hex digits are four base-32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*parts), _DIGITS, BASE32)


def _lines(*fields: tuple[str, Column]) -> Column:
    return F.concat(*[F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")) for name, value in fields])


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0, date: str = DATE) -> None:
    """Write a record for every row of ``pages`` (page_id, url, html) under ``path``.

    Of rows with equal payloads of ``least_bytes`` or more, the one with the smallest page_id is a
    response and the others revisit it; smaller payloads are all responses, and so are rows of a
    payload without any page_id.  Rows that repeat the smallest page_id are responses each.  A
    null html is an empty payload; line breaks in a url become blanks, a null url "unknown:".
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce(F.col("url"), F.lit("unknown:")), r"[\r\n]+", " ").alias("url"),
        html.alias("html"),
        F.octet_length(html).alias("bytes"),
        base32_sha1(html).alias("digest"),
    )
    same = rows.where(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
    same = same.agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    same = stored(same, "repeated")
    # Payloads stay where they were read if the repeated digests are few; else they are shuffled.
    few = same.count() <= BROADCAST_DIGESTS
    rows = rows.join(F.broadcast(same) if few else same, ["digest", "bytes"], "left")
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(BLANK),
    )
    payload = F.when(revisits, F.lit("")).otherwise(F.col("html"))
    size = F.octet_length(http) + F.octet_length(payload)
    common = (
        ("WARC-Record-ID", urn("page_id")), ("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date)),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", size.cast("string")),
    )
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    revisit = _lines(("WARC-Type", F.lit("revisit")), ("WARC-Profile", profile), ("WARC-Refers-To", urn("first")), *common)
    head = F.when(revisits, revisit).otherwise(_lines(("WARC-Type", F.lit("response")), *common))
    record = F.concat(F.lit(MAGIC), head, F.lit("\r\n"), http, payload)
    rows.select(record.alias("value")).write.option("lineSep", BLANK).text(path)


# -- reading ------------------------------------------------------------------


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics: file, block (a split's first byte), place in the reading order, value."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}: *([^\r\n]*)", 1)


def _long(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9]{1,18} *$"), F.trim(text).cast("long"))


def _parsed(pieces: DataFrame, value: str = "value") -> DataFrame:
    """The pieces with what they would be as records; ``value`` starts behind the magic."""
    raw = F.col(value)
    out = pieces.withColumn("head", F.substring_index(raw, BLANK, 1)).withColumn("size", F.octet_length(raw))
    out = out.withColumn("body_at", F.octet_length("head") + len(BLANK))
    out = out.withColumn("content", F.when(F.col("body_at") <= F.col("size"), _long(_field(F.col("head"), "Content-Length"))))
    out = out.withColumn("candidate", F.col("content").isNotNull() & (_field(F.col("head"), "WARC-Record-ID") != ""))
    out = out.withColumn("length", len(MAGIC) + F.col("body_at") + F.col("content") + len(BLANK))
    out = out.withColumn("whole", F.col("candidate") & (F.col("size") - F.col("body_at") == F.col("content") + len(BLANK)))
    block = F.substring(raw.cast("binary"), F.col("body_at") + 1, F.col("content").cast("int"))
    out = out.withColumn("block_bytes", F.when(F.col("whole"), block))
    out = out.withColumn("http", F.substring_index(F.col("block_bytes").cast("string"), BLANK, 1))
    payload = F.substring("block_bytes", F.octet_length("http") + len(BLANK) + 1, F.length("block_bytes"))
    page = lambda name: _long(F.regexp_extract(_field(F.col("head"), name), r"urn:page:([0-9]+)", 1))
    signed = lambda name: F.when(_field(F.col("head"), name).contains("urn:page:-"), -F.coalesce(_long(F.regexp_extract(_field(F.col("head"), name), r"urn:page:-([0-9]+)", 1)), F.lit(0))).otherwise(page(name))
    kind = _field(F.col("head"), "WARC-Type")
    revisit = kind == "revisit"
    return (
        out.withColumn("record_type", kind)
        .withColumn("page_id", signed("WARC-Record-ID"))
        .withColumn("refers_to", F.when(revisit, signed("WARC-Refers-To")))
        .withColumn("payload_bytes", F.when(revisit, _long(_field(F.col("http"), "Content-Length"))).otherwise(F.length(payload).cast("long")))
        .withColumn(
            "payload_digest",
            F.when(revisit, F.regexp_replace(_field(F.col("head"), "WARC-Payload-Digest"), "^sha1:", "")).otherwise(base32_sha1(payload)),
        )
    )


_RECORD = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _exits(rows):
    """For each candidate of a block, where the chain from it leaves the block."""
    rows = rows.sort_values("offset")
    ends = dict(zip(rows["offset"], rows["offset"] + rows["length"]))
    for offset in reversed(list(ends)):
        ends[offset] = ends.get(ends[offset], ends[offset])
    return rows[["file", "block", "offset"]].assign(leaves=[ends[o] for o in rows["offset"]])


def _followed(rows):
    """The candidates of a block that the chain from its reached entries meets."""
    rows = rows.sort_values("offset")
    reached = set(rows["offset"][rows["entered"]])
    for offset, length in zip(rows["offset"], rows["length"]):
        if offset in reached:
            reached.add(offset + length)
    return rows[rows["offset"].isin(reached)][["file", "offset"]]


def _reached_entries(exits: DataFrame) -> DataFrame:
    """(file, offset) of the entries into blocks that the chain from offset 0 passes.

    Every step doubles the distance that each pointer covers, so the number of rounds grows with
    the logarithm of a file's blocks.
    """
    targets = exits.select("file", F.col("leaves").alias("offset")).distinct()
    starts = exits.where("offset = 0").select("file", "offset")
    nodes = targets.unionByName(starts).distinct()
    jumps = stored(exits.join(nodes, ["file", "offset"], "left_semi").select("file", "offset", "leaves"), "jumps")
    reached = stored(starts, "reached")
    known = reached.count()
    while True:
        further = reached.join(jumps, ["file", "offset"]).select("file", F.col("leaves").alias("offset"))
        further = further.join(jumps.select("file", "offset"), ["file", "offset"], "left_semi")
        reached = stored(reached.unionByName(further).distinct(), "reached")
        now = reached.count()
        if now == known:
            return reached
        known = now
        onward = jumps.select("file", F.col("offset").alias("leaves"), F.col("leaves").alias("beyond"))
        jumps = stored(
            jumps.join(onward, ["file", "leaves"], "left").select("file", "offset", F.coalesce("beyond", "leaves").alias("leaves")), "jumps"
        )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record under ``path``: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Size and digest of a response are those of the payload as read; a revisit's are those of the
    payload it stands for, by its headers.  A magic line inside a payload starts no record.  What
    follows a broken record in its file is not reached.  An archive without files has no rows.
    """
    found = _parsed(_pieces(spark, path))
    own = ("file", "block", "place", "size", "candidate", "length", "whole", *_RECORD)
    found = stored(found.select(*own), "pieces")
    in_block = Window.partitionBy("file", "block").orderBy("place")
    step = F.col("size") + len(MAGIC)
    blocks = found.groupBy("file", "block").agg(F.sum(step).alias("bytes"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"))
    before = F.coalesce(F.sum(step).over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = found.withColumn("before", before).withColumn("nth", F.row_number().over(in_block))
    placed = placed.join(blocks, ["file", "block"])
    placed = stored(placed.withColumn("offset", F.col("base") + F.col("before") - len(MAGIC)).drop("base", "before"), "placed")

    candidates = placed.where("candidate").select("file", "block", "offset", "length")
    exits = stored(
        candidates.groupBy("file", "block").applyInPandas(_exits, "file string, block long, offset long, leaves long"), "exits"
    )
    entered = _reached_entries(exits).withColumn("entered", F.lit(True))
    marked = candidates.join(entered, ["file", "offset"], "left").withColumn("entered", F.coalesce("entered", F.lit(False)))
    records = stored(marked.groupBy("file", "block").applyInPandas(_followed, "file string, offset long"), "records")

    whole = placed.where("whole").join(records, ["file", "offset"], "left_semi").select(*_RECORD)
    cut = placed.where("candidate and not whole").join(records, ["file", "offset"], "left_semi")
    if not cut.take(1):
        return whole
    return whole.unionByName(_stitched(spark, path, placed, records, cut))


def _stitched(spark: SparkSession, path: str, placed: DataFrame, records: DataFrame, cut: DataFrame) -> DataFrame:
    """Records whose payload holds magics: their pieces are read again and put together."""
    heads = cut.select("file", "block", "nth", "offset", F.col("offset").alias("owner"))
    inside = placed.where("offset >= 0").join(records, ["file", "offset"], "left_anti").select(
        "file", "block", "nth", "offset", F.lit(None).cast("long").alias("owner")
    )
    back = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    parts = heads.unionByName(inside).withColumn("owner", F.last("owner", ignorenulls=True).over(back)).where("owner is not null")
    again = _pieces(spark, path)
    firsts = again.groupBy("file", "block").agg(F.min("place").alias("first"))
    again = again.join(firsts, ["file", "block"]).withColumn("nth", (F.col("place") - F.col("first") + 1).cast("int"))
    parts = again.join(parts, ["file", "block", "nth"])
    whole = parts.groupBy("file", "owner").agg(F.sort_array(F.collect_list(F.struct("offset", F.col("value").cast("binary").alias("raw")))).alias("parts"))
    joined = F.aggregate(
        F.slice("parts", 2, F.size("parts")), F.element_at("parts", 1)["raw"],
        lambda acc, p: F.concat(acc, F.lit(MAGIC).cast("binary"), p["raw"]),
    )
    return _parsed(whole.select(joined.cast("string").alias("value"))).where("whole").select(*_RECORD)


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Archive the pages in the shared folder and read the archives back."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, least_bytes)
    return read_archive(pages.sparkSession, path)
