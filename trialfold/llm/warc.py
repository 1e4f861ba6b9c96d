"""WARC archives: writing, and reading back by boundary chains (operator 9).

Writing: of pages with equal payloads (SHA-1 and length) the one with the
smallest id is a response record, the others are revisit records that name it.
Spark's text writer makes the files, a record ending with the empty line that
the format asks for.

Reading: Spark's text reader splits the files at the record magic, wherever it
stands, so tasks share a file and no task holds one.  Running sums of fragment
lengths, first inside an input split and then over the splits of a file, give
every fragment's offset.  Each fragment that parses as a header is a candidate
record with its successor's offset.  Pointer jumping from offset 0 (each round
doubles the jumps) keeps the records that the chain from the file's start
reaches; a magic inside a payload isn't reached, and its fragment goes back
into the record around it.  All payloads are then hashed again.

Defined results: a null page is empty; null ids are larger than all others; of
rows that repeat the smallest id all are responses; a file whose chain breaks
is read up to the break; no pages give no records.
"""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trialfold.llm.common import bounded, cut

MAGIC = "WARC/1.0\r\n"
#: What a revisit repeats: the payload, told by its digest.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8"
#: Bytes of a stretch of a file, to which the places of stray fragments are matched.
STRETCH = 1 << 20


@F.pandas_udf(T.StringType())
def base32(digests: pd.Series) -> pd.Series:
    """SHA-1 in hex as base32."""
    return digests.map(lambda h: base64.b32encode(bytes.fromhex(h)).decode(), na_action="ignore")


def verdicts(pages: DataFrame) -> DataFrame:
    """(sha, size, n, first) of payloads that more than one page has."""
    slim = pages.select("page_id", *_payload(F.col("html")))
    return (slim.groupBy("_sha", "_size").agg(F.count("*").alias("_n"), F.min("page_id").alias("_first")).where("_n > 1"))


def _payload(html: Column) -> tuple[Column, Column]:
    data = F.coalesce(html, F.lit("")).cast("binary")
    return F.sha1(data).alias("_sha"), F.octet_length(data).cast("long").alias("_size")


def _id(c: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))


def write(pages: DataFrame, path: str, least: int = 0, date: Column | None = None) -> None:
    """Write a record for each page; equal payloads below ``least`` bytes
    aren't looked for.  Texts are written by the task that read them.
    ``date``: when a page was fetched (a timestamp; the time of writing, if unknown)."""
    when = F.coalesce(date, F.current_timestamp()) if date is not None else F.current_timestamp()
    several = cut(verdicts(pages).where(F.col("_size") >= least).select(F.col("_sha").alias("_s"), F.col("_size").alias("_z"), "_first"))
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), *_payload(F.col("html")))
    rows = rows.join(bounded(several), (F.col("_sha") == F.col("_s")) & (F.col("_size") == F.col("_z")), "left")
    again = F.col("_s").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    block = F.concat(F.lit(HTTP + END), F.when(again, F.lit("")).otherwise(F.col("html")))
    address = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "")
    address = F.when(address == "", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))).otherwise(address)
    head = F.concat_ws(
        "\r\n", F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _id(F.col("page_id"))), F.concat(F.lit("WARC-Target-URI: "), address),
        F.concat(F.lit("WARC-Date: "), F.date_format(F.to_utc_timestamp(when, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.when(again, F.concat(F.lit("WARC-Refers-To: "), _id(F.col("_first")))),
        F.when(again, F.lit(f"WARC-Profile: {PROFILE}")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32("_sha")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    record = F.concat(F.lit(MAGIC), head, F.lit(END), block)
    rows.select(record.alias("value")).write.mode("overwrite").option("lineSep", END).text(path)


# ---------------------------------------------------------------- reading

def _scanned(spark: SparkSession, path: str) -> DataFrame:
    """What follows each magic in the files (value), in the order of reading (file, _split, _n).

    A file that starts with the magic yields an empty fragment first, which
    stands for no record; its place is offset ``-len(MAGIC)``."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
                    F.monotonically_increasing_id().alias("_n"), (F.octet_length("value") + len(MAGIC)).alias("_bytes")))


def _placed(rows: DataFrame) -> DataFrame:
    """Fragments with ``start``, the offset of their magic in the file."""
    by_split = rows.groupBy("file", "_split").agg(F.sum("_bytes").alias("_sum"))
    before = by_split.select("file", "_split", (F.sum("_sum").over(Window.partitionBy("file").orderBy("_split")) - F.col("_sum")).alias("_before"))
    inside = F.sum("_bytes").over(Window.partitionBy("file", "_split").orderBy("_n")) - F.col("_bytes")
    return (rows.withColumn("_inside", inside).join(before, ["file", "_split"])
            .withColumn("start", F.col("_before") + F.col("_inside") - len(MAGIC)).drop("_before", "_inside"))


def _field(head: Column, name: str) -> Column:
    return F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*)", 1)


def parsed(rows: DataFrame) -> DataFrame:
    """Candidate records: the way to the successor, and what a whole fragment gives."""
    head = F.substring_index("value", END, 1)
    length = F.when(_field(head, "Content-Length").rlike(r"^[0-9]{1,15}$"), _field(head, "Content-Length").cast("long"))
    begin = F.octet_length(head) + len(END)
    whole = F.octet_length("value") == begin + F.col("length") + len(END)
    block = F.substring(F.col("value").cast("binary"), (begin + 1).cast("int"), F.col("length").cast("int"))
    return (rows.withColumn("length", F.when(F.col("value").contains(END), length))
            .withColumn("_way", len(MAGIC) + begin + F.col("length") + len(END))
            .withColumn("_kind", F.lower(_field(head, "WARC-Type"))).withColumn("_id", _field(head, "WARC-Record-ID"))
            .withColumn("_to", _field(head, "WARC-Refers-To"))
            .withColumn("_digest", F.regexp_replace(_field(head, "WARC-Payload-Digest"), "^(?i)sha1:", ""))
            .withColumn("_whole", F.coalesce(whole, F.lit(False)))
            .withColumn("_block", F.when(F.col("_whole"), block)))


def chained(candidates: DataFrame) -> DataFrame:
    """The (file, start) that the chains of (file, _split, start, next) reach from 0.

    Inside a split, candidates whose successor is the next candidate form a
    run, named by its last member (runs of equal targets are not one: a stray
    may end where the record around it ends); the first jump of each goes to
    the end of its run at once, so that the chain is as long as a file has
    splits and strays.  Jumps from the file start find the places where the
    chain enters runs, and a run is reached from its first entry on."""
    inside = Window.partitionBy("file", "_split").orderBy("start")
    ends = F.when(~F.lead("start").over(inside).eqNullSafe(F.col("next")), F.struct("start", "next"))
    runs = cut(candidates.select("file", "_split", "start", ends.alias("_end"))
               .select("file", "_split", "start", F.first("_end", ignorenulls=True).over(
                   inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("_end"))
               .select("file", "_split", "start", F.col("_end.start").alias("_last"), F.col("_end.next").alias("next")))
    found, jump = cut(runs.where("start = 0").select("file", "start")), runs.select("file", "start", "next")
    n = found.count()
    while n:
        # those reached so far jump to as many new ones, then every jump is doubled
        more = (found.join(jump, ["file", "start"]).select("file", F.col("next").alias("start"))
                .join(runs.select("file", "start"), ["file", "start"], "left_semi"))
        found = cut(found.unionByName(more).distinct())
        if (now := found.count()) == n:
            break
        n = now
        far = jump.select("file", F.col("start").alias("next"), F.col("next").alias("_far"))
        jump = cut(jump.join(far, ["file", "next"]).select("file", "start", F.col("_far").alias("next")))
    entries = (runs.join(found, ["file", "start"]).groupBy("file", "_split", "_last").agg(F.min("start").alias("_entry")))
    return runs.join(entries, ["file", "_split", "_last"]).where("start >= _entry").select("file", "start")


def read(spark: SparkSession, path: str) -> DataFrame:
    """id, kind, refers_to, declared digest, size and SHA-1 (hex) of the
    payload of each record that a chain reaches."""
    scan = _scanned(spark, path)
    # each fragment's payload is hashed where it is read: no text is shuffled for the offsets
    data = _http_payload(F.col("_block"))
    slim = cut(_placed(parsed(scan).select(
        "file", "_split", "_n", "_bytes", "length", "_way", "_kind", "_id", "_to", "_digest", "_whole",
        F.octet_length(data).cast("long").alias("size"), F.sha1(data).alias("sha")))
        .where("start >= 0").withColumn("next", F.col("start") + F.col("_way")))
    candidates = slim.where("length is not null")
    found = chained(candidates)
    records = candidates.join(found, ["file", "start"])
    fields = ["_kind", "_id", "_to", "_digest", "size", "sha"]
    broken = cut(records.where("not _whole").select("file", "start", "next", "length", *fields[:4]))
    if not broken.isEmpty():
        return records.where("_whole").select(*fields).unionByName(_joined(scan, broken).select(*fields))
    return records.select(*fields)


def _http_payload(block: Column) -> Column:
    """What follows the empty line of an HTTP block (bytes)."""
    at = F.octet_length(F.substring_index(block.cast("string"), END, 1)) + len(END)
    return F.substring(block, (at + 1).cast("int"), F.octet_length(block))


def _joined(scan: DataFrame, broken: DataFrame) -> DataFrame:
    """Records whose block holds the magic, put together from their fragments
    (the texts of files without such records stay where they are).

    Fragments are matched to records by stretches of the file; a record's
    fragments meet in one task, as its payload must."""
    def stretch(c: str) -> Column:
        return F.floor(F.col(c) / STRETCH)

    spans = broken.withColumn("_at", F.explode(F.sequence(stretch("start"), F.floor((F.col("next") - 1) / STRETCH))))
    spans = spans.select("file", "_at", F.col("start").alias("_start"), "next", "length", "_kind", "_id", "_to", "_digest")
    files = bounded(cut(broken.select("file").distinct()))
    parts = _placed(scan.join(files, "file", "left_semi")).select("file", "start", "value").withColumn("_at", stretch("start"))
    inside = (F.col("start") >= F.col("_start")) & (F.col("start") < F.col("next"))
    met = parts.join(bounded(spans), ["file", "_at"]).where(inside)
    names = ["file", "_start", "length", "_kind", "_id", "_to", "_digest"]
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "value"))), lambda p: p["value"]), MAGIC)
    whole = met.groupBy(*names).agg(text.alias("value"))
    begin = F.octet_length(F.substring_index("value", END, 1)) + len(END)
    block = F.substring(F.col("value").cast("binary"), (begin + 1).cast("int"), F.col("length").cast("int"))
    data = _http_payload(F.col("_block"))
    return (whole.withColumn("_block", block).where(F.octet_length("_block") == F.col("length"))
            .withColumn("size", F.octet_length(data).cast("long")).withColumn("sha", F.sha1(data)))


def records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of
    each record read back.  A revisit's payload is that of the response that
    it names; a record whose declared digest isn't its payload's has no digest."""
    rows = cut(read(spark, path))

    def number(c: str) -> Column:
        return F.regexp_extract(c, r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")

    one = rows.where("_kind = 'response'").select(number("_id").alias("page_id"), "size", base32("sha").alias("_sum"), "_digest")
    checked = F.when(F.col("_sum") == F.col("_digest"), F.col("_digest"))
    responses = one.select("page_id", F.col("size").alias("payload_bytes"), checked.alias("payload_digest"),
                           F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    named = (rows.where("_kind = 'revisit'").select(number("_id").alias("page_id"), number("_to").alias("refers_to"), "_digest"))
    first = responses.select(F.col("page_id").alias("_p"), "payload_bytes", F.col("payload_digest").alias("_d")).distinct()
    revisits = (named.join(first, (F.col("refers_to") == F.col("_p")) & (F.col("_digest") == F.col("_d")), "left")
                .select("page_id", "payload_bytes", F.col("_d").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to"))
    return responses.unionByName(revisits)
