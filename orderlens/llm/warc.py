"""WARC archives written and read as text, and captures put together from their records.

A capture is written as three records: the request, the response (or, for a payload that another capture holds, a
revisit) and its metadata. Request and metadata name the second by `WARC-Concurrent-To`. All three are one string of
the text sink, with the blank lines that end a record as line separator, so archives are written by Spark's own
committed writer, to any file system, and hold payload bytes as they are. Each part file is an archive, gzipped as one
member by default.

Reading splits text at `WARC/1.`, so big plain files are read by many tasks. A payload may hold that string too: a
piece shorter than its `Content-Length` is put together with those after it. Files with such a piece are found by one
pass over the headers, and only they take that way; the sizes of a file's pieces, not their bytes, meet in one task.

`captures` joins the records through their concurrent-to ids and gives one nested row per capture. A request or
metadata record whose response is missing gives a capture of its own, of type null.

A null payload is empty and an empty table gives an archive without records. A null id has no `page_id` line, a null
url no target. Ids need not be distinct: every row is a capture with record ids of its own, and of rows with the same
largest id and payload one is the response. Line breaks within urls are percent-encoded. A record is one row, however
long. Only the three named columns are read, so others may have any name.
"""

from __future__ import annotations

import uuid
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .hot_keys import look_up
from .native import let
from .scratch import landed

#: Payloads below this size are stored with every capture.
LEAST_BYTES = 1000

END = "\r\n\r\n"
#: Versions 1.0 and 1.1 both begin so.
MARK = "WARC/1."
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def write(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = LEAST_BYTES, date: str | None = None, compression: str = "gzip",
) -> None:
    """One capture per row. Of equal payloads of `least_bytes` or more only that of the largest id is stored."""
    run = uuid.uuid4().hex
    rows = landed(
        pages.select(
            F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
            F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"), F.monotonically_increasing_id().alias("row"),
        ).withColumns({"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload")}),
        "captures",
    )
    large = rows.where(F.col("n_bytes") >= least_bytes)
    groups = large.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "row"))["row"].alias("holder"))
    rows = rows.withColumn("key", F.when(F.col("n_bytes") >= least_bytes, F.col("digest")))
    rows = look_up(rows, "key", "row", landed(groups.where("n > 1").withColumnRenamed("digest", "key"), "holders"), rows.count())
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows.select(_transaction(run, date)).write.option("lineSep", END).option("compression", compression).text(path)


def _record_id(run: str, row: Column, kind: str) -> Column:
    """A name in the form of a UUID, the same for the same row of a run."""
    named = F.md5(F.concat(F.lit(f"{run}:{kind}:"), row.cast("string")))
    return let(named, lambda x: F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]), F.lit(">")))


def _record(kind: str | Column, record_id: Column, date: str, fields: dict[str, Column], content_type: str, block: Column) -> Column:
    """A record without the blank lines after it; fields that are null are left out."""
    lines = [F.concat(F.lit("WARC/1.1\r\nWARC-Type: "), F.lit(kind) if isinstance(kind, str) else kind), F.concat(F.lit("WARC-Record-ID: "), record_id), F.lit(f"WARC-Date: {date}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields.items()]
    lines += [F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def _transaction(run: str, date: str) -> Column:
    """Request, response or revisit, and metadata of a row, one after the other."""
    own = _record_id(run, F.col("row"), "response")
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    parts = r"^[^:/?#]*://([^/?#]*)([^#]*)"
    where, host = F.regexp_extract(target, parts, 2), F.regexp_extract(target, parts, 1)
    again = F.col("holder").isNotNull() & (F.col("holder") != F.col("row"))
    request = F.concat(F.lit("GET "), F.coalesce(F.nullif(where, F.lit("")), F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), F.coalesce(host, F.lit("")), F.lit(END))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n_bytes").cast("string"), F.lit(END))
    response = F.concat(head, F.when(again, F.lit("")).otherwise(F.col("payload").cast("string")))
    about = F.coalesce(F.concat(F.lit("page_id: "), F.col("page_id").cast("string"), F.lit("\r\n")), F.lit(""))
    told = {
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": F.concat(F.lit("sha1:"), F.col("digest")),
        "WARC-Profile": F.when(again, F.lit(PROFILE)),
        "WARC-Refers-To": F.when(again, _record_id(run, F.col("holder"), "response")),
    }
    beside = {"WARC-Target-URI": target, "WARC-Concurrent-To": own}
    http = "application/http; msgtype="
    records = [
        _record("request", _record_id(run, F.col("row"), "request"), date, beside, http + "request", request),
        _record(F.when(again, "revisit").otherwise("response"), own, date, told, http + "response", response),
        _record("metadata", _record_id(run, F.col("row"), "metadata"), date, beside, "application/warc-fields", about),
    ]
    return F.concat(records[0], F.lit(END), records[1], F.lit(END), records[2]).alias("value")


def _field(name: str) -> Column:
    return F.nullif(F.regexp_extract("head", rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1), F.lit(""))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text from one mark to the next, where it stands, its header and the size of its block, as declared and as found."""
    text = spark.read.option("lineSep", MARK).text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("place")]
    return text.select(*place, "value").withColumn("head", F.substring_index("value", END, 1)).withColumns(
        {"declared": _field("Content-Length").cast("long"), "found": F.octet_length("value") - F.octet_length("head") - len(END)}
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """All records: type, ids they name, further header fields, and their block as bytes.

    `truncated` marks a block that ends before its declared size. Text without a header gives a record of null type.
    """
    pieces = _pieces(spark, path)
    # The text before a file's first mark is empty.
    whole = (F.col("found") >= F.col("declared")) | (F.col("value") == "")
    odd = landed(pieces.where(~F.coalesce(whole, F.lit(False))).select("file").distinct(), "odd_files")
    if not odd.isEmpty():
        sizes = pieces.join(odd, "file", "left_semi").select("file", "split", "place", F.octet_length("value").alias("size"), F.octet_length("head").alias("lead"), "declared")
        starts = sizes.groupBy("file").applyInArrow(_record_starts, "file string, place long, start long")
        parts = pieces.join(landed(starts, "record_starts"), ["file", "place"]).groupBy("file", "start").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("parts"))
        mended = parts.select(F.array_join(F.transform("parts", lambda p: p["value"]), MARK).alias("value"))
        pieces = pieces.join(odd, "file", "left_anti").select("value").unionByName(mended).withColumn("head", F.substring_index("value", END, 1))
    body = F.substring(F.col("value").cast("binary"), F.octet_length("head") + len(END) + 1, F.coalesce(F.col("declared"), F.lit(2**31 - 1)).cast("int"))
    found = pieces.where("value <> ''").withColumn("declared", _field("Content-Length").cast("long"))
    return found.select(
        _field("WARC-Type").alias("type"), _field("WARC-Record-ID").alias("record_id"),
        F.regexp_extract_all("head", F.lit(r"(?im)^WARC-Concurrent-To:[ \t]*(.*?)[ \t]*\r?$"), 1).alias("concurrent_to"),
        _field("WARC-Refers-To").alias("refers_to"), _field("WARC-Target-URI").alias("target_uri"), _field("WARC-Date").alias("date"),
        _field("WARC-Payload-Digest").alias("payload_digest"), _field("Content-Type").alias("content_type"),
        body.alias("block"), (F.octet_length(body) < F.col("declared")).alias("truncated"),
    )


def _record_starts(table: pa.Table) -> pa.Table:
    """For each piece of a file the place of the piece with which its record begins."""
    table = table.sort_by([("split", "ascending"), ("place", "ascending")])
    starts, start, open_bytes = [], None, 0
    rows = zip(*(table[c].to_pylist() for c in ("place", "size", "lead", "declared")), strict=True)
    for place, size, lead, declared in rows:
        if open_bytes > 0:
            open_bytes -= len(MARK) + size
        else:
            start, open_bytes = place, 0 if declared is None else lead + len(END) + declared - size
        starts.append(start)
    return pa.table({"file": table["file"], "place": table["place"], "start": pa.array(starts, pa.int64())})


def captures(found: DataFrame) -> DataFrame:
    """One row per capture: the response or revisit with its payload, its requests and its metadata records.

    The payload is what follows the HTTP header. `n_bytes` and `digest` are those that a revisit's headers give, else the
    payload's own; they are taken before the join, so without the payload the join moves ids and digests only.
    """
    main = F.col("type").isin("response", "revisit", "resource", "conversion")
    http = F.col("content_type").startswith("application/http")
    text = F.col("block").cast("string")
    lead = F.when(http, F.substring_index(text, END, 1))
    held = F.when(http, F.substring("block", F.octet_length("lead") + len(END) + 1, 2**31 - 1)).otherwise(F.col("block"))
    own = found.where(main).withColumn("lead", lead).select(
        "record_id", "type", "target_uri", "date", "payload_digest", "refers_to", "truncated", F.col("lead").alias("http_header"), held.alias("payload")
    )
    stored = F.regexp_extract("http_header", r"(?im)^Content-Length:[ \t]*(\d+)", 1).try_cast("long")
    again = F.col("type") == "revisit"
    own = own.withColumns({
        "n_bytes": F.when(again, stored).otherwise(F.octet_length("payload").cast("long")),
        "digest": F.when(again, F.regexp_extract("payload_digest", r"^sha1:(.*)$", 1)).otherwise(F.sha1("payload")),
    })
    beside = found.where(F.col("type").isin("request", "metadata")).select(F.explode_outer("concurrent_to").alias("of"), "type", F.struct("record_id", "block").alias("record"))
    beside = beside.groupBy("of").agg(*[F.collect_list(F.when(F.col("type") == kind, F.col("record"))).alias(name) for kind, name in (("request", "requests"), ("metadata", "metadata"))])
    none = F.array().cast(beside.schema["requests"].dataType)
    joined = own.join(beside, F.col("record_id") == F.col("of"), "full")
    return joined.withColumns({"record_id": F.coalesce("record_id", "of"), **{c: F.coalesce(c, none) for c in ("requests", "metadata")}}).drop("of")


def page_captures(found: DataFrame) -> DataFrame:
    """page_id, record_type, n_bytes and digest of the full payload and refers_to, the page that holds a revisit's payload.

    Size and digest of a revisit are those of the response that it names; where the archives lack it, what its own header says.
    """
    about = F.array_join(F.transform("metadata", lambda m: m["block"].cast("string")), "\n")
    rows = landed(
        captures(found).select(
            F.nullif(F.regexp_extract(about, r"(?m)^page_id: (.*?)\r?$", 1), F.lit("")).alias("page_id"), "record_id", F.col("type").alias("record_type"), "n_bytes",
            "digest", F.when(F.col("type") == "revisit", F.col("refers_to")).alias("names"),
        ),
        "page_captures",
    )
    named = rows.where("names is not null").groupBy("names").agg(F.count(F.lit(1)).alias("n"))
    holders = rows.select(F.col("record_id").alias("names"), F.col("page_id").alias("holder"), F.col("n_bytes").alias("full_bytes"), F.col("digest").alias("full_digest"))
    table = landed(holders.join(named, "names"), "held_payloads")
    out = look_up(rows, "names", "record_id", table, rows.count())
    return out.select("page_id", F.col("record_type"), F.coalesce("full_bytes", "n_bytes").alias("n_bytes"), F.coalesce("full_digest", "digest").alias("digest"), F.col("holder").alias("refers_to"))


#: The rows of the query, for page ids that are present and distinct.
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, strlen(payload) AS n, sha1(payload) AS d, max(page_id) OVER (PARTITION BY payload) AS last FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= {LEAST_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= {LEAST_BYTES} AND page_id <> last THEN last END AS refers_to
FROM q
"""
