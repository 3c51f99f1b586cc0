"""WARC archives: writing page captures, reading them back, assembling transactions.

A capture is a response (or a revisit of an equal payload), its request and
a metadata record, the latter two concurrent to the first. Archives are
written by Spark's text writer: a record is one value and the line separator
is the blank lines that end a record, so the files are plain WARC. Reading
streams each file into records by their lengths, checks the digests of
payloads, joins records by their concurrent-to identifiers into one nested
row a capture, and follows a revisit's refers-to to the response it names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paceline.llm.spread import checkpoint_dir, discard, stored

CRLF = "\r\n"
#: Records and bytes in one archive file, which a task reads compressed and streams; a longer capture has a file of its own.
RECORDS_PER_FILE, FILE_BYTES = 3000, 256_000_000
#: Records and payload bytes that a reading task holds at once.
BATCH_RECORDS, BATCH_BYTES = 512, 32_000_000
#: Payloads with revisits, and repeated captures, up to which they are broadcast (some 200 bytes each).
MAX_BROADCAST_ROWS = 100_000
#: Payloads of at least this many bytes are deduplicated.
MIN_REVISIT_BYTES = 0
DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_of_hex(sha1: Column) -> Column:
    """Base-32 text of a SHA-1 in hex: five hex digits are four characters."""
    quarter = lambda k, j: F.substring(F.lit(BASE32), F.shiftright(F.conv(F.substring(sha1, 5 * k + 1, 5), 16, 10).cast("int"), 15 - 5 * j).bitwiseAND(31) + 1, F.lit(1))
    return F.concat(*(quarter(k, j) for k in range(8) for j in range(4)))


def _record_id(kind: str, page: Column, url: Column, sha: Column, repeat: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.lit(kind), F.coalesce(page.cast("string"), F.lit("?")), F.coalesce(url, F.lit("?")), sha, repeat.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _record(kind: str, record: Column, fields: list[tuple[str, Column]], block: Column) -> Column:
    """Text of a record without the blank lines that end it; null fields are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: "), record), F.lit(f"WARC-Date: {DATE}")]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), block)


def _joined(rows: DataFrame, few: DataFrame, on: Column, how: str) -> DataFrame:
    """A join that broadcasts ``few`` if it is small enough."""
    return rows.join(F.broadcast(few) if few.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS else few, on, how)


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> None:
    """Write each row as a capture; of equal payloads that are long enough the smallest page is the response, the rest revisit it."""
    one_line = lambda c: F.regexp_replace(c, r"[\x00-\x20]", "%20")
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    captures = pages.select(F.col(id_col).cast("long").alias("page"), one_line(F.col(url_col).cast("string")).alias("url"), html.alias("html"), F.sha1(html).alias("sha"), F.octet_length(html).alias("bytes"))
    keys = stored(captures.groupBy("page", "url", "sha", "bytes").agg(F.count(F.lit(1)).alias("rows")), "warc-keys")
    firsts = keys.where(F.col("bytes") >= min_revisit_bytes).groupBy("sha").agg(F.sum("rows").alias("n"), F.min("page").alias("least"), F.min_by("url", F.struct(F.coalesce("page", F.lit(2**63 - 1)), F.coalesce("url", F.lit("")))).alias("first_url"))
    firsts = firsts.where("n > 1 and least is not null").select(F.col("sha").alias("of"), "least", "first_url")
    row = captures.withColumn("repeat", F.lit(0))
    again = keys.where("rows > 1").select(F.col("page").alias("p"), F.col("url").alias("u"), F.col("sha").alias("s"), "rows")
    if not again.isEmpty():  # equal rows are counted, kept once and exploded, so that each has identifiers of its own
        same = F.col("page").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")) & (F.col("sha") == F.col("s"))
        once = _joined(captures, again, same, "inner").groupBy("page", "url", "sha", "bytes", "rows").agg(F.first("html").alias("html"))
        repeats = once.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.col("rows").cast("int") - 1)))
        row = _joined(row, again, same, "left_anti").unionByName(repeats.select(*row.columns))
    row = _joined(row, firsts, F.col("sha") == F.col("of"), "left")
    row = row.withColumn("least", F.when(~F.col("page").eqNullSafe(F.col("least")), F.col("least")))
    page, url, sha, repeat = F.col("page"), F.col("url"), F.col("sha"), F.col("repeat")
    again = F.col("least").isNotNull()
    main, first = _record_id("response", page, url, sha, repeat), _record_id("response", F.col("least"), F.col("first_url"), sha, F.lit(0))
    digest = F.concat(F.lit("sha1:"), base32_of_hex(sha))
    target = [("WARC-Target-URI", url)]
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    http = ("Content-Type", F.lit("application/http; msgtype=response"))
    response = _record("response", main, [*target, http, ("WARC-Payload-Digest", digest)], F.concat(head, "html"))
    revisit = _record("revisit", main, [*target, http, ("WARC-Payload-Digest", digest), ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), ("WARC-Refers-To", first), ("WARC-Refers-To-Target-URI", F.col("first_url"))], head)
    request = _record("request", _record_id("request", page, url, sha, repeat), [*target, ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/http; msgtype=request"))], F.concat(F.lit("GET "), F.coalesce(url, F.lit("/")), F.lit(f" HTTP/1.1{CRLF * 2}")))
    about = F.coalesce(F.concat(F.lit("pageId: "), page.cast("string")), F.lit("pageId:"))
    metadata = _record("metadata", _record_id("metadata", page, url, sha, repeat), [*target, ("WARC-Concurrent-To", main), ("Content-Type", F.lit("application/warc-fields"))], F.concat(about, F.lit(CRLF)))
    records = row.select(F.explode(F.array(request, F.when(again, revisit).otherwise(response), metadata)).alias("value"))
    longest = keys.agg(F.max("bytes")).first()[0] or 0
    per_file = 3 * max(1, min(RECORDS_PER_FILE // 3, FILE_BYTES // (longest + 2000)))
    records.write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)
    discard(keys)


_RECORDS = "warc_type string, record_id string, concurrent_to string, refers_to string, target_uri string, date string, payload_digest string, payload_bytes long, payload string, page_id long"
_BATCH = pa.schema([(n, pa.int64() if kind == "long" else pa.string()) for n, kind in (x.split() for x in _RECORDS.split(", "))])


def parse(archive: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive, one at a time."""
    while line := archive.readline():
        if not line.startswith(b"WARC/"):
            continue  # blank lines between records
        headers = {}
        while (line := archive.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        n = int(headers["content-length"])
        block = archive.read(n)
        if len(block) < n:
            raise ValueError(f"record {headers.get('warc-record-id')} is cut off")
        yield headers, block


def _row(h: dict[str, str], block: bytes, payload: bool) -> tuple:
    kind, said = h.get("warc-type"), h.get("warc-payload-digest", "").removeprefix("sha1:") or None
    body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    digest = said if body is None else base64.b32encode(hashlib.sha1(body).digest()).decode()
    if said not in (None, digest):
        raise ValueError(f"the payload of {h.get('warc-record-id')} doesn't have the digest that its record names")
    fields = {k.strip(): v.strip() for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split(CRLF))} if kind == "metadata" else {}
    text = body.decode("utf-8", "replace") if payload and body is not None else None
    return kind, h.get("warc-record-id"), h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-date"), digest, None if body is None else len(body), text, int(fields["pageId"]) if fields.get("pageId") else None


def read_records(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """One row per record of the archives under ``path``; digest and length of a payload are computed from its bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flush = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _BATCH, strict=True)], schema=_BATCH)
        for b in batches:
            for raw in b["content"]:
                raw, rows, held = io.BytesIO(raw.as_buffer()), [], 0
                raw = gzip.GzipFile(fileobj=raw) if raw.getbuffer()[:2] == b"\x1f\x8b" else raw
                for h, block in parse(raw):
                    rows.append(_row(h, block, payload))
                    held += len(block)
                    if len(rows) >= BATCH_RECORDS or held >= BATCH_BYTES:
                        yield flush(rows)
                        rows, held = [], 0
                if rows:
                    yield flush(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{txt,txt.gz,warc,warc.gz}").load(path).select("content")
    return files.mapInArrow(run, _RECORDS)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: its response or revisit, its request and its metadata.

    Records are joined by WARC-Concurrent-To; a record that names a request
    belongs to that request's capture. A record whose capture isn't there
    makes a row without a response.
    """
    requests = records.where("warc_type = 'request'").select(F.col("record_id").alias("_request"), F.col("concurrent_to").alias("_main"))
    attached = records.where("concurrent_to is not null")
    via = attached.where("warc_type <> 'request'").select(F.col("record_id").alias("_id"), "concurrent_to").join(requests, F.col("concurrent_to") == F.col("_request")).select("_id", "_main")
    chained = via.where("_main is not null")
    kept = records.join(chained, records["record_id"] == chained["_id"], "left").withColumn("capture", F.coalesce("_main", "concurrent_to", "record_id")).drop("_id", "_main")
    row = F.struct(*(c for c in records.columns))
    pick = lambda *kinds: F.max(F.when(F.col("warc_type").isin(*kinds), row))
    return kept.groupBy("capture").agg(pick("response", "revisit").alias("response"), pick("request").alias("request"), pick("metadata").alias("metadata"))


def warc_round_trip(pages: DataFrame, path: str | None = None, payload: bool = False) -> DataFrame:
    """Write the pages as archives and assemble what the archives hold.

    Returns one row per capture: page_id, payload_bytes, payload_digest,
    record_type, refers_to and payload (null unless asked for).

    A null html is an empty payload. A null url is left out of the records;
    blanks and control characters in it are escaped. A page with a null id
    revisits an equal payload of a page that has one. Repeated rows are
    captures of their own; those that repeat the smallest page are all
    responses, and revisits refer to the first. An empty table writes no
    record and gives an empty result.
    """
    import uuid

    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_warc(pages, path)
    records = stored(read_records(spark, path, payload), "warc-records")  # the archives are read once
    captures = stored(assemble(records).where("response is not null"), "warc-captures")
    discard(records)
    main = F.col("response")
    named = captures.select(F.col("metadata.page_id").alias("page_id"), main["warc_type"].alias("record_type"), main["record_id"].alias("record_id"), main["refers_to"].alias("of"), main["payload_bytes"].alias("payload_bytes"), main["payload_digest"].alias("payload_digest"), main["payload"].alias("payload"))
    responses = named.where("record_type = 'response'").select(F.col("record_id").alias("to"), F.col("page_id").alias("to_page"), F.col("payload_bytes").alias("to_bytes"), F.col("payload_digest").alias("to_digest"))
    # a response that many revisits name is one row, so that Spark can split the revisits' side
    out = named.join(responses, (F.col("of") == F.col("to")) & (F.col("payload_digest") == F.col("to_digest")), "left")
    return out.select("page_id", F.coalesce("payload_bytes", "to_bytes").alias("payload_bytes"), "payload_digest", "record_type", F.col("to_page").alias("refers_to"), "payload")
