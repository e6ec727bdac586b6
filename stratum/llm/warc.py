"""WARC archives: writing with deduplication and segments, reading with reassembly.

Writing: one record per page, block = HTTP response in chunked transfer framing.
Of pages with equal payloads of at least ``LEAST_DEDUP`` bytes the one with the
largest page id keeps its payload, the others become revisit records that refer
to it. A block longer than ``SEGMENT_BYTES`` is cut into a first segment and
continuation records. Spark's text writer puts the records into files, with the
record terminator as line separator, on any file system Spark can write to.

Reading: every file is parsed record by record by its Content-Length; segments
are grouped by origin, ordered by number and joined, the total length is checked
against the last segment's, the chunked framing is decoded and the payload
digest verified. Revisits take length and digest from the record they refer to.

Defined results: null html is an empty payload; a page without an id is never
deduplicated; repeated rows of one id that is the largest are all responses; a
damaged record stops the read with an error that names it; an empty table gives no
records and no rows; columns other than id, url and html are ignored. A payload of any
length is written and joined again in segments, by one task each way. Ids may be
texts; an empty one reads back as null.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import arrow_schema, on_workers, record_batch, settle

# Fixed values of the formats.
VERSION = b"WARC/1.1"
CRLF = b"\r\n"
END = "\r\n\r\n"

LEAST_DEDUP = 1_000
SEGMENT_BYTES = 16_384
CHUNK_BYTES = 4_096
#: Most records of one archive file (each at most a segment and its header).
RECORDS_PER_FILE = 8_192
DATE = "2024-01-01T00:00:00Z"


def page_urn(page_id: object, row: int | None = None) -> str:
    """The id, percent-encoded, and the row that holds it."""
    return f"<urn:page:{'' if page_id is None else quote(str(page_id), safe='')}{'' if row is None else f'#r{row}'}>"


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(piece), piece)
             for at in range(0, len(payload), CHUNK_BYTES)
             for piece in [payload[at:at + CHUNK_BYTES]]]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        stop = body.index(CRLF, at)
        size = int(body[at:stop].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        at = stop + 2
        if body[at + size:at + size + 2] != CRLF:
            raise ValueError("a chunk does not end where its length says")
        out.append(body[at:at + size])
        at += size + 2


def http_block(payload: bytes) -> bytes:
    return (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload))


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(CRLF + CRLF)
    framed = any(line.lower().replace(b" ", b"") == b"transfer-encoding:chunked" for line in head.split(CRLF))
    return unchunked(body) if framed else body


def record(kind: str, urn: str, headers: dict[str, object], block: bytes) -> bytes:
    """A record without its terminator."""
    lines = {"WARC-Type": kind, "WARC-Record-ID": urn, "WARC-Date": DATE, **headers, "Content-Length": len(block)}
    return VERSION + CRLF + "".join(f"{k}: {v}\r\n" for k, v in lines.items()).encode() + CRLF + block


def page_records(row: int, page_id: object, url: str | None, payload: bytes, digest: str,
                 refers_to: object, segment_bytes: int = SEGMENT_BYTES) -> Iterator[bytes]:
    urn = page_urn(page_id, row)
    about: dict[str, object] = {"WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()}
    if url and not any(ord(c) < 32 for c in url):
        about["WARC-Target-URI"] = url
    if refers_to is not None:
        yield record("revisit", urn, about | {
            "WARC-Refers-To": page_urn(refers_to),
            "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}, b"")
        return
    block = http_block(payload)
    about["Content-Type"] = "application/http; msgtype=response"
    if len(block) <= segment_bytes:
        yield record("response", urn, about, block)
        return
    last = -(-len(block) // segment_bytes)
    for number in range(1, last + 1):
        part = block[(number - 1) * segment_bytes:number * segment_bytes]
        if number == 1:
            yield record("response", urn, about | {"WARC-Segment-Number": 1}, part)
            continue
        extra: dict[str, object] = {"WARC-Segment-Origin-ID": urn, "WARC-Segment-Number": number}
        if number == last:
            extra["WARC-Segment-Total-Length"] = len(block)
        yield record("continuation", f"{urn[:-1]}/{number}>", extra, part)


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        stop = data.find(CRLF + CRLF, at)
        if not data.startswith(VERSION, at) or stop < 0:
            raise ValueError(f"no record header at byte {at}")
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")[1:]
        headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
        start = stop + 4
        at = start + int(headers["content-length"])
        if data[at:at + 4] != CRLF + CRLF:
            raise ValueError(f"{headers.get('warc-record-id')} does not end where its length says")
        yield headers, data[start:at]
        at += 4


def decide(pages: DataFrame) -> DataFrame:
    """Adds ``payload`` (binary), ``digest`` and ``refers_to``. Equal payloads are
    counted by digest before the join, so a payload that many pages share is one
    row on the small side; adaptive execution splits it on the other."""
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"),
                        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    owners = (rows.where((F.col("size") >= LEAST_DEDUP) & F.col("page_id").isNotNull())
              .groupBy("digest").agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
              .where("n > 1").select(F.col("digest").alias("owner_digest"), "owner"))
    refers = F.when((F.col("size") >= LEAST_DEDUP) & (F.col("page_id") < F.col("owner")), F.col("owner"))
    return (rows.join(owners, F.col("digest") == F.col("owner_digest"), "left")
            .withColumn("refers_to", refers).drop("owner", "owner_digest"))


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES) -> None:
    """Write the pages' records as gzipped archive parts under ``path``. Payloads
    move at most once, for the join with the shared digests; a record is at most a
    segment, so RECORDS_PER_FILE bounds the bytes of a file."""
    on_workers(pages.sparkSession)
    rows = (decide(pages).withColumn("row", F.monotonically_increasing_id())
            .withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload"))))
    schema = arrow_schema("value binary")

    def run(batches):
        for batch in batches:
            out = [r for row in batch.select(["row", "page_id", "url", "payload", "digest", "refers_to"]).to_pylist()
                   for r in page_records(row["row"], row["page_id"], row["url"], row["payload"] or b"",
                                         row["digest"], row["refers_to"], segment_bytes)]
            if out:
                yield record_batch({"value": out}, schema)

    # The cast keeps the bytes as they are; the writer copies them out.
    lines = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    (lines.write.option("lineSep", END).option("compression", "gzip")
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def read_archives(spark: SparkSession, path: str, id_type: str = "bigint") -> DataFrame:
    """One row per page read back: page_id, payload_bytes, payload_digest,
    record_type, refers_to. Whole records are finished where they are parsed;
    only segments of long ones are shuffled, by origin."""
    on_workers(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    ddl = ("urn string, kind string, refers string, digest string, length bigint, "
           "number int, total bigint, part binary")
    schema = arrow_schema(ddl)

    def parse_files(batches):
        for batch in batches:
            for content in batch.column(0):
                out = [_row(h, block) for h, block in parse(gzip.decompress(content.as_py()))]
                if out:
                    yield record_batch(dict(zip(schema.names, map(list, zip(*out)))), schema)

    # Settled, as both ways below read it: archives are parsed once.
    parsed = settle(files.mapInArrow(parse_files, ddl), "warc-records")
    whole = parsed.where("number is null").select("urn", "kind", "refers", "digest", "length")

    def assemble(group: pa.Table) -> pa.Table:
        group = group.sort_by("number")
        numbers, parts = group["number"].to_pylist(), group["part"].to_pylist()
        head = group.slice(0, 1).to_pylist()[0]
        block = b"".join(parts)
        if numbers != list(range(1, len(numbers) + 1)) or group["total"].to_pylist()[-1] != len(block):
            raise ValueError(f"{head['urn']}: segments are missing, repeated or of another total length")
        digest, length = _payload(head["urn"], head["digest"], block)
        return pa.table({"urn": [head["urn"]], "kind": [head["kind"]], "refers": pa.array([None], pa.string()),
                         "digest": [digest], "length": pa.array([length], pa.int64())})

    joined = (parsed.where("number is not null").select("urn", "kind", "digest", "number", "total", "part")
              .groupBy("urn").applyInArrow(assemble, "urn string, kind string, refers string, digest string, length bigint"))
    records = whole.unionByName(joined)
    page, target = (F.url_decode(F.nullif(F.regexp_extract(c, "^<urn:page:([^#>]*)", 1), F.lit(""))).cast(id_type)
                    for c in ("urn", "refers"))
    pages = records.select(page.alias("page_id"), "kind", target.alias("refers_to"), "digest", "length")
    # A revisit's own record has no payload: take both figures from its target.
    targets = (pages.where("kind = 'response' and page_id is not null").groupBy("page_id", "digest")
               .agg(F.max("length").alias("target_length"))
               .select(F.col("page_id").alias("target_id"), F.col("digest").alias("target_digest"), "target_length"))
    return (pages.join(targets, (F.col("refers_to") == F.col("target_id")) & (F.col("digest") == F.col("target_digest")), "left")
            .select("page_id", F.coalesce("target_length", "length").alias("payload_bytes"),
                    F.coalesce("target_digest", "digest").alias("payload_digest"),
                    F.col("kind").alias("record_type"), "refers_to"))


def _payload(urn: str, claimed: str, block: bytes) -> tuple[str, int]:
    payload = http_payload(block)
    digest = hashlib.sha1(payload).hexdigest()
    if digest != claimed:
        raise ValueError(f"{urn}: the payload does not have the digest its record states")
    return digest, len(payload)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    kind, urn = headers["warc-type"], headers["warc-record-id"]
    stated = headers.get("warc-payload-digest", "")
    claimed = base64.b32decode(stated[5:]).hex() if stated.startswith("sha1:") else None
    number = headers.get("warc-segment-number")
    if number is not None:
        total = headers.get("warc-segment-total-length")
        origin = headers.get("warc-segment-origin-id", urn)
        return (origin, kind, None, claimed, None, int(number), total and int(total), block)
    if kind == "revisit":
        return (urn, kind, headers["warc-refers-to"], claimed, None, None, None, None)
    digest, length = _payload(urn, claimed, block)
    return (urn, kind, None, digest, length, None, None, None)
