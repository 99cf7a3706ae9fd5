"""WARC archives of web pages: writing, and reading back with segment reassembly.

Writing is SQL: a page is an HTTP response whose payload is framed in chunks. Of pages with equal
payloads of ``REVISIT_BYTES`` or more, the one of the least id is the response, the others are
revisit records that refer to it. A block over ``SEGMENT_BYTES`` is cut: the first record has
segment number 1, continuation records carry its id as origin, their number and, the last, the
total length. Spark's text writer ends each record and compresses and commits the files.

Reading parses files record by record. Segments are dealt by origin, ordered by number and joined
if none is missing and the total length holds; then chunk framing is decoded and the payload's
digest compared. What fails has a null payload and a ``status`` that says why.

Defined cases: a null payload is empty; null ids are kept, come after others for the least id and
have no page header; a null url has no target header; line ends, tabs, spaces and zeros in urls are
percent-encoded; equal rows are records of their own, the first read is the response; a segment that
occurs twice counts once if both are equal, else the record is in conflict; an empty table gives
an archive without records; other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES, SEGMENT_BYTES, REVISIT_BYTES = 8192, 16384, 100
# Bounds a file, which a task reads whole: at most this many segments.
RECORDS_PER_FILE = 4000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def _lines(*fields: tuple[str, Column | str]) -> Column:
    """Header lines; a null value leaves its line out."""
    return F.concat(
        *(
            F.coalesce(F.concat(F.lit(f"{name}: "), value if isinstance(value, Column) else F.lit(value), F.lit("\r\n")), F.lit(""))
            for name, value in fields
        )
    )


def _cut(data: str, size: int) -> Column:
    """Consecutive pieces of a binary column, one empty piece if it is empty."""
    pieces = f"sequence(0, greatest(0, (octet_length({data}) - 1) div {size}))"
    return F.expr(f"transform({pieces}, i -> substring({data}, int(i * {size} + 1), {size}))")


def _urn(name: Column) -> Column:
    digits = F.md5(name.cast("binary"))
    parts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archives(
    pages: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Write a record per row of ``pages`` (``page_id``, ``url``, ``html``) below ``path``.

    Rows are told apart by their place, so ``pages`` has to be a table that is read in the same
    order each time, such as files.
    """
    source = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("digest", F.sha2("payload", 256))
    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row")
    copies = source.filter(F.octet_length("payload") >= revisit_bytes).groupBy("digest")
    copies = copies.agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    marked = source.join(copies, "digest", "left")

    def name(row: Column) -> Column:
        return _urn(F.concat_ws(":", F.lit("page"), row))

    revisit = F.coalesce(F.col("first.row") != F.col("row"), F.lit(False))
    framed = F.transform(
        _cut("payload", CHUNK_BYTES),
        lambda piece: F.concat(F.lower(F.hex(F.octet_length(piece))), F.lit("\r\n"), piece.cast("string"), F.lit("\r\n")),
    )
    framed = F.when(F.octet_length("payload") > 0, F.array_join(framed, "")).otherwise("")
    http = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = F.when(revisit, F.lit(http + "\r\n")).otherwise(
        F.concat(F.lit(http + "Transfer-Encoding: chunked" + END), framed, F.lit("0" + END))
    )
    uri = F.col("url")
    for mark in "\r\n\t \x00":
        uri = F.replace(uri, F.lit(mark), F.lit(f"%{ord(mark):02X}"))
    records = marked.select(
        name(F.col("row")).alias("record"),
        F.when(revisit, name(F.col("first.row"))).alias("refers_to"),
        F.when(revisit, "revisit").otherwise("response").alias("type"),
        "page_id",
        "digest",
        uri.alias("uri"),
        block.cast("binary").alias("block"),
    )
    segments = records.select("*", F.octet_length("block").alias("total"), F.posexplode(_cut("block", segment_bytes)).alias("at", "part"))
    first, last = F.col("at") == 0, (F.col("at") + 1) * segment_bytes >= F.col("total")
    number = F.when(F.col("total") > segment_bytes, (F.col("at") + 1).cast("string"))
    head = _lines(
        ("WARC-Type", F.when(first, F.col("type")).otherwise("continuation")),
        ("WARC-Record-ID", F.when(first, F.col("record")).otherwise(_urn(F.concat_ws(":", "record", "at")))),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", F.col("uri")),
        ("WARC-Segment-Number", number),
        ("WARC-Segment-Origin-ID", F.when(~first, F.col("record"))),
        ("WARC-Segment-Total-Length", F.when(~first & last, F.col("total").cast("string"))),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha256:"), F.col("digest")))),
        ("WARC-Refers-To", F.when(first, F.col("refers_to"))),
        ("WARC-Profile", F.when(first & F.col("refers_to").isNotNull(), F.lit(PROFILE))),
        ("X-Page-ID", F.when(first, F.col("page_id").cast("string"))),
        ("Content-Type", F.when(first, F.lit("application/http; msgtype=response"))),
        ("Content-Length", F.octet_length("part").cast("string")),
    )
    text = segments.select(F.concat(F.lit("WARC/1.1\r\n"), head, F.lit("\r\n"), F.col("part").cast("string")).alias("value"))
    writer = text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file)
    writer.text(path)


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record of one archive file."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    at = 0
    while (start := content.find(b"WARC/", at)) >= 0:
        head = content.find(b"\r\n\r\n", start)
        if head < 0:
            return
        lines = content[start:head].decode("utf-8", "replace").split("\r\n")[1:]
        fields = {key.strip().lower(): value.strip() for key, _, value in (line.partition(":") for line in lines)}
        length = int(fields.get("content-length", "0"))
        yield fields, content[head + 4 : head + 4 + length]
        at = head + 4 + length


def dechunk(body: bytes) -> bytes | None:
    """The payload of chunked transfer framing; None if the framing is broken or cut short."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return None
        if not size:
            return b"".join(out)
        at = end + 2 + size
        if size < 0 or body[at : at + 2] != b"\r\n":
            return None
        out.append(body[end + 2 : at])
        at += 2
    return None


def payload_of(kind: str, digest: str | None, block: bytes) -> tuple[bytes | None, str]:
    """Payload and status of a whole record."""
    if kind == "revisit":
        return None, "ok"
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None, "no http header"
    if b"transfer-encoding: chunked" in head.lower():
        body = dechunk(body)
        if body is None:
            return None, "bad framing"
    if digest and digest.startswith("sha256:") and hashlib.sha256(body).hexdigest() != digest[7:]:
        return None, "digest mismatch"
    return body, "ok"


RECORDS = pa.schema(
    [
        ("record", pa.string()),
        ("type", pa.string()),
        ("page_id", pa.int64()),
        ("uri", pa.string()),
        ("refers_to", pa.string()),
        ("digest", pa.string()),
        ("payload", pa.binary()),
        ("status", pa.string()),
        # Of segments that wait for the others: their origin, number, total length and block.
        ("origin", pa.string()),
        ("segment", pa.int64()),
        ("total", pa.int64()),
        ("block", pa.binary()),
    ]
)
COLUMNS = (
    "record string, type string, page_id long, uri string, refers_to string, digest string, payload binary, status string"
)
SEGMENT_COLUMNS = "origin string, segment long, total long, block binary"


def _batches(rows: Iterator[dict], names: list[str], limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([RECORDS.field(name) for name in names])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row.get("payload") or b"") + len(row.get("block") or b"")
        if size > limit:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema=schema)


def _records(batches) -> Iterator[dict]:
    for batch in batches:
        for content in batch.column("content"):
            for fields, block in parse(content.as_py()):
                page = fields.get("x-page-id")
                row = {
                    "record": fields.get("warc-record-id"),
                    "type": fields.get("warc-type"),
                    "page_id": int(page) if page else None,
                    "uri": fields.get("warc-target-uri"),
                    "refers_to": fields.get("warc-refers-to"),
                    "digest": fields.get("warc-payload-digest"),
                }
                number, total = fields.get("warc-segment-number"), fields.get("warc-segment-total-length")
                if number:
                    origin = fields.get("warc-segment-origin-id") or row["record"]
                    row |= {"origin": origin, "segment": int(number), "total": int(total) if total else None, "block": block}
                elif row["type"] in ("response", "revisit"):
                    row["payload"], row["status"] = payload_of(row["type"], row["digest"], block)
                else:
                    continue
                yield row


def reassembled(segments: list[dict]) -> dict | None:
    """The record of one origin's segments, sorted by number; None if it has no first segment."""
    head, parts, total, status = None, {}, None, "ok"
    for row in segments:
        number = row["segment"]
        if number in parts and parts[number] != row["block"]:
            status = "conflicting segments"
        parts[number] = row["block"]
        total = row["total"] if row["total"] is not None else total
        head = row if number == 1 else head
    if head is None:
        return None
    out = {name: head[name] for name in RECORDS.names[:6]} | {"payload": None, "status": status}
    if status == "ok":
        block = b"".join(parts.values())
        if list(parts) != list(range(1, len(parts) + 1)) or total is None:
            out["status"] = "missing segment"
        elif len(block) != total:
            out["status"] = "length mismatch"
        else:
            out["payload"], out["status"] = payload_of(head["type"], head["digest"], block)
    return out


def _joined(batches) -> Iterator[dict]:
    """Records from segments sorted by origin and number."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["origin"] != row["origin"]:
                if record := reassembled(held):
                    yield record
                held = []
            held.append(row)
    if held and (record := reassembled(held)):
        yield record


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every response and revisit record of the archives below ``path``: ``record``, ``type``,
    ``page_id``, ``uri``, ``refers_to``, ``digest``, ``payload``, ``status``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    rows = files.mapInArrow(lambda batches: _batches(_records(batches), RECORDS.names), f"{COLUMNS}, {SEGMENT_COLUMNS}")
    whole = rows.filter("origin IS NULL").select(*RECORDS.names[:8])
    waiting = rows.filter("origin IS NOT NULL").drop("payload", "status")
    ordered = waiting.repartition("origin").sortWithinPartitions("origin", "segment")
    joined = ordered.mapInArrow(lambda batches: _batches(_joined(batches), RECORDS.names[:8]), COLUMNS)
    return whole.unionByName(joined)
