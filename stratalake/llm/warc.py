"""WARC archives: writing records with revisits and segments, reading them back whole.

Writing: payloads of at least ``REVISIT_BYTES`` that are equal are stored once, by the record
of the smallest id; the others become revisit records. A response is an HTTP message in chunked
transfer framing. A record longer than ``SEGMENT`` bytes is cut into segments: the first keeps
the record's headers, the continuations name it as their origin, the last one states the total
length. Archives go through Spark's text writer with the record end as line separator, so any
file system of the cluster will do and a task that is run again leaves no half files.

Reading: archives are parsed record by record by their declared lengths; continuation records
are grouped by origin identifier, ordered by segment number, joined and checked against the
total length; then the HTTP head is cut off and the chunked framing is decoded and checked. A
record that fails a check comes out with ``fault`` set and without payload.

An archive holds at most ``ARCHIVE_RECORDS`` rows and is read as one value, so memory follows
the archive, not the table. Only records with segments are shuffled.

Defined results: a NULL payload is empty; a NULL url is written as an empty one. A record is
identified by id and payload, so repeated rows write equal records and each gets its row back.
Among equal payloads, rows without an id come last. An empty table writes no record and reads
back empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from stratalake.session import fresh_path, pin

REVISIT_BYTES = 100
SEGMENT = 32 << 10
CHUNK = 8 << 10
ARCHIVE_RECORDS = 1000
_END = b"\r\n\r\n"
# The record head, and the profile of a revisit, of the WARC 1.1 format.
_VERSION = b"WARC/1.1"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = pa.schema(
    [(n, pa.string()) for n in ("record_id", "record_type", "origin_id", "refers_to", "target_uri", "payload_digest")]
    + [("segment", pa.int32()), ("total", pa.int64()), ("block", pa.binary()), ("fault", pa.string())]
)
_DDL = (
    "record_id string, record_type string, origin_id string, refers_to string, target_uri string, "
    "payload_digest string, segment int, total bigint, block binary, fault string"
)


def record_id(key: Column, digest: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("null")), F.lit(":"), digest, F.lit(">"))


def _http(payload: bytes) -> bytes:
    parts = [b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"]
    for i in range(0, len(payload), CHUNK):
        piece = payload[i : i + CHUNK]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    lines = [_VERSION] + [f"{name}: {value}".encode() for name, value in fields if value is not None]
    return b"\r\n".join([*lines, b"Content-Length: %d" % len(block), b"", block])


def _header_value(text: str | None) -> str:
    """A url without the characters that would end its header line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "")


def _records(rid: str, refers: str | None, url: str | None, digest: str, payload: bytes) -> Iterator[bytes]:
    """The record of one row, in segments if it is long."""
    head = [("WARC-Target-URI", _header_value(url)), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers is not None:
        yield _record(
            [("WARC-Type", "revisit"), ("WARC-Record-ID", rid), ("WARC-Refers-To", refers), ("WARC-Profile", _PROFILE), *head], b""
        )
        return
    block = _http(payload)
    pieces = [block[i : i + SEGMENT] for i in range(0, len(block), SEGMENT)]
    first = [("WARC-Type", "response"), ("WARC-Record-ID", rid), *head, ("Content-Type", "application/http;msgtype=response")]
    yield _record(first + [("WARC-Segment-Number", 1)] * (len(pieces) > 1), pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        total = len(block) if n == len(pieces) else None
        own = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{rid[:-1]}:{n}>"), ("WARC-Segment-Origin-ID", rid)]
        yield _record([*own, ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total)], piece)


def write_archives(df: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> None:
    """One record per row of ``df`` (more if it is cut into segments) below ``folder``."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = df.select(F.col(key).alias("id"), F.col(url).cast("string").alias("url"), body.alias("body"))
    rows = rows.withColumn("digest", F.sha2("body", 256))
    long = rows.where(F.octet_length("body") >= REVISIT_BYTES)
    # Only digests that occur more than once take part in the join; their rows carry no payload.
    repeated = long.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = pin(repeated.select("digest", "first"), "repeated")
    marked = rows.join(repeated, "digest", "left")
    revisits = (F.octet_length("body") >= REVISIT_BYTES) & F.coalesce(
        F.col("id") != F.col("first"), F.col("first").isNotNull()
    )
    marked = marked.select(
        record_id(F.col("id"), F.col("digest")).alias("record_id"),
        F.when(revisits, record_id(F.col("first"), F.col("digest"))).alias("refers"),
        "url",
        "digest",
        F.col("body").cast("binary").alias("body"),
    )
    schema = pa.schema([("value", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            made = [r for row in zip(*columns, strict=True) for r in _records(*row)]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], schema=schema)

    records = marked.mapInArrow(build, "value binary").select(F.col("value").cast("string"))
    writer = records.write.option("lineSep", _END.decode()).option("maxRecordsPerFile", ARCHIVE_RECORDS)
    writer.text(folder)


def parse(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record, by declared length.

    A head that is no WARC head, or a block that is cut off, ends the archive with a ``fault``.
    """
    at = 0
    while at < len(archive):
        stop = archive.find(_END, at)
        head = archive[at:stop].split(b"\r\n") if stop >= 0 else []
        if not head or not head[0].startswith(b"WARC/"):
            yield {"fault": "no record head"}, b""
            return
        fields = dict(line.decode("utf-8", "replace").split(":", 1) for line in head[1:] if b":" in line)
        fields = {name.strip().lower(): value.strip() for name, value in fields.items()}
        size = fields.get("content-length", "")
        start = stop + len(_END)
        if not size.isdigit() or start + int(size) > len(archive):
            yield fields | {"fault": "block is cut off"}, b""
            return
        yield fields, archive[start : start + int(size)]
        at = start + int(size) + len(_END)


def dechunk(block: bytes) -> tuple[bytes | None, str | None]:
    """``(payload, fault)`` of an HTTP message, its chunked framing decoded if it has one."""
    stop = block.find(_END)
    if stop < 0:
        return None, "no HTTP head"
    head, at = block[:stop].lower(), stop + len(_END)
    if not re.search(rb"\r\ntransfer-encoding:[^\r]*chunked", head):
        return block[at:], None
    parts = []
    while True:
        line = block.find(b"\r\n", at)
        size = block[at:line].split(b";")[0].strip() if line >= 0 else b""
        if not re.fullmatch(rb"[0-9A-Fa-f]+", size):
            return None, "bad chunk size"
        n = int(size, 16)
        at = line + 2
        if n == 0:
            return b"".join(parts), None
        if block[at + n : at + n + 2] != b"\r\n":
            return None, "chunk is cut off"
        parts.append(block[at : at + n])
        at += n + 2


def _parsed(spark: SparkSession, folder: str, segmented: bool) -> DataFrame:
    """Records of all archives that do, or do not, belong to a segmented one."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows: list[list] = [[] for _ in _FIELDS]
                for fields, block in parse(archive.as_py()):
                    number = fields.get("warc-segment-number")
                    if (number is not None) != segmented:
                        continue
                    total = fields.get("warc-segment-total-length")
                    values = [fields.get(n) for n in ("warc-record-id", "warc-type", "warc-segment-origin-id")]
                    values += [fields.get(n) for n in ("warc-refers-to", "warc-target-uri", "warc-payload-digest")]
                    values += [number and int(number), total and int(total), block, fields.get("fault")]
                    for column, value in zip(rows, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, _FIELDS, strict=True)], schema=_FIELDS)

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(read, _DDL)


def reassemble(segments: DataFrame) -> DataFrame:
    """First segments with the whole block of their record; ``fault`` where a check fails.

    Equal segments of repeated records count once, and each first segment gets its record back.
    """
    first = F.col("record_type") != "continuation"
    origin = F.when(first, F.col("record_id")).otherwise(F.col("origin_id"))
    parts = segments.withColumn("_origin", origin).groupBy("_origin").agg(
        F.sort_array(F.collect_set(F.struct("segment", F.col("block").cast("string").alias("block")))).alias("_parts"),
        F.max("total").alias("_total"),
    )
    whole = F.array_join("_parts.block", "").cast("binary")
    in_order = F.col("_parts.segment") == F.sequence(F.lit(1), F.size("_parts"))
    right = in_order & F.coalesce(F.octet_length("_block") == F.col("_total"), F.lit(False))
    parts = parts.withColumn("_block", whole).select(
        "_origin", "_block", F.when(~right, F.lit("segments do not make the record")).alias("_fault")
    )
    heads = segments.where(first).drop("block", "fault")
    joined = heads.join(parts, heads["record_id"] == parts["_origin"], "left")
    return joined.withColumns({"block": F.col("_block"), "fault": F.col("_fault")}).drop("_origin", "_block", "_fault")


@F.arrow_udf(BinaryType())
def _payload(blocks: pa.Array) -> pa.Array:
    return pa.array([None if b is None else dechunk(b)[0] for b in blocks.to_pylist()], pa.binary())


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Whole records: ``record_id, record_type, refers_to, target_uri, payload_digest, payload, fault``.

    ``payload_digest`` is what the archive states; revisits have no payload of their own.
    """
    whole = _parsed(spark, folder, segmented=False)
    records = whole.unionByName(reassemble(_parsed(spark, folder, segmented=True)), allowMissingColumns=True)
    response = F.col("record_type") == "response"
    # Blocks of other records are not given to the decoder at all.
    records = records.withColumn("payload", _payload(F.when(response & F.col("fault").isNull(), F.col("block"))))
    stated = F.regexp_extract("payload_digest", r"^sha256:([0-9a-f]{64})$", 1)
    fault = (
        F.when(F.col("fault").isNotNull(), F.col("fault"))
        .when(response & F.col("payload").isNull(), F.lit("bad HTTP framing"))
        .when(response & (F.sha2("payload", 256) != stated), F.lit("digest differs"))
    )
    return records.select("record_id", "record_type", "refers_to", "target_uri", stated.alias("payload_digest"), "payload", fault.alias("fault"))


def archived_pages(df: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``key, payload_bytes, payload_digest, record_type, refers_to`` as read back from new archives.

    Size and digest of a response are those of the payload that was read; a revisit takes them
    from the response that it refers to.
    """
    spark = df.sparkSession
    folder = fresh_path(spark, "warc")
    write_archives(df, folder, key, url, payload)
    records = read_archives(spark, folder).select(
        "record_id",
        "record_type",
        "refers_to",
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "fault",
    )
    records = pin(records, "records")
    page = lambda rid: F.regexp_extract(rid, r"^<urn:page:(-?\d+):", 1).try_cast("bigint")
    responses = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_bytes").alias("_bytes"), F.col("payload_digest").alias("_digest")
    )
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    resolved = revisits.join(responses.dropDuplicates(["refers_to"]), "refers_to", "left").select(
        "record_id", "record_type", "refers_to", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest")
    )
    whole = records.where("record_type = 'response'").drop("fault").unionByName(resolved)
    return whole.select(
        page("record_id").alias(key), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to")
    )
