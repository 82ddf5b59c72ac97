"""WARC archives: writing segmented records and reassembling them.

Payloads go out as HTTP responses in chunked transfer framing. A record block longer than a segment is cut
into a first record and continuation records, each naming the first one (WARC-Segment-Origin-ID) and its
number; the last carries the total length. Segments of a record may lie in different files. Reading groups
continuations by origin, orders them by number, verifies gaplessness and total length, and decodes the
framing. Records whose payload equals that of a smaller id are revisits without payload.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import shared_dir
from .common import materialize

CRLF = "\r\n"
RECORD_END = CRLF + CRLF


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uuid_of(*cols) -> Column:
    h = F.md5(F.concat_ws("|", *cols))
    parts = [F.substring(h, at + 1, n) for at, n in ((0, 8), (8, 4), (12, 4), (16, 4), (20, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def warc_records(pages: DataFrame, min_bytes: int, segment_chars: int, chunk_chars: int, date: str) -> DataFrame:
    """(record string without its closing blank lines, n) for each record; n spreads the records over files."""
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), F.coalesce("html", F.lit("")).alias("body")
    ).withColumn("sha", F.unhex(F.sha1(F.col("body").cast("binary"))))
    p = p.withColumn("uri", F.regexp_replace(F.regexp_replace("url", "[\r\n]", " "), "^$", "about:blank")).drop("url")
    # for each payload the record with the smallest id, from partial minima of each task; as a table of its own, so that the
    # join below meets two plain exchanges, whose hot partitions Spark splits
    origin = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "uri"))).alias("first")
    first = materialize(p.where(F.octet_length("body") >= min_bytes).groupBy("sha").agg(origin), "warc-first")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    p = p.join(first, "sha", "left").withColumn("again", F.coalesce((F.octet_length("body") >= min_bytes) & other, F.lit(False)))
    # known by id, address and payload: pages that share an id but not the payload are records of their own
    named = lambda page, uri: _uuid_of(F.lit("record"), F.coalesce(page.cast("string"), F.lit("null")), F.hex("sha"), uri)
    rid = named(F.col("page_id"), F.col("uri"))
    chunk = lambda x: F.concat(F.lower(F.conv(F.octet_length(x).cast("string"), 10, 16)), F.lit(CRLF), x, F.lit(CRLF))
    n_chunks = F.ceil(F.length("body") / F.lit(chunk_chars)).cast("int")
    pieces = F.when(F.length("body") == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), n_chunks), lambda i: F.substring(F.col("body"), (i - 1) * chunk_chars + 1, F.lit(chunk_chars)))
    )
    http = F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Transfer-Encoding: chunked{CRLF}{CRLF}")
    block = F.concat(http, F.array_join(F.transform(pieces, chunk), ""), F.lit(f"0{CRLF}{CRLF}"))
    target = F.when(F.col("again"), named(F.col("first.page_id"), F.col("first.uri")))
    block = F.when(F.col("again"), F.lit(f"HTTP/1.1 200 OK{CRLF}{CRLF}")).otherwise(block)
    p = p.withColumn("rid", rid).withColumn("target", target).withColumn("block", block)
    n_seg = F.greatest(F.lit(1), F.ceil(F.length("block") / F.lit(segment_chars)).cast("int"))
    seg = p.withColumn("total", F.octet_length("block")).withColumn("segs", n_seg).withColumn("i", F.explode(F.sequence(F.lit(1), F.col("segs"))))
    seg = seg.withColumn("part", F.substring(F.col("block"), (F.col("i") - 1) * segment_chars + 1, F.lit(segment_chars)))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    opt = lambda cond, name, value: F.when(cond, line(name, value)).otherwise(F.lit(""))
    start = F.col("i") == 1
    split = F.col("segs") > 1
    kind = F.when(~start, F.lit("continuation")).when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))
    has_id = F.col("page_id").isNotNull()
    record = F.concat(
        F.lit("WARC/1.1" + CRLF), line("WARC-Type", kind),
        line("WARC-Record-ID", F.concat(F.lit("<"), F.when(start, F.col("rid")).otherwise(_uuid_of("rid", F.col("i").cast("string"))), F.lit(">"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", F.col("uri")),
        opt(has_id & start, "X-Page-ID", F.col("page_id").cast("string")),
        opt(start & F.col("again"), "WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        opt(start & F.col("again"), "WARC-Refers-To", F.concat(F.lit("<"), F.col("target"), F.lit(">"))),
        opt(split, "WARC-Segment-Number", F.col("i").cast("string")),
        opt(~start, "WARC-Segment-Origin-ID", F.concat(F.lit("<"), F.col("rid"), F.lit(">"))),
        opt(split & (F.col("i") == F.col("segs")), "WARC-Segment-Total-Length", F.col("total").cast("string")),
        opt(start, "Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("part").cast("string")), F.lit(CRLF), F.col("part"),
    )
    return seg.select(record.alias("value"))


def write_warc(
    pages: DataFrame,
    path: str | None = None,
    min_bytes: int = 0,
    segment_chars: int = 8192,
    chunk_chars: int = 2048,
    file_bytes: int = 32 << 20,
    date: str = "2024-01-01T00:00:00Z",
    level: str = "BEST_SPEED",
) -> str:
    """Write gzip WARC files (through Spark's writer, so to any store) and return their folder.

    A null html is an empty payload, a null url ``about:blank``. A page whose payload occurs under a smaller id is a
    revisit, also if its own id is null; payloads that occur under null ids only are all responses. Pages that share
    an id are told apart by address and payload; rows equal in all three are one record, written as often as they
    occur, and all responses if their id is the smallest of their payload. No page gives an empty folder.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    records = warc_records(pages, min_bytes, segment_chars, chunk_chars, date)
    # files are read whole, so their size is bounded: every record is at most a segment and its header
    records.write.option("lineSep", RECORD_END).option("compression", "gzip").option("zlib.compress.level", level).option(
        "maxRecordsPerFile", max(1, file_bytes // (segment_chars + 1000))
    ).text(path)
    return path


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(b"\r\n"):
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode()
    return out


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; a malformed record raises ValueError."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        if stop < 0 or not data.startswith(b"WARC/1.", at):
            raise ValueError(f"no WARC record at byte {at}")
        h = _headers(data[data.index(b"\r\n", at) + 2 : stop])
        size = int(h["content-length"])
        block = data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size + 4
        if len(block) != size or data[at - 4 : at] != b"\r\n\r\n":
            raise ValueError("record is cut short")
        yield h, block


def decode_chunked(body: bytes) -> bytes:
    """The payload of chunked transfer framing; trailers and chunk extensions are allowed."""
    out, at = [], 0
    while True:
        stop = body.index(b"\r\n", at)
        size = int(body[at:stop].split(b";")[0], 16)
        at = stop + 2
        if not size:
            return b"".join(out)
        out.append(body[at : at + size])
        if len(out[-1]) != size or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk is cut short")
        at += size + 2


def http_payload(block: bytes) -> bytes:
    head, _, body = block.partition(b"\r\n\r\n")
    h = _headers(head)
    return decode_chunked(body) if "chunked" in h.get("transfer-encoding", "").lower() else body


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per reassembled record: record_id, record_type, page_id, uri, refers_to_id, payload, problem.

    problem is null, or says what keeps a record from being whole (a missing or repeated segment, a total
    length that differs, broken framing); its payload is null then.
    """
    kind = "record_id string, origin string, record_type string, page_id long, uri string, refers_to_id string, segment int, total long, block binary"

    def split(batches: Iterator[pa.RecordBatch], segmented: bool) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in kind.split(", ")]
        types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for content in batch.column(0):
                raw = content.as_py()
                raw = gzip.decompress(raw) if raw[:2] == b"\x1f\x8b" else raw
                rows, held = [], 0
                for h, block in parse_warc(raw):
                    if ("warc-segment-number" in h) != segmented:
                        continue
                    rid = h["warc-record-id"].strip("<>")
                    page = h.get("x-page-id")
                    origin, refers = h.get("warc-segment-origin-id", rid).strip("<>"), (h.get("warc-refers-to") or "").strip("<>") or None
                    # the last segment tells the total; a record in one piece is its own total
                    total = h.get("warc-segment-total-length", None if "warc-segment-number" in h else len(block))
                    number, total = int(h.get("warc-segment-number", 1)), None if total is None else int(total)
                    rows.append((rid, origin, h["warc-type"], int(page) if page else None, h.get("warc-target-uri"), refers, number, total, block))
                    held += len(block)
                    if held > 4 << 20:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    fields = F.struct("segment", "block", "record_type", "page_id", "uri", "refers_to_id", "record_id", "total")
    # only segmented records are dealt out by their origin; the others stay where they were read
    single = files.mapInArrow(lambda batches: split(batches, False), kind).select(F.array(fields).alias("s"))
    # a record's segments are as many as its own length needs, so the list is bounded by one record
    many = files.mapInArrow(lambda batches: split(batches, True), kind).groupBy("origin").agg(F.array_sort(F.collect_list(fields)).alias("s"))
    whole = single.unionAll(many.select("s"))

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for segs in batch.column(0).to_pylist():
                # a record written several times (of equal rows) comes as that many equal segments of each number
                by = {}
                for s in segs:
                    by.setdefault(s["segment"], []).append(s)
                first = by.get(1, [segs[0]])[0]
                times = len(by.get(1, [0]))
                block = b"".join(by[k][0]["block"] for k in sorted(by))
                total = by[max(by)][0]["total"]
                problem, payload = None, None
                if sorted(by) != list(range(1, len(by) + 1)) or total is None:
                    problem = "segments are missing"
                elif total != len(block):
                    problem = f"total length is {total}, segments have {len(block)}"
                else:
                    try:
                        payload = http_payload(block)
                    except ValueError as e:
                        problem = f"broken framing: {e}"
                out += [(first["record_id"], first["record_type"], first["page_id"], first["uri"], first["refers_to_id"], payload, problem)] * times
            cols = list(zip(*out, strict=True)) or [[]] * 7
            types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["record_id", "record_type", "page_id", "uri", "refers_to_id", "payload", "problem"])

    return whole.select("s").mapInArrow(assemble, "record_id string, record_type string, page_id long, uri string, refers_to_id string, payload binary, problem string")


def payload_digests(records: DataFrame) -> DataFrame:
    """Adds payload_bytes and payload_digest (bare upper-case base32 SHA-1), and drops the payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payload = batch.column(batch.schema.get_field_index("payload")).to_pylist()
            digest = pa.array([None if x is None else base32(hashlib.sha1(x).digest()) for x in payload], pa.string())
            size = pa.array([None if x is None else len(x) for x in payload], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.select(["record_id", "record_type", "page_id", "refers_to_id", "problem"]).columns, size, digest], names=["record_id", "record_type", "page_id", "refers_to_id", "problem", "payload_bytes", "payload_digest"])

    return records.mapInArrow(run, "record_id string, record_type string, page_id long, refers_to_id string, problem string, payload_bytes long, payload_digest string")


def op3_warc(spark, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back, with the digest of each full payload."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = payload_digests(read_warc(spark, write_warc(pages)))
    records = materialize(records, "warc-records")
    # records of one id are equal, so any of them will do, but all values come from the same one
    one = F.min(F.struct("page_id", "payload_bytes", "payload_digest")).alias("one")
    origin = records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(one).select(
        "refers_to_id", F.col("one.page_id").alias("refers_to"), F.col("one.payload_bytes").alias("full"), F.col("one.payload_digest").alias("digest")
    )
    none = F.lit(None).cast("long").alias("refers_to")
    response = records.where("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", none, "problem")
    # a revisit has the payload of the record it refers to; only revisits are joined, as others name none
    revisit = records.where("record_type = 'revisit'").join(origin, "refers_to_id", "left").select(
        "page_id", F.col("full").alias("payload_bytes"), F.col("digest").alias("payload_digest"), "record_type", "refers_to", "problem"
    )
    return response.unionAll(revisit)
