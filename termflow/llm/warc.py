"""WARC archives: one gzip member per record, written with payload
deduplication, and a sequential reader that inflates member by member, frames
records by Content-Length and verifies digests.

An archive is an ordered run of byte chunks (archive, seq, content): their
concatenation is a valid ``.warc.gz``. As a table in the shared folder it is
written and read with Spark's own file sources, whatever store that is; files
made elsewhere are read with ``read_files``. Chunks end between records and
hold about ``CHUNK_BYTES``, so memory is bounded by the largest record.

Defined results: a null html is an empty payload. Payloads of at least
``min_bytes`` that are equal share one response, that of the smallest page_id
(null ids last; among equal ids the smallest url); the others are revisits
without a body, also rows that repeat the response's in full. A record whose digest or length does not hold has
``valid`` false. Extra columns are not archived.

Scale: payload digests are the shuffle key, not payloads; the smallest page of
a digest is a partial aggregate, so a payload shared by a third of all pages
costs a row per task. Bodies are shuffled once, to the writers, by the key of
the whole row, so that copies spread over all tasks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_path

CHUNK_BYTES = 4 << 20
#: Input bytes the incremental inflater takes at a time.
FEED_BYTES = 64 << 10
#: Fixed header values.
VERSION, DATE = b"WARC/1.1", "2024-01-01T00:00:00Z"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def _urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _uri(url) -> str:
    """A header value holds no line breaks."""
    return (url or "").replace("\r", "%0D").replace("\n", "%0A")


def encode_record(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool) -> bytes:
    """One gzip member with one record."""
    head = HTTP_HEAD % len(payload)
    block = head if revisit else head + payload
    lines = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)),
             ("WARC-Date", DATE), ("WARC-Target-URI", _uri(url)),
             ("WARC-Payload-Digest", f"sha256:{digest}"),
             ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        lines.insert(2, ("WARC-Refers-To", _urn(refers_to)))
        lines.insert(3, ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    raw = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines).encode() + b"\r\n" + block + b"\r\n\r\n"
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(raw) + deflate.flush()


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Inflated gzip members of a byte stream, one at a time; a member may
    cross chunk borders. A damaged member ends the stream with ValueError."""
    inflate, out = zlib.decompressobj(31), []
    for chunk in chunks:
        view, at = memoryview(chunk), 0
        while at < len(view):
            piece = view[at:at + FEED_BYTES]
            try:
                out.append(inflate.decompress(piece))
            except zlib.error as e:
                raise ValueError(f"damaged gzip member: {e}") from e
            at += len(piece) - len(inflate.unused_data)
            if inflate.eof:
                yield b"".join(out)
                inflate, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("archive ends within a gzip member")


def decode_record(member: bytes) -> dict:
    """Headers, framing and digests of one record; ``valid`` is False when the
    framing or a digest does not hold."""
    head, _, rest = member.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    fields = {}
    for line in lines:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("ascii", "replace")] = value.strip().decode("utf-8", "replace")
    try:
        length = int(fields.get("content-length", "-1"))
    except ValueError:
        length = -1
    block = rest[:length] if length >= 0 else b""
    ok = first.startswith(b"WARC/") and len(block) == length and rest[length:] == b"\r\n\r\n"
    ok = ok and fields.get("warc-block-digest", "") in ("", f"sha256:{hashlib.sha256(block).hexdigest()}")
    _, sep, body = block.partition(b"\r\n\r\n")
    payload = body if sep else block
    kind = fields.get("warc-type", "")
    digest = hashlib.sha256(payload).hexdigest()
    claimed = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind != "revisit":
        ok = ok and claimed in ("", digest)

    def number(name):
        text = fields.get(name, "")
        text = text.removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text.lstrip("-").isdigit() else None

    return {"page_id": number("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": kind,
            "payload": None if kind == "revisit" else payload,
            "payload_digest": claimed if kind == "revisit" else digest,
            "refers_to": number("warc-refers-to"), "valid": bool(ok)}


def plan_records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """(page_id, url, html, payload_digest, record_type, refers_to): which
    records are responses and which revisits."""
    page_id, url, html = F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit(""))
    key = ("payload_digest", "id", "no_id", "link", "no_url")  # nulls apart, so that plain equality holds
    p = pages.select(F.sha2(html, 256).alias("payload_digest"), F.coalesce(page_id, F.lit(0)).alias("id"), page_id.isNull().alias("no_id"),
                     F.coalesce(url, F.lit("")).alias("link"), url.isNull().alias("no_url"), html.alias("html"))
    # Only digests that occur twice need a decision, which goes to each row by its whole key, without a body.
    order = F.struct("no_id", "id", "link")
    rows = p.where(F.octet_length("html") >= min_bytes).select(*key).groupBy(*key).agg(F.count("*").alias("n"))
    shared = (rows.groupBy("payload_digest").agg(F.min(order).alias("low"), F.sum("n").alias("n"))
              .where("n > 1").select("payload_digest", "low"))
    decided = rows.select(*key).join(shared, "payload_digest").select(*key, "low", (F.col("low") == order).alias("is_low"))
    # Bodies are shuffled once. Rows that agree in full travel as one with their number, of which one at most is the response.
    bodies = p.groupBy(*key).agg(F.first("html").alias("html"), F.count("*").alias("n"))
    each = (bodies.join(decided, list(key), "left")
            .select(*key, "html", "low", "is_low", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("k")))
    again = F.col("low").isNotNull() & (~F.col("is_low") | (F.col("k") > 1))
    return each.select(
        F.when(~F.col("no_id"), F.col("id")).alias("page_id"), F.when(~F.col("no_url"), F.col("link")).alias("url"), "html", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again & ~F.col("low.no_id"), F.col("low.id")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, min_bytes: int = 100) -> None:
    """Archive ``pages`` under ``path``: a table (archive, seq, content), an
    archive per writing task."""
    from pyspark import TaskContext

    def encode(batches):
        archive, seq, parts, size = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for row in batch.to_pylist():
                payload = row["html"].encode("utf-8", "surrogatepass")
                member = encode_record(row["page_id"], row["url"], payload, row["payload_digest"],
                                       row["refers_to"], row["record_type"] == "revisit")
                parts.append(member)
                size += len(member)
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_pydict({"archive": [archive], "seq": [seq], "content": [b"".join(parts)]},
                                                     schema=schema)
                    seq, parts, size = seq + 1, [], 0
        if parts:
            yield pa.RecordBatch.from_pydict({"archive": [archive], "seq": [seq], "content": [b"".join(parts)]},
                                             schema=schema)

    schema = pa.schema([("archive", pa.int32()), ("seq", pa.int32()), ("content", pa.binary())])
    chunks = plan_records(pages, min_bytes).mapInArrow(encode, "archive int, seq int, content binary")
    # Already compressed; a codec on top only costs time.
    chunks.write.option("compression", "none").parquet(path)




def _decoder(keep_payload: bool):
    def decode(batches):
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload", pa.binary()), ("payload_bytes", pa.int64()),
                            ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("valid", pa.bool_())])
        rows = []
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("content"))
            for content in column:
                for member in members(iter([content.as_py()])):
                    record = decode_record(member)
                    payload = record["payload"]
                    record["payload_bytes"] = None if payload is None else len(payload)
                    if not keep_payload:
                        record["payload"] = None
                    rows.append(record)
                    if len(rows) >= 500:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return decode


_READ_SCHEMA = ("page_id long, url string, record_type string, payload binary, payload_bytes long, "
                "payload_digest string, refers_to long, valid boolean")


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """Records of the archives under ``path``, read member by member. Chunks
    end between records, so any task can read any chunk."""
    # Few chunks to an Arrow batch: a chunk is megabytes, not a short row.
    return (spark.read.schema("archive int, seq int, content binary").parquet(path)
            .select("content").mapInArrow(_decoder(keep_payload), _READ_SCHEMA))


def read_files(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """Records of ``.warc.gz`` files, an archive to a task; a file is one row
    of Spark's ``binaryFile`` source and must stay under 2 GB."""
    return (spark.read.format("binaryFile").load(path).select("content")
            .mapInArrow(_decoder(keep_payload), _READ_SCHEMA))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """``records`` with the payload size of each revisit taken from the
    response of the same digest."""
    sizes = (records.where("record_type = 'response'").groupBy("payload_digest")
             .agg(F.max("payload_bytes").alias("full_bytes")))
    return (records.join(sizes, "payload_digest", "left")
            .withColumn("payload_bytes", F.coalesce("payload_bytes", "full_bytes")).drop("full_bytes"))


def archive_and_read(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """Round trip through archives in the shared folder."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, min_bytes)
    return resolve_revisits(read_archives(spark, path, keep_payload=False))
