"""WARC archives: writing records as segments, reading them back and reassembling.

Writing: of records with equal payloads of at least ``min_bytes`` bytes that with the largest id is
the response and the others are revisits of it.  A response's block is an HTTP message whose body is
in chunked transfer framing; blocks over ``segment_bytes`` are cut into a first segment and
``continuation`` records that name the origin, their number and, in the last, the total length.
Files are gzip-compressed and hold ``RECORDS`` records at most, so one fits in a task's memory.

Reading: records are found by their Content-Length.  Whole records are decoded where they are read;
segments are grouped by origin, ordered by number and checked against the total length, so only
records that were cut are shuffled.  Framing is then undone and the digest of the payload taken anew.

Null payloads are empty; a null address is left out; rows with a null id are responses and come back
with a null id; rows that repeat an id are records of their own.
"""

from __future__ import annotations

import base64
import gzip
import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS = 1024
CHUNK = 8192
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
_FIELDS = "record string, page_id long, record_type string, refers_to long, digest string, number int, total long, block binary"


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    out = []
    for at in range(0, len(payload), size):
        part = payload[at:at + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join(out) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of chunked framing; chunk extensions and trailers are skipped."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2:end + 2 + size])
        if body[end + 2 + size:end + 4 + size] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        at = end + 4 + size


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _record_rows(segment_bytes: int):
    def run(batches):
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            out, held = [], 0
            for page, url, payload, digest, refers in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                page, url, digest, refers = page.as_py(), url.as_py(), digest.as_py(), refers.as_py()
                name = f"<urn:x-page:{'' if page is None else page}:{task}-{row}>"
                row += 1
                digest = base64.b32encode(bytes.fromhex(digest)).decode()
                at = [] if url is None else [("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A"))]
                if refers is not None:
                    out.append(_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name), *at, ("WARC-Refers-To", f"<urn:x-page:{refers}>"),
                                        ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                                        ("WARC-Payload-Digest", f"sha1:{digest}")], b""))
                else:
                    block = _HTTP + chunked(payload.as_py())
                    first = [("WARC-Type", "response"), ("WARC-Record-ID", name), *at, ("WARC-Payload-Digest", f"sha1:{digest}"),
                             ("Content-Type", "application/http; msgtype=response")]
                    if len(block) <= segment_bytes:
                        out.append(_record(first, block))
                    else:
                        cuts = range(0, len(block), segment_bytes)
                        for k, cut in enumerate(cuts, 1):
                            fields = first if k == 1 else [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}:{k}>"), ("WARC-Segment-Origin-ID", name)]
                            fields = [*fields, ("WARC-Segment-Number", str(k))]
                            if k == len(cuts):
                                fields.append(("WARC-Segment-Total-Length", str(len(block))))
                            out.append(_record(fields, block[cut:cut + segment_bytes]))
                held += len(out[-1])
                if held > 8 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    return run


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, segment_bytes: int = 32 << 10) -> None:
    """Write one WARC record per row of ``pages`` under ``path``."""
    d = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                     F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    d = d.withColumn("digest", F.sha1("payload")).withColumn("size", F.length("payload"))
    last = d.groupBy("digest", "size").agg(F.max("page_id").alias("last"), F.count("*").alias("n")).where(
        F.col("last").isNotNull() & (F.col("n") > 1) & (F.col("size") >= min_bytes)).drop("n")
    d = d.join(last, ["digest", "size"], "left").withColumn(
        "refers_to", F.when((F.col("page_id") != F.col("last")), F.col("last")))
    records = d.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(_record_rows(segment_bytes), "value binary")
    # the text writer puts the records' bytes down as they are, each with the two line ends that close it
    records.select(F.col("value").cast("string")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option(
        "maxRecordsPerFile", RECORDS).text(path)


def parse_records(data: bytes):
    """(fields, block) of every record of an uncompressed archive."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        yield fields, data[end + 4:end + 4 + size]
        at = end + 4 + size + 4


def _page(name: str | None):
    part = name.strip("<>").split(":")[2] if name else ""
    return int(part) if part else None


def _parse_rows(segments: bool):
    """Rows of the records that are segments, or of those that are whole."""

    def run(batches):
        names = ["record", "page_id", "record_type", "refers_to", "digest", "number", "total", "block"]
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            for content in batch.column("content"):
                rows = []
                for f, block in parse_records(gzip.decompress(content.as_py())):
                    number = f.get("WARC-Segment-Number")
                    if (number is not None) != segments:
                        continue
                    origin = f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"])
                    total = f.get("WARC-Segment-Total-Length")
                    rows.append((origin, _page(origin), f["WARC-Type"], _page(f.get("WARC-Refers-To")), f.get("WARC-Payload-Digest"),
                                 number and int(number), total and int(total), block))
                columns = list(zip(*rows)) if rows else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record with its whole block: (record, page_id, record_type, refers_to, digest, number, total, block).

    ``number`` is the number of segments found (null: never cut); a missing segment or a wrong total
    length raises.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.gz").load(path).select("content")
    whole = files.mapInArrow(_parse_rows(False), _FIELDS)
    parts = files.mapInArrow(_parse_rows(True), _FIELDS)
    head = parts.groupBy("record").agg(
        F.max("page_id").alias("page_id"), F.max(F.when(F.col("number") == 1, F.col("record_type"))).alias("record_type"),
        F.max("refers_to").alias("refers_to"), F.max("digest").alias("digest"), F.count("*").cast("int").alias("number"),
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"))
    block = F.expr("aggregate(parts, cast('' as binary), (x, p) -> concat(x, p.block))")
    good = (F.col("parts")[F.size("parts") - 1]["number"] == F.size("parts")) & (F.length("block") == F.col("total"))
    cut = head.withColumn("block", block).withColumn(
        "block", F.when(good, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("segments are missing of "), "record")).cast("binary")))
    return whole.unionByName(cut.drop("parts"))


def _payload_rows(batches):
    for batch in batches:
        out = []
        for block, digest in zip(batch.column("block"), batch.column("digest")):
            head, _, body = block.as_py().partition(b"\r\n\r\n")
            payload = unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body
            found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if digest.as_py() != f"sha1:{found}":
                raise ValueError("a payload does not have the digest that its record names")
            out.append((len(payload), found, payload))
        size, found, payload = zip(*out) if out else ([], [], [])
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(size, pa.int64()), pa.array(found, pa.string()), pa.array(payload, pa.binary())],
                                         ["page_id", "payload_bytes", "payload_digest", "payload"])


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, payload); a revisit's payload is null, its length that of the response."""
    records = read_records(spark, path)
    found = records.where("record_type = 'response'").mapInArrow(
        _payload_rows, "page_id long, payload_bytes long, payload_digest string, payload binary")
    sizes = found.groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    again = records.where("record_type = 'revisit'").select("page_id", "refers_to", F.expr("substr(digest, 6)").alias("payload_digest"))
    again = again.join(sizes, ["refers_to", "payload_digest"], "left")
    return found.select("page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "payload").unionByName(
        again.select("page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to", F.lit(None).cast("binary").alias("payload")))
