"""WARC archives: writing with payload deduplication, and a splittable reader.

Each record is a gzip member of its own.  Of records with equal payloads that
with the largest id is a ``response``; the others are ``revisit`` records that
refer to it and carry the HTTP headers without the payload.  Rows that repeat
the largest id are all responses.  A row without id is a revisit if another
row has its payload and an id, else a response.

The reader cuts files into byte ranges, one row each, and spreads them over
tasks.  A task looks for the gzip magic in its range, takes a place for a
record's start only if the member there decodes to a WARC header, and owns the
records that start in its range, reading on past its end for the last one.  So
a file of any size is read by many tasks and each record exactly once.

A member may hold several records (they share its place).  A member that begins
as a record and is cut short or broken, and a rest of one that holds no whole
record, give a row of type ``damaged`` without other fields.

Null payloads are written empty, null addresses left out.  Line breaks and
other control characters in addresses are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import filesystem, shuffle_width, write_once, written

MAGIC = b"\x1f\x8b\x08"  # gzip with deflate (fixed value)
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"  # the tables carry no capture time; a fixed one keeps archives reproducible
BLOCK = 1 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _safe(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_bytes(page_id, url: str | None, payload: bytes, refers_to=None) -> bytes:
    """One record as a gzip member; a revisit if ``refers_to`` is given."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
              ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    if url is not None:
        fields.append(("WARC-Target-URI", _safe(url)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


# --- reading ---------------------------------------------------------------

class _Window:
    """Reads of a file at any place, by blocks."""

    def __init__(self, f, size: int):
        self.f, self.size, self.at, self.held = f, size, 0, b""

    def read(self, at: int, n: int) -> bytes:
        n = max(0, min(n, self.size - at))
        if at < self.at or at + n > self.at + len(self.held):
            self.f.seek(at)
            self.at, self.held = at, self.f.read(min(max(n, BLOCK), self.size - at))
        return self.held[at - self.at:at - self.at + n]

    def find(self, what: bytes, at: int, end: int) -> int:
        """First place in [at, end) where ``what`` starts, or -1."""
        while at < end:
            part = self.read(at, min(BLOCK, end - at + len(what) - 1))
            k = part.find(what)
            if 0 <= k < end - at:
                return at + k
            at += max(1, len(part) - len(what) + 1)
        return -1


DAMAGED = {"version": None, "fields": {"warc-type": "damaged"}, "block": b""}


def _begins_as_record(raw: bytes) -> bool:
    try:
        return zlib.decompressobj(31).decompress(raw, len(VERSION)).startswith(b"WARC/1.")
    except zlib.error:
        return False


def _member(window: _Window, at: int) -> tuple[tuple[bytes, int] | None, bool]:
    """(content, end) of the gzip member at ``at`` if it decodes and begins as a WARC record, else None; and whether it begins so."""
    unpack, out, pos, valid = zlib.decompressobj(31), [], at, False
    step = 4096
    while not unpack.eof:
        raw = window.read(pos, step)
        if not raw:
            return None, valid
        try:
            out.append(unpack.decompress(raw))
        except zlib.error:
            return None, valid or _begins_as_record(window.read(at, 4096))
        pos += len(raw)
        if not valid:
            head = b"".join(out)[:len(VERSION)]
            if not head.startswith(b"WARC/1."[:len(head)]):
                return None, False
            valid = len(head) >= 7
        step = BLOCK
    return ((b"".join(out), pos - len(unpack.unused_data)) if valid else None), valid


def parse_record(content: bytes, at: int = 0) -> dict | None:
    """Header fields (lower-case names), version and block of the record at ``at``, and where it ends;
    None if there is no whole one."""
    split = content.find(b"\r\n\r\n", at)
    if split < 0:
        return None
    lines = content[at:split].decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    if not lines[0].startswith("WARC/1.") or not fields.get("content-length", "").isdigit():
        return None
    end = split + 4 + int(fields["content-length"])
    if end > len(content):
        return None
    return {"version": lines[0], "fields": fields, "block": content[split + 4:end], "end": end}


def parse_records(content: bytes) -> Iterator[dict]:
    """The records of a member, one after the other; a record of type ``damaged`` for a rest that holds none."""
    at = 0
    while at < len(content):
        record = parse_record(content, at)
        if record is None:
            yield DAMAGED
            return
        yield record
        at = record["end"]
        while content[at:at + 1] in (b"\r", b"\n"):
            at += 1


def records_in_range(f, size: int, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(place, record) of the records whose members start in [start, end) of an open file.

    A member that begins as a WARC record and does not decode to its end is one record of type ``damaged``;
    the search goes on behind its first byte.
    """
    window, at = _Window(f, size), start
    end = min(end, size)
    while at < end:
        at = window.find(MAGIC, at, end)
        if at < 0:
            return
        member, looks_valid = _member(window, at)
        if member is None:
            if looks_valid:
                yield at, DAMAGED
            at += 1  # the magic inside other data, or of a broken member
            continue
        for record in parse_records(member[0]):
            yield at, record
        at = member[1]


def byte_ranges(files: DataFrame, split_bytes: int) -> DataFrame:
    """Rows (file, size, start, end) that cover ``files`` (file, size)."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split_bytes).cast("long")))
    return files.filter("size > 0").withColumn("start", starts).withColumn("end", F.col("start") + split_bytes)


def read_records(spark: SparkSession, files: DataFrame, folder: str | None = None, split_bytes: int = 64 << 20,
                 with_block: bool = False) -> DataFrame:
    """Records of the archives in ``files`` (file, size; names in ``folder`` or whole URIs).

    Columns: file, place, record_type, record_id, target_uri, payload_digest,
    refers_to, payload_bytes (of the full payload, also for revisits), and the
    block if asked for.
    """
    ranges = byte_ranges(files.select("file", "size"), split_bytes).repartition(shuffle_width(spark))
    names = ["file", "place", "record_type", "record_id", "target_uri", "payload_digest", "refers_to", "payload_bytes"]
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64()]
    schema = ("file string, place long, record_type string, record_id string, target_uri string, "
              "payload_digest string, refers_to string, payload_bytes long")
    if with_block:
        names, kinds, schema = [*names, "block"], [*kinds, pa.binary()], schema + ", block binary"
    arrow = pa.schema(list(zip(names, kinds)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file_system, path = filesystem(f"{folder.rstrip('/')}/{row['file']}" if folder else row["file"])
                rows, held = [], 0
                with file_system.open_input_file(path) as f:
                    for place, record in records_in_range(f, row["size"], row["start"], row["end"]):
                        get = record["fields"].get
                        digest = get("warc-payload-digest")
                        out = {"file": row["file"], "place": place, "record_type": get("warc-type"),
                               "record_id": get("warc-record-id"), "target_uri": get("warc-target-uri"),
                               "payload_digest": digest.partition(":")[2] if digest else None,
                               "refers_to": get("warc-refers-to"), "payload_bytes": payload_size(record)}
                        if with_block:
                            out["block"] = record["block"]
                            held += len(record["block"])
                        rows.append(out)
                        if len(rows) >= 4096 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pylist(rows, schema=arrow)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return ranges.mapInArrow(run, schema)


def payload_size(record: dict) -> int:
    """Bytes of the payload that the record stands for: what follows the HTTP headers, or for a
    revisit the length they name."""
    head, found, rest = record["block"].partition(b"\r\n\r\n")
    if not found:
        return len(record["block"])
    if record["fields"].get("warc-type") == "revisit":
        for line in head.decode("latin-1").split("\r\n"):
            name, _, value = line.partition(":")
            if name.strip().lower() == "content-length" and value.strip().isdigit():
                return int(value.strip())
    return len(rest)


def read_archives(spark: SparkSession, path: str, split_bytes: int = 64 << 20, with_block: bool = True) -> DataFrame:
    """Records of all archives under ``path`` (any folder Spark can list and pyarrow can open)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.col("path").alias("file"), F.col("length").alias("size")))
    return read_records(spark, files, None, split_bytes, with_block)


# --- writing ---------------------------------------------------------------

def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = 1 << 30, id_col: str = "page_id",
                   url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write a record for each row into archives under ``folder``; returns their names and sizes.

    Payloads of ``least_bytes`` or more are deduplicated over the whole table:
    the largest id of each digest is an aggregate, joined back in a join whose
    hot keys (empty pages, error pages) Spark can split.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    largest = (rows.filter(F.octet_length("payload") >= least_bytes).groupBy("digest")
               .agg(F.max("id").alias("largest"), F.count("*").alias("n")).filter("n > 1")
               .select(F.concat("digest", F.lit("")).alias("same"), "largest"))  # another key: see components.apart
    rows = rows.join(largest, F.col("digest") == F.col("same"), "left").select(
        "id", "url", "payload",
        F.when(~F.col("id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        source = (row for batch in batches for i in range(0, batch.num_rows, 256) for row in batch.slice(i, 256).to_pylist())
        row = next(source, None)
        while row is not None:
            def members():
                nonlocal row
                size = 0
                while row is not None and size < file_bytes:
                    raw = record_bytes(row["id"], row["url"], row["payload"].encode(), row["refers_to"])
                    size += len(raw)
                    yield raw
                    row = next(source, None)

            name, size = write_once(folder, f"pages-{part:06d}-{number:04d}", members())
            number += 1
            yield pa.RecordBatch.from_pydict({"file": [name], "size": [size]})

    return written(spark, rows.mapInArrow(run, "file string, size long"), "warc-files")


def archive_index(pages: DataFrame, split_bytes: int = 64 << 20, **options) -> DataFrame:
    """Write ``pages`` as archives under the shared scratch folder and read them back: page_id,
    payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    records = read_records(spark, write_archives(pages, folder, **options), folder, split_bytes)

    def number(c: str):
        return F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")

    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          number("refers_to").alias("refers_to"))
