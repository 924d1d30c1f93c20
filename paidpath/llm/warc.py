"""WARC archives (operator 6): a writer, and a reader that splits compressed archives.

Every record is a gzip member of its own. Archives are written by Spark, so that a task that
runs again leaves no second copy, into whatever store the path names; each closes with one
zero byte, which gzip allows as padding.

The reader cuts archives into byte ranges. A task looks for gzip's magic bytes in its range,
takes a place as a record only if the member's first bytes decode to a WARC header, and owns
the records that start inside its range, reading on past its end where one does.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paidpath.llm.tables import scratch

ARCHIVE_BYTES = 16 << 20  # an archive is closed when it has grown to this
RANGE_BYTES = 4 << 20
STEP = 256 << 10
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # uuid's namespace for URLs


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One gzip member: a response, or a revisit of page ``refers_to`` without payload."""
    digest = base32_sha1(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head + payload if refers_to is None else head
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)),
              ("WARC-Date", DATE), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"),
              ("X-Payload-Length", str(len(payload))), ("Content-Length", str(len(block)))]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    whole = b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    return press.compress(whole) + press.flush()


def with_revisits(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``page_id, url, html, refers_to``: of equal payloads of at least ``min_bytes`` bytes
    all but that of the largest page_id refer to it."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"))
    leaders = rows.groupBy("digest").agg(F.max("page_id").alias("leader"), F.count("*").alias("n")).where("n > 1")
    small = F.octet_length(F.coalesce("html", F.lit(""))) < min_bytes
    return rows.join(leaders.select("digest", "leader"), "digest", "left").select(
        "page_id", "url", "html", F.when(small | (F.col("leader") == F.coalesce("page_id", F.col("leader") - 1)), F.lit(None)).otherwise(
            F.col("leader")).cast("long").alias("refers_to"))


def write_archives(rows: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes ``rows`` (page_id, url, html, refers_to) as archives of about ``archive_bytes``
    under ``path``. A null html is an empty payload."""
    def press(batches):
        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to")]
            for values in zip(*columns, strict=True):
                page_id, url, html, refers_to = (v.as_py() for v in values)
                held.append(record(page_id, url, (html or "").encode(), refers_to))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["archive"])

    archives = rows.select("page_id", "url", "html", "refers_to").mapInArrow(press, "archive binary")
    # the text writer puts a row's bytes out as they are, and the separator after it
    (archives.select(F.col("archive").cast("string").alias("value")).write
     .option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path))


def _open(uri: str):
    """A file of any store that Arrow reaches, for reading at places."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem().open_input_file("/" + uri[5:].lstrip("/"))
    store, path = fs.FileSystem.from_uri(uri)
    return store.open_input_file(path)


class _Window:
    """Bytes of a file from a place on, read in steps as they are asked for."""

    def __init__(self, file, start: int):
        self.file, self.at, self.size = file, start, file.size()
        self.held = b""

    def upto(self, end: int) -> bool:
        """Holds the bytes before ``end``; whether the file has any more."""
        while self.at + len(self.held) < min(end, self.size):
            have = self.at + len(self.held)
            self.held += self.file.read_at(min(max(STEP, end - have), self.size - have), have)
        return self.at + len(self.held) < self.size

    def drop(self, start: int) -> None:
        self.held, self.at = self.held[start - self.at:], start


def _header(text: bytes) -> tuple[dict[str, str], int] | None:
    """Named fields (names in lower case) and the header's length; None if it is none."""
    if not text.startswith(b"WARC/1.") or (end := text.find(b"\r\n\r\n")) < 0:
        return None
    fields = {}
    for line in text[:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return (fields, end + 4) if fields.get("content-length", "").isdigit() and "warc-type" in fields else None


def _member(window: _Window, start: int) -> tuple[bytes, int] | None:
    """The decoded member at ``start`` and where it ends, or None if it is no WARC record."""
    d, out, at = zlib.decompressobj(31), [], start
    size, header = 0, False
    while not d.eof:
        window.upto(at + STEP)
        part = window.held[at - window.at:at - window.at + STEP]
        if not part:
            return None
        try:
            out.append(d.decompress(part))
        except zlib.error:
            return None
        at += len(part)
        size += len(out[-1])
        if not header:
            text = b"".join(out)
            if text[:7] != b"WARC/1."[:len(text[:7])] or size > 1 << 20 and b"\r\n\r\n" not in text:
                return None
            header, out = b"\r\n\r\n" in text, [text]
    return b"".join(out), at - len(d.unused_data)


def records_in(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, fields, block) of the records of an archive that start in [start, end)."""
    window, at = _Window(file, start), start
    while at < end:
        window.drop(at)
        window.upto(min(at + STEP, end) + len(MAGIC) - 1)
        found = window.held.find(MAGIC, 0, min(STEP, end - at) + len(MAGIC) - 1)
        if found < 0:
            at = min(at + STEP, end)
            continue
        at += found
        member = _member(window, at)
        head = _header(member[0]) if member else None
        if head is None:
            at += 1
            continue
        fields, begin = head
        yield at, fields, member[0][begin:begin + int(fields["content-length"])]
        at = member[1]


def read_archives(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row for each record under ``path``: ``archive, offset, warc_type, fields`` (map,
    names in lower case), ``payload`` (the block, of an HTTP message its body)."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")  # contents are not read
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(range_bytes).cast("long"))
    ranges = files.where("length > 0").select("path", F.explode(starts).alias("start")).withColumn("end", F.col("start") + range_bytes)

    def read(batches):
        for batch in batches:
            for uri, start, end in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                with _open(uri) as file:
                    for place, fields, block in records_in(file, start, end):
                        if fields.get("content-type", "").startswith("application/http"):
                            block = block[block.find(b"\r\n\r\n") + 4:]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([uri]), pa.array([place]), pa.array([fields["warc-type"]]),
                             pa.array([list(fields.items())], pa.map_(pa.string(), pa.string())), pa.array([block], pa.binary())],
                            names=["archive", "offset", "warc_type", "fields", "payload"])

    # a task for each range, up to what the cluster can use
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return ranges.repartition(max(1, min(ranges.count(), tasks)), "path", "start").mapInArrow(
        read, "archive string, offset long, warc_type string, fields map<string,string>, payload binary")


def archived_pages(pages: DataFrame, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Writes ``pages`` (page_id, url, html) as archives in the shared folder and reads them
    back: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` per page. Length
    and digest of a response are those of the payload that was read; a revisit has none, so
    its header tells. A null html is an empty payload, a null url is left out, a null page_id
    stays null; repeated rows of the largest page_id are all responses."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(with_revisits(pages, min_bytes), path, archive_bytes)
    rows = read_archives(pages.sparkSession, path, range_bytes)
    field = lambda name: F.col("fields")[name]

    def digest(batches):
        for batch in batches:
            kinds, payloads = batch.column("record_type").to_pylist(), batch.column("payload")
            own = [base32_sha1(p.as_buffer()) if k == "response" else None for k, p in zip(kinds, payloads, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(own, pa.string())],
                                             names=[*batch.schema.names[:5], "read_digest"])

    wide = rows.select(field("x-page-id").cast("long").alias("page_id"), F.col("warc_type").alias("record_type"),
                       field("x-refers-to-page-id").cast("long").alias("refers_to"),
                       F.when(F.col("warc_type") == "response", F.octet_length("payload").cast("long")).otherwise(
                           field("x-payload-length").cast("long")).alias("told_bytes"),
                       F.regexp_replace(field("warc-payload-digest"), "^sha1:", "").alias("told_digest"), "payload")
    named = wide.mapInArrow(digest, "page_id long, record_type string, refers_to long, told_bytes long, told_digest string, read_digest string")
    return named.select("page_id", F.col("told_bytes").alias("payload_bytes"), F.coalesce("read_digest", "told_digest").alias("payload_digest"),
                        "record_type", "refers_to")
