"""WARC writing with deduplication and a splittable reader.

Writer: one gzip member a record.  Of records with equal payloads of at least
``REVISIT_BYTES`` bytes the one with the smallest id is a ``response``, the
others are ``revisit`` records that name it and carry no payload; which is
decided by an aggregation of digests, not by looking at payloads together.
Files are written under a temporary name and renamed, so a task that runs
again leaves one whole file.

Reader: an archive is cut into byte ranges of ``SPLIT`` bytes, one row a task
can take.  A task scans its range for the gzip magic, takes a place for a
member only if it decodes to a record header with all that a record needs,
and owns every record that starts inside its range, reading past the end for
the last one.  A range without a start yields nothing, so records of any
length are read once, and one long archive is read by many tasks.

Defined results: null html is an empty payload; null ids never hold the
response for others; repeated rows (equal id and payload) are all responses if
theirs is the smallest id; control characters in urls are percent-encoded; an
empty table writes no archive and reads no record.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citystream.llm.common import (SharedFile, file_system, read, small_batches, stored,
                                   width)
from citystream.session import scratch_path

REVISIT_BYTES = 100
SPLIT = 4 << 20
READ = 1 << 20
MAGIC = b"\x1f\x8b\x08"
#: Bytes of a member that are decoded at first to look for its record header;
#: more are, up to its blank line, as long as it begins like one.
HEADER_BYTES = 1 << 16
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(page_id, url, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One record, gzip member and all; ``refers_to`` None: a response."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {size}",
            "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if revisit:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return (packer.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n"
                            + block + b"\r\n\r\n") + packer.flush())


def _writer(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        out, name = None, f"part-{TaskContext.get().partitionId():05d}.warc.gz"
        for b in batches:
            if not b.num_rows:
                continue
            out = out or SharedFile(folder, name)
            for row in zip(*(c.to_pylist() for c in b.columns)):
                page_id, url, text, digest, size, refers_to = row
                out.write(_record(page_id, url, text.encode("utf-8", "surrogatepass"), digest,
                                  size, refers_to))
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([out.size], pa.int64())],
                                             ["file", "size"])
    return run


def write_warc(pages: DataFrame, folder: str) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to ``folder``; -> (file, size)."""
    small_batches(pages.sparkSession)
    text = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = (pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                         text.alias("html"))
            .withColumn("size", F.octet_length("html").cast("long"))
            .withColumn("digest", F.sha2(F.col("html"), 256)))
    heads = (rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest")
             .agg(F.min("page_id").alias("head"), F.count("*").alias("n"))
             .where((F.col("n") > 1) & F.col("head").isNotNull()).select("digest", "head"))
    out = (rows.join(heads, "digest", "left")
           .select("page_id", "url", "html", "digest", "size",
                   F.when(~F.col("head").eqNullSafe(F.col("page_id")), F.col("head"))
                   .alias("refers_to")))
    return stored(out.mapInArrow(_writer(folder), "file string, size long"), "warc-files")


def _is_record(data: bytes) -> int:
    """Length of a whole record header, blank line included; 0: none."""
    if not data.startswith(b"WARC/1."):
        return 0
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return 0
    head = data[:end].lower()
    return end + 4 if b"\r\nwarc-type:" in head and b"\r\ncontent-length:" in head else 0


class _Window:
    """A file's bytes from a moving offset on, read in blocks."""

    def __init__(self, src, at: int):
        self.src, self.at, self.data = src, at, b""

    def more(self) -> bool:
        got = self.src.read_at(READ, self.at + len(self.data))
        self.data += got
        return bool(got)

    def drop(self, n: int) -> None:
        self.data, self.at = self.data[n:], self.at + n


def _member(win: _Window):
    """(record, bytes used) of the member at the window's start, or None."""
    unpack = zlib.decompressobj(31)
    got, fed, head, checked = [], 0, b"", False
    while not unpack.eof:
        if fed >= len(win.data) and not win.more():
            return None
        piece = win.data[fed:fed + READ]
        fed += len(piece)
        try:
            while not checked and piece and not unpack.eof:
                # The header may end in bytes not read yet, however long it is.
                head += unpack.decompress(piece, max(HEADER_BYTES, len(head)))
                piece = unpack.unconsumed_tail
                if not head.startswith(b"WARC/1."[:len(head)]):
                    return None
                if b"\r\n\r\n" in head:
                    if not _is_record(head):
                        return None
                    checked = True
                    got.append(head)
            if piece and not unpack.eof:
                got.append(unpack.decompress(piece))
        except zlib.error:
            return None
    return (b"".join(got), fed - len(unpack.unused_data)) if checked else None


def records(src, start: int, end: int) -> Iterator[bytes]:
    """Records of one archive whose member starts in [start, end)."""
    win = _Window(src, start)
    while win.at < end:
        at = win.data.find(MAGIC)
        if at < 0:
            keep = min(len(win.data), len(MAGIC) - 1)
            win.drop(len(win.data) - keep)
            if win.at >= end or not win.more():
                return
            continue
        win.drop(at)
        if win.at >= end:
            return
        found = _member(win)
        if found is None:
            win.drop(1)
            continue
        yield found[0]
        win.drop(found[1])


def parse(record: bytes) -> dict:
    """Header fields and payload of a record."""
    at = record.find(b"\r\n\r\n")
    head = dict(x.split(": ", 1) for x in
                record[:at].decode("utf-8", "surrogatepass").split("\r\n")[1:] if ": " in x)
    block = record[at + 4:at + 4 + int(head["Content-Length"])]
    body = block.find(b"\r\n\r\n")
    page = head["WARC-Record-ID"][len("<urn:page:"):-1]
    refers = head.get("WARC-Refers-To")
    return {"page_id": int(page) if page else None, "url": head["WARC-Target-URI"],
            "record_type": head["WARC-Type"],
            "refers_to": int(refers[len("<urn:page:"):-1]) if refers else None,
            "payload": None if refers else block[body + 4:],
            "payload_bytes": int(head["X-Payload-Length"]),
            "payload_digest": head["WARC-Payload-Digest"].partition(":")[2]}


_ROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                  ("refers_to", pa.int64()), ("payload", pa.binary()),
                  ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def _reader(folder: str, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        for b in batches:
            for name, start, end in zip(*(b.column(i).to_pylist() for i in range(3))):
                rows, size = [], 0
                with fs.open_input_file(f"{root}/{name}") as src:
                    for raw in records(src, start, end):
                        row = parse(raw)
                        if check and row["payload"] is not None:
                            own = hashlib.sha256(row["payload"]).hexdigest()
                            if own != row["payload_digest"] or \
                                    len(row["payload"]) != row["payload_bytes"]:
                                raise OSError(f"{name}: damaged record of page {row['page_id']}")
                        rows.append(row)
                        size += len(raw)
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(rows, _ROW)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _ROW)
    return run


def read_warc(files: DataFrame, folder: str, split: int = SPLIT, check: bool = True) -> DataFrame:
    """Records of the archives ``files`` (file, size) below ``folder``; each
    payload is held against its stored digest and length unless not ``check``."""
    spark = files.sparkSession
    small_batches(spark)
    ranges = (files.where("size > 0")
              .select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1,
                                                   F.lit(split).cast("long"))).alias("start"))
              .select("file", "start", (F.col("start") + split).alias("end"))
              .repartition(width(spark), "file", "start"))
    return ranges.mapInArrow(_reader(folder, check),
                             "page_id long, url string, record_type string, refers_to long, "
                             "payload binary, payload_bytes long, payload_digest string")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "llm-warc")
    files = write_warc(read(spark, sf_dir, "pages"), folder)
    return read_warc(files, folder).select("page_id", "payload_bytes", "payload_digest",
                                           "record_type", "refers_to")


WARC_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS size,
         sha256(coalesce(html, '')) AS digest FROM pages),
h AS (SELECT digest, min(page_id) AS head FROM p WHERE size >= 100 GROUP BY digest)
SELECT p.page_id, CAST(size AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN h.head IS NULL OR h.head = p.page_id THEN 'response' ELSE 'revisit' END
         AS record_type,
       CASE WHEN h.head <> p.page_id THEN h.head END AS refers_to
FROM p LEFT JOIN h ON p.digest = h.digest AND p.size >= 100
"""
