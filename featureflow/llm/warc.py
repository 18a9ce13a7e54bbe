"""WARC archives with an embedded Zstandard dictionary, written and read by Spark tasks.

An archive is one ``.warc.zst`` file: a leading skippable frame (magic
0x184D2A5D) that holds the dictionary, then one Zstandard frame per record, so
a record can be read without the others.  The dictionary is trained on the
archive's own first records.  Of records with equal payloads the one with the
smallest page id is a ``response``, the others are ``revisit`` records that
refer to it and carry no payload.

Archives go to the shared checkpoint folder under a name of the task's partition,
the archive's running number in it and the records' first and last key, written
under a temporary name and renamed, so a task that is run again leaves one
complete file, and no two archives share a name whatever rows repeat.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from featureflow.llm.common import stored

SKIPPABLE = 0x184D2A5D
DICTIONARY = 64 << 10              # bytes of a dictionary at most
TRAINING = 1 << 20                 # record bytes a dictionary is trained on
ARCHIVE = 32 << 20                 # payload bytes after which a task starts another archive
LEVEL = 3


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit names the record it refers to and has an empty block."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", f"<urn:page:{page_id}>"),
            ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("X-Payload-Length", str(len(payload)))]
    if url is not None:
        # white space and control characters would break the header line
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f-\xa0]", lambda m: quote(m[0]), url)))
    if revisit:
        head += [("WARC-Refers-To", f"<urn:page:{refers_to}>"),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    head += [("Content-Type", "text/html"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode("utf-8") + b"\r\n" + block + b"\r\n\r\n"


def parse(data: bytes):
    """(headers, block) of each record of uncompressed WARC data."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC/1.1 record")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        stop = end + 4 + int(headers["Content-Length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError("record length does not match its Content-Length")
        yield headers, data[end + 4:stop]
        at = stop + 4


def train_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from records of about TRAINING bytes; empty when they are too few or too alike to train on."""
    sample, size = [], 0
    for r in records:
        for at in range(0, min(len(r), 64 << 10), 8 << 10):
            sample.append(r[at:at + (8 << 10)])
            size += len(sample[-1])
        if size >= TRAINING:
            break
    try:
        return zstandard.train_dictionary(min(DICTIONARY, max(256, size // 10)), sample, k=512, d=8,
                                          level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b""


def pack(records: list[bytes]) -> bytes:
    """A whole archive: skippable frame with the dictionary, then a frame per record."""
    raw = train_dictionary(records)
    extra = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
    if raw:
        extra["dict_data"].precompute_compress(level=LEVEL)
    press = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, **extra)
    return b"".join([struct.pack("<II", SKIPPABLE, len(raw)), raw, *map(press.compress, records)])


def unpack(archive: bytes) -> bytes:
    """The uncompressed records of an archive, one after the other."""
    magic, size = struct.unpack_from("<II", archive)
    if magic != SKIPPABLE:
        raise ValueError("no dictionary frame")
    raw = archive[8:8 + size]
    extra = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
    body = memoryview(archive)[8 + size:]
    return zstandard.ZstdDecompressor(**extra).stream_reader(body, read_across_frames=True).read()


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(folder: str) -> str:
    """``folder`` as a URI (Spark prints local paths as file:/path)."""
    if folder.startswith("file:/") and not folder.startswith("file://"):
        return "file://" + folder[len("file:"):]
    return folder if "://" in folder else f"file://{folder}"


def _writer(folder: str):
    def write(records: list[bytes], first, last, part: int, number: int) -> tuple[str, int]:
        fs, base = pafs.FileSystem.from_uri(folder)
        keys = hashlib.sha1(repr((first, last, len(records))).encode()).hexdigest()[:20]
        name = f"{part:06d}-{number:06d}-{keys}.warc.zst"
        data = pack(records)
        held = f"{base}/.{name}-{uuid.uuid4().hex}"
        with fs.open_output_stream(held) as f:
            f.write(data)
        fs.move(held, f"{base}/{name}")
        return name, len(data)

    def run(batches):
        records, size, first, last = [], 0, None, None
        done = []
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("id", "url", "html", "sha", "first"))
            for page, url, html, sha, ref in zip(*columns, strict=True):
                payload = (html or "").encode("utf-8")
                digest = base64.b32encode(sha).decode()
                key = (page, url, digest)
                first, last = key if not records else first, key
                records.append(record(page, url, payload, digest, ref))
                size += len(records[-1])
                if size >= ARCHIVE:
                    done.append((*write(records, first, last, part, len(done)), len(records)))
                    records, size = [], 0
        if records:
            done.append((*write(records, first, last, part, len(done)), len(records)))
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.string()),
                                          pa.array([d[1] for d in done], pa.int64()),
                                          pa.array([d[2] for d in done], pa.int64())], ["archive", "bytes", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """Write every row of ``pages`` as one record below ``folder``; returns (archive, bytes, records).

    A NULL html is an empty payload.  Payloads of at least ``least_bytes``
    bytes that are equal share one response, that of the smallest id; smaller
    ones are all responses.  Rows that repeat the smallest id with the same
    payload are responses too (a record cannot refer to itself), and rows with
    a NULL id are responses and never referred to.  Other columns are not read.
    """
    folder = _uri(folder)
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    body = F.coalesce("html", F.lit("")).cast("binary")
    keyed = rows.withColumn("sha", F.unhex(F.sha1(body)))
    shared = (keyed.filter((F.length(body) >= least_bytes) & F.col("id").isNotNull()).groupBy("sha")
              .agg(F.min("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("sha", "first"))
    # a group of equal payloads may be large: only ids and digests are grouped, and the join's skew is split
    kind = (F.length(body) >= least_bytes) & (F.col("first") != F.col("id"))
    placed = (keyed.join(shared, "sha", "left")
              .select("id", "url", "html", "sha", F.when(kind, F.col("first")).alias("first"))
              .sortWithinPartitions("id", "sha", "url"))        # a task run again writes the same files
    return stored(placed.mapInArrow(_writer(folder), "archive string, bytes long, records long"), "warc-manifest")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archives below ``folder``: (page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, payload).  Payload and its length and digest are taken from the block of a response and from the
    headers of a revisit (whose payload is NULL); a response whose block does not match its digest raises."""

    def page(urn: str | None):
        value = None if urn is None else urn[len("<urn:page:"):-1]
        return None if value in (None, "None") else int(value)

    def run(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                rows = []
                for head, block in parse(unpack(content)):
                    digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                    response = head["WARC-Type"] == "response"
                    if response and base32_sha1(block) != digest:
                        raise ValueError(f"payload of {head['WARC-Record-ID']} does not match its digest")
                    uri = head.get("WARC-Target-URI")
                    rows.append((page(head["WARC-Record-ID"]), uri,
                                 len(block) if response else int(head["X-Payload-Length"]), digest,
                                 head["WARC-Type"], page(head.get("WARC-Refers-To")), block if response else None))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                        (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()))],
                    ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").schema(
        StructType.fromDDL("path string, modificationTime timestamp, length long, content binary")).load(_uri(folder)))
    return files.select("content").mapInArrow(
        run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
             "refers_to long, payload binary")
