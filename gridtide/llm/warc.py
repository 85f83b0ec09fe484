"""WARC archives of pages, each compressed with a Zstandard dictionary of its own.

A `.warc.zst` file starts with a skippable frame (magic 0x184D2A5D) that holds the dictionary, trained on
records of this very archive; every record follows as a frame of its own. An archive too small to train on
has no dictionary and no such frame.

Spark finds equal payloads first: of those at least `least` bytes long, the page with the largest id is
archived in full, and the others become revisit records that name it. Each task then cuts its rows into archives of
about `ARCHIVE_BYTES` and holds one at a time. It writes to any file system that pyarrow opens by URI, under
a name no other attempt uses, and reports what it wrote; `read` takes only reported archives, so what a lost
or repeated task left behind is never read. Files are read back as whole rows, one archive at a time.

Defined cases. Null html is the empty payload. A null id is written as such and comes back null; it never
refers to others and is nobody's reference, but a copy of a page with an id revisits it. Rows that repeat an id and
payload are all archived alike. A missing url gives the record's id as its target; blanks and control
characters in a url are escaped. A payload that does not fit its digest on reading is an error.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm.common import durable, ship, whole
from gridtide.sources.scratch import make_dir

ARCHIVE_BYTES = 16 << 20  # records before compression
DICTIONARY_BYTES, SAMPLE_BYTES = 64 << 10, 2 << 20  # of a dictionary; of the records it is trained on
LEAST_SAMPLES = 16
LEVEL = 3
LEAST_REVISIT = 1000  # payload bytes
MAGIC = 0x184D2A5D
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WRITTEN = "path string, records long, bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, "
    "payload binary"
)


def _urn(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").rpartition(":")[2]
    return int(number) if number else None


def _escaped(url: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record: a response, or a revisit of the page `refers_to`."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_urn(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_urn(page_id) if not url else _escaped(url)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{_urn(refers_to)}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """Trained on records spread evenly over the archive, up to SAMPLE_BYTES of them."""
    step = max(1, sum(map(len, records)) // SAMPLE_BYTES)
    samples = [r for r in records[::step] if len(r) <= SAMPLE_BYTES // 8]
    if len(samples) < LEAST_SAMPLES:
        return None
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    try:
        return zstandard.train_dictionary(size, samples, k=1024, d=8, level=LEVEL)
    except zstandard.ZstdError:  # too little, or nothing in common
        return None


def archive(records: list[bytes]) -> bytes:
    """The bytes of a `.warc.zst` file."""
    trained = _dictionary(records)
    out = io.BytesIO()
    if trained is not None:
        trained.precompute_compress(level=LEVEL)
        out.write(struct.pack("<II", MAGIC, len(trained.as_bytes())) + trained.as_bytes())
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
    for one in records:
        out.write(compressor.compress(one))
    return out.getvalue()


def parse(content: bytes) -> Iterator[tuple]:
    """Rows of RECORDS from the bytes of an archive; payload null for revisits."""
    start, trained = 0, None
    if len(content) >= 8 and struct.unpack_from("<I", content)[0] == MAGIC:
        start = 8 + struct.unpack_from("<I", content, 4)[0]
        trained = zstandard.ZstdCompressionDict(content[8:start])
    frames = io.BytesIO(content)
    frames.seek(start)
    plain = io.BufferedReader(
        zstandard.ZstdDecompressor(dict_data=trained).stream_reader(frames, read_across_frames=True), 1 << 20
    )
    while line := plain.readline():
        if line.strip() != b"WARC/1.1":
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        head = {}
        while (line := plain.readline().rstrip(b"\r\n")):
            name, _, value = line.decode().partition(": ")
            head[name] = value
        block = plain.read(int(head["Content-Length"]))
        plain.read(4)
        http, _, payload = block.partition(b"\r\n\r\n")
        size = int(http.rpartition(b"Content-Length: ")[2])
        digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
        full = head["WARC-Type"] == "response"
        if full and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
            raise ValueError(f"payload of {head['WARC-Record-ID']} does not fit its digest")
        target = head["WARC-Target-URI"]
        own = head["WARC-Record-ID"].strip("<>")
        yield (
            _page(own), None if target == own else target, head["WARC-Type"],
            _page(head["WARC-Refers-To"]) if not full else None, size, digest, payload if full else None,
        )


def with_references(pages: DataFrame, id_col: str, html_col: str, least: int) -> DataFrame:
    """`pages` as __id, __payload (binary), __url and __refers: the page whose equal payload stands for this one's."""
    payload = whole(F.col(html_col)).cast("binary")
    keyed = pages.select(
        F.col(id_col).cast("long").alias("__id"), F.col("url").alias("__url"), payload.alias("__payload"),
        F.when(F.octet_length(payload) >= least, F.sha2(payload, 256)).alias("__same"),
    )
    held = keyed.where("__same IS NOT NULL").groupBy("__same").agg(
        F.max("__id").alias("__refers"), F.count(F.lit(1)).alias("__rows")
    )
    several = durable(held.where("__rows > 1").select("__same", "__refers"), "equal-payloads")
    refers = F.when(~F.col("__id").eqNullSafe(F.col("__refers")), F.col("__refers"))
    return keyed.join(several, "__same", "left").select("__id", "__url", "__payload", refers.alias("__refers"))


def write(
    pages: DataFrame, folder: str, id_col: str = "page_id", html_col: str = "html", least: int = LEAST_REVISIT,
    archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Writes archives of the pages (id, url, html) under `folder`; the table of them, one row each: path, records, bytes."""
    ship(pages.sparkSession)
    make_dir(pages.sparkSession, folder)

    def store(records: list[bytes]) -> pa.RecordBatch:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base)
        content, name = archive(records), f"pages-{uuid.uuid4().hex}.warc.zst"
        with system.open_output_stream(f"{base}/.{name}", compression=None) as out:
            out.write(content)
        system.move(f"{base}/.{name}", f"{base}/{name}")
        return pa.record_batch({"path": [name], "records": [len(records)], "bytes": [len(content)]})

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size = [], 0
        for batch in batches:
            ids, urls, payloads, refers = batch.columns
            for page_id, url, payload, refers_to in zip(ids, urls, payloads, refers):
                one = record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py())
                records.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield store(records)
                    records, size = [], 0
        if records:
            yield store(records)

    rows = with_references(pages, id_col, html_col, least)
    return durable(rows.mapInArrow(tasks, WRITTEN), "archives")


def read(spark: SparkSession, folder: str, archives: DataFrame) -> DataFrame:
    """The records of the archives that `write` reported: page_id, url, record_type, refers_to, payload_bytes,
    payload_digest (lower-case hex), payload (null for revisits)."""
    ship(spark)
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.read.format("binaryFile").schema(schema).option("pathGlobFilter", "*.warc.zst")
    named = files.load(folder).select(F.substring_index("path", "/", -1).alias("path"), "content")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in RECORDS.split(", ")]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for row in parse(content.as_py()):
                    rows.append(row)
                    size += row[4]
                    if size >= 4 << 20:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    reported = archives.select("path")
    return named.join(reported, "path", "left_semi").select("content").mapInArrow(
        records, RECORDS
    )
