"""Operator 3: WARC archives with a Zstandard dictionary per file.

A file starts with a skippable frame that holds the dictionary; every record
after it is a frame of its own, compressed with that dictionary, so a record
can be read by itself. The dictionary is trained by the writing task on the
first ``SAMPLE_BYTES`` of its own records, which bounds its memory; records
after that are compressed as they come.

Equal payloads are archived once: of the rows with one digest the one with the
largest page id is a ``response`` record, the others are ``revisit`` records
that refer to it. The keeper of a digest comes from a map-side combined
maximum, never from a window over a group. Tasks write under names of their
own attempt and report them; only reported files are read back.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrix.llm.common import stored
from attrix.session import scratch_path

SKIPPABLE = 0x184D2A5D
SAMPLE_BYTES = 4 << 20
DICTIONARY_BYTES = 64 << 10
FILE_BYTES = 256 << 20
LEVEL = 6
_DATE = "1970-01-01T00:00:00Z"
_RECORD = re.compile(rb"WARC/1\.1\r\n")


def base32_of(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page(uri: str) -> int | None:
    name = uri.strip("<>").rpartition(":")[2]
    return None if name == "null" else int(name)


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str,
           refers_to: int | None, is_revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP head only."""
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:x-page:{page_id}")
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    head = [f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}",
            f"WARC-Target-URI: {target}", f"WARC-Date: {_DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {_uri(refers_to)}"]
    else:
        body += payload
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained where the samples allow it, else their own bytes as raw content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        raw = b"".join(samples)[-DICTIONARY_BYTES:].ljust(8, b"\0")
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class ArchiveWriter:
    """Writes records to one file; buffers only what the dictionary is trained on."""

    def __init__(self, stream):
        self.stream, self.held, self.size, self.frames = stream, [], 0, None
        self.written = 0

    def _start(self) -> None:
        dictionary = build_dictionary(self.held)
        data = dictionary.as_bytes()
        self._put(struct.pack("<II", SKIPPABLE, len(data)) + data)
        self.frames = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_content_size=True)
        for r in self.held:
            self._put(self.frames.compress(r))
        self.held = []

    def _put(self, data: bytes) -> None:
        self.stream.write(data)
        self.written += len(data)

    def add(self, rec: bytes) -> None:
        if self.frames is not None:
            self._put(self.frames.compress(rec))
            return
        self.held.append(rec)
        self.size += len(rec)
        if self.size >= SAMPLE_BYTES:
            self._start()

    def close(self) -> None:
        if self.frames is None and self.held:
            self._start()


def read_archive(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record of a file, one after the other."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the file does not start with a dictionary frame")
    data = stream.read(size)
    kind = zstandard.DICT_TYPE_FULLDICT if data[:4] == b"\x37\xa4\x30\xec" else zstandard.DICT_TYPE_RAWCONTENT
    frames = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data, dict_type=kind))
    text = io.BufferedReader(frames.stream_reader(stream, read_across_frames=True), 1 << 16)
    while line := text.readline():
        if not _RECORD.fullmatch(line):
            raise ValueError(f"not a WARC record: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := text.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
            headers[name] = value
        n = int(headers["Content-Length"])
        block = text.read(n)
        if len(block) != n or text.read(4) != b"\r\n\r\n":
            raise ValueError("a record is cut short")
        yield headers, block


def _write(root: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pa.fs.FileSystem.from_uri(root)
        out = stream = None
        name, records = "", 0

        def done() -> pa.RecordBatch:
            out.close()
            stream.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([records], pa.int64()),
                                               pa.array([out.written], pa.int64())], names=["name", "records", "bytes"])
        for b in batches:
            for page, url, html, size, digest, refers, revisit in zip(*(b.column(c).to_pylist() for c in (
                    "page_id", "url", "payload", "size", "digest", "refers_to", "revisit"))):
                if out is None:
                    name, records = f"{uuid.uuid4().hex}.warc.zst", 0
                    fs.create_dir(folder, recursive=True)
                    stream = fs.open_output_stream(f"{folder}/{name}")
                    out = ArchiveWriter(stream)
                out.add(record(page, url, (html or "").encode("utf-8", "surrogatepass"), size, base32_of(digest), refers, revisit))
                records += 1
                if out.written >= file_bytes:
                    yield done()
                    out = None
        if out is not None:
            yield done()
    return run


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   target: str | None = None, file_bytes: int = FILE_BYTES) -> tuple[str, DataFrame]:
    """Archive every row; returns the folder and the manifest (name, records, bytes).

    A null payload is empty; equal payloads (empty ones too) have one response,
    the row with the largest page id (of equal rows one); a null page id counts
    as smaller than any other. An empty table writes no file.
    """
    root = target or scratch_path(pages.sparkSession, "warc")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = stored(pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                               payload.alias("payload"), F.octet_length(payload).cast("long").alias("size"),
                               F.sha1(payload).alias("digest"), F.monotonically_increasing_id().alias("row")), "warc-rows")
    keepers = rows.groupBy("digest").agg(F.max(F.struct("page_id", "row")).alias("keep"))
    marked = rows.join(keepers, "digest").withColumn("revisit", F.col("row") != F.col("keep.row"))
    records = marked.select("page_id", "url", F.when(~F.col("revisit"), F.col("payload")).alias("payload"), "size", "digest",
                            F.when(F.col("revisit"), F.col("keep.page_id")).alias("refers_to"), "revisit")
    return root, stored(records.mapInArrow(_write(root, file_bytes), "name string, records long, bytes long"), "warc-manifest")


def read_archives(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record.

    Payloads of response records are hashed again and must match their digest.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = pa.fs.FileSystem.from_uri(root)
        for b in batches:
            for name in b.column("name").to_pylist():
                rows = []
                with fs.open_input_stream(f"{folder}/{name}") as f:
                    for h, block in read_archive(f):
                        digest = h["WARC-Payload-Digest"].partition(":")[2]
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        kind = h["WARC-Type"]
                        if kind == "response" and (len(payload) != size or base64.b32encode(
                                hashlib.sha1(payload).digest()).decode() != digest):
                            raise ValueError(f"{name}: payload of {h['WARC-Record-ID']} does not match its digest")
                        rows.append((_page(h["WARC-Record-ID"]), size, digest, kind,
                                     _page(h["WARC-Refers-To"]) if kind == "revisit" else None))
                cols = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    n = max(1, manifest.count())
    return manifest.select("name").repartition(n, "name").mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_round_trip(pages: DataFrame) -> DataFrame:
    return read_archives(pages.sparkSession, *write_archives(pages))
