"""WARC archives of individually compressed records that share a Zstandard dictionary."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from massloom.llm.common import kept
from massloom.session import scratch_dir

#: The skippable frame that holds the dictionary.
SKIPPABLE = 0x184D2A5D
DICT_BYTES = 32 << 10
#: Records from which an archive's dictionary is built: its first ones, up to so many bytes.
SAMPLE_BYTES = 2 << 20
#: Bytes of a record that serve as a sample; records are written whole.
SAMPLE_RECORD = 1 << 16
ARCHIVE_BYTES = 256 << 20
DATE = "2024-01-01T00:00:00Z"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _id(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page(record_id: str) -> int | None:
    value = record_id.rpartition(":")[2].rstrip(">")
    return None if value == "null" else int(value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, revisits: bool, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. A revisit has the headers of the whole payload, but not its bytes."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisits else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisits else 'response'}", f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        # a line break or another control character would end the header
        head.append("WARC-Target-URI: " + "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in url))
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisits:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {_id(refers_to)}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


class ArchiveWriter:
    """Holds back the first records as the dictionary's sample, then writes frame after frame."""

    def __init__(self, out: BinaryIO, dict_bytes: int, sample_bytes: int, level: int):
        self.out, self.dict_bytes, self.sample_bytes, self.level = out, dict_bytes, sample_bytes, level
        self.waiting: list[bytes] | None = []
        self.held = self.size = self.records = 0

    def add(self, record: bytes) -> None:
        self.records += 1
        if self.waiting is None:
            self._frame(record)
            return
        self.waiting.append(record)
        self.held += len(record)
        if self.held >= self.sample_bytes:
            self._start()

    def _start(self) -> None:
        try:
            made = zstandard.train_dictionary(self.dict_bytes, [r[:SAMPLE_RECORD] for r in self.waiting], k=1024, d=8).as_bytes()
        except zstandard.ZstdError:  # too few or too small records for a dictionary
            made = b""
        packed = zstandard.ZstdCompressor().compress(made)
        self._write(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.packer = zstandard.ZstdCompressor(level=self.level, dict_data=zstandard.ZstdCompressionDict(made) if made else None)
        for record in self.waiting:
            self._frame(record)
        self.waiting = None

    def _frame(self, record: bytes) -> None:
        self._write(self.packer.compress(record))

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> None:
        if self.waiting is not None:
            self._start()
        self.out.close()


def read_records(source: BinaryIO) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive, read as a stream."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("the archive does not begin with a dictionary frame")
    made = zstandard.ZstdDecompressor().decompress(source.read(size))
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(made) if made else None)
    stream = unpacker.stream_reader(source, read_across_frames=True, read_size=1 << 20)
    buffer = b""

    def more(least: int = 1) -> bool:
        nonlocal buffer
        got = stream.read(max(least, 1 << 18))
        buffer += got
        return bool(got)

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer:
                    raise ValueError("the archive ends within a record")
                return
        first, *lines = buffer[:end].decode("utf-8", "surrogatepass").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        head = dict(line.split(": ", 1) for line in lines)
        buffer, size = buffer[end + 4 :], int(head["Content-Length"]) + 4
        if len(buffer) < size:
            parts, have = [buffer], len(buffer)
            while have < size:
                got = stream.read(size - have)
                if not got:
                    raise ValueError("the archive ends within a record")
                parts.append(got)
                have += len(got)
            buffer = b"".join(parts)
        yield head, buffer[: size - 4]
        buffer = buffer[size:]


def pyarrow_uri(folder: str) -> str:
    """A folder as pyarrow names it: Hadoop's names of S3 are all ``s3`` there."""
    scheme, sep, rest = folder.partition("://")
    return f"s3://{rest}" if sep and scheme in ("s3a", "s3n") else folder


def filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path) of a folder as Spark names it."""
    return pafs.FileSystem.from_uri(pyarrow_uri(folder))


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0,
    dict_bytes: int = DICT_BYTES, sample_bytes: int = SAMPLE_BYTES, archive_bytes: int = ARCHIVE_BYTES, level: int = 3,
) -> DataFrame:
    """Write every row as a record into archives in ``folder``; the manifest (path, records, bytes) of
    those that count.

    Of rows with equal payloads of at least ``least_bytes``, that with the largest id is the
    response and the others revisit it; rows that share the largest id are all responses. Null html
    is an empty payload; a null id is smaller than any other; a null url gets no header. An archive
    is written by one task under a name of its own and counts only if its task ends well, as the
    manifest is a table that Spark commits. Tasks hold one dictionary sample and one batch of rows.
    """
    body = F.coalesce(html, F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("html"), F.sha1(body.cast("binary")).alias("sha"))
    slim = pages.select(F.col(page_id).cast("long").alias("page_id"), F.sha1(body.cast("binary")).alias("sha"), F.octet_length(body).alias("size"))
    top = slim.where(F.col("size") >= least_bytes).groupBy("sha").agg(F.max("page_id").alias("top"), F.count("*").alias("copies")).where("copies > 1")
    revisits = slim.join(top, "sha").where(~F.col("page_id").eqNullSafe(F.col("top")))
    revisits = revisits.groupBy(F.col("page_id").alias("p"), F.col("sha").alias("s")).agg(F.any_value("top").alias("top"), F.lit(True).alias("again"))
    # the only shuffle of payloads is by id and digest, which no group of copies makes uneven
    marked = rows.join(revisits, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("sha") == F.col("s")), "left").select(
        "page_id", "url", "html", F.coalesce("again", F.lit(False)).alias("again"), "top")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, base = filesystem(folder)
        fs.create_dir(base)
        writer, name, done = None, "", []

        def finish() -> None:
            writer.close()
            done.append((name, writer.records, writer.size))

        for batch in batches:
            for page, at, text, again, to in zip(batch["page_id"], batch["url"], batch["html"], batch["again"], batch["top"], strict=True):
                if writer is None:
                    name = posixpath.join(base, f"{uuid.uuid4().hex}.warc.zst")
                    writer = ArchiveWriter(fs.open_output_stream(name), dict_bytes, sample_bytes, level)
                page, to = (None if pd.isna(x) else int(x) for x in (page, to))
                payload = text.encode("utf-8", "surrogatepass")
                writer.add(record_bytes(page, at, payload, _digest(payload), again, to))
                if writer.size >= archive_bytes:
                    finish()
                    writer = None
        if writer is not None:
            finish()
        yield pd.DataFrame(done, columns=["path", "records", "bytes"])

    # ids must not pass through floats
    marked = marked.withColumns({c: F.col(c).cast("string") for c in ("page_id", "top")})
    return kept(marked.mapInPandas(write, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """Every record of the archives: (page_id, payload_bytes, payload_digest, record_type, refers_to, url).

    A response's digest is computed from the payload that was read and must be the header's; a
    revisit's size and digest are those of its headers.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, _ = filesystem(folder)
        columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

        def frame(rows: list[tuple]) -> pd.DataFrame:
            parts = list(zip(*rows, strict=True)) or [()] * len(columns)
            kinds = dict.fromkeys(("page_id", "payload_bytes", "refers_to"), "Int64")  # ids must not pass through floats
            return pd.DataFrame({c: pd.array(p, dtype=kinds.get(c, "object")) for c, p in zip(columns, parts, strict=True)})

        for batch in batches:
            for path in batch["path"]:
                rows = []
                with fs.open_input_stream(path) as source:
                    for head, block in read_records(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind, digest = head["WARC-Type"], head["WARC-Payload-Digest"].partition(":")[2]
                        if kind == "response" and _digest(payload) != digest:
                            raise ValueError(f"{path}: payload of {head['WARC-Record-ID']} does not have its digest")
                        size = int(http.rpartition(b"Content-Length: ")[2])
                        refers = _page(head["WARC-Refers-To"]) if kind == "revisit" else None
                        rows.append((_page(head["WARC-Record-ID"]), size, digest, kind, refers, head.get("WARC-Target-URI")))
                        if len(rows) >= 10_000:
                            yield frame(rows)
                            rows = []
                yield frame(rows)

    n = max(1, manifest.count())
    return manifest.select("path").repartition(n).mapInPandas(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive_round_trip(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives, by default in the shared folder, and return what is read back."""
    folder = folder or scratch_dir(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, **options), folder)
