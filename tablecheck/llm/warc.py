"""WARC archives written and read as a chunked record table.

A payload travels as rows ``(record, chunk number, data)`` of bounded size.  The writer puts
a record's header before its first chunk and appends the others as they come; the
reader streams an archive and emits chunk rows that carry the digest and the length of
the payload up to and including that chunk.  The last chunk row therefore holds the whole payload's
digest, and no step needs a whole record in memory.

Payloads of at least ``least`` bytes that are equal (SHA-256) share one response record, that with
the smallest id; the others become revisit records, whose HTTP header keeps the full length.

Archives are written below the shared folder through ``pyarrow.fs``, one file per task
attempt; only files named in the committed manifest are read, so a retried task leaves no
duplicate.  Every record is a gzip member.  Files are cut at ``file_bytes`` and read by a task each, so reading stays parallel.

Edge cases: a null payload is empty; empty and small payloads are always responses; rows that repeat
the id of the response are responses too, under the same record id; a row of a null id refers to the response like any other, is
never referred to, and is a response where all ids of its group are null; an empty table gives an empty archive;
other columns are ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import materialise, new_folder

CHUNK_BYTES = 1 << 16
#: Compression level of a record; reading tasks at most, whatever the number of files.
LEVEL, MAX_READERS = 3, 10_000
CHUNKS = "record_id string, chunk_no long, data binary, payload_bytes long, payload_digest string, is_last boolean, record_type string, refers_to string, target_uri string, declared_digest string"


def plan_records(df: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", least: int = 100) -> DataFrame:
    """``(id, uri, payload, n_bytes, digest, refers_to)``; ``refers_to`` is null for responses."""
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(uri_col), F.lit("")).alias("uri"), F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("n_bytes"), F.sha2("payload", 256).alias("digest"))
    # Only ids and digests are shuffled to find repeated payloads; a payload meets the written list of revisits, and moves for that only if
    # the list is too large for the planner to broadcast.
    large = rows.where(F.col("n_bytes") >= least).select("id", "digest")
    first = large.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = large.join(first, "digest").where(~F.col("id").eqNullSafe(F.col("first"))).select(F.col("id").alias("again"), F.col("digest").alias("same"), "first").distinct()
    again = materialise(again, "revisits")
    rows = rows.join(again, (F.col("digest") == F.col("same")) & F.col("id").eqNullSafe(F.col("again")), "left")
    return rows.select("id", "uri", "payload", "n_bytes", "digest", F.col("first").alias("refers_to"))


def chunk_rows(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each record's payload as rows of at most ``chunk_bytes`` in order; a revisit is one empty chunk."""
    n = F.when(F.col("refers_to").isNull(), F.greatest(F.lit(0), F.ceil(F.col("n_bytes") / chunk_bytes) - 1)).otherwise(0).cast("int")
    data = F.when(F.col("refers_to").isNull(), F.substring("payload", F.col("chunk_no") * chunk_bytes + 1, F.lit(chunk_bytes))).otherwise(F.lit(b""))
    return records.withColumn("chunk_no", F.explode(F.sequence(F.lit(0), n))).select("id", "uri", "n_bytes", "digest", "refers_to", "chunk_no", data.alias("data"))


def _record_id(id_) -> str:
    return f"<urn:record:{json.dumps(id_, default=str)}>"


def _header(id_, uri: str, n_bytes: int, digest: str, refers_to) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", _record_id(id_)), ("WARC-Target-URI", " ".join(uri.split())), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha256:{digest}")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(http) + (n_bytes if refers_to is None else 0))]
    return "WARC/1.1\r\n".encode() + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + http


def write_archives(chunks: DataFrame, file_bytes: int = 1 << 30) -> DataFrame:
    """Write chunk rows to WARC files, each record a gzip member of its own; returns the manifest ``(path, n_records, n_bytes)``."""
    spark, folder = chunks.sparkSession, new_folder(chunks.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        task = TaskContext.get()
        out, files, member = None, [], None
        for batch in batches:
            ids, uris, sizes, digests, refers, numbers = (c.to_pylist() for c in batch.columns[:6])
            for i, data in enumerate(batch.column(6)):
                if numbers[i] == 0:
                    if member is not None:
                        out.write(member.compress(b"\r\n\r\n") + member.flush())
                        if out.tell() >= file_bytes:
                            out = _close(out, files)
                    if out is None:
                        name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{len(files):04d}.warc.gz"
                        out = store.open_output_stream(f"{base}/{name}", compression=None)
                        files.append([f"{folder}/{name}", 0, 0])
                    files[-1][1] += 1
                    member = zlib.compressobj(LEVEL, wbits=31)
                    out.write(member.compress(_header(ids[i], uris[i], sizes[i], digests[i], refers[i])))
                out.write(member.compress(data.as_buffer()))
        if out is not None:
            out.write(member.compress(b"\r\n\r\n") + member.flush())
            _close(out, files)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*files)) or [()] * 3, (pa.string(), pa.int64(), pa.int64()))], names=["path", "n_records", "n_bytes"])

    return materialise(chunks.mapInArrow(run, "path string, n_records long, n_bytes long"), "manifest")


def _close(out, files: list) -> None:
    files[-1][2] = out.tell()
    out.close()


def _fields(stream) -> dict[bytes, str]:
    """Header lines up to the empty one; empty at the end of the stream."""
    found: dict[bytes, str] = {}
    while (line := stream.readline().rstrip(b"\r\n")) or not found:
        if not line:
            return found
        key, _, value = line.partition(b":")
        found[key.lower()] = value.strip().decode()
    return found


def stream_archive(stream, chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of one archive, read in pieces of ``chunk_bytes``."""
    while warc := _fields(stream):
        left = int(warc[b"content-length"])
        begun = stream.tell()
        http = _fields(stream)
        left -= stream.tell() - begun
        kind, refers = warc[b"warc-type"], warc.get(b"warc-refers-to")
        digest, total, number = hashlib.sha256(), 0, 0
        tail = (kind, refers, warc[b"warc-target-uri"], warc[b"warc-payload-digest"].removeprefix("sha256:"))
        while True:
            data = stream.read(min(chunk_bytes, left)) if left else b""
            if left and not data:
                raise EOFError("an archive ends inside a record")
            left -= len(data)
            total += len(data)
            digest.update(data)
            if kind == "revisit":  # carries no payload; what it stands for is declared
                yield (warc[b"warc-record-id"], 0, b"", int(http[b"content-length"]), tail[3], True, *tail)
            else:
                yield (warc[b"warc-record-id"], number, data, total, digest.copy().hexdigest(), left == 0, *tail)
            number += 1
            if not left:
                break
        stream.readline()
        stream.readline()


def read_archives(manifest: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The chunk table of the archives in ``manifest``; the files are dealt over as many tasks as there are files, ``MAX_READERS`` at most."""
    names = [x.split()[0] for x in CHUNKS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_(), *[pa.string()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with pa.BufferedInputStream(store.open_input_file(place), 1 << 20) as raw, gzip.GzipFile(fileobj=raw) as stream:
                    for row in stream_archive(_Lines(stream), chunk_bytes):
                        rows.append(row)
                        held += len(row[2]) + 200
                        if held >= 1 << 22:
                            yield give(rows)
                            rows, held = [], 0
                if rows:
                    yield give(rows)

    files = manifest.select("path")
    return files.repartitionByRange(max(1, min(files.count(), MAX_READERS)), "path").mapInArrow(run, CHUNKS)


class _Lines:
    """``readline`` and ``read`` over an Arrow stream, with a small buffer."""

    def __init__(self, stream, size: int = 1 << 16):
        self.stream, self.size, self.buffer, self.at, self.past = stream, size, b"", 0, 0

    def tell(self) -> int:
        return self.past + self.at

    def _more(self) -> bool:
        data = self.stream.read(self.size)
        self.past += self.at
        self.buffer, self.at = self.buffer[self.at :] + data, 0
        return bool(data)

    def readline(self) -> bytes:
        while (end := self.buffer.find(b"\n", self.at)) < 0:
            if not self._more():
                end = len(self.buffer) - 1
                break
        line = self.buffer[self.at : end + 1]
        self.at = end + 1
        return line

    def read(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n and self._more():
            pass
        data = self.buffer[self.at : self.at + n]
        self.at += len(data)
        return data
