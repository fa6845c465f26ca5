"""Landing files: framed payloads and poll metadata."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAGIC, VERSION = b"\x89GRT", 1
META = "timestamp double, content_type string, response_type string, digest string, status_code int, error_body string, error_type string, error_message string, drift_missing_required array<string>, drift_extras array<string>"
PATH = r"([^/]+)/(?:bins|metadata)/.*?(\d{4})[-/](\d{2})[-/](\d{2})/"


def frame(payloads: list[bytes]) -> bytes:
    """K5: a framed file: header, then length, sha256 and bytes of each payload."""
    body = b"".join(struct.pack(">I", len(p)) + hashlib.sha256(p).digest() + p for p in payloads)
    return MAGIC + bytes([VERSION]) + body


def unframe(content: bytes) -> Iterator[tuple[bytes, str, str | None]]:
    """(payload, digest, error). A bad header is one row; a short or corrupt frame ends the file; a file without
    the magic is one bare payload, as older ones are."""
    if content[:4] != MAGIC:
        yield content, hashlib.sha256(content).hexdigest(), None
        return
    if len(content) < 5 or content[4] != VERSION:
        yield b"", "", "bad_header"
        return
    at = 5
    while at < len(content):
        if at + 36 > len(content):
            yield b"", "", "truncated"
            return
        (size,) = struct.unpack_from(">I", content, at)
        digest, payload = content[at + 4 : at + 36], content[at + 36 : at + 36 + size]
        if len(payload) < size:
            yield b"", "", "truncated"
            return
        if hashlib.sha256(payload).digest() != digest:
            yield b"", "", "corrupt"
            return
        yield payload, digest.hex(), None
        at += 36 + size


def payloads(files: DataFrame) -> DataFrame:
    """(path, ord, payload, digest, error) of binaryFile rows (path, content)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                rows = [(path, i, *x) for i, x in enumerate(unframe(content or b""))]
                if rows:
                    p, o, b, d, e = zip(*rows)
                    yield pa.RecordBatch.from_pydict({"path": p, "ord": pa.array(o, pa.int64()), "payload": pa.array(b, pa.binary()), "digest": d, "error": pa.array(e, pa.string())})

    return files.select("path", "content").mapInArrow(run, "path string, ord long, payload binary, digest string, error string")


def landed(frames: DataFrame, polls: DataFrame) -> DataFrame:
    """Each payload's time: the earliest poll with its digest, else the number in the file's name."""
    first = polls.filter("digest is not null").groupBy("digest").agg(F.floor(F.min("timestamp")).cast("long").alias("__t"))
    named = F.regexp_extract("path", r"(\d+)\.bin$", 1).try_cast("long")
    rows = frames.filter("error is null").join(first, "digest", "left")
    return rows.withColumn("fetched_at", F.coalesce("__t", named)).drop("__t", "error")


def read_bins(spark: SparkSession, path: str) -> DataFrame:
    """S3."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").option("recursiveFileLookup", "true").load(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Polls, with the file that they come from; lines that aren't JSON give nulls."""
    return spark.read.schema(META).option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.jsonl").json(path).withColumn("path", F.input_file_name())


def discover(files: DataFrame, before: str | None = None) -> DataFrame:
    """The (feed, day) pairs that paths name, whole days before `before`; other paths are skipped."""
    rows = files.select(F.regexp_extract("path", PATH, 1).alias("feed"), F.concat_ws("-", *[F.regexp_extract("path", PATH, i) for i in (2, 3, 4)]).alias("day"))
    rows = rows.filter("feed <> ''").distinct()
    return rows.filter(F.col("day") < before) if before else rows
