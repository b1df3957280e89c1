"""WARC archives: a writer for pages and a Python data source that reads archives.

The writer stores each page's payload once: of records with equal payloads the
one of the smallest id is the response, the others are revisits that refer to
it. Every task writes its own archives in a shared folder; only those that the
successful tasks report are listed and later read.

The data source plans one partition for each stretch of an archive, reads a
record's headers first, and passes over the block of a record that pushed
predicates on its type or headers refuse, or whose payload is not wanted.

A null payload is empty. Rows of one id and one payload share their record type;
rows with a null id are responses only where no other row has their payload.
Columns besides id, URL and payload are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith

from tessera.llm.common import chunks, scratch_dir

#: Bytes of an archive after which a task begins another one, and of a stretch that one partition reads.
ARCHIVE_BYTES, STRETCH_BYTES = 1 << 30, 64 << 20

LISTING = "_archives.json"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SCHEMA = (
    "warc_type string, record_id string, target_uri string, date string, payload_digest string, refers_to string, "
    "content_length long, payload_length long, payload binary"
)
#: Columns that are headers, on which predicates can be pushed.
HEADERS = {
    "warc_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
    "date": "warc-date",
    "payload_digest": "warc-payload-digest",
    "refers_to": "warc-refers-to",
}


def place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, name: str, url: str | None, date: str, digest: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One record. A revisit has the HTTP headers of the full payload, and no body."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if kind == "response" else http
    heads = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:page:{name}>"), ("WARC-Date", date)]
    if url is not None:
        heads.append(("WARC-Target-URI", " ".join(url.split())))  # a header is one line
    heads += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if refers_to is not None:
        heads += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in heads).encode() + b"\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
    stretch_bytes: int = STRETCH_BYTES,
) -> str:
    """Write a record for each row; the folder's URI. Payloads below ``least_bytes`` bytes are all responses."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = _packer(words).compress
        for part, data, at in chunks(batches, "payload", 1 << 22):
            raw = data.tobytes()
            each = [raw[a:b] for a, b in zip(at[:-1], at[1:])]
            columns = [pa.array([payload_digest(x) for x in each]), pa.array([len(x) for x in each], pa.int64()), pa.array([pack(x) for x in each], pa.binary())]
            yield pa.RecordBatch.from_arrays([part.column("name"), part.column("url"), *columns], names=["name", "url", "digest", "n_bytes", "body"])

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _unpacker(words).decompress
        system, base = place(folder)
        system.create_dir(base, recursive=True)
        out, done, path, size, starts = None, [], "", 0, [0]
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    # a task that runs again writes files of its own; those of a lost one are never listed
                    path, size, starts = f"{uuid.uuid4().hex}.warc", 0, [0]
                    out = system.open_output_stream(f"{base}/{path}")
                first = row["first"]
                again = row["n_bytes"] >= least_bytes and first is not None and row["name"] != first
                made = record("revisit" if again else "response", str(row["name"]), row["url"], date, row["digest"], unpack(row["body"]), str(first) if again else None)
                if size - starts[-1] >= stretch_bytes:
                    starts.append(size)
                out.write(made)
                size += len(made)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, size, starts))
                    out = None
        if out is not None:
            out.close()
            done.append((path, size, starts))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(d) for d in done], pa.string())], names=["archive"])

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("name"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(payload), F.lit("")).alias("payload"))
    # what pages have in common makes their way through the shuffle shorter; any sample does
    words = _shared_words([r[0].encode() for r in rows.select(F.substring("payload", 1, 20_000)).limit(400).collect()])
    packed = rows.mapInArrow(squeeze, f"name {kind}, url string, digest string, n_bytes long, body binary")
    light = rows.mapInArrow(_digests, f"name {kind}, digest string, n_bytes long")
    least = light.groupBy("digest").agg(F.min("name").alias("first")).select(F.col("digest").alias("d"), "first")
    joined = packed.join(least, F.col("digest") == F.col("d")).drop("d")  # a payload of very many pages is a skewed join, which Spark splits
    archives = [json.loads(r["archive"]) for r in joined.mapInArrow(store, "archive string").collect()]  # names and offsets of the archive files, in one job
    system, base = place(folder)
    system.create_dir(base, recursive=True)
    with system.open_output_stream(f"{base}/{LISTING}") as f:
        f.write(json.dumps(sorted(archives)).encode())
    return folder


def _shared_words(sample: list[bytes]) -> bytes:
    """A compression dictionary; empty where the sample is too small for one."""
    import zstandard

    try:
        return zstandard.train_dictionary(112_640, sample).as_bytes()
    except zstandard.ZstdError:
        return b""


def _packer(words: bytes):
    import zstandard

    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(words) if words else None)


def _unpacker(words: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words) if words else None)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, at in chunks(batches, "payload", 1 << 22):
        raw = data.tobytes()
        digests = [payload_digest(raw[a:b]) for a, b in zip(at[:-1], at[1:])]
        yield pa.RecordBatch.from_arrays([part.column("name"), pa.array(digests), pa.array(np.diff(at))], names=["name", "digest", "n_bytes"])


class Stretch(InputPartition):
    """Records of an archive that begin from ``start`` up to ``end`` (None: the file's end)."""

    def __init__(self, path: str, start: int, end: int | None):
        super().__init__(None)
        self.path, self.start, self.end = path, start, end


class WarcSource(DataSource):
    """``spark.read.format("warc").option("payload", "false").load(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = options["path"]
        self.payload = options.get("payload", "true").lower() == "true"
        self.check = options.get("check", "true").lower() == "true"
        self.wanted: list[tuple[str, str, tuple]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes predicates on single headers; yields the rest back to Spark."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column in HEADERS and isinstance(f, (EqualTo, EqualNullSafe)):
                self.wanted.append((column, "in", (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.wanted.append((column, "in", tuple(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.wanted.append((column, "starts", (f.value,)))
            elif column in HEADERS and isinstance(f, IsNotNull):
                self.wanted.append((column, "there", ()))
            else:
                yield f

    def partitions(self) -> list[Stretch]:
        system, base = place(self.folder)
        if system.get_file_info(f"{base}/{LISTING}").type == fs.FileType.File:
            with system.open_input_stream(f"{base}/{LISTING}") as f:
                listed = json.loads(f.read())
        else:
            files = system.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True))
            listed = [(x.path[len(base) :].lstrip("/"), x.size, [0]) for x in files if x.path.endswith((".warc", ".warc.gz"))]
        plan = [Stretch(path, a, b) for path, _, starts in listed for a, b in zip(starts, [*starts[1:], None])]
        return plan or [Stretch("", 0, 0)]

    def accepts(self, row: dict) -> bool:
        for column, how, values in self.wanted:
            got = row[column]
            if how == "in" and got not in values or how == "there" and got is None:
                return False
            if how == "starts" and not (got or "").startswith(values[0]):
                return False
        return True

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        system, base = place(self.folder)
        rows, size = [], 0
        with io.BufferedReader(system.open_input_file(f"{base}/{partition.path}"), 1 << 20) as raw:
            source = raw
            if partition.path.endswith(".gz"):
                import gzip

                source = gzip.GzipFile(fileobj=raw)
            for row in self.records(source, partition.start, partition.end):
                rows.append(row)
                size += 500 + len(row["payload"] or b"")
                if size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, ARROW)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, ARROW)

    def records(self, source, start: int, end: int | None) -> Iterator[dict]:
        if start:
            source.seek(start)
        while end is None or source.tell() < end:
            line = source.readline()
            if not line:
                return
            if not line.strip():
                continue
            if not line.startswith(b"WARC/"):
                raise ValueError(f"no record begins before byte {source.tell()}: {line[:40]!r}")
            heads = _headers(source)
            length = int(heads["content-length"])
            row = {c: heads.get(h) for c, h in HEADERS.items()}
            row["payload_digest"] = (row["payload_digest"] or "").removeprefix("sha1:") or None
            row |= {"content_length": length, "payload_length": None, "payload": None}
            if not self.accepts(row):
                source.seek(length, io.SEEK_CUR)
                continue
            begin = source.tell()
            if heads.get("content-type", "").startswith("application/http"):
                source.readline()
                http = _headers(source)
                row["payload_length"] = int(http["content-length"]) if "content-length" in http else None
            body = length - (source.tell() - begin)
            if self.payload and row["warc_type"] != "revisit":
                row["payload"] = source.read(body)
                if self.check and row["payload_digest"] not in (None, payload_digest(row["payload"])):
                    raise ValueError(f"{row['record_id']}: the payload's digest is another one")
            else:
                source.seek(body, io.SEEK_CUR)
            yield row


ARROW = pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]]) for c in SCHEMA.split(", ")])


def _headers(source) -> dict[str, str]:
    heads = {}
    while (line := source.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        heads[name.strip().lower()] = value.strip()
    return heads


def read_archives(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    """The records of the archives in a folder; without ``payload`` no block is decoded."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(folder)
