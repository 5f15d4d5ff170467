"""WARC archives: written whole, then normalised to a gzip member per record with an index."""

from __future__ import annotations

import hashlib
import json
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tourledger.llm.common import ensure_checkpoint_dir, pick

#: Payloads shorter than this are never replaced by revisits.
MIN_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 50_000
_CHUNK = 1 << 20
_LEVEL = 6
_DATE = "1970-01-01T00:00:00Z"  # archives are a function of the pages, so no clock is read
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _shared_uri(spark: SparkSession, name: str) -> str:
    folder = ensure_checkpoint_dir(spark)
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4()}"


def open_uri(uri: str) -> tuple[fs.FileSystem, str]:
    """The store of a URI or absolute path and the path in it."""
    scheme, colon, rest = uri.partition(":")
    if colon and scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if not colon:
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def records(pages: DataFrame) -> DataFrame:
    """A row per page: page_id, url, payload, sha1, refers_to and record_type.

    Of pages whose payloads of MIN_REVISIT_BYTES or more are equal (by SHA-256), those with
    the largest page_id are responses and the others revisit it. All shorter ones, and all
    of payloads that only null ids have, are responses. A null html is an empty payload.
    """
    rows = pick(pages, "page_id", "url", "html").select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("key", F.when(F.col("bytes") >= MIN_REVISIT_BYTES, F.sha2("payload", 256)))
    copies = rows.where("key is not null").groupBy("key").agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = copies.where("n > 1 and first is not null").drop("n")
    # The copies are the small side and are hashed; a hot payload's pages are split at run time.
    joined = rows.join(copies.hint("shuffle_hash"), "key", "left")
    revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", F.sha1("payload").alias("sha1"),
        F.when(revisit, F.col("first")).alias("refers_to"),
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
    )


def _identity(page_id: Column, url: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), F.coalesce(url, F.lit("")), digest))
    parts = [F.substring(h, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def record_text(rows: DataFrame) -> DataFrame:
    """Each record as WARC text, without its last line feed, which the writer adds.

    The target URI has its white space percent-encoded; a null url is left out.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20")
    body = F.when(F.col("record_type") == "revisit", "").otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _identity(F.col("page_id"), F.col("url"), F.col("sha1"))),
        line("WARC-Date", F.lit(_DATE)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        F.coalesce(line("X-Page-ID", F.col("page_id").cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("X-Payload-Length", F.octet_length("payload").cast("string")),
        F.when(F.col("record_type") == "revisit", F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("X-Refers-To-Page-ID", F.col("refers_to").cast("string")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(body).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, body, F.lit("\r\n\r")).alias("value"))


def write_monolithic(rows: DataFrame, uri: str) -> None:
    """The records as files that are one gzip stream each: Spark's own text files."""
    record_text(rows).write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", RECORDS_PER_FILE).text(uri)


class _Inflated:
    """The inflated bytes of a gzip stream, also of several one after another."""

    def __init__(self, stream):
        self.stream, self.inflate, self.held = stream, zlib.decompressobj(31), bytearray()

    def more(self) -> bool:
        data = self.stream.read(_CHUNK)
        if not data:
            return False
        while data:
            self.held += self.inflate.decompress(data)
            data = self.inflate.unused_data
            if self.inflate.eof:
                self.inflate = zlib.decompressobj(31)
            elif data:
                break
        return True

    def until(self, mark: bytes) -> bytes | None:
        """Everything up to and with the mark; None at the end of the stream."""
        seen = 0
        while (at := self.held.find(mark, seen)) < 0:
            seen = max(0, len(self.held) - len(mark))
            if not self.more():
                if self.held:
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        while len(self.held) < n:
            if not self.more():
                raise ValueError("the archive ends within a record")
        found = bytes(self.held[:n])
        del self.held[:n]
        return found


def read_records(stream) -> Iterator[tuple[dict[str, str], bytes, bytes]]:
    """Headers, block and raw bytes of each record of a gzipped WARC, inflated as it is read."""
    inflated = _Inflated(stream)
    while (head := inflated.until(b"\r\n\r\n")) is not None:
        headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if line)
        block = inflated.take(int(headers["Content-Length"]))
        yield headers, block, head + block + inflated.take(4)


def member(raw: bytes) -> bytes:
    """The bytes as a gzip member of their own; equal bytes give equal members."""
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite gzipped WARC files so that every record is a gzip member of its own.

    Each file under the URI ``source`` is inflated once, as a stream, and becomes a
    ``.warc.gz`` under ``target`` beside a ``.idx`` with a JSON line per record: offset, length,
    id and type. Returns the manifest: archive, index, records. A file's name has the attempt
    in it, and the manifest only names files of attempts that ended well, so lost executors
    leave no half archive behind that anyone reads.
    """
    # binaryFile lists the files and deals them out by size; no content is read through it.
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(source).select("path")
    schema = "archive string, index string, records bigint"

    def rewrite(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        attempt, number = context.taskAttemptId(), 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, own = open_uri(path)
                out, folder = open_uri(target)
                name = f"{folder}/archive-{context.partitionId():05d}-{attempt}-{number:04d}"
                number += 1
                offset = count = 0
                with store.open_input_stream(own, compression=None) as stream, out.open_output_stream(f"{name}.warc.gz", compression=None) as archive, out.open_output_stream(f"{name}.idx", compression=None) as index:
                    for headers, _, raw in read_records(stream):
                        packed = member(raw)
                        archive.write(packed)
                        entry = {"offset": offset, "length": len(packed), "id": headers["WARC-Record-ID"], "type": headers["WARC-Type"]}
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset, count = offset + len(packed), count + 1
                prefix = target.rstrip("/") + name[len(folder.rstrip("/")) :]
                yield pa.RecordBatch.from_arrays([pa.array([f"{prefix}.warc.gz"]), pa.array([f"{prefix}.idx"]), pa.array([count], pa.int64())], names=["archive", "index", "records"])

    store, folder = open_uri(target)
    store.create_dir(folder, recursive=True)
    manifest = f"{target.rstrip('/')}/manifest"
    files.mapInArrow(rewrite, schema).write.parquet(manifest)
    return spark.read.schema(schema).parquet(manifest)


def read_back(manifest: DataFrame) -> DataFrame:
    """A row per record, found through the indexes and read from the archives: page_id,
    payload_bytes, payload_digest, record_type, refers_to. Responses' figures are taken from
    the payload, revisits' from their headers."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = open_uri(archive)
                _, listed = open_uri(index)
                found: list[tuple] = []
                with store.open_input_file(path) as data, store.open_input_stream(listed, compression=None) as lines:
                    for entry in _json_lines(lines):
                        data.seek(entry["offset"])
                        headers, block, _ = next(read_records(pa.BufferReader(data.read(entry["length"]))))
                        found.append(_row(headers, block))
                        if len(found) >= 1000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)
                            found = []
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=names)

    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    return manifest.select("archive", "index").mapInArrow(read, schema)


def _json_lines(stream) -> Iterator[dict]:
    held = b""
    while chunk := stream.read(_CHUNK):
        *lines, held = (held + chunk).split(b"\n")
        yield from map(json.loads, lines)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    page, first = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    if headers["WARC-Type"] == "revisit":
        size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
    else:
        size, digest = len(block), hashlib.sha1(block).hexdigest()
    return None if page is None else int(page), size, digest, headers["WARC-Type"], None if first is None else int(first)


def archived_pages(pages: DataFrame) -> DataFrame:
    """Pages written to monolithic archives, normalised, and read back from the result.

    Every page row gives a row, equal ones too; an empty table gives none. Archives go to
    new folders under ``spark.checkpoint.dir``.
    """
    spark = pages.sparkSession
    whole, split = _shared_uri(spark, "warc-monolithic"), _shared_uri(spark, "warc")
    write_monolithic(records(pages), whole)
    manifest = normalise(spark, whole, split)
    return read_back(manifest.repartition(max(1, spark.sparkContext.defaultParallelism)))
