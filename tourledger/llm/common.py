"""Shared helpers: column picking, Arrow text buffers, word spans and hashes in numpy."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

#: Texts are worked on in pieces of so many bytes; a longer text is a piece of its own.
PIECE_BYTES = 1 << 20
#: Powers up to so many bytes stay in a worker; for a longer text they are made anew.
POWERS_KEPT = 8 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly the columns named, also where others differ from them in case only."""
    at = [df.columns.index(name) for name in names]
    numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return numbered.select(*[F.col(f"c{i}").alias(name) for i, name in zip(at, names)])


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """All columns under the names c0, c1, ..., which nothing clashes with, and where each is."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), {old: new for old, new in reversed(list(zip(df.columns, names)))}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder and read back, without lineage.

    Spark removes shuffle files once the driver has collected the plans that made them; it is
    told to collect here, so that a chain of cuts holds little more than its last shuffles.
    """
    ensure_checkpoint_dir(df.sparkSession)
    gc.collect()
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.checkpoint(eager=True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; only where it is unset, one for tests."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to storage that all executors share")
        folder = tempfile.mkdtemp(prefix="checkpoints-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def schema_of(df: DataFrame, *more: StructField) -> StructType:
    return StructType([*df.schema.fields, *more])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and where each row's begin; null is empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterable[pa.RecordBatch], text: int, limit: int = PIECE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches of about ``limit`` text bytes, each with its text_bytes."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            own = offsets[begin : end + 1]
            yield batch.slice(begin, end - begin), data[own[0] : own[-1]], own - own[0]
            begin = end


def give_back() -> None:
    """Memory that arrays no longer use goes back to the system, where its allocator can; Spark
    keeps Python workers for later tasks, and they would keep it beside the JVM's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(work: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The function for ``mapInArrow``, giving back its memory when a task's batches are done."""

    @wraps(work)
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return run


def byte_set(ranges: Iterable[tuple[int, int]]) -> np.ndarray:
    """A table of 256 flags with the given inclusive ranges set."""
    flags = np.zeros(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


#: Bytes of tokens: all but space and 0x09-0x0D.
TOKEN_BYTES = ~byte_set([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of words: digits, letters and all of non-ASCII characters.
WORD_BYTES = byte_set([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
#: Lower-cases A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of bytes in ``inside``, never across rows, and the
    index of each row's first run (one more entry than rows)."""
    flags = inside[data]
    n = len(data)
    edges = offsets[(offsets > 0) & (offsets < n)]
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = flags[:-1]
    before[edges] = False
    begins = np.flatnonzero(flags & ~before)
    after = np.empty(n, bool)
    after[n - 1 :] = False
    after[:-1] = flags[1:]
    after[edges - 1] = False
    ends = np.flatnonzero(flags & ~after) + 1
    return begins, ends, np.searchsorted(begins, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


class _Powers:
    """Powers of the hash base and of its inverse, as far as they have been needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_Powers.up) >= n:
        return _Powers.up, _Powers.down
    found = []
    for base in (_BASE, _INVERSE):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps, out=steps))
    if n <= POWERS_KEPT:
        _Powers.up, _Powers.down = found
    return found[0], found[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power, from which ``span_hash`` takes any span's hash."""
    up, _ = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of bytes; equal spans have equal hashes."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[begins]) * down[begins] + _ODD)


def words8(data: np.ndarray) -> np.ndarray:
    """At each byte, the eight bytes from there on as one integer; the end is padded with 0."""
    padded = np.zeros(-(-len(data) // 8) * 8 + 8, np.uint8)
    padded[: len(data)] = data
    return np.lib.stride_tricks.as_strided(padded.view(np.uint64), shape=(len(data) + 1,), strides=(1,))


def binary(arrays: Iterable[np.ndarray]) -> pa.Array:
    return pa.array([np.ascontiguousarray(a).tobytes() for a in arrays], pa.binary())
