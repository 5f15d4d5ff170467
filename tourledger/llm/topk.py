"""Exact top-k inner-product search by multi-resolution segment statistics."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tourledger.llm.common import pick

TOP = 5
QUERY_EVERY = 50
SCALE = 256
#: Queries that one scan answers; a larger query set takes several scans.
QUERY_BLOCK = 4096
#: Segments of the statistics, coarse to fine.
LEVELS = (1, 4, 16)
_ROWS = 2048
_QUERIES = 512
_LONG = (1 << 63) - 1


def segment_statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Each segment's mean and standard deviation, both times the root of its length, so that
    products of these rows bound inner products."""
    edges = np.linspace(0, vectors.shape[1], segments + 1).astype(int)
    found = []
    for low, high in zip(edges[:-1], edges[1:]):
        if low < high:
            part = vectors[:, low:high]
            found += [part.mean(axis=1) * np.sqrt(high - low), part.std(axis=1) * np.sqrt(high - low)]
    return np.stack(found, axis=1) if found else np.zeros((len(vectors), 0))


def _vectors(column: pa.Array) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Which rows take part, and by length their indices; the integer vectors by length."""
    column = column.cast(pa.large_list(pa.float64()))
    lengths = np.diff(np.asarray(column.offsets))
    flat = column.values.slice(column.offsets[0].as_py(), int(lengths.sum()))
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is nan
    present = ~np.asarray(column.is_null())
    lengths = np.where(present, lengths, -1)
    at = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    present &= bad[at[1:]] == bad[at[:-1]]
    own = {}
    for length in np.unique(lengths[present]).tolist():
        rows = np.flatnonzero(present & (lengths == length))
        with np.errstate(over="ignore"):
            own[length] = (rows, np.floor(values[at[rows][:, None] + np.arange(length)] * SCALE))
    return present, own


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products. Doubles hold them while all partial sums stay below 2^53;
    others are Python integers, held to the range of a long."""
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(queries.shape[1], 1)
    if bound < 2.0**53:
        return (queries @ rows.T).astype(np.int64)
    whole = lambda m: [[int(x) if np.isfinite(x) else int(np.copysign(1, x)) << 1100 for x in v] for v in m]
    left, right = whole(queries), whole(rows)
    return np.array([[max(-_LONG, min(_LONG, sum(a * b for a, b in zip(x, y)))) for y in right] for x in left], np.int64).reshape(len(left), len(right))


class Queries:
    """A block of query vectors of one length, with what each has found so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [segment_statistics(vectors, n) for n in LEVELS]
        self.scores = np.full((len(ids), k), -_LONG - 1, np.int64)
        self.found = np.full((len(ids), k), -1, np.int64)
        self.count = np.zeros(len(ids), np.int64)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Hold candidates against the queries. Level by level a pair is dropped whose bound is
        below the query's k-th best score; those left get their exact product. Segment means
        and deviations bound a product from above as they bound a distance from below."""
        stats = [segment_statistics(vectors, n) for n in LEVELS]
        size = float(np.abs(vectors).max(initial=0)) * float(np.abs(self.vectors).max(initial=0)) * max(vectors.shape[1], 1)
        slack = 1 + 1e-9 * size
        for low in range(0, len(self.ids), _QUERIES):
            own = slice(low, min(low + _QUERIES, len(self.ids)))
            worst = np.where(self.count[own] >= self.k, self.scores[own].min(axis=1), -np.inf)[:, None]
            with np.errstate(invalid="ignore", over="ignore"):
                alive = ~(self.levels[0][own] @ stats[0].T + slack < worst)
                columns = np.flatnonzero(alive.any(axis=0))
                alive = alive[:, columns]
                for mine, theirs in zip(self.levels[1:], stats[1:]):
                    alive &= ~(mine[own] @ theirs[columns].T + slack < worst)
                    left = alive.any(axis=0)
                    columns, alive = columns[left], alive[:, left]
            if not len(columns):
                continue
            lines = np.flatnonzero(alive.any(axis=1))
            exact = _products(self.vectors[own][lines], vectors[columns])
            alive = alive[lines] & (ids[columns][None, :] != self.ids[own][lines][:, None]) & ~(exact < worst[lines])
            for line, scores, ok in zip(lines + low, exact, alive):
                self._keep(line, ids[columns[ok]], scores[ok])

    def _keep(self, line: int, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(ids):
            n = self.count[line]
            ids = np.concatenate([self.found[line, :n], ids])
            scores = np.concatenate([self.scores[line, :n], scores])
            order = np.lexsort((ids, -scores))
            ids, scores = ids[order], scores[order]
            fresh = np.concatenate([[True], (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])])
            best = np.flatnonzero(fresh)[: self.k]
            self.count[line] = len(best)
            self.found[line, : len(best)], self.scores[line, : len(best)] = ids[best], scores[best]


def _answer(rows: DataFrame, queries: dict[int, tuple[np.ndarray, np.ndarray]], k: int) -> DataFrame:
    """Each partition's k best for each query of a block."""
    names = ["query_id", "vec_id", "score"]
    schema = StructType([StructField(name, LongType()) for name in names])
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = {length: Queries(ids, vectors, k) for length, (ids, vectors) in shared.value.items()}
        for batch in batches:
            for begin in range(0, batch.num_rows, _ROWS):
                piece = batch.slice(begin, _ROWS)
                ids = piece.column(0).to_numpy(zero_copy_only=False)
                for length, (at, vectors) in _vectors(piece.column(1))[1].items():
                    if length in own:
                        own[length].add(ids[at].astype(np.int64), vectors)
        for q in own.values():
            line = np.repeat(np.arange(len(q.ids)), q.count)
            place = np.concatenate([np.arange(n) for n in q.count]) if len(q.count) else line
            columns = [q.ids[line], q.found[line, place], q.scores[line, place]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return rows.mapInArrow(search, schema)


def top_k(embeddings: DataFrame, k: int = TOP, every: int = QUERY_EVERY) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` highest inner products.

    Components x become floor(256 x). Queries are the rows whose vec_id is divisible by
    ``every``; candidates all rows with another vec_id. Equal scores go to the smaller vec_id.
    Rows whose id or vector is null, or whose vector holds null or non-finite components, take
    no part; vectors of different lengths are not compared. Rows of one id and one score are one
    find; rows that share an id but not the vector are queries that share their id's ranks. Scores beyond the range of a long are held to it.

    Queries are broadcast in blocks of bounded size and each block scans all rows.
    """
    rows = pick(embeddings, "vec_id", "embedding").where("vec_id is not null and embedding is not null")
    rows = rows.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
    asked = rows.where(F.col("vec_id") % every == 0).distinct()
    many = asked.count() // QUERY_BLOCK + 1
    answers = []
    for b in range(many):
        block = asked.where(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(many)) == b).orderBy("vec_id").toArrow().combine_chunks()
        queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in block.to_batches():
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            queries = {length: (ids[at], vectors) for length, (at, vectors) in _vectors(batch.column(1))[1].items()}
        answers.append(_answer(rows, queries, k))
    found = reduce(DataFrame.union, answers).distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
