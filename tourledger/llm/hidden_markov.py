"""Hidden Markov language model: Baum-Welch over token classes, exact scaled forward scores.

A token's class is a hash of its first and last letters; the end of a text is a class of its
own. Hidden states emit classes, and a class emits its tokens in proportion to their training
counts plus one half, with one share for all unknown tokens. So a text's probability is that of
its classes, summed exactly over all state sequences, times that of its tokens within them.

Texts are worked on in packs, a row for many documents: a pack has the distinct tokens once and
the texts as positions among them. Only distinct tokens go through the shuffle that counts them,
once per pack however often they occur, and their counts come back to the pack.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from tourledger.llm.common import LOWER, TOKEN_BYTES, cut, mix, pick, pieces, prefix_hash, remainder, span_hash, spans

STATES = 8
CLASSES = 2048  # class 0 is the end of a text
ROUNDS = 3
#: The states are told apart by rounds over one in so many training texts of each pack, so that the
#: draw grows with the corpus.
START_SHARE = 16
START_ROUNDS = 12
#: Tokens whose forward states are kept at once.
STORED = 1 << 21
#: Training texts of several packs are gone through together, up to so many tokens.
TOGETHER = 1 << 20
#: A text longer than all but so many of those it is worked on with is cut into segments, of at least
#: and, but for the root of its length, at most so many tokens. Results do not depend on it.
CROWD = 64
SEGMENT = (256, 4096)
SEGMENT_LANES = 4096
#: Tokens are counted in buckets of their hashes, at least 2 ** BUCKET_BITS; there are more, a power
#: of two, where the packs have more than BUCKET_BYTES of hashes a bucket, so that a task's stays small.
BUCKET_BITS = 8
BUCKET_BYTES = 16 << 20
PACK_BYTES = 8 << 20
_END = np.uint64(0xFFFFFFFFFFFFFFFF)  # the end's token; no word hashes to it but by chance
SEED = 7

_PACK = StructType([
    StructField("pack", LongType()), StructField("ids", ArrayType(LongType())), StructField("held_out", ArrayType(BooleanType())),
    StructField("lengths", BinaryType()), StructField("tokens", BinaryType()), StructField("words", BinaryType()),
    StructField("classes", BinaryType()), StructField("counts", BinaryType()),
])


def token_classes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class of each token, from its first byte, its last two and whether it is short."""
    last = data[ends - 1].astype(np.uint64)
    before = data[np.maximum(ends - 2, begins)].astype(np.uint64)
    short = np.minimum(ends - begins, 4).astype(np.uint64)
    shape = data[begins].astype(np.uint64) | last << np.uint64(8) | before << np.uint64(16) | short << np.uint64(24)
    return (mix(shape + np.uint64(1)) % np.uint64(CLASSES - 1)).astype(np.uint16) + np.uint16(1)


def packs(docs: DataFrame) -> DataFrame:
    """The documents' tokens in packs, written once: later steps read them several times."""
    rows = pick(docs, "doc_id", "text")
    rows = rows.select("text", F.col("doc_id").cast("long"), (remainder(F.col("doc_id"), 5) == 1).alias("held_out"))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for number, (batch, data, offsets) in enumerate(pieces(batches, 0, PACK_BYTES)):
            low = LOWER[data]
            begins, ends, first = spans(low, offsets, TOKEN_BYTES)
            hashes = span_hash(prefix_hash(low), begins, ends)
            lengths = np.diff(first) + 1
            words, at, inverse = np.unique(np.append(hashes, _END), return_index=True, return_inverse=True)
            # Texts are their tokens and then the end, the last of the distinct tokens.
            tokens = np.insert(inverse[:-1], first[1:], inverse[-1]).astype(np.uint32)
            classes = np.zeros(len(words), np.uint16)
            real = at < len(begins)
            classes[real] = token_classes(low, begins[at[real]], ends[at[real]])
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            learned = tokens[np.repeat(~held, lengths)]
            counts = np.bincount(learned, minlength=len(words)).astype(np.uint32)
            arrays = [lengths.astype(np.uint32), tokens, words, classes, counts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([task | number]), pa.array([batch.column(1).to_pylist()], pa.list_(pa.int64())), pa.array([held.tolist()]), *[pa.array([np.ascontiguousarray(a).tobytes()], pa.binary()) for a in arrays]],
                names=_PACK.names,
            )

    return cut(rows.mapInArrow(pack, _PACK))


_COUNTED = "pack bigint, bucket int, counts binary, tokens bigint, distinct bigint, class_counts binary"


def count_tokens(packed: DataFrame) -> DataFrame:
    """Training counts of each pack's distinct tokens, a row per pack and bucket of hashes.

    A token's count is summed over all packs where its bucket is; the row of the bucket's
    first pack also has the bucket's sums: tokens, distinct tokens and both by class.
    """
    size = packed.agg(F.sum(F.length("words")).alias("size")).first().size or 0
    bits = max(BUCKET_BITS, math.ceil(math.log2(max(size / BUCKET_BYTES, 1))))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, words, classes, counts in zip(*[c.to_pylist() for c in batch.columns]):
                words, classes, counts = np.frombuffer(words, np.uint64), np.frombuffer(classes, np.uint16), np.frombuffer(counts, np.uint32)
                own, begins = np.unique(words >> np.uint64(64 - bits), return_index=True)  # words are in order
                cuts = [slice(a, b) for a, b in zip(begins, [*begins[1:], len(words)])]
                columns = [[pack] * len(own), own.astype(np.int32), *[[a[c].tobytes() for c in cuts] for a in (words, classes, counts)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), *[pa.binary()] * 3))], names=["pack", "bucket", "words", "classes", "counts"])

    asked = packed.select("pack", "words", "classes", "counts").mapInArrow(ask, "pack bigint, bucket int, words binary, classes binary, counts binary")

    def count(group: pa.Table) -> pa.Table:
        pack = group.column("pack").to_pylist()
        words = [np.frombuffer(w, np.uint64) for w in group.column("words").to_pylist()]
        counts = np.concatenate([np.frombuffer(c, np.uint32) for c in group.column("counts").to_pylist()])
        classes = np.concatenate([np.frombuffer(c, np.uint16) for c in group.column("classes").to_pylist()])
        distinct, at, inverse = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
        sums = np.bincount(inverse, counts, len(distinct)).astype(np.int64)
        edges = np.cumsum([0, *[len(w) for w in words]])
        found = [sums[inverse[a:b]].tobytes() for a, b in zip(edges[:-1], edges[1:])]
        known = sums > 0
        own = classes[at]
        by_class = np.stack([np.bincount(own, sums, CLASSES), np.bincount(own[known], minlength=CLASSES)]).astype(np.int64)
        rest = len(pack) - 1
        bucket = group.column("bucket").to_pylist()
        return pa.table({
            "pack": pa.array(pack, pa.int64()), "bucket": pa.array(bucket, pa.int32()), "counts": pa.array(found, pa.binary()),
            "tokens": pa.array([int(sums.sum()), *[0] * rest], pa.int64()), "distinct": pa.array([int(known.sum()), *[0] * rest], pa.int64()),
            "class_counts": pa.array([by_class.tobytes(), *[None] * rest], pa.binary()),
        })

    return cut(asked.groupBy("bucket").applyInArrow(count, _COUNTED))


@dataclass
class HiddenMarkov:
    first: np.ndarray  # (states,)
    move: np.ndarray  # (states, states)
    emit: np.ndarray  # (classes, states): of each class, its probability in each state

    @classmethod
    def beginning(cls, counts: np.ndarray) -> HiddenMarkov:
        """Near the corpus's class shares, each state with its own random lean."""
        rng = np.random.default_rng(SEED)
        share = (counts + 0.5) / (counts + 0.5).sum()
        emit = share[:, None] * rng.gamma(2.0, size=(CLASSES, STATES))
        move = np.full((STATES, STATES), 0.1 / STATES) + np.eye(STATES) * 0.9
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=0))

    @classmethod
    def estimated(cls, first: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray) -> HiddenMarkov:
        """From expected counts; the corpus's class shares count as half a class's worth each,
        so that no class is impossible in any state."""
        emit = emit + share[:, None] * 10
        return cls((first + 0.1) / (first + 0.1).sum(), (move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _lanes(begins: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences from long to short, and at each step how many are not over."""
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    alive = len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps), "right")
    return order, begins[order], alive


@dataclass
class Segments:
    """Sequences cut into segments of at most ``limit`` tokens, in order; most are one segment."""

    begins: np.ndarray
    lengths: np.ndarray
    parts: np.ndarray  # of each sequence, its number of segments
    start: np.ndarray  # of each sequence, its first segment

    @classmethod
    def of(cls, begins: np.ndarray, lengths: np.ndarray) -> Segments:
        limit = segment_length(lengths)
        parts = np.maximum(-(-lengths // limit), 1)
        start = np.cumsum(parts) - parts
        owner = np.repeat(np.arange(len(parts)), parts)
        done = (np.arange(len(owner)) - start[owner]) * limit
        return cls(begins[owner] + done, np.minimum(lengths[owner] - done, limit), parts, start)

    def long(self) -> tuple[np.ndarray, np.ndarray]:
        """The sequences of several segments, from many segments to few, and for each place of a
        segment how many of them have one there."""
        order, _, alive = _lanes(self.start, self.parts)
        many = int((self.parts > 1).sum())
        return order[:many], np.minimum(alive, many)


def segment_length(lengths: np.ndarray) -> int:
    """Steps that many sequences take together; only few sequences go on beyond, in segments."""
    if not len(lengths):
        return SEGMENT[0]
    crowd = int(np.partition(lengths, -CROWD)[-CROWD]) if len(lengths) > CROWD else 0
    return max(SEGMENT[0], math.isqrt(int(lengths.max())), min(crowd, SEGMENT[1]))


def _transfers(model: HiddenMarkov, sequence: np.ndarray, segments: Segments) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each segment of a long sequence, the matrix from the state before it to the state at its
    end: rows that sum to one and their natural logs. All segments take a step at once, so a
    long sequence needs no step for each of its tokens. The matrix of a first segment has the
    model's first states in all rows. The last result is each segment's place among them."""
    which = np.flatnonzero(np.repeat(segments.parts > 1, segments.parts))
    place = np.full(len(segments.begins), -1)
    place[which] = np.arange(len(which))
    matrix, logs = np.empty((len(which), STATES, STATES)), np.zeros((len(which), STATES))
    begins = np.zeros(len(segments.begins), bool)
    begins[segments.start] = True
    for low in range(0, len(which), SEGMENT_LANES):
        own = which[low : low + SEGMENT_LANES]
        order, at, alive = _lanes(segments.begins[own], segments.lengths[own])
        state = np.where(begins[own[order], None, None], model.first, model.move)
        grown, written = np.zeros((len(own), STATES)), low + order
        for t, n in enumerate(alive.tolist()):
            if n < len(state):
                matrix[written[n : len(state)]] = state[n:]
            state = (state[:n].reshape(-1, STATES) @ model.move).reshape(n, STATES, STATES) if t else state
            state = state * model.emit[sequence[at[:n] + t]][:, None, :]
            scale = state.sum(axis=2)
            state /= scale[:, :, None]
            grown[:n] += np.log(scale)
        matrix[written[: len(state)]] = state
        logs[written] = grown
    return matrix, logs, place


def _entered(segments: Segments, matrix: np.ndarray, logs: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each segment of a long sequence, the state before it, and of each sequence of ``long``
    the natural log of its probability."""
    texts, alive = segments.long()
    before = np.empty((len(matrix), STATES))
    total, state = np.zeros(len(texts)), np.full((len(texts), STATES), 1 / STATES)
    for p, n in enumerate(alive.tolist()):
        own = place[segments.start[texts[:n]] + p]
        before[own] = state = state[:n]
        with np.errstate(divide="ignore"):
            weights = np.log(state) + logs[own]
        top = weights.max(axis=1)
        state = np.einsum("ni,nij->nj", np.exp(weights - top[:, None]), matrix[own])
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += top + np.log(scale)
    return before, total


def _left(segments: Segments, matrix: np.ndarray, logs: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of each segment of a long sequence, how likely each state at its end makes what comes after."""
    texts, alive = segments.long()
    after = np.ones((len(matrix), STATES))
    for p in range(len(alive) - 1, 0, -1):
        own = place[segments.start[texts[: alive[p]]] + p]
        weights = logs[own] + np.log(np.einsum("nij,nj->ni", matrix[own], after[own]))
        after[own - 1] = np.exp(weights - weights.max(axis=1, keepdims=True))
    return after


def log_likelihoods(model: HiddenMarkov, sequence: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """log10 probability of each whole sequence by the scaled forward recursion; all
    sequences take a step at once, and long ones all their segments."""
    segments = Segments.of(begins, lengths)
    short = np.flatnonzero(segments.parts == 1)
    order, at, alive = _lanes(begins[short], lengths[short])
    total = np.zeros(len(short))
    state = np.tile(model.first, (len(short), 1))
    for t, n in enumerate(alive.tolist()):
        state = (state[:n] @ model.move if t else state[:n]) * model.emit[sequence[at[:n] + t]]
        scale = state.sum(axis=1)
        state /= scale[:, None]
        total[:n] += np.log10(scale)
    found = np.empty(len(begins))
    found[short[order]] = total
    found[segments.long()[0]] = _entered(segments, *_transfers(model, sequence, segments))[1] / math.log(10)
    return found


def _groups(lengths: np.ndarray, lanes: int) -> Iterator[slice]:
    """Stretches of at most STORED tokens and ``lanes`` sequences, or of one sequence."""
    done, begin = np.cumsum(lengths), 0
    while begin < len(lengths):
        before = int(done[begin - 1]) if begin else 0
        end = min(max(begin + 1, int(np.searchsorted(done, before + STORED, "right"))), begin + lanes)
        yield slice(begin, end)
        begin = end


def expected_counts(model: HiddenMarkov, sequence: np.ndarray, begins: np.ndarray, lengths: np.ndarray, lanes: int = 8192) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch's expected counts of first states, moves and emissions over whole sequences.

    Sequences take a step at once, forward and then back, in groups whose forward states fit into
    memory. A long sequence is gone through as segments, each from the exact state before it and
    back from what comes after it, so that the sums are those of the whole sequence.
    """
    first, move, emit = np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))
    matrix, table, starts = model.move.astype(np.float32), model.emit.astype(np.float32), model.first.astype(np.float32)
    segments = Segments.of(begins, lengths)
    *parts, place = _transfers(model, sequence, segments)
    before, after = _entered(segments, *parts, place)[0].astype(np.float32), _left(segments, *parts, place).astype(np.float32)
    begun = np.zeros(len(place), bool)
    begun[segments.start] = True
    order = np.argsort(-segments.lengths, kind="stable")
    for group in _groups(segments.lengths[order], lanes):
        own = order[group]
        _, at, alive = _lanes(segments.begins[own], segments.lengths[own])
        state = np.tile(starts, (len(own), 1))
        entering = np.flatnonzero(~begun[own])
        entry = before[place[own[entering]]]
        state[entering] = entry @ matrix
        back = np.ones((len(own), STATES), np.float32)
        followed = place[own] >= 0
        back[followed] = after[place[own[followed]]]
        kept = []
        for t, n in enumerate(alive.tolist()):
            emitted = table[sequence[at[:n] + t]]
            state = (state[:n] @ matrix if t else state) * emitted
            scale = 1 / state.sum(axis=1, keepdims=True)
            state = state * scale
            kept.append((state, emitted, scale))
        weights, seen, ahead = [], [], None
        for t in range(len(kept) - 1, -1, -1):
            here, emitted, scale = kept.pop()
            n, m = len(here), 0
            if ahead is not None:
                m = len(ahead)
                move += (here[:m].T @ ahead) * matrix
                back[:m] = ahead @ matrix.T
            back[m:n] /= (here[m:] * back[m:n]).sum(axis=1, keepdims=True)  # these end here
            gamma = here * back[:n]
            gamma /= gamma.sum(axis=1, keepdims=True)
            weights.append(gamma)
            seen.append(sequence[at[:n] + t])
            ahead = emitted * back[:n] * scale
        first += gamma[begun[own]].sum(axis=0)
        move += (entry.T @ ahead[entering]) * matrix
        weights, seen = np.concatenate(weights), np.concatenate(seen)
        for k in range(STATES):
            emit[:, k] += np.bincount(seen, weights[:, k], CLASSES)
    return first, move, emit


def _class_counts(counted: DataFrame) -> np.ndarray:
    """Training tokens and distinct ones of each class, summed over buckets within partitions first."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 * CLASSES, np.int64)
        for batch in batches:
            for found in batch.column(0).to_pylist():
                sums += np.frombuffer(found, np.int64)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], names=["place", "value"])

    partial = counted.where("class_counts is not null").select("class_counts").mapInArrow(add, "place int, value bigint")
    return _summed(partial, np.zeros(2 * CLASSES, np.int64)).reshape(2, CLASSES)


def _summed(partial: DataFrame, sums: np.ndarray) -> np.ndarray:
    """``sums`` with the sum of each place's values; as many rows as the model has numbers."""
    for row in partial.groupBy("place").agg(F.sum("value").alias("value")).collect():
        sums[row.place] = row.value
    return sums


def _together(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Classes and lengths of the training texts of one or more packs."""
    parts, size = [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            held, lengths, tokens, classes = [c[k].as_py() for c in batch.columns]
            lengths = np.frombuffer(lengths, np.uint32).astype(np.int64)
            learned = ~np.array(held, bool)
            sequence = np.frombuffer(classes, np.uint16)[np.frombuffer(tokens, np.uint32)][np.repeat(learned, lengths)]
            parts.append((sequence, lengths[learned]))
            size += len(sequence)
            if size >= TOGETHER:
                yield tuple(map(np.concatenate, zip(*parts)))
                parts, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*parts)))


def _round(packed: DataFrame, model: HiddenMarkov, share: np.ndarray) -> HiddenMarkov:
    """One round of Baum-Welch over every training text, summed over partitions."""
    shared = packed.sparkSession.sparkContext.broadcast(model)
    schema = StructType([StructField("place", IntegerType()), StructField("value", DoubleType())])

    def expect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(STATES + STATES * STATES + CLASSES * STATES)
        for sequence, lengths in _together(batches):
            sums += np.concatenate([x.ravel() for x in expected_counts(shared.value, sequence, np.cumsum(lengths) - lengths, lengths)])
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(sums[found])], names=schema.names)

    expected = packed.select("held_out", "lengths", "tokens", "classes").mapInArrow(expect, schema)
    sums = _summed(expected, np.zeros(STATES + STATES * STATES + CLASSES * STATES))
    first, move, emit = np.split(sums, [STATES, STATES + STATES * STATES])
    return HiddenMarkov.estimated(first, move.reshape(STATES, STATES), emit.reshape(CLASSES, STATES), share)


def drawn_texts(packed: DataFrame, share: int = START_SHARE) -> DataFrame:
    """One in ``share`` training texts of each pack, at least one, whole; as packs of their own,
    whose tokens are classes."""
    schema = "held_out array<boolean>, lengths binary, tokens binary, classes binary"

    def draw(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack, held, lengths, tokens, classes in zip(*[c.to_pylist() for c in batch.columns]):
                lengths = np.frombuffer(lengths, np.uint32)
                learned = np.flatnonzero(~np.array(held, bool))
                some = np.random.default_rng((SEED, pack)).permutation(learned)[: -(-len(learned) // share)]
                mine = np.zeros(len(lengths), bool)
                mine[some] = True
                own = np.frombuffer(classes, np.uint16)[np.frombuffer(tokens, np.uint32)[np.repeat(mine, lengths)]]
                arrays = [lengths[mine], own.astype(np.uint32), np.arange(CLASSES, dtype=np.uint16)]
                columns = [pa.array([[False] * len(some)], pa.list_(pa.bool_())), *[pa.array([a.tobytes()], pa.binary()) for a in arrays]]
                yield pa.RecordBatch.from_arrays(columns, names=["held_out", "lengths", "tokens", "classes"])

    return cut(packed.select("pack", "held_out", "lengths", "tokens", "classes").mapInArrow(draw, schema))


def train(packed: DataFrame, class_counts: np.ndarray, rounds: int = ROUNDS, start_rounds: int = START_ROUNDS) -> HiddenMarkov:
    """Baum-Welch: first over a share of the texts, to tell the states apart, then ``rounds``
    times over all training texts, from which alone the final parameters come. Texts are
    whole in both, and no number bounds how many there are."""
    share = (class_counts + 0.5) / (class_counts + 0.5).sum()
    model = HiddenMarkov.beginning(class_counts)
    if not class_counts.any():
        return model
    some = drawn_texts(packed)
    for texts, times in ((some, start_rounds), (packed, rounds)):
        for _ in range(times):
            model = _round(texts, model, share)
    return model


def language_model_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Tokens are runs of other than space and 0x09-0x0D, A-Z lower-cased, and an end. The
    texts whose crc32 of the id is not 1 modulo 5 (a null id counts as the empty text) are
    learned from. base_score is the log10 probability of the tokens by themselves, score that
    of the model; null texts are an end alone. Tokens are counted by 64-bit hashes.
    """
    return _scores(*_learned(docs))


def _learned(docs: DataFrame) -> tuple[DataFrame, DataFrame, HiddenMarkov, int, float, np.ndarray]:
    """Packs, their counts, the model, the number of training tokens, and the logs of what a token's
    share and a share of a class are of."""
    packed = packs(docs)
    counted = count_tokens(packed)
    sums = counted.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("distinct"), F.lit(0)).alias("distinct")).first()
    by_class = _class_counts(counted)
    tokens, distinct = int(sums.tokens), int(sums.distinct)
    within = np.log10(by_class[0] + 0.5 * (by_class[1] + 1))
    return packed, counted, train(packed, by_class[0]), tokens, np.log10(tokens + 0.5 * (distinct + 1)), within


def _scores(packed: DataFrame, counted: DataFrame, model: HiddenMarkov, train_tokens: int, whole: float, within: np.ndarray) -> DataFrame:
    replies = counted.groupBy("pack").agg(F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("replies"))
    joined = packed.select("pack", "ids", "held_out", "lengths", "tokens", "classes").join(replies, "pack").drop("pack")
    shared = packed.sparkSession.sparkContext.broadcast((model, within))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, within = shared.value
        for batch in batches:
            for k in range(batch.num_rows):
                ids, held, lengths, tokens, classes, replies = [c[k].as_py() for c in batch.columns]
                lengths = np.frombuffer(lengths, np.uint32).astype(np.int64)
                tokens, classes = np.frombuffer(tokens, np.uint32), np.frombuffer(classes, np.uint16)
                counts = np.concatenate([np.frombuffer(r["counts"], np.int64) for r in replies])
                at = np.cumsum(lengths) - lengths
                logs = np.add.reduceat(np.log10(counts + 0.5)[tokens], at)
                known = np.add.reduceat((counts > 0)[tokens].astype(np.int64), at)
                sequence = classes[tokens]
                classed = np.add.reduceat(within[sequence], at)
                chain = log_likelihoods(model, sequence, at, lengths)
                columns = [pa.array(ids, pa.int64()), pa.array(held), lengths, known, np.full(len(ids), train_tokens), logs - lengths * whole, chain + logs - classed]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names)

    return joined.mapInArrow(score, schema)
