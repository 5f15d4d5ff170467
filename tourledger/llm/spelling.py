"""Spelling variants: words that one edit parts, found by range searches in k-d trees.

A word is a point: the counts of its letters, up to ``MOST`` and folded into ``AXES``. One replaced
letter moves it by an L1 distance of two at most, one inserted or deleted by one at most, and
both bounds and folding only bring points together. A count is written as that many bits, so that
a point is one integer, the distance of two the number of bits in which they differ, and a box
the bits that all and that any of its points have. Words of each length are dealt to boxes, the
leaves of a k-d tree whose planes come from a bounded sample; a word is also sent, as a question,
to the boxes of its own length within two and of the next smaller length within one. A box is
searched by a k-d tree of its own, whose nodes are pruned by the distance to the box around
their points; of what is left the order of letters decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tourledger.llm.common import LOWER, cut, frugal, pick, pieces

#: Words of fewer code points or occurrences take no part.
MIN_LENGTH = 5
MIN_COUNT = 3
#: One in so many words of a document loses a letter.
CORRUPTED = 97
#: a-z have an axis each, the letters from U+00C0 on share the rest; a count has two bits.
AXES = 32
PLAIN = 26
MOST = 2
#: Points the planes between boxes are fitted to, those of least hash. Every word is indexed.
SAMPLE = 50_000
#: Words a box should hold.
BOX = 16_384
#: Points in a leaf of a box's own tree.
LEAF = 32
#: Words a task counts before it hands the counts on, and bytes of a text that it splits at a time.
COUNTED = 200_000
CHUNK = 1 << 20
#: Distances and letters compared at a time.
STEP = 1 << 22

_RUN = re.compile(rb"[a-z]+(?:\xc3[\x80-\xbf][a-z]*)*|(?:\xc3[\x80-\xbf][a-z]*)+")
_REST = re.compile(rb"(?:[a-z]+|\xc3[\x80-\xbf])*")


# Words and their counts


def _runs(data: bytes) -> Iterator[list[bytes]]:
    """The letter runs of lower-cased UTF-8, some at a time, none cut."""
    begin = 0
    while begin < len(data):
        end = min(len(data), begin + CHUNK)
        while end < len(data) and 0x80 <= data[end] < 0xC0:
            end += 1
        end = _REST.match(data, end).end()
        yield _RUN.findall(data, begin, end)
        begin = end


def _less_a_letter(run: bytes, h: int) -> bytes:
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` and ``n``: letter runs of whole texts (null: none), A-Z lower-cased, with one code
    point less where ``CORRUPTED`` divides the crc32 of ``<doc_id>:<run>`` (a null id counts as
    the empty text), of ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences at least."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()

        def handed_on() -> pa.RecordBatch:
            found = [(run.decode(), n) for run, n in total.items() if n and len(run) >= MIN_LENGTH]
            found = [(word, n) for word, n in found if len(word) >= MIN_LENGTH]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], names=["word", "n"])

        for batch, data, offsets in pieces(batches, 1):
            lower = LOWER[data].tobytes()
            for row, doc_id in enumerate(batch.column(0).to_pylist()):
                start = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
                for runs in _runs(lower[offsets[row] : offsets[row + 1]]):
                    total.update(runs)
                    hit = [run for run in set(runs) if not zlib.crc32(run, start) % CORRUPTED]
                    counts = Counter(runs) if hit else {}
                    for run in hit:
                        total[run] -= counts[run]
                        total[_less_a_letter(run, zlib.crc32(run, start))] += counts[run]
                    if len(total) >= COUNTED:
                        yield handed_on()
        yield handed_on()

    rows = pick(docs, "doc_id", "text").mapInArrow(frugal(work), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


# Points, and planes between boxes


def letters(words: Iterable[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters of the words one after another, a byte each, and the words' lengths."""
    codes = [word.encode("latin-1") for word in words]
    return np.frombuffer(b"".join(codes), np.uint8), np.array([len(c) for c in codes], np.int64)


_AXIS = np.where(np.arange(256) < 128, (np.arange(256) - 97) % 256, PLAIN + np.arange(256) % (AXES - PLAIN)).astype(np.int64)
_BITS = [np.uint64(1 << bit) for bit in range(AXES * MOST)]


def points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case words as points, and the words' lengths. Of an axis with count c the
    first c bits are set, ``MOST`` at the most."""
    data, lengths = letters(words)
    found = np.zeros(len(words), np.uint64)
    step = max(1, STEP // AXES)
    ends = np.concatenate([[0], np.cumsum(lengths)])
    for begin in range(0, len(words), step):
        some = lengths[begin : begin + step]
        axis = _AXIS[data[ends[begin] : ends[begin + len(some)]]]
        counts = np.bincount(np.repeat(np.arange(len(some)), some) * AXES + axis, minlength=len(some) * AXES).reshape(-1, AXES)
        for most in range(MOST):
            bits = np.packbits(counts > most, axis=1, bitorder="little").view(np.uint32)[:, 0].astype(np.uint64)
            found[begin : begin + step] |= bits << np.uint64(most * AXES)
    return found, lengths


def _plane(own: np.ndarray) -> np.uint64 | None:
    """The bit, which says whether an axis is above a value, that parts points most evenly."""
    best, found = 0, None
    for bit in _BITS:
        above = int(np.count_nonzero(own & bit))
        even = min(above, len(own) - above)
        if even > best:
            best, found = even, bit
    return found


def _planes(own: np.ndarray, most: float, number: list[int]):
    """A tree of (bit, lower, upper) with boxes' numbers as leaves."""
    bit = _plane(own) if len(own) > most else None
    if bit is None:
        number[0] += 1
        return number[0] - 1
    upper = (own & bit) != 0
    return int(bit), _planes(own[~upper], most, number), _planes(own[upper], most, number)


def fitted_planes(words: DataFrame) -> dict[int, object]:
    """For each length in the sample, the tree of planes; other lengths have one box.

    The driver takes the points of ``SAMPLE`` words at most and their lengths; they only
    decide how evenly boxes are filled.
    """
    sample = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, lengths = points(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(lengths), pa.array(own.view(np.int64))], names=["length", "point"])

    taken = sample.mapInArrow(work, "length long, point long").collect()
    share = len(taken) / max(1, words.count())
    by_length: dict[int, list[int]] = {}
    for row in taken:
        by_length.setdefault(row.length, []).append(row.point)
    return {n: _planes(np.array(own, np.int64).view(np.uint64), max(1.0, BOX * share), [0]) for n, own in by_length.items()}


def _apart(own: np.ndarray, every: np.uint64, some: np.uint64) -> np.ndarray:
    """The distance of points from a box, given the bits of every and of some point in it."""
    return np.bitwise_count(every & ~own) + np.bitwise_count(own & ~some)


def _halves(bit: int, every: int, some: int) -> tuple[tuple[int, int], tuple[int, int]]:
    """A box below and above a plane: more than a count is more than all smaller ones too."""
    axis, most = (bit.bit_length() - 1) % AXES, (bit.bit_length() - 1) // AXES
    higher = sum(1 << (axis + AXES * k) for k in range(most, MOST))
    lower = sum(1 << (axis + AXES * k) for k in range(most + 1))
    return (every, some & ~higher), (every | lower, some)


def boxes_within(tree, own: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each box's number with the indices of the points that are at most ``radius`` from it."""
    stack = [(tree, np.arange(len(own)), 0, (1 << (AXES * MOST)) - 1)]
    while stack:
        node, rows, every, some = stack.pop()
        rows = rows[_apart(own[rows], np.uint64(every), np.uint64(some)) <= radius]
        if not len(rows):
            continue
        if isinstance(node, tuple):
            below, above = _halves(node[0], every, some)
            stack += [(node[1], rows, *below), (node[2], rows, *above)]
        else:
            yield node, rows


# Searching a box


def _within(index: np.ndarray, questions: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indices of questions and of points of the index at most ``radius`` apart, in blocks."""
    stack = [(np.arange(len(index)), np.arange(len(questions)))]
    while stack:
        own, asked = stack.pop()
        if not len(own):
            continue
        here = index[own]
        near = _apart(questions[asked], np.bitwise_and.reduce(here), np.bitwise_or.reduce(here)) <= radius
        asked = asked[near]
        if not len(asked):
            continue
        bit = _plane(here) if len(own) > LEAF else None
        if bit is not None:
            upper = (here & bit) != 0
            stack += [(own[~upper], asked), (own[upper], asked)]
            continue
        step, across = max(1, STEP // LEAF), max(LEAF, STEP // len(asked))
        for start in range(0, len(own), across):
            for begin in range(0, len(asked), step):
                some = asked[begin : begin + step]
                apart = np.bitwise_count(questions[some][:, None] ^ here[None, start : start + across])
                a, b = np.nonzero(apart <= radius)
                yield some[a], own[start + b]


def _rows_of(words: list[str], length: int) -> np.ndarray:
    return letters(words)[0].reshape(-1, length)


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of equal length differ in exactly one place."""
    return (a != b).sum(1) == 1


def one_more(longer: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """Whether the longer row without one letter is the shorter one."""
    length = shorter.shape[1]
    differs = longer[:, :length] != shorter
    first = np.where(differs.any(1), differs.argmax(1), length)
    after = longer[:, 1:] != shorter
    return ~(after & (np.arange(length) >= first[:, None])).any(1)


def _verified(a: np.ndarray, b: np.ndarray, pairs: Iterable[tuple[np.ndarray, np.ndarray]], test) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Those of the pairs of rows that pass the test; blocks of pairs are gathered and cut."""
    step = max(1, STEP // a.shape[1])
    held, n = [], 0

    def passed() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        i, j = (np.concatenate(side) for side in zip(*held))
        for begin in range(0, len(i), step):
            some = slice(begin, begin + step)
            good = test(a[i[some]], b[j[some]])
            yield i[some][good], j[some][good]

    for pair in pairs:
        held.append(pair)
        n += len(pair[0])
        if n >= step:
            yield from passed()
            held, n = [], 0
    if held:
        yield from passed()


# Roles of a word in a box: indexed and asking, asking, asking and a letter longer.
_HOME, _GUEST, _LONGER = 0, 1, 2
_DEALT = "length long, box int, role int, word string, n long"
_LINKS = "word string, near string, near_n long"


def _dealt(words: DataFrame, planes: dict[int, object]) -> DataFrame:
    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in pieces(batches, 0, CHUNK):
            own, lengths = points(batch.column(0).to_pylist())
            for length in map(int, np.unique(lengths)):
                at = np.flatnonzero(lengths == length)
                tree, smaller, home = planes.get(length, 0), planes.get(length - 1, 0), np.zeros(len(at), np.int64)
                for box, rows in boxes_within(tree, own[at], 0):
                    home[rows] = box
                    yield rows_of(batch, at[rows], length, box, _HOME)
                for box, rows in boxes_within(tree, own[at], 2):
                    yield rows_of(batch, at[rows[home[rows] != box]], length, box, _GUEST)
                for box, rows in boxes_within(smaller, own[at], 1):
                    yield rows_of(batch, at[rows], length - 1, box, _LONGER)

    def rows_of(batch: pa.RecordBatch, rows: np.ndarray, length: int, box: int, role: int) -> pa.RecordBatch:
        part = batch.take(pa.array(rows))
        same = [np.full(len(rows), value, kind) for value, kind in ((length, np.int64), (box, np.int32), (role, np.int32))]
        return pa.RecordBatch.from_arrays([*map(pa.array, same), *part.columns], names=["length", "box", "role", "word", "n"])

    return words.select("word", "n").mapInArrow(frugal(work), _DEALT)


def _searched(table: pa.Table) -> pa.Table:
    """Links of the words in one box."""
    length = table.column("length")[0].as_py()
    role = table.column("role").to_numpy()
    table = table.take(pa.array(np.argsort(role, kind="stable"))).combine_chunks()
    words = table.column("word").to_pylist()
    homes, same = int((role == _HOME).sum()), int((role != _LONGER).sum())
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if homes:
        own, _ = points(words)
        equal, longer = _rows_of(words[:same], length), _rows_of(words[same:], length + 1)
        for i, j in _verified(equal, equal, _within(own[:homes], own[:same], 2), one_replaced):
            left.append(i)
            right.append(j)
        for i, j in _verified(longer, equal, _within(own[:homes], own[same:], 1), one_more):
            left += [i + same, j]
            right += [j, i + same]
    left, right = pa.array(np.concatenate(left)), pa.array(np.concatenate(right))
    return pa.table({"word": table.column("word").take(left), "near": table.column("word").take(right), "near_n": table.column("n").take(right)})


def near_words(words: DataFrame) -> DataFrame:
    """Each word with every near word and that one's ``n``, from a table of distinct words."""
    planes = fitted_planes(words)
    return _dealt(words, planes).groupBy("length", "box").applyInArrow(_searched, _LINKS)


def variants(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``form``, ``form_n``, ``root`` and ``n_near`` of distinct words with counts.

    Near words differ by one inserted, deleted or replaced code point. A form is the near
    word of greatest ``n`` (ties: the smallest in code-point order) if that is at least twice the
    word's own, so that forms lead to a root in at most log2 of the greatest count steps, which
    are doubled in each round. No words give no rows.
    """
    words = cut(words.select("word", "n"))
    best = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near"))).alias("best"))
    found = words.join(best, "word", "left")
    forms = -F.col("best.m") >= 2 * F.col("n")
    found = cut(found.select(
        "word", "n", F.when(forms, F.col("best.near")).alias("form"), F.when(forms, -F.col("best.m")).alias("form_n"),
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
    ))
    steps = cut(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = cut(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if steps.where("moved").isEmpty():
            break
        steps = steps.drop("moved")
    roots = steps.select("word", "root")
    return found.join(roots, "word", "left").select("word", "n", "form", "form_n", F.coalesce("root", "word").alias("root"), "n_near")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Variants among the words of whole documents."""
    return variants(word_counts(docs))
