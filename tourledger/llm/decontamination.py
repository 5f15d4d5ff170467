"""Benchmark decontamination by Wu-Manber multi-pattern search."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from tourledger.llm.common import LOWER, WORD_BYTES, cut, frugal, numbered, pick, pieces, schema_of, spans, text_bytes, words8

WINDOW_WORDS = 13
#: Share of a document's words that must be hit: one in so many.
HIT_ONE_IN = 20
#: Benchmark text that one set of tables holds; a larger benchmark takes several scans.
BLOCK_BYTES = 4 << 20

TABLE_BITS = 20
_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MASKS = np.array([0, *[(1 << 8 * k) - 1 for k in range(1, 9)]], np.uint64)
#: Patterns of similar length share tables, so that a short one shortens no long one's shifts.
_CLASSES = (1, 2, 4, 8, 16, 32, 64)
#: Bytes of a pattern that the shift table looks at, at most.
_REACH = 64
_LANE = 2048


def _slots(blocks: np.ndarray) -> np.ndarray:
    return ((blocks * _PRIME) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space between them and a line feed after each row; where
    words begin, and the index of each row's first word (one more entry than rows)."""
    table = np.where(WORD_BYTES, LOWER, 0x20).astype(np.uint8)
    text = np.insert(table[data], offsets[1:], 0x0A)
    is_word = text > 0x20
    after = np.zeros(len(text), bool)
    after[1:] = is_word[:-1]
    text = text[is_word | after | (text == 0x0A)]
    is_word = text > 0x20
    begins = np.flatnonzero(is_word & np.concatenate([[True], ~is_word[:-1]]))
    ends = np.flatnonzero(text == 0x0A)
    first = np.concatenate([[0], np.searchsorted(begins, ends)])
    return text, begins, first


@dataclass
class _Tables:
    """Shift and suffix tables of the patterns of one length class."""

    reach: int
    block: int
    shift: np.ndarray
    suffixes: np.ndarray
    patterns: np.ndarray
    prefixes: np.ndarray


class WuManber:
    """Search of many word sequences at once.

    A pattern is looked for by its first ``reach`` bytes, the least length in its class. The
    shift table gives for each block of bytes how far the window can move on without passing
    a place where a pattern could end; where it is 0, the patterns whose own suffix block
    has the same hash are compared, first by prefix and then in full.
    """

    def __init__(self, patterns: list[tuple[bytes, int]]):
        """Patterns: bytes and number of words; they must differ."""
        self.texts = [text for text, _ in patterns]
        self.words = np.array([words for _, words in patterns], np.int64)
        lengths = np.array([len(text) for text in self.texts], np.int64)
        buffer = np.frombuffer(b"".join(self.texts) + bytes(8), np.uint8)
        at = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        eight = words8(buffer)
        self.classes = []
        for low, high in zip(_CLASSES, [*_CLASSES[1:], 1 << 62]):
            own = np.flatnonzero((lengths >= low) & (lengths < high))
            if not len(own):
                continue
            reach = int(min(lengths[own].min(), _REACH))
            block = min(8, max(1, reach // 2))
            shift = np.full(1 << TABLE_BITS, reach - block + 1, np.uint8)
            for end in range(block, reach + 1):
                slots = _slots(eight[at[own] + end - block] & _MASKS[block])
                np.minimum.at(shift, slots, reach - end)
            suffixes = eight[at[own] + reach - block] & _MASKS[block]
            order = np.argsort(suffixes, kind="stable")
            prefixes = eight[at[own]] & _MASKS[min(8, reach)]
            self.classes.append(_Tables(reach, block, shift, suffixes[order], own[order], prefixes[order]))

    def search(self, text: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and pattern of each occurrence that begins and ends with a word."""
        at, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        eight = words8(np.concatenate([text, np.zeros(_REACH + 8, np.uint8)]))
        raw = text.tobytes()
        for tables in self.classes:
            places = self._candidates(tables, eight, len(text))
            word = np.searchsorted(begins, places)
            ok = (word < len(begins)) & (begins[np.minimum(word, len(begins) - 1)] == places) if len(begins) else np.zeros(len(places), bool)
            places, word = places[ok], word[ok]
            suffixes = eight[places + tables.reach - tables.block] & _MASKS[tables.block]
            low = np.searchsorted(tables.suffixes, suffixes, "left")
            many = np.searchsorted(tables.suffixes, suffixes, "right") - low
            each = np.repeat(np.arange(len(places)), many)
            entry = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many) + low[each]
            same = (eight[places[each]] & _MASKS[min(8, tables.reach)]) == tables.prefixes[entry]
            each, pattern = each[same], tables.patterns[entry[same]]
            hit = np.zeros(len(each), bool)
            for i, (place, p) in enumerate(zip(places[each].tolist(), pattern.tolist())):
                end = place + len(self.texts[p])
                hit[i] = raw.startswith(self.texts[p], place) and (end >= len(raw) or raw[end] <= 0x20)
            at.append(word[each[hit]])
            found.append(pattern[hit])
        return np.concatenate(at), np.concatenate(found)

    @staticmethod
    def _candidates(tables: _Tables, eight: np.ndarray, n: int) -> np.ndarray:
        """Places where the shift is 0. Many windows move through the text side by side."""
        place = np.arange(0, n, _LANE)
        end = np.minimum(place + _LANE, n)
        back, mask, found = tables.reach - tables.block, _MASKS[tables.block], []
        while len(place):
            shift = tables.shift[_slots(eight[place + back] & mask)]
            found.append(place[shift == 0])
            place = place + np.maximum(shift, 1)
            inside = place < end
            place, end = place[inside], end[inside]
        return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass
class Benchmark:
    """The windows of a block of benchmark items, ready to search."""

    search: WuManber
    items: list[list[str]]  # of each pattern


def benchmark_windows(items: list[tuple[str, str]], window: int = WINDOW_WORDS) -> Benchmark:
    """Windows of ``window`` words of each item; an item of fewer, but not none, is one."""
    column = pa.array([text for _, text in items], pa.string())
    text, begins, first = normalised(*text_bytes(column))
    ends = np.flatnonzero(text <= 0x20)
    ends = ends[np.searchsorted(ends, begins)] if len(begins) else begins
    raw, patterns = text.tobytes(), {}
    for k, (item, _) in enumerate(items):
        low, high = int(first[k]), int(first[k + 1])
        size = min(window, high - low)
        for w in range(low, high - size + 1 if size else low):
            patterns.setdefault((raw[begins[w] : ends[w + size - 1]], size), set()).add(item)
    return Benchmark(WuManber(list(patterns)), [sorted(found) for found in patterns.values()])


def _scan(df: DataFrame, text: str, block: Benchmark, carry: list[str]) -> DataFrame:
    at = df.columns.index(text)
    kept = [df.columns.index(name) for name in carry]
    fields = (StructField("n_words", LongType()), StructField("hits", ArrayType(LongType())), StructField("items", ArrayType(StringType())))
    schema = schema_of(df.select(*carry), *fields)
    before = [df.columns.index(name) for name in ("hits", "items")] if "hits" in df.columns else None
    shared = df.sparkSession.sparkContext.broadcast(block)

    @frugal
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, data, offsets in pieces(batches, at):
            words, begins, first = normalised(data, offsets)
            word, pattern = own.search.search(words, begins)
            change = np.zeros(len(begins) + 1, np.int64)
            np.add.at(change, word, 1)
            np.add.at(change, word + own.search.words[pattern], -1)
            row = np.searchsorted(first, word, "right") - 1
            items: dict[int, set[str]] = {}
            for r, p in zip(row.tolist(), pattern.tolist()):
                items.setdefault(r, set()).update(own.items[p])
            if before is not None:
                for r in range(batch.num_rows):
                    items.setdefault(r, set()).update(batch.column(before[1])[r].as_py())
                    earlier = np.array(batch.column(before[0])[r].as_py(), np.int64) + first[r]
                    np.add.at(change, earlier[::2], 1)
                    np.add.at(change, earlier[1::2], -1)
            covered = np.cumsum(change)[:-1] > 0
            edge = np.concatenate([[False], covered, [False]])
            starts_row = np.zeros(len(edge), bool)
            starts_row[first] = True  # a run of hits ends with its row
            low = np.flatnonzero(edge[1:-1] & (~edge[:-2] | starts_row[:-2])) if len(covered) else np.zeros(0, np.int64)
            high = np.flatnonzero(edge[1:-1] & (~edge[2:] | starts_row[1:-1])) + 1 if len(covered) else low
            runs = np.searchsorted(low, first)
            flat = np.stack([low, high], 1)
            hits = [(flat[a:b] - f).ravel().tolist() for a, b, f in zip(runs[:-1], runs[1:], first)]
            found = [sorted(items.get(r, ())) for r in range(batch.num_rows)]
            columns = [pa.array(np.diff(first), pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(found, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], *columns], names=schema.names)

    return df.mapInArrow(scan, schema)


def _blocks(benchmark: DataFrame) -> list[Callable[[], list[tuple[str, str]]]]:
    """Readers of the items, each of about BLOCK_BYTES of text. A null id is the id ''."""
    items = pick(benchmark, "item_id", "text").where("text is not null")
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = int(size // BLOCK_BYTES) + 1

    def block(k: int):
        own = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(many)) == k)
        return lambda: [(row.item, row.text) for row in own.orderBy("item", "text").collect()]

    return [block(k) for k in range(many)]


def contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """The documents (the columns in ``carry``, all if None) with n_words, hits, n_hit, items,
    n_items and contaminated.

    Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased.
    ``hits`` are the first word and the word after the last of each hit run, one after the
    other; ``items`` the ids of the items with windows that occur, sorted as strings. A
    document is contaminated if at least one word in 20 is hit. Null or empty texts have no
    words; items that are null or have no words have no windows; benchmark rows with one id
    are one item, a null id is the id ''. Every document row gives a row, equal ones too;
    without benchmark nothing is hit. Columns of the input keep their names, so those in
    ``carry`` must not be called like the ones added.

    The benchmark's tables are broadcast, for a bounded amount of its text at a time; what
    one scan has found is written before the next.
    """
    carry = docs.columns if carry is None else carry
    blocks = _blocks(benchmark)
    df, found = docs, None
    for k, items in enumerate(blocks):
        last = k == len(blocks) - 1
        keep = carry if last else [*dict.fromkeys([*carry, "text"])]
        found = _scan(df, "text", benchmark_windows(items()), keep)
        df = found if last else cut(found)
    n_hit = F.expr("aggregate(hits, 0L, (a, x) -> x - a)")  # ends minus begins: the signs alternate
    return df.withColumns({"n_hit": n_hit, "n_items": F.size("items").cast("long")}).withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_ONE_IN >= F.col("n_words")))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    plain, at = numbered(docs)
    plain = plain.withColumnRenamed(at["text"], "text")
    found = contamination(plain, benchmark)
    return found.where(~F.col("contaminated")).select(*plain.columns).toDF(*docs.columns)
