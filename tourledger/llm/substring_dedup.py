"""Removal of repeated substrings, found by suffix sorting around shared anchors.

Any 50-byte string holds an anchor: the 16 bytes of least hash among all its 16-byte
strings. Equal strings hold equal anchors at equal places, so what surrounds anchors that
several documents share, 84 bytes that take in every 50-byte string around it, is all that
has to be compared. Surroundings of one anchor meet in one group and are put in order by
suffix sorting; runs of suffixes that agree and the bytes at both ends then tell which
strings are equal, and the least document id of each goes back to where it came from. An anchor
with very many different surroundings (a footer with another name beside it in each document) does
not meet: each of its 50-byte strings goes where its hash of 128 bits sends it, with the least
id that a pack has for it.

Documents are kept in packs, files in the shared folder that tasks read again by their URI,
so that no text is shuffled. What a pack has many times it sends once.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tourledger.llm.common import cut, ensure_checkpoint_dir, frugal, give_back, mix, numbered, pick, pieces, text_bytes, words8
from tourledger.llm.suffix_sorting import suffix_order
from tourledger.llm.warc import open_uri

MATCH = 50
ANCHOR = 16
BEFORE = MATCH - ANCHOR  # bytes before an anchor in its surroundings
AROUND = BEFORE + MATCH
STARTS = BEFORE + 1  # places in the surroundings where a string with the anchor begins
BLOCK = 12  # bytes that are one symbol when suffixes are sorted
BLOCKS = AROUND // BLOCK
PACK_BYTES = 8 << 20
BUCKET_BYTES = 4 << 20  # text for which there is one more bucket of anchors
SORT_ROWS = 20_000  # surroundings that are sorted together, about
HOT_ENTRIES = 1 << 17  # an anchor with more entries does not meet in one group
COMPARED = 1 << 16  # surroundings that are made before equal ones among them become one
_PIECE = 1 << 20
NO_ID = np.iinfo(np.int64).max  # a null id: greater than all others

_P = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours."""
    best, reach = (np.minimum if least else np.maximum), 1
    while reach * 2 <= width:
        values = best(values[: len(values) - reach], values[reach:])
        reach *= 2
    if reach < width:
        values = best(values[: len(values) - (width - reach)], values[width - reach :])
    return values


def _hash16(eight: np.ndarray, at: np.ndarray | slice, after: np.ndarray | slice) -> np.ndarray:
    return mix(mix(eight[at] * _P[0]) + eight[after] * _P[1])


def anchors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Places of all anchors of strings within rows, in ascending order."""
    n = len(data)
    width = MATCH - ANCHOR + 1
    if n < MATCH:
        return np.zeros(0, np.int64)
    eight = words8(data)
    many = n - ANCHOR + 1
    hashes = np.empty(many, np.uint32)
    for low in range(0, many, _PIECE):
        high = min(low + _PIECE, many)
        hashes[low:high] = _hash16(eight, slice(low, high), slice(low + 8, high + 8)) >> np.uint64(32)
    least = _slide(hashes, width, True)
    # A place is an anchor if it is the least of any window: the greatest of their leasts.
    padded = np.zeros(len(least) + 2 * (width - 1), np.uint32)
    padded[width - 1 : width - 1 + len(least)] = least
    found = np.flatnonzero(_slide(padded, width, False)[:many] == hashes)
    row = np.searchsorted(offsets, found, "right") - 1
    inside = (found + ANCHOR <= offsets[row + 1]) & (offsets[row + 1] - offsets[row] >= MATCH)
    return found[inside]


class Pack:
    """Some documents, their text bytes and their anchors."""

    def __init__(self, batch: pa.RecordBatch, text: int, doc: int):
        self.batch = batch
        self.data, self.offsets = text_bytes(batch.column(text))
        ids = batch.column(doc)
        self.ids = np.where(np.asarray(ids.is_null()), NO_ID, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        lists = batch.column(batch.num_columns - 1)
        own = np.diff(np.asarray(lists.offsets))
        self.row = np.repeat(np.arange(batch.num_rows), own)
        flat = lists.values.slice(lists.offsets[0].as_py(), int(own.sum())) if len(lists) else pa.array([], pa.uint32())
        self.at = flat.to_numpy().astype(np.int64) + self.offsets[self.row]
        self.eight = words8(np.concatenate([self.data, np.zeros(AROUND, np.uint8)]))
        # How much of the surroundings is in the document.
        self.left = np.minimum(BEFORE, self.at - self.offsets[self.row])
        self.right = np.minimum(MATCH, self.offsets[self.row + 1] - self.at)

    def _part(self, before: int, size: int) -> np.ndarray:
        """A hash of the 33 bytes from ``before`` bytes before each anchor on."""
        at = np.maximum(self.at - before, 0)
        h = _hash16(self.eight, at, at + 8)
        h = mix(h + self.eight[at + 16] * _P[2])
        return mix(h + self.eight[at + size - 8] * _P[0])

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each anchor, and 31 bits of two hashes: of the string that reaches as far
        before the anchor as after it, and of that from the anchor on. A match of 50 bytes
        takes in one or the other in full."""
        half = (MATCH - ANCHOR) // 2
        anchor = _hash16(self.eight, self.at, self.at + 8)
        left = np.where(self.left >= half, self._part(half, ANCHOR + half) & np.uint64(0x7FFF), np.uint64(0x8000))
        right = np.where(self.right >= ANCHOR + half, self._part(0, ANCHOR + half) & np.uint64(0x7FFF), np.uint64(0x8000))
        return anchor, (left << np.uint64(16) | right).astype(np.uint32)

    def entries(self, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct keys by bucket: where each bucket's begin, 32 bits of the anchor's
        hash, the parts, whether two of the pack's rows have it, and each anchor's entry."""
        anchor, parts = self.keys()
        bucket = bucket_of(anchor, buckets)
        short = anchor.astype(np.uint32)
        order = np.lexsort((self.row, parts, short, bucket))
        b, s, p, r = bucket[order], short[order], parts[order], self.row[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (b[1:] != b[:-1]) | (s[1:] != s[:-1]) | (p[1:] != p[:-1])
        begins = np.flatnonzero(fresh)
        twice = np.zeros(len(begins), bool)
        if len(begins):
            twice = np.minimum.reduceat(r, begins) != np.maximum.reduceat(r, begins)
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(fresh) - 1
        return np.searchsorted(b[begins], np.arange(buckets + 1)), s[begins], p[begins], twice, entry

    def surroundings(self, buckets: int, shared: dict[int, tuple[np.ndarray, np.ndarray]]) -> Surroundings:
        """The distinct surroundings of shared anchors.

        Some at a time are made and equal ones among them become one at once, so that a text
        of one character, all of whose places are anchors, takes little memory.
        """
        edges, _, _, _, entry = self.entries(buckets)
        flag, hot = np.zeros(edges[-1], bool), np.zeros(edges[-1], bool)
        for k, (own, own_hot) in shared.items():
            many = edges[k + 1] - edges[k]
            flag[edges[k] : edges[k + 1]] = np.unpackbits(own, count=many).astype(bool)
            hot[edges[k] : edges[k + 1]] = np.unpackbits(own_hot, count=many).astype(bool)
        mine = np.flatnonzero(flag[entry]) if len(entry) else np.zeros(0, np.int64)
        padded = np.concatenate([np.zeros(BEFORE, np.uint8), self.data, np.zeros(MATCH, np.uint8)])
        place, found = np.arange(AROUND), Surroundings.none()
        parts, whiches, n = [], [], 0
        for low in range(0, len(mine), COMPARED):
            some = mine[low : low + COMPARED]
            at, left, right = self.at[some], self.left[some], self.right[some]
            around = np.zeros((len(some), AROUND + 4), np.uint8)
            around[:, :AROUND] = np.lib.stride_tricks.sliding_window_view(padded, AROUND)[at]
            around[:, :AROUND][(place < BEFORE - left[:, None]) | (place >= BEFORE + right[:, None])] = 0
            around[:, AROUND], around[:, AROUND + 1] = left, right
            anchor = _hash16(self.eight, at, at + 8)
            part, which = Surroundings(bucket_of(anchor, buckets), anchor, around, self.ids[self.row[some]], hot[entry[some]]).distinct()
            parts.append(part)
            whiches.append(which + n)
            n += len(part.ids)
        if parts:
            found, which = Surroundings.joined(parts).distinct()
            found.which = which[np.concatenate(whiches)]
        found.mine = mine
        return found


class Surroundings:
    """Rows by bucket: the anchor's hash, the bytes with the two extents, the least id, and whether
    the anchor is hot. Of a pack also ``mine``, its shared anchors, and ``which``, the row of each."""

    def __init__(self, bucket: np.ndarray, anchor: np.ndarray, around: np.ndarray, ids: np.ndarray, hot: np.ndarray):
        self.bucket, self.anchor, self.around, self.ids, self.hot = bucket, anchor, around, ids, hot
        self.mine = self.which = np.zeros(0, np.int64)

    @classmethod
    def none(cls) -> Surroundings:
        return cls(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros((0, AROUND + 4), np.uint8), np.zeros(0, np.int64), np.zeros(0, bool))

    @classmethod
    def joined(cls, parts: list[Surroundings]) -> Surroundings:
        return cls(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("bucket", "anchor", "around", "ids", "hot")))

    def distinct(self) -> tuple[Surroundings, np.ndarray]:
        """Equal rows as one, with the least id, in order of buckets; and which each row is."""
        order = np.lexsort((self.ids, _row_hash(self.around), self.anchor, self.bucket))
        b, a, w = self.bucket[order], self.anchor[order], self.around[order]
        fresh = np.ones(len(order), bool)
        fresh[1:] = (b[1:] != b[:-1]) | (a[1:] != a[:-1]) | (w[1:] != w[:-1]).any(axis=1)
        begins = np.flatnonzero(fresh)
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(fresh) - 1
        return Surroundings(b[begins], a[begins], w[begins], self.ids[order][begins], self.hot[order][begins]), which

    def asked(self, buckets: int) -> Iterator[tuple[int, bytes, bytes, bytes]]:
        """Requests by bucket: hashes of anchors, bytes and ids; those of hot ones, in buckets of their
        own, have both halves of the strings' hashes and ids."""
        plain = np.flatnonzero(~self.hot)
        edges = np.searchsorted(self.bucket[plain], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = plain[edges[k] : edges[k + 1]]
            yield k, self.anchor[own].tobytes(), self.around[own].tobytes(), self.ids[own].tobytes()
        strings, _ = self.hot_strings(buckets)
        edges = np.searchsorted(strings[0], np.arange(buckets + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            own = slice(edges[k], edges[k + 1])
            yield buckets + k, strings[1][own].tobytes(), strings[2][own].tobytes(), strings[3][own].tobytes()

    def hot_strings(self, buckets: int) -> tuple[tuple[np.ndarray, ...], np.ndarray]:
        """The distinct strings in hot surroundings, by bucket: the bucket, two hashes and the least id;
        and for each hot row and start which string it is, -1 where none fits."""
        rows = np.flatnonzero(self.hot)
        around, ids = self.around[rows], self.ids[rows]
        fits = _fits(around[:, AROUND, None], around[:, AROUND + 1, None])
        which = np.full((len(rows), STARTS), -1, np.int64)
        found, n = [], 0
        for start in range(STARTS):
            valid = np.flatnonzero(fits[:, start])
            if not len(valid):
                continue
            string = np.zeros((len(valid), -(-MATCH // 8) * 8), np.uint8)
            string[:, :MATCH] = around[valid, start : start + MATCH]
            words = string.view(np.uint64)
            one, two = np.zeros(len(valid), np.uint64), np.full(len(valid), start, np.uint64)
            for column in words.T:
                one = mix(one * _P[2] + column)
                two = mix((two + column) * _P[1] + _P[0])
            order = np.lexsort((ids[valid], two, one))
            h, t = one[order], two[order]
            begins = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]))
            own = np.zeros(len(valid), np.int64)
            own[begins] = 1
            which[valid[order], start] = n + np.cumsum(own) - 1
            found.append((h[begins], t[begins], ids[valid][order][begins]))
            n += len(begins)
        if not found:
            none = np.zeros(0, np.uint64)
            return (np.zeros(0, np.int64), none, none, np.zeros(0, np.int64)), which
        one, two, least = (np.concatenate(columns) for columns in zip(*found))
        bucket = bucket_of(one, buckets)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(n + 1, np.int64)
        place[order] = np.arange(n)
        place[n] = -1  # of those that do not fit
        return (bucket[order], one[order], two[order], least[order]), place[which]


def bucket_of(anchor: np.ndarray, buckets: int) -> np.ndarray:
    return ((anchor >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)


def _row_hash(rows: np.ndarray) -> np.ndarray:
    columns = np.ascontiguousarray(rows).view(np.uint64) if len(rows) else np.zeros((0, 1), np.uint64)
    h = np.zeros(len(rows), np.uint64)
    for k in range(columns.shape[1]):
        h = mix(h * _P[2] + columns[:, k])
    return h


def equal_suffixes(around: np.ndarray) -> Callable[[int, int], np.ndarray]:
    """Sorts all block suffixes of surroundings. The result tells for a block and a number of
    blocks which surroundings agree there, as a class number for each of them."""
    rows = len(around)
    blocks = np.ascontiguousarray(around[:, :AROUND]).reshape(rows * BLOCKS, BLOCK)
    head, tail = np.ascontiguousarray(blocks[:, :8]).view(np.uint64)[:, 0], np.ascontiguousarray(blocks[:, 8:]).view(np.uint32)[:, 0]
    order = np.lexsort((tail, head))
    h, t = head[order], tail[order]
    symbol = np.empty(len(order), np.int64)
    symbol[order] = np.cumsum(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])])[: len(order)])
    text = np.zeros((rows, BLOCKS + 1), np.int64)
    text[:, :BLOCKS] = symbol.reshape(rows, BLOCKS)
    text = np.concatenate([[0], text.ravel()])
    sorted_at = np.array(suffix_order(text.tolist()), np.int64)
    long = np.concatenate([text, np.zeros(BLOCKS, np.int64)])
    common = np.zeros(len(text), np.int64)  # blocks in common with the suffix before
    agree = np.ones(len(text) - 1, bool)
    for k in range(-(-MATCH // BLOCK)):
        agree &= long[sorted_at[1:] + k] == long[sorted_at[:-1] + k]
        common[1:] += agree
    rank = np.empty(len(text), np.int64)
    rank[sorted_at] = np.arange(len(text))
    place = 1 + np.arange(rows) * (BLOCKS + 1)

    def classes(block: int, many: int) -> np.ndarray:
        return np.cumsum(common < many)[rank[place + block]]

    return classes


def _fits(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the string at each start lies within the document."""
    start = np.arange(STARTS)
    return (BEFORE - left.astype(np.int64) <= start) & (start + MATCH <= BEFORE + right.astype(np.int64))


def least_ids(around: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each surroundings and start, the least id of those with an equal string there."""
    rows = len(around)
    least = np.full((rows, STARTS), NO_ID, np.int64)
    classes = equal_suffixes(around)
    fits = _fits(around[:, AROUND, None], around[:, AROUND + 1, None])
    for start in range(STARTS):
        valid = np.flatnonzero(fits[:, start])
        if not len(valid):
            continue
        first, last = -(-start // BLOCK), (start + MATCH) // BLOCK
        ends = np.zeros((len(valid), 16), np.uint8)  # the bytes at both ends that fill no block
        head = first * BLOCK - start
        ends[:, :head] = around[valid, start : first * BLOCK]
        ends[:, head : head + start + MATCH - last * BLOCK] = around[valid, last * BLOCK : start + MATCH]
        ends = ends.view(np.uint64)
        own = classes(first, last - first)[valid]
        order = np.lexsort((ends[:, 1], ends[:, 0], own))
        own, ends = own[order], ends[order]
        begins = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (ends[1:] != ends[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(begins, len(own)))
        least[valid[order], start] = np.repeat(np.minimum.reduceat(ids[valid[order]], begins), sizes)
    return least


def _runs(least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal neighbours as one: how many runs each row has, their lengths and values."""
    change = np.ones(least.shape, bool)
    change[:, 1:] = least[:, 1:] != least[:, :-1]
    begins = np.flatnonzero(change.ravel())
    return change.sum(axis=1).astype(np.uint8), np.diff(np.append(begins, least.size)).astype(np.uint8), least.ravel()[begins]


def _binary_rows(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[name], kinds[name]) for name in kinds], names=list(kinds))


_ENTRIES = {"pack": pa.int64(), "bucket": pa.int32(), "anchors": pa.binary(), "parts": pa.binary(), "twice": pa.binary()}
_SHARED = {"pack": pa.int64(), "bucket": pa.int32(), "hot": pa.binary(), "shared": pa.binary()}
_AROUND = {"pack": pa.int64(), "bucket": pa.int32(), "anchors": pa.binary(), "around": pa.binary(), "ids": pa.binary()}
_REPLY = {"pack": pa.int64(), "bucket": pa.int32(), "runs": pa.binary(), "lengths": pa.binary(), "values": pa.binary()}


def _ddl(kinds: dict[str, pa.DataType]) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary"}
    return ", ".join(f"{name} {names[kind]}" for name, kind in kinds.items())


def write_packs(docs: DataFrame, text: int) -> DataFrame:
    """Documents in pack files, Arrow files in the shared folder: pack, uri, rows, bytes."""
    folder = f"{ensure_checkpoint_dir(docs.sparkSession).rstrip('/')}/packs-{uuid.uuid4()}"
    store, path = open_uri(folder)
    store.create_dir(path, recursive=True)

    @frugal
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        for number, (batch, data, offsets) in enumerate(pieces(batches, text, PACK_BYTES)):
            found = anchors(data, offsets)
            at = np.searchsorted(found, offsets)
            local = found - np.repeat(offsets[:-1], np.diff(at))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(local, pa.uint32()))
            whole = pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "anchors"])
            name = f"pack-{context.partitionId():05d}-{number:05d}-{context.taskAttemptId()}.arrow"
            own, place = open_uri(folder)
            with own.open_output_stream(f"{place}/{name}", compression=None) as sink, pa.ipc.new_file(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
                writer.write_batch(whole)
            ids = [pa.array([context.partitionId() << 32 | number]), pa.array([f"{folder}/{name}"]), pa.array([batch.num_rows]), pa.array([len(data)])]
            yield pa.RecordBatch.from_arrays(ids, names=["pack", "uri", "rows", "bytes"])

    return cut(docs.mapInArrow(write, "pack bigint, uri string, rows bigint, bytes bigint"))


def _read_pack(uri: str, text: int, doc: int) -> Pack:
    store, path = open_uri(uri)
    with store.open_input_file(path) as source:
        return Pack(pa.ipc.open_file(source).get_batch(0), text, doc)


def _each_pack(batches: Iterable[pa.RecordBatch]) -> Iterator[list]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield [column[k].as_py() for column in batch.columns]


def _bitmaps(replies: list[dict] | None) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By bucket, bits for its entries: whether several rows have it, whether its anchor is hot."""
    return {r["bucket"]: (np.frombuffer(r["shared"], np.uint8), np.frombuffer(r["hot"], np.uint8)) for r in replies or []}


def _shared_anchors(packs: DataFrame, buckets: int, text: int, doc: int, hot_entries: int) -> DataFrame:
    """For each pack and bucket a bit for each entry: whether several rows have it, and whether
    its anchor has more than ``hot_entries`` entries."""

    @frugal
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, uri in _each_pack(batches):
            edges, short, parts, twice, _ = _read_pack(uri, text, doc).entries(buckets)
            own = np.flatnonzero(np.diff(edges)).tolist()
            cuts = [slice(edges[k], edges[k + 1]) for k in own]
            yield _binary_rows({"pack": [pack] * len(own), "bucket": own, "anchors": [short[c].tobytes() for c in cuts], "parts": [parts[c].tobytes() for c in cuts], "twice": [np.packbits(twice[c]).tobytes() for c in cuts]}, _ENTRIES)

    def compare(group: pa.Table) -> pa.Table:
        short = [np.frombuffer(a, np.uint32) for a in group.column("anchors").to_pylist()]
        sizes = [len(s) for s in short]
        parts = np.concatenate([np.frombuffer(p, np.uint32) for p in group.column("parts").to_pylist()])
        twice = np.concatenate([np.unpackbits(np.frombuffer(t, np.uint8), count=n) for t, n in zip(group.column("twice").to_pylist(), sizes)]).astype(bool)
        anchor = np.concatenate(short).astype(np.uint64) << np.uint64(16)
        shared = np.zeros(len(anchor), bool)
        for part in (parts >> np.uint32(16), parts & np.uint32(0xFFFF)):
            key = anchor | part.astype(np.uint64)
            order = np.argsort(key, kind="stable")
            own = key[order]
            begins = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            many = np.diff(np.append(begins, len(own))) > 1
            several = np.repeat(many, np.diff(np.append(begins, len(own)))) & (part[order] != 0x8000)
            shared[order] |= several
            shared |= twice & (part != 0x8000)
        edges = np.cumsum([0, *sizes])
        order = np.argsort(anchor, kind="stable")
        begins = np.flatnonzero(np.concatenate([[True], anchor[order][1:] != anchor[order][:-1]])[: len(order)])
        many = np.diff(np.append(begins, len(order)))
        hot = np.zeros(len(anchor), bool)
        hot[order] = np.repeat(many > hot_entries, many)
        bits = [[np.packbits(flags[a:b]).tobytes() for a, b in zip(edges[:-1], edges[1:])] for flags in (hot, shared)]
        hot_bits, shared_bits = (pa.chunked_array([pa.array(own, pa.binary())]) for own in bits)
        return pa.table({"pack": group.column("pack"), "bucket": group.column("bucket"), "hot": hot_bits, "shared": shared_bits})

    return packs.select("pack", "uri").mapInArrow(ask, _ddl(_ENTRIES)).groupBy("bucket").applyInArrow(compare, _ddl(_SHARED))


def _least_in_groups(asked: DataFrame, buckets: int) -> DataFrame:
    """For each pack's surroundings the least id with an equal string at each start; for strings
    of hot anchors the least id of each."""

    def compare_strings(group: pa.Table) -> pa.Table:
        one, two, ids = (
            np.concatenate([np.frombuffer(x, kind) for x in group.column(name).to_pylist()])
            for name, kind in (("anchors", np.uint64), ("around", np.uint64), ("ids", np.int64))
        )
        sizes = [len(x) // 8 for x in group.column("ids").to_pylist()]
        order = np.lexsort((two, one))
        h, t = one[order], two[order]
        begins = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (t[1:] != t[:-1])]))
        least = np.empty(len(ids), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(ids[order], begins), np.diff(np.append(begins, len(order))))
        edges = np.cumsum([0, *sizes])
        none = pa.chunked_array([pa.array([b""] * len(sizes), pa.binary())])
        values = pa.chunked_array([pa.array([least[x:y].tobytes() for x, y in zip(edges[:-1], edges[1:])], pa.binary())])
        return pa.table({"pack": group.column("pack"), "bucket": group.column("bucket"), "runs": none, "lengths": none, "values": values})

    def compare(group: pa.Table) -> pa.Table:
        if group.column("bucket")[0].as_py() >= buckets:
            return compare_strings(group)
        hashes = [np.frombuffer(a, np.uint64) for a in group.column("anchors").to_pylist()]
        sizes = [len(a) for a in hashes]
        anchor = np.concatenate(hashes)
        around = np.frombuffer(b"".join(group.column("around").to_pylist()), np.uint8).reshape(len(anchor), AROUND + 4)
        ids = np.concatenate([np.frombuffer(i, np.int64) for i in group.column("ids").to_pylist()])
        order = np.lexsort((ids, _row_hash(around), anchor))
        a, w = anchor[order], around[order]
        new_anchor = np.concatenate([[True], a[1:] != a[:-1]])[: len(a)]
        fresh = new_anchor.copy()
        fresh[1:] |= (w[1:] != w[:-1]).any(axis=1)
        which = np.empty(len(a), np.int64)
        which[order] = np.cumsum(fresh) - 1
        first = np.flatnonzero(fresh)
        distinct, least_id = w[first], ids[order][first]
        number = np.cumsum(new_anchor[first]) - 1  # of the anchor of each distinct surroundings
        alone = np.bincount(number)[number] == 1 if len(number) else np.zeros(0, bool)
        least = np.where(_fits(distinct[:, AROUND, None], distinct[:, AROUND + 1, None]), least_id[:, None], NO_ID)
        rest = np.flatnonzero(~alone)
        low = 0
        while low < len(rest):  # anchors stay whole, so that a hot one is sorted in one go
            high = min(low + SORT_ROWS, len(rest))
            high += int(np.searchsorted(number[rest[high - 1 :]], number[rest[high - 1]], "right")) - 1
            own = rest[low:high]
            least[own] = least_ids(distinct[own], least_id[own])
            low = high
        edges = np.cumsum([0, *sizes])
        replies = [_runs(least[which[x:y]]) for x, y in zip(edges[:-1], edges[1:])]
        binary = [pa.chunked_array([pa.array([r[k].tobytes() for r in replies], pa.binary())]) for k in range(3)]
        del a, w, around, distinct, least, replies
        give_back()
        return pa.table({"pack": group.column("pack"), "bucket": group.column("bucket"), "runs": binary[0], "lengths": binary[1], "values": binary[2]})

    return asked.groupBy("bucket").applyInArrow(compare, _ddl(_REPLY))


def _removed(pack: Pack, buckets: int, shared: dict[int, np.ndarray], replies: list[dict]) -> np.ndarray:
    """A flag for each byte of the pack: covered by a string that a smaller id has too."""
    found = pack.surroundings(buckets, shared)
    mine, which = found.mine, found.which
    least = np.full((len(found.ids), STARTS), NO_ID, np.int64)
    plain, hot = np.flatnonzero(~found.hot), np.flatnonzero(found.hot)
    edges = np.searchsorted(found.bucket[plain], np.arange(buckets + 1))
    strings, string = found.hot_strings(buckets)
    hot_edges = np.searchsorted(strings[0], np.arange(buckets + 1))
    of_string = np.full(len(strings[3]) + 1, NO_ID, np.int64)  # the last one is of those that do not fit
    for r in replies:
        k, values = r["bucket"], np.frombuffer(r["values"], np.int64)
        if k >= buckets:
            of_string[hot_edges[k - buckets] : hot_edges[k - buckets + 1]] = values
            continue
        runs, lengths = np.frombuffer(r["runs"], np.uint8), np.frombuffer(r["lengths"], np.uint8)
        least[plain[edges[k] : edges[k] + len(runs)]] = np.repeat(values, lengths).reshape(len(runs), STARTS)
    least[hot] = of_string[string]
    starts = np.zeros(len(pack.data) + MATCH, bool)
    ids = pack.ids[pack.row[mine]]
    for low in range(0, len(mine), 1 << 16):
        some = slice(low, low + (1 << 16))
        row, start = np.nonzero(least[which[some]] < ids[some, None])
        starts[pack.at[mine[some]][row] - BEFORE + start] = True
    change = starts.astype(np.int32)
    change[MATCH:] -= starts[:-MATCH]
    return np.cumsum(change)[: len(pack.data)] > 0


_OUT = (StructField("n_bytes", LongType()), StructField("spans", ArrayType(LongType())), StructField("kept_sha256", StringType()))


def remove_repeats(docs: DataFrame, carry: list[str] | None = None, hot_entries: int = HOT_ENTRIES) -> DataFrame:
    """The documents with their repeated bytes marked: the columns in ``carry`` (all if None),
    and n_bytes, spans (begin and end of each maximal removed run, one after the other),
    kept_sha256 and, where ``carry`` has text, the text that is left.

    A byte is removed if it is covered by a MATCH-byte string of its document that also starts
    in a document of smaller doc_id. Texts are taken as UTF-8 and judged as they came in; null
    is empty. A null id is greater than all others; rows of one id do not remove from each
    other. Text that is left may begin or end within a character, whose bytes are then left
    out of the text column (not of the digest); a text that was null stays null. Every row
    gives a row. Columns added must not clash with those in ``carry``. What an anchor with more
    than ``hot_entries`` entries (a pack and what is beside the anchor) is compared by has no
    effect on the result.
    """
    carry = docs.columns if carry is None else carry
    own = docs.select(*dict.fromkeys(["doc_id", "text", *carry]))
    own = own.withColumn("doc_id", F.col("doc_id").cast("long"))
    text, doc = own.columns.index("text"), own.columns.index("doc_id")
    packs = write_packs(own, text)
    buckets = int((packs.agg(F.sum("bytes")).first()[0] or 0) // BUCKET_BYTES) + 1
    grouped = lambda df, *columns: df.groupBy("pack").agg(F.collect_list(F.struct(*columns)).alias(columns[-1] + "_list"))
    shared = cut(grouped(_shared_anchors(packs, buckets, text, doc, hot_entries), "bucket", "hot", "shared"))

    @frugal
    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pack, uri, bitmaps in _each_pack(batches):
            rows = list(_read_pack(uri, text, doc).surroundings(buckets, _bitmaps(bitmaps)).asked(buckets))
            bucket, anchor, around, ids = ([r[k] for r in rows] for k in range(4))
            yield _binary_rows({"pack": [pack] * len(rows), "bucket": bucket, "anchors": anchor, "around": around, "ids": ids}, _AROUND)

    known = packs.select("pack", "uri").join(shared, "pack", "left")
    replies = grouped(_least_in_groups(known.mapInArrow(ask, _ddl(_AROUND)), buckets), "bucket", "runs", "lengths", "values")
    kept = [own.columns.index(name) for name in carry]
    schema = StructType([*own.select(*carry).schema.fields, *_OUT])

    @frugal
    def remove(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, uri, bitmaps, found in _each_pack(batches):
            pack = _read_pack(uri, text, doc)
            gone = _removed(pack, buckets, _bitmaps(bitmaps), found or [])
            spans, digests, left = [], [], []
            for a, b in zip(pack.offsets[:-1], pack.offsets[1:]):
                flags = np.concatenate([[False], gone[a:b], [False]])
                spans.append(np.flatnonzero(flags[1:] != flags[:-1]).tolist())
                bytes_left = pack.data[a:b][~gone[a:b]].tobytes()
                digests.append(hashlib.sha256(bytes_left).hexdigest())
                left.append(bytes_left)
            columns = []
            for k in kept:
                column = pack.batch.column(k)
                if k == text:
                    texts = [None if null else x.decode("utf-8", "ignore") for null, x in zip(column.is_null().to_pylist(), left)]
                    column = pa.array(texts, column.type)
                columns.append(column)
            sizes = pa.array(np.diff(pack.offsets), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, sizes, pa.array(spans, pa.list_(pa.int64())), pa.array(digests, pa.string())], names=schema.names)

    return known.join(replies, "pack", "left").mapInArrow(remove, schema)


def repeat_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document row."""
    found = remove_repeats(pick(docs, "doc_id", "text"), ["doc_id"])
    removed = F.expr("aggregate(spans, 0L, (a, x) -> x - a)")  # ends minus begins: the signs alternate
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.floor(F.size("spans") / 2).cast("long").alias("n_spans"), "kept_sha256")


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents, with their own columns, and the text that is left."""
    plain, at = numbered(docs)
    plain = plain.withColumnsRenamed({at["doc_id"]: "doc_id", at["text"]: "text"})
    return remove_repeats(plain).select(*plain.columns).toDF(*docs.columns)
