"""Substring removal where anchors are hot, texts are of one character, and sorting is linear."""

from __future__ import annotations

import hashlib
import random
import re
import resource

import numpy as np
import pyarrow as pa
import pytest

from tourledger.llm import substring_dedup
from tourledger.llm.substring_dedup import MATCH, Pack, anchors, least_ids, repeat_digests
from tourledger.llm.suffix_sorting import suffix_order


def brute(texts: list[tuple[int, str]]) -> list[tuple]:
    first: dict[bytes, int] = {}
    coded = [(i, t.encode()) for i, t in texts]
    for i, t in coded:
        for k in range(len(t) - MATCH + 1):
            first[t[k : k + MATCH]] = min(first.get(t[k : k + MATCH], i), i)
    found = []
    for i, t in coded:
        gone = bytearray(len(t))
        for k in range(len(t) - MATCH + 1):
            if first[t[k : k + MATCH]] < i:
                gone[k : k + MATCH] = b"\1" * MATCH
        left = bytes(x for x, g in zip(t, gone) if not g)
        found.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest()))
    return sorted(found)


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n))


def footers(n: int) -> list[tuple[int, str]]:
    """A line of 40 bytes with other text on both sides, one of 70, and one that only some share more of."""
    rng = random.Random(7)
    line, longer = "All rights reserved by the same company.", "This longer line is the same in all documents, down to its last words."
    texts = []
    for k in range(n):
        beside = rng.choice([f"by {words(rng, 2)} {k}", "by Some Body, Anytown", words(rng, 9)])
        texts.append((k * 7 % (2 * n), f"{words(rng, 6)}\n{line} {beside}\n{longer}{words(rng, 3)}"))
    texts += [(3 * n + k, line) for k in range(3)] + [(4 * n, longer), (4 * n + 1, f"{longer}{longer}"), (4 * n + 2, "")]
    return texts


@pytest.mark.parametrize("hot_entries", [0, 3, 1 << 17])
def test_hot_anchors_are_compared_apart(spark, hot_entries):
    """With 0 every shared anchor is hot, with 3 some are."""
    texts = footers(120)
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    found = substring_dedup.remove_repeats(docs, ["doc_id"], hot_entries).selectExpr(
        "doc_id", "n_bytes", "aggregate(spans, 0L, (a, x) -> x - a) AS removed", "size(spans) div 2 AS n_spans", "kept_sha256"
    )
    assert sorted(tuple(r) for r in found.collect()) == brute(texts)


def pack_of(texts: list[str], ids: list[int]) -> Pack:
    column = pa.array(texts, pa.string())
    data, offsets = substring_dedup.text_bytes(column)
    found = anchors(data, offsets)
    at = np.searchsorted(found, offsets)
    lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found - np.repeat(offsets[:-1], np.diff(at)), pa.uint32()))
    return Pack(pa.RecordBatch.from_arrays([column, pa.array(ids), lists], names=["text", "doc_id", "anchors"]), 0, 1)


def test_texts_of_one_character_have_few_surroundings():
    """Two texts of 4 MB: every place is an anchor, but what is around them is the same but for the ends."""
    pack = pack_of(["-" * (4 << 20), "-" * (4 << 20)], [1, 2])
    entries = int(pack.entries(3)[0][-1])
    everything = {k: (np.full(entries // 8 + 1, 255, np.uint8), np.zeros(entries // 8 + 1, np.uint8)) for k in range(3)}
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    found = pack.surroundings(3, everything)
    grown = (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) / 1024
    assert len(pack.at) > 8_000_000 and len(found.ids) < 200 and len(found.which) == len(found.mine) == len(pack.at)
    assert grown < 1000  # MB


def test_texts_of_one_character(spark):
    texts = [(1, "-" * 60_000), (2, "-" * 70_001), (3, "-" * 49), (4, "-" * 50), (5, "= " * 30_000), (6, "x" + "= " * 30)]
    found = repeat_digests(spark.createDataFrame(texts, "doc_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == brute(texts)


@pytest.mark.parametrize("compared", [1, 5, 1 << 16])
def test_surroundings_do_not_depend_on_how_many_are_made_at_a_time(monkeypatch, compared):
    texts = [t for _, t in footers(40)]
    pack = pack_of(texts, list(range(len(texts))))
    edges = pack.entries(2)[0]
    everything = {k: (np.full(int(edges[-1]), 255, np.uint8), np.zeros(int(edges[-1]), np.uint8)) for k in range(2)}
    whole = pack.surroundings(2, everything)
    monkeypatch.setattr(substring_dedup, "COMPARED", compared)
    parts = pack.surroundings(2, everything)
    assert (whole.around[whole.which] == parts.around[parts.which]).all() and (whole.ids[whole.which] == parts.ids[parts.which]).all()
    assert len(whole.ids) == len(parts.ids) and (whole.bucket == parts.bucket).all()


def test_strings_by_hash_equal_strings_by_sorting():
    texts = [t for _, t in footers(60)]
    pack = pack_of(texts, list(range(len(texts))))
    many = int(pack.entries(1)[0][-1])
    found = pack.surroundings(1, {0: (np.full(many, 255, np.uint8), np.full(many, 255, np.uint8))})
    assert found.hot.all()
    strings, string = found.hot_strings(1)
    by_hash = np.append(strings[3], substring_dedup.NO_ID)[string]
    expected = np.empty_like(by_hash)
    for anchor in np.unique(found.anchor):
        own = np.flatnonzero(found.anchor == anchor)
        expected[own] = least_ids(found.around[own], found.ids[own])
    assert (by_hash == expected).all()


def test_suffixes_are_sorted_without_comparing(monkeypatch):
    """Larger texts against plain sorting, with the built-in sorts out of reach of the sorter."""
    import builtins

    from tourledger.llm import suffix_sorting

    rng = random.Random(5)
    texts = []
    for letters, n in ((1, 400), (2, 3000), (3, 3000), (50, 3000), (2000, 3000)):
        text = [0]
        for _ in range(6):
            text += [rng.randint(1, letters) for _ in range(n // 6)] + [0]
        texts.append(text)
        texts.append([0, *([1, 2] * 200), 0, *([1, 2] * 199), 1, 0])
    plain = builtins.sorted

    def refused(*_, **__):
        raise AssertionError("a comparison sort")

    monkeypatch.setattr(suffix_sorting, "sorted", refused, raising=False)
    for text in texts:
        order = suffix_order(text)
        ends, end = [0] * len(text), 0
        for i in range(len(text) - 1, -1, -1):
            end = i if not text[i] else end
            ends[i] = end
        suffixes = [text[i : ends[i] + 1] for i in order]
        assert plain(order) == list(range(len(text))) and suffixes == plain(suffixes)
