"""Near duplicates: ids that say little, long texts, and what the alignment leaves out."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest

from tourledger.llm import near_dedup
from tourledger.llm.near_dedup import edit_distance, near_duplicates, one_of_each, similar

SCHEMA = "doc_id long, text string, key_a string, mark int"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 8))) for _ in range(n)]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_ids_that_all_rows_share(spark, doc_id):
    """2,000 texts under one id are fetched once each: the time does not grow with their square."""
    rng = random.Random(1)
    texts = [" ".join(words(rng, 12)) for _ in range(1000)]
    texts += [text + " more" for text in texts]
    rows = [(doc_id, text, "x", 1) for text in texts]
    started = time.perf_counter()
    sizes = Counter(r.group_size for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    same = time.perf_counter() - started
    assert sizes == {2: 2000}
    started = time.perf_counter()
    near_duplicates(spark.createDataFrame([(k, *row[1:]) for k, row in enumerate(rows)], SCHEMA)).collect()
    assert same < 2 * (time.perf_counter() - started) + 5


def test_one_of_each_keeps_its_columns(spark):
    rng = random.Random(2)
    text = " ".join(words(rng, 40))
    rows = [(3, text, "a", 1), (5, text.upper(), "b", 2), (9, text + " end", "c", 3), (None, text, "d", 4), (4, None, "e", 5), (4, "", "f", 6)]
    kept = one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "key_a", "mark"]
    assert sorted(r.mark for r in kept.collect()) == [1, 5, 6]


def plain_distance(a: list[int], b: list[int]) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def test_alignment_is_the_edit_distance():
    rng = random.Random(3)
    for _ in range(300):
        a = [rng.randint(0, 2) for _ in range(rng.randint(0, 30))]
        b = [x for x in a if rng.random() < 0.8] + [rng.randint(0, 2) for _ in range(rng.randint(0, 5))]
        distance = plain_distance(a, b)
        one, two = np.array(a, np.uint64), np.array(b, np.uint64)
        for band in {distance, distance + 1, len(a) + len(b)}:
            assert edit_distance(one, two, band) == distance
        if distance:
            assert edit_distance(one, two, distance - 1) is None


def test_long_texts_with_swapped_halves():
    """50,000 words: the shingles are nearly all the same, the order is not. Seconds, not hours."""
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 60, 50_000, np.uint64)
    started = time.perf_counter()
    assert not similar(a, np.concatenate([a[25_000:], a[:25_000]]))
    assert similar(a, np.delete(a, np.arange(0, 50_000, 50)))
    assert time.perf_counter() - started < 60


def test_moved_and_repeated_passages_are_no_near_duplicates(spark):
    """Meant so: their shingles agree, but an alignment has to delete and insert whole passages."""
    rng = random.Random(5)
    one, two, three = (words(rng, 100) for _ in range(3))
    texts = [one + two + three, three + two + one, one + one, one, one + two + three + ["x"]]
    rows = [(k, " ".join(text), None, None) for k, text in enumerate(texts)]
    found = {r.doc_id: r.group_id for r in near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}
    grams = [near_dedup.shingles(np.array([hash(w) for w in text], np.int64).view(np.uint64), np.array([0, len(text)]))[0] for text in texts]
    share = [len(np.intersect1d(grams[a], grams[b])) / len(np.union1d(grams[a], grams[b])) for a, b in ((0, 1), (2, 3))]
    assert min(share) > 0.9
