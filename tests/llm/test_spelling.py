"""Spelling variants against all pairs, and the query against SQL."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from checks.compare import connect, difference
from tourledger.llm import registry, spelling
from tourledger.llm.spelling import boxes_within, near_words, points, spelling_variants, variants, word_counts

DOCS = "TEXT string, doc_id long, text string, word string, n long"


def is_near(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(counts: dict[str, int]) -> set[tuple]:
    near = {a: [b for b in counts if is_near(a, b)] for a in counts}
    form = {}
    for word, found in near.items():
        best = min(found, key=lambda b: (-counts[b], b), default=None)
        form[word] = best if best is not None and counts[best] >= 2 * counts[word] else None
    rows = set()
    for word in counts:
        root = word
        while form[root] is not None:
            root = form[root]
        rows.add((word, counts[word], form[word], counts.get(form[word]), root, len(near[word])))
    return rows


def vocabulary(rng: random.Random, n: int) -> dict[str, int]:
    words = {"".join(rng.choice("abéÿ") for _ in range(rng.randint(5, 8))) for _ in range(n // 2)}
    words |= {"".join(rng.choice("etaoinsàèéùüß") for _ in range(rng.randint(5, 6))) for _ in range(n // 2)}
    words |= {"a" * k for k in range(5, 40)} | {"a" * 300, "a" * 301, "b" + "a" * 300, "x" * 5000, "x" * 4999 + "y"}
    return {word: rng.choice([3, 3, 4, 6, 7, 12, 12, 24, 50, 100]) for word in words}


def rows_of(df) -> set[tuple]:
    rows = [(r.word, r.n, r.form, r.form_n, r.root, r.n_near) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("box", [10, spelling.BOX])
def test_variants_are_those_of_all_pairs(spark, monkeypatch, box):
    """Small boxes ask many others; the driver alone reads the size."""
    monkeypatch.setattr(spelling, "BOX", box)
    counts = vocabulary(random.Random(box), 700)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert rows_of(variants(df)) == expected(counts)


def test_long_chains_and_ties(spark):
    words = ["abcde"]
    for k in range(12):
        words.append(words[-1] + "fghijklmnopq"[k])
    counts = {word: 3 * 2**k for k, word in enumerate(words)} | {"zzzzz": 5, "zzzza": 10, "zzzzb": 10, "lonely": 9}
    found = rows_of(variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert found == expected(counts)
    assert {r[4] for r in found if r[0] in words} == {words[-1]}
    assert next(r for r in found if r[0] == "zzzzz")[2] == "zzzza"


def test_each_link_once_per_direction(spark):
    counts = vocabulary(random.Random(9), 300)
    links = [(r.word, r.near, r.near_n) for r in near_words(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()]
    assert sorted(links) == sorted((a, b, counts[b]) for a in counts for b in counts if is_near(a, b))


def test_boxes_hold_what_is_near():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdé") for _ in range(7)) for _ in range(400)]
    own, _ = points(words)
    tree = spelling._planes(own, 12, [0])
    home = np.zeros(len(own), int)
    for box, rows in boxes_within(tree, own, 0):
        home[rows] = box
    assert len(set(home)) > 20
    apart = np.bitwise_count(own[:, None] ^ own[None, :])
    for radius in (1, 2):
        reached = {(int(row), box) for box, rows in boxes_within(tree, own, radius) for row in rows}
        for a, b in zip(*np.nonzero(apart <= radius)):
            assert (int(a), int(home[b])) in reached


def brute_counts(rows: list[tuple]) -> dict[str, int]:
    total = Counter()
    for doc_id, text in rows:
        runs, run = Counter(), ""
        for c in (text or "") + " ":
            c = c.lower() if "A" <= c <= "Z" else c
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            else:
                runs[run] += 1
                run = ""
        for run, n in runs.items():
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if run:
                total[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += n
    return {word: n for word, n in total.items() if len(word) >= 5 and n >= 3}


def document_rows() -> list[tuple]:
    rng = random.Random(8)
    texts = [None, "", "¡?", "x", "Écoles ÉCOLES écoles", "naïve×naïve÷naïve", "ĀbcdefĀbcdef", "漢abcde漢abcde", "a" * 6000, "q1w2e3", "don't don't don't"]
    words = ["".join(rng.choice("aeiourstlnÉé") for _ in range(rng.randint(4, 9))) for _ in range(120)]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 400))) for _ in range(120)]
    rows = [("other", k % 90 - 5, text, "w", 1) for k, text in enumerate(texts)]
    return rows + [("o", None, texts[-1], None, None), ("o", None, None, None, None), rows[-1], rows[-1]]


@pytest.mark.parametrize("chunk", [7, spelling.CHUNK])
def test_word_counts(spark, monkeypatch, chunk):
    monkeypatch.setattr(spelling, "CHUNK", chunk)
    rows = document_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    assert {r.word: r.n for r in word_counts(docs).collect()} == brute_counts([(r[1], r[2]) for r in rows])
    parts = [run for text in rows for runs in spelling._runs((text[2] or "").lower().encode()) for run in runs]
    assert parts == [run for text in rows for run in spelling._RUN.findall((text[2] or "").lower().encode())]


def test_query_on_edge_rows(spark, tmp_path):
    rows = document_rows()
    docs = spark.createDataFrame(rows, DOCS)
    docs.toDF("upper", *docs.columns[1:]).select("doc_id", "text").coalesce(1).write.parquet(f"{tmp_path}/raw")
    con = connect(str(tmp_path))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/raw/*.parquet'")
    assert difference(spelling_variants(docs), con, registry.SPELLING) is None
    assert rows_of(spelling_variants(docs)) == expected(brute_counts([(r[1], r[2]) for r in rows]))
    assert spelling_variants(docs.limit(0)).collect() == []


def test_query(spark, sf_dir, duck):
    assert difference(registry.queries()["op11_spelling_variants"](spark, sf_dir), duck, registry.SPELLING) is None
