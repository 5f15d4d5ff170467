"""The pipeline stage by stage against brute force: the same documents, with the same texts."""

from __future__ import annotations

import random
import re

import duckdb
import pandas as pd

import corpus_pipeline
from tourledger.llm import registry
from tourledger.llm.substring_dedup import MATCH

WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return re.findall(WORD, (text or "").encode().translate(_LOWER))


def prose(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("the of and tion ing er an re on at".split()) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def corpus() -> tuple[list[tuple], list[tuple]]:
    """Documents (doc_id, text, lang, source, n_chars) and benchmark items."""
    rng = random.Random(12)
    items = [(k, " ".join(prose(rng, 30))) for k in range(4)] + [(9, "alpha beta gamma"), (10, None), (11, "")]
    texts: list[str | None] = [None, "", "?! 12", "одно", "שלום עולם", "你好", "word", "Ωμέγα " * 30, "a" * 4000, "= " * 300 + "x"]
    base = [prose(rng, n) for n in (12, 40, 80, 200, 2500)]
    for own in base:
        texts += [" ".join(own), " ".join(own).upper(), " ".join(own[:-1] + ["changed"])]
        moved = own[len(own) // 2 :] + own[: len(own) // 2]
        texts.append(" ".join(moved))
        texts.append(" ".join(w if k % 3 else "other" for k, w in enumerate(own)))
    passage = " ".join(prose(rng, 40))
    texts += [f"{' '.join(prose(rng, 15))} {passage} {' '.join(prose(rng, 15))}" for _ in range(5)]
    texts += [f"{' '.join(prose(rng, 5))} {items[k][1]} {' '.join(prose(rng, 5))}" for k in range(3)]  # contaminated
    texts += [f"{' '.join(prose(rng, 900))} {items[3][1]}", f"{' '.join(prose(rng, 70))} alpha beta gamma", "alpha beta gamma delta"]
    texts += [" ".join(prose(rng, rng.randint(1, 60))) for _ in range(30)]
    ids = rng.sample(range(1000), len(texts))
    return [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "b", "é", None]), None) for i, t in zip(ids, texts)], items


def with_letters(docs: list[tuple]) -> list[tuple]:
    return [d for d in docs if d[1] is not None and any(c.isalpha() for c in d[1])]


def distance(a: list, b: list) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before if x == y else 1 + min(row[j], row[j - 1])
    return row[-1]


def one_of_each(docs: list[tuple]) -> list[tuple]:
    """Of each component of all pairs with similar shingles and a close alignment, the least id."""
    words = [words_of(d[1]) for d in docs]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(docs)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if not both or both < 0.8 * len(sets[i] | sets[j]):
                continue
            if distance(words[i], words[j]) <= 0.2 * (len(words[i]) + len(words[j])) + 1e-9:
                root[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, d in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d[0]), d[0])
    return [d for i, d in enumerate(docs) if d[0] == least[find(i)]]


def without_repeats(docs: list[tuple]) -> list[tuple]:
    coded = [(d, (d[1] or "").encode()) for d in docs]
    first: dict[bytes, int] = {}
    for d, t in coded:
        for k in range(len(t) - MATCH + 1):
            first[t[k : k + MATCH]] = min(first.get(t[k : k + MATCH], d[0]), d[0])
    kept = []
    for d, t in coded:
        gone = bytearray(len(t))
        for k in range(len(t) - MATCH + 1):
            if first[t[k : k + MATCH]] < d[0]:
                gone[k : k + MATCH] = b"\1" * MATCH
        left = bytes(x for x, g in zip(t, gone) if not g).decode("utf-8", "ignore")
        kept.append((d[0], None if d[1] is None else left, *d[2:]))
    return kept


def clean(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    windows = set()
    for _, text in items:
        own = words_of(text)
        size = min(13, len(own))
        windows |= {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
    sizes = {len(w) for w in windows}
    kept = []
    for d in docs:
        own, hit = words_of(d[1]), set()
        for size in sizes:
            for k in range(len(own) - size + 1):
                if tuple(own[k : k + size]) in windows:
                    hit.update(range(k, k + size))
        if not hit or 20 * len(hit) < len(own):
            kept.append(d)
    return kept


def mixed(docs: list[tuple]) -> dict[int, int]:
    """Words that the mix takes, by the mixing query's SQL."""
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"text": "string", "source": "string"}))
    rows = con.execute(f"SELECT doc_id, taken FROM ({registry.MIXING}) WHERE taken > 0").fetchall()
    return dict(rows)


def test_each_stage_keeps_what_brute_force_keeps(spark, tmp_path):
    docs, items = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(docs, schema).repartition(3)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    expected = [with_letters(docs)]
    expected.append(one_of_each(expected[-1]))
    expected.append(without_repeats(expected[-1]))
    expected.append(clean(expected[-1], items))
    counts = [len(docs), *map(len, expected)]
    assert counts[0] > counts[1] > counts[2] == counts[3] > counts[4] > 40  # every stage has something to do, and leaves most
    for number, ((name, stage), own) in enumerate(zip(corpus_pipeline.STAGES, expected)):
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{number}")
        frame = spark.read.parquet(f"{tmp_path}/{number}")
        found = sorted((r.doc_id, r.text, r.lang or "", r.source or "") for r in frame.collect())
        assert found == sorted((d[0], d[1], d[2] or "", d[3] or "") for d in own), name
    last = {r.doc_id: (r.taken, r.text) for r in corpus_pipeline.STAGES[-1][1](spark, frame, str(tmp_path)).collect()}
    texts = {d[0]: d[1] for d in expected[-1]}
    assert last == {i: (taken, texts[i]) for i, taken in mixed(expected[-1]).items()}
    assert {r.doc_id: (r.taken, r.text) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()} == last
