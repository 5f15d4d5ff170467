"""The manifest against trees built one after another, and its query against SQL."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from checks.compare import connect, difference
from tourledger.llm import registry
from tourledger.llm.manifest import BLOCK, document_manifest, folded, manifest, ranked, siblings

SCHEMA = "lang string, doc_id long, leaf string, C0 string, extra int"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def tree(digests: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and each leaf's siblings before and after it by level."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for path, i in zip(paths, at):
            begin = i // 8 * 8
            path.append(("".join(level[begin:i]), "".join(level[i + 1 : begin + 8])))
        level = [sha("".join(level[i : i + 8])) for i in range(0, len(level), 8)]
        at = [i // 8 for i in at]
    return level[0], paths


def expected(rows: list[tuple]) -> list[tuple]:
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[0]].append(row)
    langs = sorted(by_lang, key=lambda l: (l is not None, (l or "").encode()))
    trees = []
    for lang in langs:
        own = sorted(by_lang[lang], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3] is not None, r[3] or ""))
        trees.append((own, *tree([row[2] for row in own])))
    root, tops = tree([subroot for _, subroot, _ in trees])
    return [(*row[:4], slot, subroot, root, path + top) for (own, subroot, paths), top in zip(trees, tops) for slot, (row, path) in enumerate(zip(own, paths))]


def found(df) -> list[tuple]:
    return [(r.lang, r.doc_id, r.leaf, r.C0, r.slot, r.subroot, r.root, [(p.before, p.after) for p in r.path]) for r in df.collect()]


def check(spark, rows: list[tuple]) -> None:
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = found(manifest(df, "lang", "doc_id", "leaf", ["C0"]))
    assert sorted(got, key=repr) == sorted(expected(rows), key=repr)


def row(lang: str | None, doc_id: int | None, text: str = "") -> tuple:
    return lang, doc_id, sha(f"{lang}|{doc_id}|{text}"), text or None, 1


def test_ids_of_all_kinds(spark):
    """Dense and sparse ids, the ends of the range, negatives, words with all bits, empty and null groups."""
    rng = random.Random(1)
    ids = [*range(-70, 130), 2**63 - 1, -(2**63), 2**38, 2**38 + 1, 2**22 - 1, 2**22, 2**54, -(2**54) - 1, *(rng.randrange(-(2**63), 2**63) for _ in range(300))]
    rows = [row(rng.choice(["de", "en", None, "", "é", "=", "EN"]), i) for i in dict.fromkeys(ids)]
    check(spark, rows + [row("one", 5)])


def test_repeated_and_null_ids(spark):
    rng = random.Random(2)
    rows = [row("a", rng.randrange(40), rng.choice("xyz")) for _ in range(300)]
    rows += [row("a", None, rng.choice("xyz") * rng.randrange(3)) for _ in range(200)] + [row("a", 7, "same")] * 90
    rows += [row(None, None, "t")] * 9 + [row("b", k) for k in range(100)]
    check(spark, rows)


@pytest.mark.parametrize("n", [1, 8, 9, BLOCK, BLOCK + 1, 2 * BLOCK + 8])
def test_round_numbers_of_leaves(spark, n):
    check(spark, [row("a", 3 * k) for k in range(n)] + [row("b", 1)])


def test_more_groups_than_a_block_has_slots(spark):
    check(spark, [row(f"lang {k}", 1) for k in range(BLOCK + 60)])


def test_no_leaves(spark):
    assert manifest(spark.createDataFrame([], SCHEMA), "lang", "doc_id", "leaf").collect() == []


def test_ranked(spark):
    keys = spark.createDataFrame([(f"{k * 7919 % 1000:03}",) for k in range(1000)], "key string")
    assert [(r.slot, r.key) for r in ranked(keys, "key").orderBy("slot").collect()] == [(k, f"{k:03}") for k in range(1000)]


def test_a_changed_leaf_or_sibling_does_not_lead_to_the_root(spark):
    df = spark.createDataFrame([row("a", k) for k in range(100)], SCHEMA)
    paths = manifest(df, "lang", "doc_id", "leaf")
    other = F.transform("path", lambda p: F.struct(F.reverse(p["before"]).alias("before"), F.reverse(p["after"]).alias("after")))
    roots = paths.select("root", folded(F.col("leaf"), F.col("path")).alias("own"), folded(F.reverse("leaf"), F.col("path")).alias("leaf"), folded(F.col("leaf"), other).alias("sibling"))
    assert {(r.own == r.root, r.leaf == r.root, r.sibling == r.root) for r in roots.collect()} == {(True, False, False)}
    assert {len(r.s) for r in paths.select(siblings(F.col("path")).alias("s")).collect()} == {64 * 15, 64 * 12, 64 * 8}


def documents(spark, tmp_path) -> str:
    rng = random.Random(3)
    texts = [None, "", "Abc", "abc", "é É ß", "漢" * 50, "X" * 100_000]
    rows = [(k % 300 - 20, rng.choice(["s", None, ""]), rng.choice(["en", "de", None]), rng.choice([None, k]), rng.choice(texts), "clash", k) for k in range(700)]
    rows += [(None, None, None, None, None, None, 0)] * 3 + [(5, "s", "en", 4, "Copy", "c", 1)] * 40
    schema = "doc_id long, source string, lang string, n_chars long, text string, LEAF string, word long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/raw")
    return str(tmp_path)


def test_query_on_edge_rows(spark, tmp_path):
    folder = documents(spark, tmp_path)
    con = connect(folder)
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/raw/*.parquet'")
    docs = spark.read.parquet(f"{folder}/raw")
    real = registry.table
    try:
        registry.table = lambda *_: docs
        df = registry.op12_manifest(spark, folder)
    finally:
        registry.table = real
    assert difference(df, con, registry.MANIFEST) is None
    assert document_manifest(docs.limit(0)).collect() == []


def test_query(spark, sf_dir, duck):
    assert difference(registry.queries()["op12_manifest"](spark, sf_dir), duck, registry.MANIFEST) is None
