"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and
columns of clashing names, against brute force."""

from __future__ import annotations

import gzip
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

import corpus_pipeline
from tourledger.llm import chat, decontamination, hidden_markov, language_id, mixing, near_dedup, substring_dedup, topk, toxicity, warc
from tourledger.llm.suffix_sorting import suffix_order

DOCS = StructType([
    StructField("TEXT", StringType()), StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()), StructField("hits", StringType()), StructField("key", LongType()),
])
WORD = rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = rb"[^\x20\x09-\x0D]+"
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))


def lowered(text: str | None) -> bytes:
    return (text or "").encode().translate(_LOWER)


def held(doc_id: int | None, n: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def prose(rng: random.Random, n: int, words: str = "the of and tion ing er an re on at en nd ti es or te ed is it al") -> str:
    own = words.split()
    return " ".join("".join(rng.choice(own) for _ in range(rng.randint(1, 3))) for _ in range(n))


def document_rows() -> list[tuple]:
    rng = random.Random(5)
    base = [prose(rng, n) for n in (40, 60, 90, 120, 300)]
    passage = prose(rng, 60)
    texts = [None, "", " \n\t ", "?!", "...", "...", "one", "One", "two words", "été à l'école", "a" * 300, "ab" * 400, "Ünïcode ßtraße " * 30]
    texts += base + base[:2] + [base[0].upper()]
    for text in base:
        words = text.split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
        words[::9] = ["other"] * len(words[::9])
        texts.append(" ".join(words))
    texts += [f"{prose(rng, 10)} {passage} {prose(rng, 10)}" for _ in range(6)]
    texts += [" ".join(prose(rng, 30, "und der die ein ich sch keit") for _ in range(2)) for _ in range(6)]
    texts.append(prose(rng, 8000))
    rows = [(None, i * 7 % 1000, t, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", "é", None]), None, "x", 1) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], rows[0]]  # repeated rows
    rows += [(None, None, base[2], "en", "a", None, None, None), (None, None, None, None, None, None, None, None), (None, 7, prose(rng, 20), "en", "b", 3, None, None)]
    return rows


@pytest.fixture(scope="module")
def rows() -> list[tuple]:
    return document_rows()


@pytest.fixture(scope="module")
def plain(spark):
    """The rows under the names of documents alone."""
    return spark.createDataFrame(document_rows(), DOCS).toDF("upper", *DOCS.names[1:]).drop("upper").repartition(3).cache()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(document_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def collected(df, *names) -> list[tuple]:
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


# Language ID


def test_languages(docs, rows):
    found = language_id.languages(docs).collect()
    assert Counter((r.doc_id, r.held_out) for r in found) == Counter((r[1], held(r[1], 3) == 1) for r in rows)
    assert all(0 <= r.score <= 1 for r in found)
    letters = Counter(r[1] for r in rows if r[2] is not None and any(c.isalpha() for c in r[2]))
    assert Counter(r.doc_id for r in found if r.lang_pred != "und") == letters
    assert {r.lang_pred for r in found} == {"en", "de", "und"}


@pytest.mark.parametrize("kinds_a_block", [language_id._BLOCK_KINDS, 2])
def test_bundles_are_sums_of_bound_letters(monkeypatch, kinds_a_block):
    monkeypatch.setattr(language_id, "_BLOCK_KINDS", kinds_a_block)
    grams = language_id.Grams(np.frombuffer("Ab! c".encode(), np.uint8), np.array([0, 5]))
    letter = lambda c: language_id._letter(ord(c)).astype(int)
    bound = lambda w: np.roll(letter(w[0]), 2) * np.roll(letter(w[1]), 1) * letter(w[2])
    expected = sum(bound(w) for w in (" ab", "ab ", " c "))
    assert (grams.bundles(grams.row, 1)[0] == expected).all()


def test_no_languages(docs, none, rows):
    assert language_id.languages(none).collect() == []
    found = language_id.languages(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(found) == len(rows) and {(r.lang_pred, r.score) for r in found} == {("und", 0.0)}


def test_known_language_rejects_what_is_undetermined_alone(spark, plain):
    """One-word texts, in letters that no language was learned from too, are kept."""
    words = ["zq", "xkcd", "Ωμέγα", "привет", "שלום", "नमस्ते", "你好", "こんにちは", "한국어", "qwxz", "vjw", "Ж"]
    odd = [(None, 2000 + k, f"{word}{word[::-1]}" * (1 + k // 12), None, "a", None, None, None) for k, word in enumerate(words * 3)]
    odd += [(None, 2100, "12 34", None, "a", None, None, None), (None, 2101, None, None, "a", None, None, None)]
    docs = plain.unionByName(spark.createDataFrame(odd, DOCS).toDF("upper", *DOCS.names[1:]).drop("upper"))
    expected = Counter(r.doc_id for r in language_id.languages(docs).where("lang_pred != 'und'").collect())
    assert set(range(2000, 2036)) <= set(expected) and 2100 not in expected and 2101 not in expected
    assert Counter(r.doc_id for r in language_id.known_language(docs).collect()) == expected


# Mixing


def water_level(sizes: list[tuple[float, float]]) -> list[float]:
    """Targets for (cap, weight) by sharing out what is left until nothing is above its cap."""
    total, target = sum(c for c, _ in sizes) / 3, [0.0] * len(sizes)
    free = set(range(len(sizes)))
    while free:
        left = total - sum(target[i] for i in range(len(sizes)) if i not in free)
        share = left / sum(sizes[i][1] for i in free)
        over = {i for i in free if share * sizes[i][1] > sizes[i][0]}
        if not over:
            for i in free:
                target[i] = share * sizes[i][1]
            break
        for i in over:
            target[i] = sizes[i][0]
        free -= over
    return target


def test_mixing(docs, rows):
    found = mixing.mix_sources(docs, rows_per_shard=10).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in found) == Counter((r[1], r[4], len(re.findall(TOKEN, lowered(r[2])))) for r in rows)
    sizes = Counter()
    for r in found:
        sizes[r.source] += r.size
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, water_level([(3.0 * sizes[s], i % 3 + 1.0) for i, s in enumerate(order)])))
    taken = Counter()
    for r in found:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        taken[r.source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 3 * mixing.BLOCK_TOKENS for s in order)
    again = mixing.mix_sources(docs.repartition(5), rows_per_shard=10).collect()
    assert Counter(found) == Counter(again)


def test_seats_go_to_the_highest_quotients(spark):
    weights = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.0, None: 11.5}
    caps = {"a": 100, "b": 4, "c": 100, "d": 9, None: 100}
    parties = spark.createDataFrame([(0, k, w, caps[k], 21) for k, w in weights.items()], "g int, k string, weight double, cap long, seats long")
    found = {r.k: r.quota for r in mixing.apportion(parties, ["g"], "k", "weight", "cap", "seats").collect()}
    quotients = sorted(((-w / (2 * n - 1), k is None, k or "", n) for k, w in weights.items() if w for n in range(1, caps[k] + 1)))[:21]
    assert found == {k: sum(q[1] == (k is None) and q[2] == (k or "") for q in quotients) for k in weights}


def test_mixing_nothing(none, spark):
    assert mixing.mix_sources(none).collect() == []
    empty = spark.createDataFrame([(None, 1, "", None, "a", None, None, None)], DOCS)
    assert [(r.size, r.target, r.taken) for r in mixing.mix_sources(empty).collect()] == [(0, 0.0, 0)]


# Decontamination


def expected_hits(text: str | None, items: list[tuple]) -> tuple:
    words, hit, found = re.findall(WORD, lowered(text)), set(), set()
    for item, body in items:
        own = re.findall(WORD, lowered(body))
        n = min(13, len(own))
        windows = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if n else set()
        for k in range(len(words) - n + 1 if n else 0):
            if tuple(words[k : k + n]) in windows:
                hit.update(range(k, k + n))
                found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found), len(hit) > 0 and 20 * len(hit) >= len(words)


def benchmark_items(rows) -> list[tuple]:
    long = next(r[2] for r in rows if r[2] and len(r[2].split()) == 300)
    return [(1, " ".join(long.split()[5:40])), (10, "ONE"), (2, long[:200]), (2, long[:200]), (3, None), (4, "!!"), (None, "two, words"), (5, "a" * 300), (6, "é")]


@pytest.mark.parametrize("block", [1 << 22, 300])
def test_contamination(spark, docs, rows, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
    items = benchmark_items(rows)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    own = docs.toDF("upper", *DOCS.names[1:]).select("doc_id", "text")
    found = decontamination.contamination(own, benchmark, ["doc_id"])
    expected = sorted(((r[1], *expected_hits(r[2], items)) for r in rows), key=repr)
    assert collected(found, "doc_id", "n_words", "n_hit", "items", "contaminated") == expected


def test_wu_manber_finds_all():
    rng = random.Random(2)
    words = ["a", "ab", "abc", "b", "ba", "longerword"]
    text = " ".join(rng.choice(words) for _ in range(4000))
    patterns = sorted({(" ".join(p).encode(), len(p)) for p in ([rng.choice(words) for _ in range(rng.choice([1, 2, 5, 14, 30]))] for _ in range(300))})
    normal, begins, _ = decontamination.normalised(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
    word, pattern = decontamination.WuManber(patterns).search(normal, begins)
    own = [w.encode() for w in text.split()]
    expected = {(k, p) for p, (body, n) in enumerate(patterns) for k in range(len(own) - n + 1) if own[k : k + n] == body.split()}
    assert set(zip(word.tolist(), pattern.tolist())) == expected


def test_no_benchmark(spark, plain, none, rows):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert {r.contaminated for r in decontamination.contamination(plain.select("doc_id", "text"), empty).collect()} == {False}
    assert decontamination.contamination(none.toDF("u", *DOCS.names[1:]).select("doc_id", "text"), empty).collect() == []


# Near duplicates


def near_groups(rows) -> dict:
    """Group id and size by row, from all pairs."""
    words = [re.findall(WORD, lowered(r[2])) for r in rows]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for w in words]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][2] is None or rows[j][2] is None:
                continue
            both = len(sets[i] & sets[j])
            if (words[i] and words[i] == words[j]) or (not words[i] and rows[i][2] == rows[j][2]) or (both and both >= 0.8 * len(sets[i] | sets[j])):
                root[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(i)
    ids = {k: min((rows[i][1] for i in own if rows[i][1] is not None), default=None) for k, own in members.items()}
    return [(rows[i][1], ids[find(i)], len(members[find(i)]), find(i)) for i in range(len(rows))]


def test_near_duplicates(docs, rows):
    found = near_dedup.near_duplicates(docs)
    assert collected(found, "doc_id", "group_id", "group_size") == sorted((g[:3] for g in near_groups(rows)), key=repr)


def test_one_of_each(plain, rows):
    kept = near_dedup.one_of_each(plain)
    assert kept.columns == plain.columns
    texts = [r for r in rows if r[2] is not None]
    groups = {g[3]: g[1] for g, r in zip(near_groups(rows), rows) if r[2] is not None}
    assert sorted(r.doc_id for r in kept.where("text is not null").collect()) == sorted(groups.values())
    assert kept.where("text is null").count() == len(rows) - len(texts)


def test_links_across_a_hub(spark):
    """Copies of copies: the ends of the chain are far from any hub but linked through others."""
    rng = random.Random(9)
    words = prose(rng, 200).split()
    chain = []
    for step in range(12):
        words = list(words)
        for k in range(2):
            words[(step * 2 + k) * 8] = f"new{step}x{k}"
        chain.append((step, " ".join(words)))
    found = near_dedup.near_duplicates(spark.createDataFrame(chain, "doc_id long, text string")).collect()
    assert {(r.group_id, r.group_size) for r in found} == {(0, 12)}


def test_short_near_copies(spark):
    """Nine words against eight of them, for which sketches often do not agree, and repeated words."""
    rng = random.Random(21)
    texts = []
    for k in range(1500):
        words = [f"{x}{k}" for x in prose(rng, 9).split()]
        texts += [" ".join(words), " ".join(words[:8] if k % 2 else words[1:])]
    texts += ["again " * 12, "again " * 14, "round and " * 8, "round and " * 9]
    made = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = collected(near_dedup.near_duplicates(made), "doc_id", "group_id", "group_size")
    assert found == sorted(((k, k // 2 * 2, 2) for k in range(len(texts))), key=repr)


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 9))] for _ in range(2))
        table = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                table[i][j] = table[i - 1][j - 1] if a[i - 1] == b[j - 1] else 1 + min(table[i - 1][j], table[i][j - 1])
        a, b = np.array(a, np.uint64), np.array(b, np.uint64)
        assert near_dedup.edit_distance(a, b, 18) == table[-1][-1]
        if table[-1][-1]:
            assert near_dedup.edit_distance(a, b, table[-1][-1] - 1) is None


def test_near_duplicates_of_nothing(none):
    assert near_dedup.near_duplicates(none).collect() == []


# Substring deduplication


def without_repeats(rows) -> list[tuple]:
    texts = [(r[1], (r[2] or "").encode()) for r in rows]
    first = {}
    rank = lambda i: math.inf if i is None else i
    for i, t in texts:
        for k in range(len(t) - 49):
            first[t[k : k + 50]] = min(first.get(t[k : k + 50], math.inf), rank(i))
    found = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - 49):
            if first[t[k : k + 50]] < rank(i):
                gone[k : k + 50] = b"\1" * 50
        left = bytes(x for x, g in zip(t, gone) if not g)
        found.append((i, len(t), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest()))
    return sorted(found, key=repr)


def test_repeats(docs, rows):
    found = substring_dedup.repeat_digests(docs)
    assert collected(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == without_repeats(rows)


def test_texts_without_repeats(plain, rows, none):
    found = substring_dedup.without_repeats(plain)
    assert found.columns == plain.columns and found.count() == len(rows)
    assert found.where("text is null").count() == sum(r[2] is None for r in rows)
    assert substring_dedup.repeat_digests(none).collect() == []


def test_suffix_order():
    rng = random.Random(3)
    for _ in range(500):
        text = [0]
        for _ in range(rng.randint(0, 5)):
            text += [rng.randint(1, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 12))] + [0]
        order = suffix_order(text)
        suffixes = [text[i : text.index(0, i) + 1] for i in order]
        assert sorted(order) == list(range(len(text))) and suffixes == sorted(suffixes)


# Chat


def turns() -> list[tuple]:
    texts = [None, "", "hello", "<|im_end|>", "<\\|x", "<\\\\|<|", "line\nbreak", "é" * 5, "x" * 50_000]
    rows = [(1, t, "assistant" if t % 2 else "user", text) for t, text in enumerate(texts)]
    rows += [(2, t, "assistant", f"turn {t}") for t in range(100)]
    rows += [(3, None, None, "no turn"), (3, 1, "a\\n\nb", "odd role"), (None, 1, "user", "no id"), (4, 5, "user", "same"), (4, 5, "user", "same"), (4, 5, "assistant", "same")]
    return rows


def test_chat(spark):
    made = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).repartition(4)
    found = chat.formatted_conversations(made)
    groups = defaultdict(list)
    for conv, turn, role, text in turns() + [(-1, 0, "user", "<|im_end|><|im_start|>assistant ok"), (-1, 1, "assistant", "<|im_end|><|im_start|>assistant ok")]:
        groups[conv].append((turn is not None, turn, role or "", text or ""))
    expected = []
    for conv, own in groups.items():
        own = [(role, text) for _, _, role, text in sorted(own)]
        loss = "".join(text for role, text in own if role == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        expected.append((conv, len(own), sha("".join(f"{r}\n{t}\n" for r, t in own)), len(loss), sha(loss), len(chat.chat_markup(own))))
    assert collected(found, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars") == sorted(expected, key=repr)
    assert {r.rewrites for r in found.collect()} == {0}
    assert [r.conv_id for r in chat.formatted_conversations(made.limit(0)).collect()] == [-1]


def test_escapes_are_reversible():
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(rng.choice("<|\\>a\n") for _ in range(rng.randint(0, 8)))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat._unrole(chat._role(text)) == text


def test_rewritten_history_is_found(spark):
    """A template that shows only the last turn's text rewrites all before."""
    template = lambda own: "".join(f"[{r}:{t if k == len(own) - 1 else '...'}]" for k, (r, t) in enumerate(own))
    rows = [(1, k, "assistant", f"text {k}") for k in range(3)]
    row, = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), template).collect()
    assert row.rewrites == [1, 2] and row.formatted == template([("assistant", f"text {k}") for k in range(3)])


def test_templates_that_need_the_whole_conversation(spark):
    """Over PIECE_TURNS turns: history rewritten at each turn, only after 40 turns, and turn numbers."""
    last = lambda own: "".join(f"[{r}:{t if k == len(own) - 1 else '...'}]" for k, (r, t) in enumerate(own))
    late = lambda own: "".join(f"[{r}:{t}]" for r, t in (own if len(own) < 40 else own[1:]))
    counted = lambda own: "".join(f"{k} {r}: {t};" for k, (r, t) in enumerate(own))
    turns = [("assistant" if k % 2 else "user", f"text {k}") for k in range(chat.PIECE_TURNS + 13)]
    made = spark.createDataFrame([(1, k, *turn) for k, turn in enumerate(turns)], "conv_id long, turn long, role string, text string")
    for template, rewrites in ((last, list(range(1, len(turns)))), (late, list(range(39, len(turns)))), (counted, [])):
        row, = chat.format_conversations(made, template).collect()
        assert row.formatted == template(turns) and len(row.spans) == len(row.masked) == len(turns)
        assert [k for k in row.rewrites if template(turns[: k + 1]).startswith(template(turns[:k]))] == []
        assert set(row.rewrites) == {k for k in range(1, len(turns)) if not template(turns[: k + 1]).startswith(template(turns[:k]))}
        assert all(0 <= x for span in row.spans for x in span) and (template is late or row.rewrites == rewrites)
        if template is counted:
            assert [row.formatted[a:b] for _, _, a, b in row.spans] == [text if role == "assistant" else "" for role, text in turns]


# WARC


def test_warc(spark, tmp_path):
    long, other = "é" * 600, "z" * 1000
    pages = [(1, "http://a/", long), (5, "http://b/ c\r\nX: y", long), (3, None, long), (2, "u", other), (4, "u", None), (6, "u", ""), (7, "u", "WARC/1.1\r\n\r\n\r\n"), (None, "u", long), (None, "u", "y" * 2000), (9, "u", "s" * 999), (10, "u", "s" * 999), (2, "u", other), (11, "u", "b" * 3_000_000)]
    made = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    largest = {}
    for page, _, html in pages:
        if html and len(html.encode()) >= 1000 and page is not None:
            largest[html] = max(page, largest.get(html, page))
    many = Counter(html for _, _, html in pages)
    expected = []
    for page, _, html in pages:
        body = (html or "").encode()
        first = largest.get(html) if many[html] > 1 else None
        revisit = first is not None and first != page
        expected.append((page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert collected(warc.archived_pages(made), *names) == sorted(expected, key=repr)
    assert warc.archived_pages(made.limit(0)).collect() == []

    whole, split = f"file://{tmp_path}/whole", f"file://{tmp_path}/split"
    warc.write_monolithic(warc.records(made), whole)
    manifest = warc.normalise(spark, whole, split).collect()
    raw = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "whole").glob("part-*")))
    again = b""
    for row in manifest:
        data = Path(row.archive.removeprefix("file://")).read_bytes()
        entries = [json.loads(line) for line in Path(row["index"].removeprefix("file://")).read_text().splitlines()]
        assert len(entries) == row.records
        for entry in entries:  # each is a member of its own
            assert zlib.decompress(data[entry["offset"] : entry["offset"] + entry["length"]], 31).startswith(b"WARC/1.1\r\n")
        again += gzip.decompress(data)
    assert sorted(again.split(b"WARC/1.1\r\n")) == sorted(raw.split(b"WARC/1.1\r\n"))


# Top k


def test_top_k(spark):
    rng = np.random.default_rng(1)
    vectors = [(k, [float(x) for x in np.round(rng.normal(size=12), 2).astype(np.float32)]) for k in range(300)]
    vectors += [(k, vectors[0][1]) for k in (301, 302, 303, 304, 305, 306, 307)] + [vectors[7], vectors[7], (400, None), (450, [1.0, None] * 6), (None, vectors[3][1]), (500, [float("nan")] * 12), (550, [1.0] * 3), (600, [1e38] * 12), (601, []), (650, [])]
    made = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit(0)).repartition(3)
    good = [(k, [math.floor(256 * x) for x in v]) for k, v in vectors if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected, most = [], (1 << 63) - 1
    for q, v in good:
        if q % 50 == 0:
            found = {(max(-most, min(most, sum(a * b for a, b in zip(v, w)))), c) for c, w in good if c != q and len(w) == len(v)}
            expected += [(q, n + 1, c, s) for n, (s, c) in enumerate(sorted(found, key=lambda x: (-x[0], x[1]))[:5])]
    assert collected(topk.top_k(made), "query_id", "rank", "vec_id", "score") == sorted(expected, key=repr)
    assert topk.top_k(made.limit(0)).collect() == []


def test_queries_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    made = spark.createDataFrame([(k, rng.normal(size=8).tolist()) for k in range(400)], "vec_id long, embedding array<double>")
    whole = collected(topk.top_k(made), "query_id", "rank", "vec_id", "score")
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    assert collected(topk.top_k(made), "query_id", "rank", "vec_id", "score") == whole


# Toxicity


def test_toxicity(spark, docs, none, rows):
    rng = random.Random(8)
    texts = [(k, prose(rng, 40) + (f" {rng.choice(['vilefoo', 'vilebar', 'scurrile'])} " if k % 4 == 0 else " ") + prose(rng, 5)) for k in range(600)]
    made = spark.createDataFrame(texts + [(None, None), (1000, ""), (1001, None)], "doc_id long, text string").withColumn("score", F.lit(1))
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(600)] + [(3, None), (None, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(made, labels).collect()}
    assert all(r.held_out == (held(k, 5) == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for k, r in found.items())
    wrong = [k for k, r in found.items() if r.held_out and k is not None and k < 600 and r.predicted != int(k % 4 == 0)]
    assert not wrong and len(found) == 603
    unlabelled = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert len(unlabelled) == len(rows) and len({r.score for r in unlabelled}) == 1
    assert toxicity.toxicity(none, labels).collect() == []


def test_lexicon_holds_rare_words_and_more_than_its_own_features(spark):
    """150 words of seven letters, each with three stems, in five toxic texts each; the sample
    that the classifier is fitted on has hardly any of them twice."""
    rng = random.Random(12)
    vile = ["".join(rng.choice("bcdfgjkqvwxz") for _ in range(7)) for _ in range(150)]
    texts = [(k, prose(rng, 30) + (f" {vile[k // 4 % 150]} " if k % 4 == 0 else " ") + prose(rng, 5)) for k in range(3000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(3000)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, 400)
    assert len(model.voters.sorted) > 400
    found = [r for r in toxicity.score(docs, model).collect() if r.held_out]
    known = Counter(vile[k // 4 % 150] for k in range(0, 3000, 4) if held(k, 5) != 0)
    toxic = [r.score for r in found if r.doc_id % 4 == 0 and known[vile[r.doc_id // 4 % 150]] >= 3]
    clean = [r.score for r in found if r.doc_id % 4]
    assert len(toxic) > 100 and np.quantile(toxic, 0.05) > np.quantile(clean, 0.95)


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.2
    draws = rng.random((4, 20_000))
    rates = [(0.9, 0.02), (0.8, 0.05), (0.7, 0.05), (0.5, 0.1)]
    votes = [np.where(truth, d < on, d < off) for d, (on, off) in zip(draws, rates)]
    votes = np.stack([votes[0], *votes], 1).astype(float)  # the first two are one voter
    model = toxicity.fit_label_model(votes, np.ones(len(votes)), votes[:500], truth[:500].astype(int))
    assert np.abs(model.rates[1, 2:] - [0.8, 0.7, 0.5]).max() < 0.1
    assert (model.posterior(votes) > 0.5)[truth].mean() > 0.8
    assert model.weights[:2].max() < model.weights[2:].min()


# Language model


@pytest.mark.parametrize("bytes_a_bucket", [hidden_markov.BUCKET_BYTES, 1])
def test_language_model(docs, none, rows, monkeypatch, bytes_a_bucket):
    monkeypatch.setattr(hidden_markov, "BUCKET_BYTES", bytes_a_bucket)
    found = hidden_markov.language_model_scores(docs).collect()
    tokens = [(r[1], [*re.findall(TOKEN, lowered(r[2])), None]) for r in rows]
    counts = Counter(w for i, own in tokens if held(i, 5) != 1 for w in own)
    total, kinds = sum(counts.values()), len(counts)
    base = lambda own: sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in own)
    expected = sorted(((i, held(i, 5) == 1, len(own), sum(counts[w] > 0 for w in own), total, round(base(own), 6)) for i, own in tokens), key=repr)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=repr) == expected
    assert all(math.isfinite(r.score) and r.score < 0 for r in found)
    assert hidden_markov.language_model_scores(none).collect() == []


def small_model() -> tuple:
    rng = np.random.default_rng(3)
    model = hidden_markov.HiddenMarkov.beginning(rng.integers(1, 50, hidden_markov.CLASSES))
    move = rng.random((hidden_markov.STATES,) * 2)
    model.move = move / move.sum(axis=1, keepdims=True)
    return model, rng.integers(0, hidden_markov.CLASSES, 9).astype(np.uint16)


def test_forward_scores_are_exact():
    """Against the sum over all state sequences, done by plain recursion without scaling."""
    model, sequence = small_model()
    lengths = np.array([4, 1, 4])
    found = hidden_markov.log_likelihoods(model, sequence, np.array([0, 4, 5]), lengths)
    for at, n, value in zip((0, 4, 5), lengths, found):
        state = model.first * model.emit[sequence[at]]
        for t in range(at + 1, at + n):
            state = state @ model.move * model.emit[sequence[t]]
        assert value == pytest.approx(math.log10(state.sum()))


def test_expected_counts():
    model, sequence = small_model()
    first, move, emit = hidden_markov.expected_counts(model, sequence, np.array([0, 5]), np.array([5, 4]))
    states, expected_move, expected_emit, expected_first = hidden_markov.STATES, 0, np.zeros_like(model.emit), 0
    for at, n in ((0, 5), (5, 4)):
        emitted = model.emit[sequence[at : at + n]]
        forward, back = [model.first * emitted[0]], [np.ones(states)]
        for t in range(1, n):
            forward.append(forward[-1] @ model.move * emitted[t])
        for t in range(n - 1, 0, -1):
            back.insert(0, model.move @ (emitted[t] * back[0]))
        whole = forward[-1].sum()
        for t in range(n):
            expected_emit[sequence[at + t]] += forward[t] * back[t] / whole
        expected_first = expected_first + forward[0] * back[0] / whole
        for t in range(n - 1):
            expected_move = expected_move + np.outer(forward[t], emitted[t + 1] * back[t + 1]) * model.move / whole
    assert np.allclose(first, expected_first, rtol=1e-3) and np.allclose(move, expected_move, rtol=1e-3) and np.allclose(emit, expected_emit, rtol=1e-3, atol=1e-6)


# The pipeline


def test_pipeline(spark, tmp_path, plain, rows, none):
    own = plain.select("doc_id", "text", "lang", "source", "n_chars")
    own.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(benchmark_items(rows), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    docs = [(None, *r[1:]) for r in rows if r[2] is not None and any(c.isalpha() for c in r[2])]
    groups = near_groups(docs)
    kept = {}
    for row, (doc, group, _, _) in zip(docs, groups):
        if doc == group:
            kept[doc, row[2]] = row
    cut = {}
    texts = without_repeats(list(kept.values()))
    assert len(texts) == len(kept)
    spark_texts = {r.doc_id: r.text for r in found}
    digests = {t[0]: t for t in texts}
    for doc, text in spark_texts.items():
        whole = digests[doc]
        if whole[2] == 0:
            assert hashlib.sha256(text.encode()).hexdigest() == whole[4]
        cut[doc] = text
    clean = [r for r in kept.values() if not expected_hits(r[2], benchmark_items(rows))[3]]
    assert set(spark_texts) <= {r[1] for r in kept.values()} and spark_texts
    assert not [d for d, t in spark_texts.items() if expected_hits(t, benchmark_items(rows))[3]]
    assert all(0 < r.taken <= 3 * r.size for r in found) and clean
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none.toDF("u", *DOCS.names[1:]).select(*own.columns), str(tmp_path)).collect() == []
