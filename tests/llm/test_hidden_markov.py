"""The language model: counts over whole texts, and scores from beginning to end."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tourledger.llm import hidden_markov
from tourledger.llm.hidden_markov import CLASSES, STATES, HiddenMarkov, _learned, _scores, drawn_texts, expected_counts, packs, token_classes


def model_of(seed: int) -> HiddenMarkov:
    rng = np.random.default_rng(seed)
    model = HiddenMarkov.beginning(rng.integers(1, 50, CLASSES))
    move, first = rng.random((STATES, STATES)), rng.random(STATES)
    return HiddenMarkov(first / first.sum(), move / move.sum(axis=1, keepdims=True), model.emit)


def plain_counts(model: HiddenMarkov, sequence: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward over one whole sequence, a step at a time."""
    n = len(sequence)
    forward, back = np.zeros((n, STATES)), np.ones((n, STATES))
    for t, c in enumerate(sequence):
        forward[t] = (forward[t - 1] @ model.move if t else model.first) * model.emit[c]
        forward[t] /= forward[t].sum()
    for t in range(n - 2, -1, -1):
        back[t] = model.move @ (model.emit[sequence[t + 1]] * back[t + 1])
        back[t] /= back[t].sum()
    gamma = forward * back
    gamma /= gamma.sum(axis=1, keepdims=True)
    move, emit = np.zeros((STATES, STATES)), np.zeros((CLASSES, STATES))
    for t in range(n - 1):
        both = np.outer(forward[t], model.emit[sequence[t + 1]] * back[t + 1]) * model.move
        move += both / both.sum()
    np.add.at(emit, sequence, gamma)
    return gamma[0], move, emit


@pytest.mark.parametrize("stored", [1, 40, 1 << 21])
def test_expected_counts_are_those_of_whole_sequences(monkeypatch, stored):
    """The same however many forward states are kept, for sequences of very unequal length."""
    monkeypatch.setattr(hidden_markov, "STORED", stored)
    rng, model = np.random.default_rng(5), model_of(5)
    lengths = np.array([1, 700, 3, 3, 64, 1, 2, 90], np.int64)
    begins = np.cumsum(lengths) - lengths
    sequence = rng.integers(0, CLASSES, lengths.sum()).astype(np.uint16)
    found = expected_counts(model, sequence, begins, lengths, lanes=5)
    expected = [sum(parts) for parts in zip(*(plain_counts(model, sequence[a : a + n]) for a, n in zip(begins, lengths)))]
    for one, other in zip(found, expected):
        assert np.allclose(one, other, rtol=1e-3, atol=1e-4)
    assert found[0].sum() == pytest.approx(len(lengths), rel=1e-4)  # only where texts begin
    assert found[1].sum() == pytest.approx((lengths - 1).sum(), rel=1e-4)  # every move, over no cut


def text_rows() -> list[tuple]:
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(60)]
    texts = [None, "", "  ", "One", "unknown-word-here", "é ü\tß"] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    texts.append(" ".join(rng.choice(words) for _ in range(3000)))
    return [(k * 3, text) for k, text in enumerate(texts)] + [(None, "null id"), (6, texts[-1])]


def test_scores_are_those_of_a_plain_recursion(spark):
    """With the trained model: classes by a forward sum over all states, tokens within classes by
    their counts, token by token and text by text."""
    rows = text_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    learned = _learned(docs)
    model = learned[2]
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.n_tokens), r.score, r.base_score) for r in _scores(*learned).collect())
    lower = lambda text: re.findall(rb"[^\x20\x09-\x0D]+", bytes(b + 32 if 65 <= b < 91 else b for b in (text or "").encode()))
    held = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 1
    end = object()
    counts = Counter(t for i, text in rows if not held(i) for t in [*lower(text), end])
    of = lambda t: 0 if t is end else int(token_classes(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]))[0])
    in_class, kinds = Counter(), Counter()
    for token, n in counts.items():
        in_class[of(token)] += n
        kinds[of(token)] += 1
    expected = []
    for i, text in rows:
        tokens, total, state = [*lower(text), end], 0.0, None
        for token in tokens:
            c = of(token)
            state = (model.first if state is None else state @ model.move) * model.emit[c]
            total += math.log10(state.sum() * (counts[token] + 0.5) / (in_class[c] + 0.5 * (kinds[c] + 1)))
            state = state / state.sum()
        base = sum(math.log10((counts[t] + 0.5) / (sum(counts.values()) + 0.5 * (len(counts) + 1))) for t in tokens)
        expected.append(((i is None, i or 0, len(tokens)), total, base))
    assert [f[0] for f in found] == [e[0] for e in sorted(expected)]
    assert np.allclose([f[1:] for f in found], [e[1:] for e in sorted(expected)], rtol=1e-6)


def test_the_draw_grows_with_the_texts(spark):
    sizes = {}
    for n in (300, 1200):
        docs = spark.createDataFrame([(k, f"text {k} of some words") for k in range(n)], "doc_id long, text string").repartition(1)
        sizes[n] = sum(len(r.held_out) for r in drawn_texts(packs(docs)).collect())
    assert sizes[300] > 300 * 0.7 / 16 and 3.5 < sizes[1200] / sizes[300] < 4.5


def test_states_beat_single_tokens_on_held_out_texts(spark):
    """Texts that keep to one of two sets of words for a while: what comes next depends on what came."""
    rng = random.Random(8)
    sets = [["".join(rng.choice(letters) for _ in range(4)) for _ in range(40)] for letters in ("abcd", "wxyz")]
    texts = [" ".join(rng.choice(sets[(k // 15 + start) % 2]) for k in range(rng.randint(20, 60))) for start in (rng.randint(0, 1) for _ in range(600))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    held = [r for r in hidden_markov.language_model_scores(docs).collect() if r.held_out]
    tokens = sum(r.n_tokens for r in held)
    assert (sum(r.score for r in held) - sum(r.base_score for r in held)) / tokens > 0.1


@pytest.mark.parametrize("segment", [1, 7, 50])
def test_segments_do_not_change_sums_or_scores(monkeypatch, segment):
    """Long sequences cut into many segments, beside short ones, and one that a segment just holds."""
    rng, model = np.random.default_rng(6), model_of(6)
    lengths = np.array([1, 900, 7, 3, 50, 51, 1, 120], np.int64)
    begins = np.cumsum(lengths) - lengths
    sequence = rng.integers(0, CLASSES, lengths.sum()).astype(np.uint16)
    whole = hidden_markov.log_likelihoods(model, sequence, begins, lengths)
    monkeypatch.setattr(hidden_markov, "segment_length", lambda lengths: segment)
    assert (hidden_markov.Segments.of(begins, lengths).parts > 1).sum() >= 3
    found = expected_counts(model, sequence, begins, lengths, lanes=9)
    expected = [sum(parts) for parts in zip(*(plain_counts(model, sequence[a : a + n]) for a, n in zip(begins, lengths)))]
    for one, other in zip(found, expected):
        assert np.allclose(one, other, rtol=1e-3, atol=1e-4)
    assert found[1].sum() == pytest.approx((lengths - 1).sum(), rel=1e-4)
    assert np.allclose(hidden_markov.log_likelihoods(model, sequence, begins, lengths), whole, rtol=1e-9)


def test_states_that_a_segment_all_but_rules_out():
    """A text whose state is certain and unlikely by what follows: nothing underflows, to the last digit."""
    move = np.full((STATES, STATES), 1e-12) + np.eye(STATES)
    emit = np.full((CLASSES, STATES), 1e-9)
    emit[np.arange(STATES) + 1, np.arange(STATES)] = 1
    model = HiddenMarkov(np.full(STATES, 1 / STATES), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    sequence = np.repeat(np.arange(STATES) + 1, 400).astype(np.uint16)
    own, length = np.zeros(1, np.int64), np.array([len(sequence)])
    assert hidden_markov.Segments.of(own, length).parts[0] > 1
    total, state = 0.0, None
    for c in sequence:
        state = (model.first if state is None else state @ model.move) * model.emit[c]
        total += math.log10(state.sum())
        state = state / state.sum()
    assert hidden_markov.log_likelihoods(model, sequence, own, length)[0] == pytest.approx(total, rel=1e-12)
    for one, other in zip(expected_counts(model, sequence, own, length), plain_counts(model, sequence)):
        assert np.allclose(one, other, rtol=1e-3, atol=1e-4)


def test_a_very_long_text_takes_few_steps():
    rng, model = np.random.default_rng(7), model_of(7)
    sequence, length = rng.integers(0, CLASSES, 1_000_000).astype(np.uint16), np.array([1_000_000])
    assert hidden_markov.Segments.of(np.zeros(1, np.int64), length).lengths.max() == 1000
    found = expected_counts(model, sequence, np.zeros(1, np.int64), length)
    assert found[0].sum() == pytest.approx(1, rel=1e-4) and found[2].sum() == pytest.approx(1_000_000, rel=1e-4)
