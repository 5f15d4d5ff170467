"""The lexicon where few texts are toxic."""

from __future__ import annotations

import random

import numpy as np

from tourledger.llm import toxicity


def test_words_of_one_text_do_not_enter_the_lexicon(spark):
    """One text in a hundred is toxic; each text has five words that no other has."""
    rng = random.Random(6)
    common = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4))) for _ in range(300)]
    rows = []
    for k in range(4000):
        words = [rng.choice(common) for _ in range(20)] + ["".join(rng.choice("klmnopqrstuvwxyz") for _ in range(9)) for _ in range(5)]
        if k % 100 == 0:
            words += ["vileness", "rotten"]
        rng.shuffle(words)
        rows.append((" ".join(words), int(k % 100 == 0)))
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    once = toxicity.learn_lexicon(spark.createDataFrame([(t, 0 if t.count("rotten") else y) for t, y in rows] + [("vileness alone", 1)], "text string, toxic int"))
    # Two words and their stems of four, five and six letters; hardly anything by chance.
    assert 7 <= len(lexicon.grams) < 60
    assert len(once.grams) == 0


def test_copies_of_a_voter_are_no_evidence():
    """The posterior from voters some of which repeat one of them is the one from that one alone."""
    rng = np.random.default_rng(4)
    truth = rng.random(30_000) < 0.15
    one, two, three = (np.where(truth, rng.random(len(truth)) < on, rng.random(len(truth)) < off) for on, off in [(0.8, 0.05), (0.7, 0.1), (0.6, 0.1)])
    apart = np.stack([one, two, three], 1).astype(float)
    copied = np.stack([one, two, one, three, one, one], 1).astype(float)
    found = [toxicity.fit_label_model(v, np.ones(len(v)), v[:2000], truth[:2000].astype(int)) for v in (apart, copied)]
    assert np.abs(found[0].posterior(apart) - found[1].posterior(copied)).max() < 0.05
    assert sorted(found[1].parents)[0] == -1 and (found[1].parents >= 0).sum() == 5
    # Against the truth: the share of toxic texts among those of each vote pattern.
    for pattern in np.unique(apart, axis=0):
        rows = (apart == pattern).all(axis=1)
        assert abs(found[0].posterior(apart[rows][:1])[0] - truth[rows].mean()) < 0.1


def test_dependent_voters_are_told_by_their_tree():
    """A voter that mostly follows another: its rates given that one, within each label, are found."""
    rng = np.random.default_rng(9)
    truth = rng.random(40_000) < 0.3
    leads = np.where(truth, rng.random(len(truth)) < 0.7, rng.random(len(truth)) < 0.1)
    follows = np.where(rng.random(len(truth)) < 0.9, leads, rng.random(len(truth)) < np.where(truth, 0.5, 0.2))
    other = np.where(truth, rng.random(len(truth)) < 0.8, rng.random(len(truth)) < 0.05)
    votes = np.stack([other, leads, follows], 1).astype(float)
    model = toxicity.fit_label_model(votes, np.ones(len(votes)), votes[:10000], truth[:10000].astype(int))
    assert model.parents[2] == 1 or model.parents[1] == 2
    child, parent = (2, 1) if model.parents[2] == 1 else (1, 2)
    for y in (0, 1):
        for on in (0, 1):
            here = (truth == y) & (votes[:, parent] == on)
            assert abs(model.given[y, on, child] - votes[here, child].mean()) < 0.06


def test_no_votes_and_no_labels_give_a_model():
    empty = toxicity.fit_label_model(np.zeros((0, toxicity.VOTERS)), np.zeros(0), np.zeros((0, toxicity.VOTERS)), np.zeros(0, int))
    assert np.isfinite(empty.posterior(np.eye(toxicity.VOTERS))).all()
