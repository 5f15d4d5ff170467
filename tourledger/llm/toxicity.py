"""Toxicity scores by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from tourledger.llm.common import LOWER, WORD_BYTES, pick, pieces, prefix_hash, remainder, span_hash, spans

#: Labelled rows that the classifier is fitted on, at most; drawn by a hash of the id. The
#: lexicon is counted over all labelled rows.
SAMPLE_ROWS = 20_000
#: Words and word stems of the lexicon that are features of their own; all entries, however
#: many, are counted in so many features by lift.
LEXICON = 256
LEVELS = 8
#: Lexicon voters, each with an equal share of the first entries, and two for all entries; the
#: pattern voters come on top.
LEXICON_VOTERS = 12
VOTERS = LEXICON_VOTERS + 2 + 4
#: Rounds of the label model in which the tree of voters is looked for anew.
TREE_ROUNDS = 5
#: A word's first bytes that count as its stem.
STEMS = (4, 5, 6)
#: An entry lifts a toxic text's odds by so much, in logs, and is in so many toxic texts or in
#: LEAST_COUNT of them with so large a likelihood ratio against chance (one in a hundred). What one
#: text alone has is no evidence: where few texts are toxic, all its rare words would pass.
LIFT = 1.5
MIN_COUNT = 5
LEAST_COUNT = 2
EVIDENCE = 6.63
_SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of each word and word stem, and the number of words of each row."""
    low = LOWER[data]
    begins, ends, first = spans(low, offsets, WORD_BYTES)
    sums = prefix_hash(low)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    rows, hashes = [row], [span_hash(sums, begins, ends)]
    for size, salt in zip(STEMS, _SALTS):
        long = ends - begins > size
        rows.append(row[long])
        hashes.append(span_hash(sums, begins[long], begins[long] + size) ^ np.uint64(salt))
    return np.concatenate(rows), np.concatenate(hashes), np.diff(first)


def _known(labels: DataFrame) -> DataFrame:
    """The ids that labels may be learned from, each with its label."""
    known = pick(labels, "doc_id", "toxic").where("doc_id is not null and toxic in (0, 1)")
    return known.where(remainder(F.col("doc_id"), 5) != 0).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of all labelled documents that labels may be learned from."""
    rows = pick(docs, "doc_id", "text").where(F.col("doc_id").isNotNull() & (remainder(F.col("doc_id"), 5) != 0))
    return rows.join(_known(labels).hint("shuffle_hash"), "doc_id").select("text", "toxic")


def labelled_sample(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic of up to ``limit`` of the labelled documents.

    The ids are drawn first, by a hash, and are broadcast: ``limit`` bounds them.
    """
    drawn = _known(labels).orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(limit)
    rows = pick(docs, "doc_id", "text").where("doc_id is not null")
    return rows.join(F.broadcast(drawn), "doc_id").select("text", "toxic")


@dataclass
class Lexicon:
    """Hashes of words and stems, best first, and the logs of their lifts, with all texts and
    without any one of their toxic texts (-inf: not in the lexicon then)."""

    grams: np.ndarray
    lift: np.ndarray
    without: np.ndarray


def learn_lexicon(rows: DataFrame) -> Lexicon:
    """All words and stems that speak for toxic texts, by LIFT and by MIN_COUNT or EVIDENCE;
    first those with the largest share of the evidence, documents times log of lift."""
    schema = StructType([StructField("gram", LongType()), StructField("ones", LongType()), StructField("zeros", LongType())])

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, 0):
            toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            row, gram, _ = _grams(data, offsets)
            order = np.lexsort((row, gram))
            row, gram = row[order], gram[order]
            fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])])[: len(gram)]
            row, gram = row[fresh], gram[fresh]
            grams, begins = np.unique(gram, return_index=True)
            if len(grams):
                ones = np.add.reduceat(toxic[row].astype(np.int64), begins)
                both = np.diff(np.append(begins, len(gram)))
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(ones), pa.array(both - ones)], names=schema.names)

    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0), np.zeros(0))
    counts = rows.mapInArrow(count, schema).groupBy("gram").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"))
    zeros, share = F.col("zeros"), n[1] / (n[0] + n[1])

    def lift(ones: Column) -> Column:
        return F.log((ones + 0.5) / (n[1] + 1)) - F.log((zeros + 0.5) / (n[0] + 1))

    def telling(ones: Column) -> Column:
        surprise = ones * F.log(ones / ((ones + zeros) * share)) + F.when(zeros > 0, zeros * F.log(zeros / ((ones + zeros) * (1 - share)))).otherwise(0)
        return (ones >= LEAST_COUNT) & (lift(ones) > LIFT) & ((ones >= MIN_COUNT) | (2 * surprise >= EVIDENCE))

    ones = F.col("ones")
    found = counts.where(telling(ones)).select("gram", "ones", lift(ones).alias("lift"), F.when(telling(ones - 1), lift(ones - 1)).otherwise(float("-inf")).alias("without")).toArrow()
    gram, many, lifts, without = (found.column(k).to_numpy() for k in range(4))
    order = np.lexsort((gram, -np.round(many * lifts, 9)))
    return Lexicon(gram[order].astype(np.int64).view(np.uint64), lifts[order].astype(np.float64), without[order].astype(np.float64))


class Voters:
    """Lexicon and pattern voters over a learned lexicon. A voter fires or abstains."""

    def __init__(self, lexicon: Lexicon):
        order = np.argsort(lexicon.grams)
        self.sorted, self.rank = lexicon.grams[order], order
        self.own = min(len(order), LEXICON)
        self.size = self.own + LEVELS
        edges = np.quantile(lexicon.lift, np.arange(1, LEVELS) / LEVELS) if len(order) else np.zeros(0)
        self.level = np.searchsorted(edges, lexicon.lift, "right")[order]
        self.without = np.where(np.isfinite(lexicon.without), np.searchsorted(edges, lexicon.without, "right"), -1)[order]

    def hits(self, data: np.ndarray, offsets: np.ndarray, toxic: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """How often each row has each of the first entries, and all entries of each level of
        lift or higher ones, and its number of words. For rows that the lexicon was learned
        from, ``toxic`` has their labels: a toxic row's entries are as they were without it."""
        rows = len(offsets) - 1
        row, gram, words = _grams(data, offsets)
        if not len(self.sorted):
            return np.zeros((rows, self.size), np.int64), words
        place = np.minimum(np.searchsorted(self.sorted, gram), len(self.sorted) - 1)
        hit = self.sorted[place] == gram
        row, place = row[hit], place[hit]
        level = self.level[place] if toxic is None else np.where(toxic[row], self.without[place], self.level[place])
        row, place, level = row[level >= 0], place[level >= 0], level[level >= 0]
        first = self.rank[place] < self.own
        at = np.concatenate([row[first] * self.size + self.rank[place[first]], row * self.size + self.own + level])
        found = np.bincount(at, minlength=rows * self.size).reshape(rows, self.size)
        found[:, self.own :] = found[:, self.own :][:, ::-1].cumsum(axis=1)[:, ::-1]
        return found, words

    def votes(self, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
        """A bit for each voter that fires: shares of the first entries, all entries, those
        of higher lift, then the patterns of first entries - two different ones, one twice, one
        in 50 words, one of the ten best."""
        fired = np.zeros((len(hits), VOTERS), bool)
        hits, levels = hits[:, : self.own], hits[:, self.own :]
        for v in range(LEXICON_VOTERS):
            fired[:, v] = (hits[:, v::LEXICON_VOTERS] > 0).any(axis=1)
        fired[:, LEXICON_VOTERS] = levels[:, 0] > 0
        fired[:, LEXICON_VOTERS + 1] = levels[:, LEVELS // 2] > 0
        total = hits.sum(axis=1)
        fired[:, -4] = (hits > 0).sum(axis=1) >= 2
        fired[:, -3] = (hits > 1).any(axis=1)
        fired[:, -2] = (total * 50 >= words) & (total > 0)
        fired[:, -1] = (hits[:, :10] > 0).any(axis=1)
        return fired

    @staticmethod
    def packed(fired: np.ndarray) -> np.ndarray:
        return fired @ (1 << np.arange(VOTERS))

    def features(self, hits: np.ndarray, words: np.ndarray) -> np.ndarray:
        hits, levels = hits[:, : self.own], hits[:, self.own :]
        total = hits.sum(axis=1)
        more = [np.log1p(total), np.log1p((hits > 0).sum(axis=1)), total / np.maximum(words, 1), levels[:, 0] / np.maximum(words, 1)]
        return np.column_stack([np.minimum(hits, 1), np.log1p(levels), *more, np.ones(len(hits))]).astype(np.float64)


@dataclass
class LabelModel:
    """How often each voter fires for either label, and given the voter that it goes with most.

    Within a label the voters form a tree: each depends on its parent's vote, and evidence that
    the parent gave already does not count again. A text's votes have one probability
    for each label, which is what expectation maximisation raises.
    """

    prior: float
    rates: np.ndarray  # (2, voters): of labels 0 and 1
    weights: np.ndarray  # the share of a voter's evidence that no single other voter has
    parents: np.ndarray  # (voters,): -1 for the root
    given: np.ndarray  # (2, 2, voters): rates of labels 0 and 1, if the parent is silent or fires

    def log_odds(self, fired: np.ndarray) -> np.ndarray:
        fired = fired.astype(bool)
        above = np.where(self.parents >= 0, fired[:, self.parents], False).astype(np.int64)
        clean, toxic = (given[above, np.arange(fired.shape[1])] for given in self.given)
        evidence = np.where(fired, np.log(toxic / clean), np.log((1 - toxic) / (1 - clean)))
        return np.log(self.prior / (1 - self.prior)) + evidence.sum(axis=1)

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(fired), -50, 50)))


def _shared(rates: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Mutual information of each two voters' votes, from how often each fires and both do."""
    found = np.zeros_like(both)
    for cell, one, other in (
        (both, rates[:, None], rates[None, :]),
        (rates[:, None] - both, rates[:, None], 1 - rates[None, :]),
        (rates[None, :] - both, 1 - rates[:, None], rates[None, :]),
        (1 - rates[:, None] - rates[None, :] + both, 1 - rates[:, None], 1 - rates[None, :]),
    ):
        cell = np.maximum(cell, 1e-12)
        found += cell * np.log(cell / (one * other))
    return np.maximum(found, 0)


def _tree(tie: np.ndarray) -> np.ndarray:
    """Each voter's parent in the tree of the strongest ties; the first voter is its root."""
    parents = np.full(len(tie), -1)
    nearest, strength, left = np.zeros(len(tie), np.int64), tie[0].copy(), np.arange(len(tie)) > 0
    while left.any():
        v = int(np.argmax(np.where(left, strength, -1)))
        parents[v], left[v] = nearest[v], False
        closer = left & (tie[v] > strength)
        nearest[closer], strength[closer] = v, tie[v][closer]
    return parents


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, known: np.ndarray, toxic: np.ndarray, rounds: int = 25) -> LabelModel:
    """Expectation maximisation over how often each vote pattern occurs.

    ``patterns`` and ``counts`` are of all documents, ``known`` and ``toxic`` the votes and
    labels of the labelled sample, which keep their labels throughout and alone give the first
    model. Each round estimates the voters' rates from the expected labels, alone and given
    their parents' votes. The tree of parents is the one of the highest likelihood, that of the
    most mutual information within labels; after TREE_ROUNDS it stays as it is.
    """
    base = np.array([[(toxic == y).sum() + 1.0] for y in (0, 1)])
    fires = np.stack([known[toxic == y].sum(axis=0) for y in (0, 1)]) + np.array([[0.05], [0.2]])
    agreed = np.stack([known[toxic == y].T.astype(np.float64) @ known[toxic == y] for y in (0, 1)])
    model, expected = None, np.zeros((2, len(counts)))
    for done in range(rounds + 1):
        if done:
            toxic_here = model.posterior(patterns) * counts
            expected = np.stack([counts - toxic_here, toxic_here])
        mass = expected.sum(axis=1, keepdims=True) + base
        rates = np.clip((expected @ patterns + fires) / (mass + 1), 1e-4, 1 - 1e-4)
        both = np.stack([(patterns * e[:, None]).T @ patterns for e in expected]) + agreed
        share = mass[:, 0] / mass.sum()
        # One text more of each label, in which votes do not depend on each other.
        tie = sum(share[y] * _shared(rates[y], (both[y] + np.outer(rates[y], rates[y])) / (mass[y] + 1)) for y in (0, 1))
        own = -sum(share[y] * (rates[y] * np.log(rates[y]) + (1 - rates[y]) * np.log(1 - rates[y])) for y in (0, 1))
        np.fill_diagonal(tie, 0)
        parents = _tree(tie) if done <= TREE_ROUNDS else model.parents
        given = np.stack([rates, rates], 1)
        below = np.flatnonzero(parents >= 0)
        for y in (0, 1):
            of, fired = parents[below], both[y].diagonal()
            with_it = both[y][of, below]
            given[y, 1, below] = (with_it + rates[y, below]) / (fired[of] + 1)
            given[y, 0, below] = (fired[below] - with_it + rates[y, below]) / (mass[y] - fired[of] + 1)
        weights = 1 - np.clip(tie.max(axis=1, initial=0) / own, 0, 1)
        model = LabelModel(float(np.clip(share[1], 1e-4, 0.9)), rates, weights, parents, np.clip(given, 1e-4, 1 - 1e-4))
    return model


def fit_linear(x: np.ndarray, target: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last column is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), x.T @ (target - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _vote_counts(texts: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray]:
    """The vote patterns of all documents and how often each occurs: at most 2 ** VOTERS."""
    schema = StructType([StructField("pattern", LongType()), StructField("n", LongType())])
    shared = texts.sparkSession.sparkContext.broadcast(voters)

    def vote(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << VOTERS, np.int64)
        for _, data, offsets in pieces(batches, 0):
            own = shared.value
            sums += np.bincount(own.packed(own.votes(*own.hits(data, offsets))), minlength=1 << VOTERS)
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], names=schema.names)

    rows = texts.mapInArrow(vote, schema).groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()
    patterns = np.array([r.pattern for r in rows], np.int64)
    return (patterns[:, None] >> np.arange(VOTERS) & 1).astype(np.float64), np.array([r.n for r in rows], np.float64)


def _sample_hits(sample: DataFrame, voters: Voters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lexicon hits, numbers of words and labels of the sample's rows."""
    fields = [("toxic", IntegerType()), ("words", LongType()), ("entries", ArrayType(IntegerType())), ("times", ArrayType(IntegerType()))]
    schema = StructType([StructField(name, kind) for name, kind in fields])
    shared = sample.sparkSession.sparkContext.broadcast(voters)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in pieces(batches, 0):
            hits, words = shared.value.hits(data, offsets, batch.column(1).to_numpy(zero_copy_only=False).astype(bool))
            entries = [np.flatnonzero(h) for h in hits]
            columns = [pa.array([e.tolist() for e in entries], pa.list_(pa.int32())), pa.array([h[e].tolist() for h, e in zip(hits, entries)], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(words, pa.int64()), *columns], names=schema.names)

    rows = sorted(sample.mapInArrow(find, schema).collect(), key=lambda r: (r.toxic, r.words, r.entries, r.times))
    hits = np.zeros((len(rows), voters.size), np.int64)
    for line, r in zip(hits, rows):
        line[r.entries] = r.times
    return hits, np.array([r.words for r in rows], np.int64), np.array([r.toxic for r in rows], np.int64)


@dataclass
class ToxicityModel:
    voters: Voters
    weights: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, limit: int = SAMPLE_ROWS) -> ToxicityModel:
    """Voters from all labelled rows, the label model from all documents' votes, and the
    classifier from a sample's posterior labels."""
    voters = Voters(learn_lexicon(labelled_rows(docs, labels)))
    sample = labelled_sample(docs, labels, limit)
    hits, words, toxic = _sample_hits(sample, voters)
    known = voters.votes(hits, words)
    patterns, counts = _vote_counts(pick(docs, "text"), voters)
    model = fit_label_model(patterns, counts, known, toxic)
    # The annotation is one more voter; its accuracy is how often it agrees with the others.
    odds = model.log_odds(known)
    accuracy = float(np.clip(((odds > 0) == (toxic == 1)).mean(), 0.7, 0.99)) if len(toxic) else 0.7
    odds = odds + np.log(accuracy / (1 - accuracy)) * (2 * toxic - 1)
    target = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    x = voters.features(hits, words)
    return ToxicityModel(voters, fit_linear(x, target) if len(x) else np.zeros(x.shape[1]))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score and predicted of every document row."""
    rows = pick(docs, "doc_id", "text")
    rows = rows.select("text", "doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"))
    fields = [rows.schema["doc_id"], StructField("held_out", BooleanType()), StructField("score", DoubleType()), StructField("predicted", IntegerType())]
    schema = StructType(fields)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch, data, offsets in pieces(batches, 0):
            hits, words = own.voters.hits(data, offsets)
            p = 1 / (1 + np.exp(-np.clip(own.voters.features(hits, words) @ own.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=schema.names)

    return rows.mapInArrow(find, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (score >= 0.5) of every document row.

    Labels are learned from documents whose crc32 of the id is not 0 modulo 5 (a null id
    counts as the empty text, so it is held out). The lexicon is counted over all of them and
    holds every entry that passes its tests; the classifier is fitted on at most SAMPLE_ROWS
    of them, the label model on the votes of all documents. Only the text
    is an input of a score; null texts are empty. Several labels of an id are one, toxic if
    any is; null ones are ignored. Without labels of both kinds the lexicon is empty and
    all scores are equal.
    """
    return score(docs, fit(docs, labels))
