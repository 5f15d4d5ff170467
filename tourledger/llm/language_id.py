"""Language identification by hyperdimensional letter n-gram profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from tourledger.llm.common import frugal, numbered, pick, pieces, remainder, schema_of

DIMENSION = 1024
SEED = 20
UNDETERMINED = "und"
#: More languages than this are an error: their prototypes go to the driver and every task.
MAX_LANGUAGES = 10_000

_BREAK = 0x20
_DENSE = 1 << 21
_PIECE = 1 << 19
#: Bundles are summed for so many rows and kinds of trigrams at a time, whatever the alphabet.
_BLOCK_ROWS = 512
_BLOCK_KINDS = 8192


@lru_cache(maxsize=1 << 16)
def _letter(code: int) -> np.ndarray:
    """The random vector of +1 and -1 of a letter (or of the break between words)."""
    return (np.random.default_rng((SEED, code)).integers(0, 2, DIMENSION, np.int8) * 2 - 1).astype(np.int8)


@lru_cache(maxsize=1 << 20)
def _lowered(code: int) -> int:
    """The lower-case letter of a code point; other code points are breaks."""
    char = chr(code)
    return ord(char.lower()[0]) if char.isalpha() else _BREAK


def _codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the rows' texts and where each row's begin."""
    begins = (data & 0xC0) != 0x80
    place = np.concatenate([[0], np.cumsum(begins)])
    text = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    if len(text) != place[-1]:  # not valid UTF-8: decode row by row
        rows = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        return np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return text, place[offsets]


class Grams:
    """Letter trigrams of a piece of texts: for each occurrence its row and its trigram."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        text, at = _codes(data, offsets)
        rows = len(offsets) - 1
        if len(text) and int(text.max()) < 0x3000:
            present = np.flatnonzero(np.bincount(text, minlength=1))
            lowered = np.zeros(int(text.max()) + 1, np.uint32)
            lowered[present] = [_lowered(int(c)) for c in present]
            text = lowered[text]
        elif len(text):
            present, inverse = np.unique(text, return_inverse=True)
            text = np.array([_lowered(int(c)) for c in present], np.uint32)[inverse]
        text = np.insert(text, at[1:], _BREAK)  # rows never share a trigram
        at = at + np.arange(rows + 1)
        letter = text != _BREAK
        after = np.concatenate([[False], letter[:-1]])
        after[np.minimum(at[:-1], max(len(text) - 1, 0))] |= True  # a break begins each row
        keep = letter | after
        keep[at[:-1][~letter[at[:-1]]]] = True
        self.letters = np.add.reduceat(letter, at[:-1]) if rows else np.zeros(0, np.int64)
        row = np.repeat(np.arange(rows), np.diff(at))[keep]
        text = text[keep]
        self.alphabet, inverse = self._alphabet(text)
        n = len(self.alphabet)
        inverse = inverse.astype(np.int64)
        blank = int(np.searchsorted(self.alphabet, _BREAK)) if n else 0
        # A word " abc " has the trigrams " ab", "abc", "bc "; a break stands before each row.
        before = np.concatenate([[blank], inverse[:-1]]) if n else inverse
        after = np.concatenate([inverse[1:], [blank]]) if n else inverse
        first = np.concatenate([[True], row[1:] != row[:-1]]) if n else np.zeros(0, bool)
        last = np.concatenate([row[1:] != row[:-1], [True]]) if n else first
        before = np.where(first, blank, before)
        after = np.where(last, blank, after)
        centre = inverse != blank
        code = ((before * n + inverse) * n + after)[centre]
        self.row = row[centre]
        if n**3 <= _DENSE:
            self.kinds = np.flatnonzero(np.bincount(code, minlength=1))
            place = np.zeros(int(code.max()) + 1 if len(code) else 1, np.int64)
            place[self.kinds] = np.arange(len(self.kinds))
            self.kind = place[code]
        else:
            self.kinds, self.kind = np.unique(code, return_inverse=True)

    @staticmethod
    def _alphabet(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(text) and int(text.max()) < 0x3000:
            alphabet = np.flatnonzero(np.bincount(text))
            place = np.zeros(int(alphabet[-1]) + 1, np.int64)
            place[alphabet] = np.arange(len(alphabet))
            return alphabet, place[text]
        return np.unique(text, return_inverse=True)

    def vectors(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """The vectors of the kinds from ``low`` to ``high``: of each its letters' vectors,
        permuted by place, multiplied."""
        kinds = self.kinds[low:high]
        if not len(kinds):
            return np.zeros((0, DIMENSION), np.float32)
        n = len(self.alphabet)
        bound = np.ones((len(kinds), DIMENSION), np.int8)
        for place, letter in ((2, kinds // (n * n)), (1, kinds // n % n), (0, kinds % n)):
            used, at = np.unique(letter, return_inverse=True)
            bound *= np.roll(np.stack([_letter(int(self.alphabet[k])) for k in used]), place, axis=1)[at]
        return bound.astype(np.float32)

    def bundles(self, groups: np.ndarray, many: int) -> np.ndarray:
        """The sum of the trigram vectors in each of ``many`` groups of rows; ``groups`` has
        each occurrence's group, in ascending order."""
        sums = np.zeros((many, DIMENSION), np.float32)
        for start in range(0, len(self.kinds), _BLOCK_KINDS):
            vectors = self.vectors(start, start + _BLOCK_KINDS)
            kind, group = self.kind, groups
            if len(self.kinds) > _BLOCK_KINDS:
                own = (kind >= start) & (kind < start + _BLOCK_KINDS)
                kind, group = kind[own] - start, group[own]
            for low in range(0, many, _BLOCK_ROWS):
                high = min(low + _BLOCK_ROWS, many)
                a, b = np.searchsorted(group, (low, high))
                counts = np.bincount((group[a:b] - low) * len(vectors) + kind[a:b], minlength=(high - low) * len(vectors))
                sums[low:high] += counts.reshape(high - low, len(vectors)).astype(np.float32) @ vectors
        return sums


def language_prototypes(docs: DataFrame) -> dict[str, np.ndarray]:
    """The bundled vector of all documents of each non-null lang."""
    rows = pick(docs, "text", "lang").where("lang is not null")
    schema = StructType([StructField("lang", StringType()), StructField("place", IntegerType()), StructField("value", DoubleType())])

    @frugal
    def bundle(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch, data, offsets in pieces(batches, 0, _PIECE):
            grams = Grams(data, offsets)
            langs = batch.column(1).to_pylist()
            names = sorted(set(langs))
            place = {name: k for k, name in enumerate(names)}
            group = np.array([place[lang] for lang in langs], np.int64)[grams.row]
            order = np.argsort(group, kind="stable")
            grams.kind = grams.kind[order]
            for name, vector in zip(names, grams.bundles(group[order], len(names))):
                sums[name] = sums.get(name, 0) + vector.astype(np.float64)
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * DIMENSION, pa.string()), pa.array(np.arange(DIMENSION), pa.int32()), pa.array(vector)], names=schema.names)

    sums = rows.mapInArrow(bundle, schema).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("vector"))
    known = found.limit(MAX_LANGUAGES + 1).collect()
    if len(known) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {row.lang: np.array([v.value for v in row.vector]) for row in known}


def identify(df: DataFrame, text: str, prototypes: dict[str, np.ndarray], carry: list[str]) -> DataFrame:
    """``carry`` columns with lang_pred and score, the cosine of the text's bundle and the best
    prototype's, at least 0. Equal cosines go to the smaller language name. Texts that are
    null or without letters, and all texts where no language was learned, are 'und' with 0."""
    at = df.columns.index(text)
    kept = [df.columns.index(name) for name in carry]
    schema = schema_of(df.select(*carry), StructField("lang_pred", StringType()), StructField("score", DoubleType()))
    names = sorted(prototypes)
    unit = np.stack([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in names]) if names else np.zeros((0, DIMENSION))
    shared = df.sparkSession.sparkContext.broadcast((names, unit.astype(np.float32)))

    @frugal
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, unit = shared.value
        for batch, data, offsets in pieces(batches, at, _PIECE):
            best, cosine = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows)
            grams = Grams(data, offsets)
            if names:
                bundles = grams.bundles(grams.row, batch.num_rows)
                for low in range(0, batch.num_rows, _BLOCK_ROWS):
                    bundle = bundles[low : low + _BLOCK_ROWS]
                    likeness = np.round((bundle @ unit.T) / np.maximum(np.linalg.norm(bundle, axis=1), 1e-30)[:, None], 6)
                    best[low : low + _BLOCK_ROWS] = likeness.argmax(axis=1)
                    cosine[low : low + _BLOCK_ROWS] = likeness.max(axis=1)
            known = (grams.letters > 0) & bool(names)
            langs = [names[k] if ok else UNDETERMINED for k, ok in zip(best.tolist(), known.tolist())]
            cosine = np.where(known, np.clip(cosine, 0.0, 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(langs, pa.string()), pa.array(cosine, pa.float64())], names=schema.names)

    return df.mapInArrow(score, schema)


def learning_rows(docs: DataFrame) -> DataFrame:
    """The documents that prototypes are learned from."""
    return pick(docs, "doc_id", "text", "lang").where(remainder(F.col("doc_id"), 3) != 1)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document row, as ``identify`` has them.

    Prototypes come from the texts and non-null languages of the documents whose crc32 of the
    id is not 1 modulo 3 (a null id counts as the empty text); null texts add nothing.
    """
    prototypes = language_prototypes(learning_rows(docs))
    rows = pick(docs, "doc_id", "text")
    found = identify(rows, "text", prototypes, ["doc_id"])
    return found.select("doc_id", (remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame) -> DataFrame:
    """The documents, with their own columns, that ``languages`` gives a language; those that
    are 'und' there are rejected. No score is too low: that of a short text, or of one in letters
    that no language was learned from, is chance."""
    prototypes = language_prototypes(learning_rows(docs))
    plain, at = numbered(docs)
    found = identify(plain, at["text"], prototypes, plain.columns)
    kept = found.where(F.col("lang_pred") != UNDETERMINED)
    return kept.select(*plain.columns).toDF(*docs.columns)
