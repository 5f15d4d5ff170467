"""SentencePiece BPE: exact encoding by backtracking, and decoding.

A sequence of pieces is the merge order's own encoding exactly if every piece, and every two
adjacent ones, come out of merging as they are: the first merge over a boundary would also be
the first one when both neighbours stand alone. So the text is covered from the left by the
longest pieces (Aho-Corasick), a piece is kept if it is compatible with the one before it, which
merging both anew decides, and otherwise gives way to the next shorter one. Where none is left,
the piece before goes too, and a bit says that no encoding has a boundary there: the pieces up to
a position are unique, so this never has to be tried again.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from tourledger.llm.common import frugal, pick, pieces, schema_of

#: The mark that stands for a space.
SPACE = "▁"
#: A vocabulary's file is broadcast; a larger one is an error.
MODEL_LIMIT = 64 << 20
#: Characters of a text that are looked up in the automaton, or cut into words, at a time.
WINDOW = 1 << 16
#: Encodings of words, and answers on adjacent pieces, that a task remembers.
REMEMBERED = 1 << 19
#: Words of more characters are not remembered.
WORD_KEPT = 48

# Piece types and field numbers of the model file, fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TRAINER_MODEL, TRAINER_SUFFIX, TRAINER_FALLBACK, TRAINER_UNKNOWN_SURFACE = 3, 24, 35, 44
TRAINER_IDS = (40, 41, 42)
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
BPE_MODEL = 2
DEFAULT_UNKNOWN_SURFACE = " ⁇ "


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of each field of a protocol buffer message."""
    at = 0
    while at < len(data):
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a SentencePiece model file says: pieces by id, scores, types and settings."""

    texts: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    types: list[int] = field(default_factory=list)
    begin_id: int = 1
    end_id: int = 2
    unknown_id: int = 0
    unknown_surface: str = DEFAULT_UNKNOWN_SURFACE
    fallback: bool = False
    prefix: bool = True


def read_model(data: bytes) -> PieceModel:
    """A BPE model with plain normalisation; anything else is a ValueError."""
    model, settings = PieceModel(), {}
    for number, value in _fields(data):
        if number == PIECES:
            own = dict(_fields(value))
            model.texts.append(own.get(PIECE_TEXT, b"").decode())
            model.scores.append(struct.unpack("<f", own[PIECE_SCORE])[0] if PIECE_SCORE in own else 0.0)
            model.types.append(own.get(PIECE_TYPE, NORMAL))
        elif number in (TRAINER, NORMALIZER):
            settings[number] = dict(_fields(value))
    trainer, normalizer = settings.get(TRAINER, {}), settings.get(NORMALIZER, {})
    problems = {
        "no BPE model": trainer.get(TRAINER_MODEL) != BPE_MODEL,
        "a character map": bool(normalizer.get(CHARSMAP)),
        "removal of white space": bool(normalizer.get(REMOVE_EXTRA, 1)),
        "white space as it is": not normalizer.get(ESCAPE, 1),
        "white space as a suffix": bool(trainer.get(TRAINER_SUFFIX, 0)),
        "user-defined or unused pieces": bool({USER_DEFINED, UNUSED} & set(model.types)),
    }
    found = [name for name, there in problems.items() if there]
    if found:
        raise ValueError(f"the model has {', '.join(found)}")
    model.unknown_id, model.begin_id, model.end_id = (trainer.get(key, n) for n, key in enumerate(TRAINER_IDS))
    model.unknown_surface = trainer.get(TRAINER_UNKNOWN_SURFACE, DEFAULT_UNKNOWN_SURFACE.encode()).decode()
    model.fallback = bool(trainer.get(TRAINER_FALLBACK, 0))
    model.prefix = bool(normalizer.get(DUMMY_PREFIX, 1))
    return model


class _Words(dict):
    """Encodings of words, as many as are remembered."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        found = self.encode(word)
        if len(word) <= WORD_KEPT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = found
        return found


class Encoder:
    """Encodes and decodes whole texts with a model."""

    def __init__(self, model: PieceModel) -> None:
        self.model = model
        self.score = {t: s for t, s, kind in zip(model.texts, model.scores, model.types) if kind == NORMAL}
        self.pair: dict[int, bool] = {}  # by left * pieces + right
        self.text: list[str] = []  # pieces that merging ever makes; all below are indices into this
        self.code: list[bytes] = []
        index: dict[str, int] = {}
        self.automaton = ahocorasick.Automaton()
        for number, (text, kind) in enumerate(zip(model.texts, model.types)):
            if kind == NORMAL and self.merged(text) == [text]:
                index[text] = len(self.text)
                self.text.append(text)
                self.code.append(struct.pack("<I", number))
                self.automaton.add_word(text, (len(text), index[text]))
        self.automaton.make_automaton()
        #: The next shorter piece that begins a piece, or None.
        self.shorter = [next((index[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in index), None) for t in self.text]
        self.size = list(map(len, self.text))
        self.longest_piece = max(self.size, default=1)
        self.bytes = {}
        for number, (text, kind) in enumerate(zip(model.texts, model.types)):
            if kind == BYTE:
                self.bytes[int(text[3:5], 16)] = struct.pack("<I", number)
        # Where no piece goes on after another character with a space, words can be encoded apart.
        self.apart = not any(re.search(f"[^{SPACE}]{SPACE}", text) for text in self.score)
        self.word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.border = re.compile(f"(?<=[^{SPACE}]){SPACE}")
        self.words = _Words(self._word)
        self.surface = [self._surface(n) for n in range(len(model.texts))]

    def merged(self, text: str) -> list[str]:
        """The text's characters merged: the best score first, of equal ones the leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging both pieces' characters gives these two pieces again."""
        both = [self._piece(left), self._piece(right)]
        return self.merged("".join(both)) == both

    def _piece(self, token: int) -> str:
        return self.text[token] if token >= 0 else chr(-1 - token)

    def _next_shorter(self, token: int) -> int | None:
        """The next piece down, at last the single character, which may have no piece of its own."""
        if token < 0:
            return None
        found = self.shorter[token]
        return -1 - ord(self.text[token][0]) if found is None and self.size[token] > 1 else found

    def _longest(self, text: str, begin: int) -> list[int]:
        """For each position of a window that begins there, the longest piece from it on."""
        end = min(len(text), begin + WINDOW)
        longest = [-1 - ord(c) for c in text[begin:end]]
        for last, (size, token) in self.automaton.iter(text, begin, min(len(text), end + self.longest_piece)):
            if last - size < end - 1:
                longest[last - size + 1 - begin] = token  # the last to end is the longest
        return longest

    def cover(self, text: str) -> list[int] | array:
        """The pieces of a text, as indices; a character without a piece is -1 - its code."""
        n, at, begin, end = len(text), 0, 0, 0
        tokens = [] if n <= WINDOW else array("i")
        failed = bytearray((n >> 3) + 1)
        size, pair, many, longest = self.size, self.pair, len(self.size), []
        token = None
        while at < n:
            if token is None:
                if not begin <= at < end:
                    begin = at // WINDOW * WINDOW
                    longest = self._longest(text, begin)
                    end = begin + len(longest)
                token = longest[at - begin]
            while token is not None:
                stop = at + (size[token] if token >= 0 else 1)
                if not failed[stop >> 3] >> (stop & 7) & 1:
                    if not tokens:
                        break
                    key = tokens[-1] * many + token
                    fits = pair.get(key) if token >= 0 <= tokens[-1] else self.compatible(tokens[-1], token)
                    if fits is None:
                        if len(pair) >= REMEMBERED:
                            pair.clear()
                        fits = pair[key] = self.compatible(tokens[-1], token)
                    if fits:
                        break
                token = self._next_shorter(token)
            if token is None:
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()  # its end is marked now, so that a shorter one is taken
                at -= size[token] if token >= 0 else 1
            else:
                tokens.append(token)
                at, token = stop, None
        return tokens

    def _word(self, text: str) -> bytes:
        """Ids of a stretch of normalised text, little-endian unsigned 32-bit."""
        out = []
        for token in self.cover(text):
            if token >= 0:
                out.append(self.code[token])
            elif self.model.fallback:
                out += [self.bytes[byte] for byte in chr(-1 - token).encode()]
            else:
                out.append(struct.pack("<I", self.model.unknown_id))
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids of a text with begin and end ids; null is empty."""
        parts = [struct.pack("<I", self.model.begin_id)]
        if text:
            text = (SPACE if self.model.prefix else "") + text.replace(" ", SPACE)
            begin = 0
            while self.apart and begin < len(text):
                border = self.border.search(text, begin + WINDOW)
                end = border.start() if border else len(text)
                parts.append(b"".join(map(self.words.__getitem__, self.word.findall(text, begin, end))))
                begin = end
            if not self.apart:
                parts.append(self._word(text))
        parts.append(struct.pack("<I", self.model.end_id))
        return b"".join(parts)

    def _surface(self, number: int) -> bytes:
        kind, text = self.model.types[number], self.model.texts[number]
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.model.unknown_surface.encode()
        return bytes([int(text[3:5], 16)]) if kind == BYTE else text.replace(SPACE, " ").encode()

    def decode(self, ids: bytes | None) -> str:
        """The text of ids: controls vanish, the prefix of the first piece goes, bytes become
        characters, and bytes that are none U+FFFD; null is empty."""
        numbers = array("I", ids or b"")
        types = self.model.types
        first = next((n for n in numbers if types[n] != CONTROL), None)
        strip = self.model.prefix and first is not None and types[first] == NORMAL and self.model.texts[first].startswith(SPACE)
        if not any(types[n] == CONTROL for n in numbers[1:-1]):
            try:
                return b"".join(map(self.surface.__getitem__, numbers)).decode()[int(strip) :]
            except UnicodeDecodeError:
                pass
        out, run = [], b""
        for n in numbers:
            if types[n] != BYTE:
                out += self._characters(run)
                run = b""
                out.append(self.surface[n].decode())
            else:
                run += self.surface[n]
        out += self._characters(run)
        return "".join(out)[int(strip) :]

    @staticmethod
    def _characters(data: bytes) -> Iterator[str]:
        """Characters of a run of byte pieces, U+FFFD for each byte that begins none."""
        at = 0
        while at < len(data):
            size = next((k for k in (1, 2, 3, 4) if _is_text(data[at : at + k])), 0)
            yield data[at : at + size].decode() if size else "\ufffd"
            at += size or 1


def _is_text(data: bytes) -> bool:
    try:
        data.decode()
    except UnicodeDecodeError:
        return False
    return True


_ENCODERS: dict[int, Encoder] = {}


def _encoder(model) -> Encoder:
    """One encoder per worker and broadcast model."""
    if model.id not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model.id] = Encoder(read_model(model.value))
    return _ENCODERS[model.id]


class _Shared:
    """A broadcast variable with an identity that workers can remember it by."""

    def __init__(self, df: DataFrame, path: str) -> None:
        with open(path, "rb") as file:
            data = file.read(MODEL_LIMIT + 1)
        if len(data) > MODEL_LIMIT:
            raise ValueError(f"{path} has more than {MODEL_LIMIT} bytes")
        read_model(data)  # what is not supported is told at once
        self.id, self.variable = hash(data), df.sparkSession.sparkContext.broadcast(data)

    @property
    def value(self) -> bytes:
        return self.variable.value


def encoded(docs: DataFrame, path: str, keep: list[str], text: str = "text") -> DataFrame:
    """The columns of ``keep``, then ``n_tokens`` and ``ids``: each whole text's ids with begin
    and end ids, as little-endian unsigned 32-bit integers.

    The driver reads the model file at ``path``, of at most ``MODEL_LIMIT`` bytes, and broadcasts
    it. A null or empty text has the two ids alone. Repeated rows stay; of columns whose names
    differ in case only the exact one is read; no rows give none. Rows are not shuffled.
    """
    rows, model = pick(docs, *keep, text), _Shared(docs, path)
    schema = schema_of(pick(docs, *keep), StructField("n_tokens", LongType(), False), StructField("ids", BinaryType(), False))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch, _, _ in pieces(batches, len(keep)):
            encoder = encoder or _encoder(model)
            ids = [encoder.encode(value) for value in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())], names=schema.names
            )

    return rows.mapInArrow(frugal(work), schema)


def decoded(tokens: DataFrame, path: str, keep: list[str], ids: str = "ids", name: str = "decoded") -> DataFrame:
    """The columns of ``keep``, then the text of each row's ids; null ids give an empty text."""
    rows, model = pick(tokens, *keep, ids), _Shared(tokens, path)
    schema = schema_of(pick(tokens, *keep), StructField(name, StringType(), False))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch, _, _ in pieces(batches, len(keep)):
            encoder = encoder or _encoder(model)
            texts = [encoder.decode(value) for value in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return rows.mapInArrow(frugal(work), schema)
