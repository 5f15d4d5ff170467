"""Chat formatting by incremental black-box rendering of turn prefixes."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from tourledger.llm.common import pick

Turn = tuple[str, str]
Template = Callable[[list[Turn]], str]

#: Turns of ``chat_markup`` that are rendered together; a longer conversation goes on in
#: another piece. Conversations in other templates are rendered whole.
PIECE_TURNS = 32
#: Stands for a turn's text while the place of the text is looked for: private characters.
PROBE = "\ue000\ue001"

TURN_OPEN, TURN_CLOSE = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    """No ``<|`` is left: a backslash more goes between ``<`` and ``|`` wherever there are only
    backslashes between them."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def chat_markup(turns: list[Turn]) -> str:
    """The template: each turn between marks, control strings inside texts escaped."""
    return "".join(f"{TURN_OPEN}{_role(role)}\n{escape(text)}{TURN_CLOSE}\n" for role, text in turns)


def read_markup(text: str) -> list[Turn]:
    """The turns that ``chat_markup`` made a text of."""
    turns = []
    for part in text.split(TURN_OPEN)[1:]:
        role, _, body = part.partition("\n")
        turns.append((_unrole(role), unescape(body[: body.rindex(TURN_CLOSE)])))
    return turns


def common_prefix(a: str, b: str) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Renderer:
    """Renders a conversation turn by turn without knowing its template.

    Each prefix of the turns is rendered and compared with the output before: what has been
    added is the new turn's span. If the old output is not a prefix of the new one, the
    template has rewritten history; the turn's span then begins where the outputs part. The
    text's place in the span shows when the turn is rendered with a probe for its text. What a
    rewrite has taken away of earlier spans goes, and where there was one, texts are looked up again
    in the final output; a masked text that cannot be found there is empty and ``lost``.

    With ``piece``, a new piece begins after so many turns with the last turn as its only
    context, so that work and memory stay in proportion to a conversation's length. This is
    exact only for templates whose output for a turn depends on it, on the turn before and on
    whether it is the first; a piece's output is what follows its context. Whether a template
    is one is looked at wherever a piece begins: after the whole piece before, its first turn must
    add the same as after the context, and rewrite nothing; else it is a ValueError. Without
    ``piece``, every prefix is rendered from the first turn on, which is exact for any template.
    """

    def __init__(self, template: Template, piece: int | None = None):
        self.template, self.piece = template, piece
        self.turns: list[Turn] = []
        self.output, self.context = "", 0
        self.spans: list[tuple[int, int, int, int]] = []
        self.masked: list[bool] = []
        self.rewrites: list[int] = []
        self.whole: tuple[list[Turn], str] | None = None  # the piece before, until the next turn

    def add(self, turn: Turn, masked: bool) -> None:
        old, before = self.output, self.turns
        self.output = self.template([*before, turn])
        if self.whole is not None:
            turns, output = self.whole
            if self.template([*turns, turn]) != output + self.output[len(old) :]:
                raise ValueError("the template looks further back than a turn and cannot be rendered in pieces")
            self.whole = None
        begin = len(old)
        if not self.output.startswith(old):
            begin = common_prefix(old, self.output)
            self.rewrites.append(len(self.spans))
            self.spans = [(min(a, begin), min(b, begin), *((c, d) if d <= begin else (min(c, begin),) * 2)) for a, b, c, d in self.spans]
        text = (begin, begin)
        if masked:
            probed = self.template([*before, (turn[0], PROBE)])
            at = probed.find(PROBE, begin)
            if at >= 0:
                text = (at, at + len(PROBE) + len(self.output) - len(probed))
        self.turns = [*before, turn]
        self.spans.append((begin, len(self.output), *text))
        self.masked.append(masked)

    @property
    def full(self) -> bool:
        return self.piece is not None and len(self.spans) >= self.piece

    def _place(self, number: int) -> tuple[int, int] | None:
        """Where the output has the text of a span's turn: what is around a probe for it must be
        what is around the text."""
        at = len(self.turns) - len(self.spans) + number
        probed = self.template([*self.turns[:at], (self.turns[at][0], PROBE), *self.turns[at + 1 :]])
        begin = probed.find(PROBE)
        end = begin + len(PROBE) + len(self.output) - len(probed)
        if begin < 0 or end < begin or probed[:begin] != self.output[:begin] or probed[begin + len(PROBE) :] != self.output[end:]:
            return None
        return begin, end

    def take(self) -> tuple[str, list[list[int]], list[int], list[int]]:
        """The piece's output, its turns' spans and texts in it, which turns rewrote history and
        which masked texts the output has not; the next piece begins."""
        lost = []
        if self.rewrites:
            for number, (a, b, c, _) in enumerate(self.spans):
                if self.masked[number]:
                    found = self._place(number)
                    if found is None:
                        lost.append(number)
                    self.spans[number] = (a, b, *(found or (c, c)))
        cut = self.context
        found = self.output[cut:], [[x - cut for x in span] for span in self.spans], self.rewrites, lost
        if self.piece is not None:
            self.whole = self.turns, self.output
        last = self.turns[-1:]
        self.turns, self.output = last, self.template(last)
        self.context, self.spans, self.masked, self.rewrites = len(self.output), [], [], []
        return found


_FORMATTED = StructType([
    StructField("conv_id", LongType()), StructField("piece", LongType()), StructField("formatted", StringType()),
    StructField("spans", ArrayType(ArrayType(LongType()))), StructField("masked", ArrayType(BooleanType())),
    StructField("rewrites", ArrayType(LongType())), StructField("lost", ArrayType(LongType())),
])


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _batched(rows: Iterator[tuple], schema: pa.Schema, limit: int = 256) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def in_order(conversations: DataFrame) -> DataFrame:
    """Turns with conversations together and in order. Equal turn numbers go by role and text,
    null numbers first; null roles and texts are empty. A null conv_id is one conversation."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").select(
        F.col("conv_id").cast("long"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")


def format_conversations(conversations: DataFrame, template: Template = chat_markup, masked_role: str = "assistant", piece: int | None = None) -> DataFrame:
    """Conversations rendered by any template, each in one row or, with ``piece``, in a row for
    each piece of up to so many turns.

    A ``piece`` may only be given for templates that ``Renderer`` can cut; ``chat_markup`` is
    one, and is cut into pieces of PIECE_TURNS. What another template does with a turn's number,
    or with turns far back, shows in whole prefixes alone, so without ``piece`` it gets them:
    rendering then takes time by the square of a conversation's length, and memory for all of it.

    Rows: conv_id, piece, formatted, spans (for each turn where its span and its text under
    the loss mask begin and end, in code points of ``formatted``; the text is empty if it is
    not masked), masked (of each turn), rewrites (turns at which the template changed what it
    had rendered before), lost (masked turns whose text ``formatted`` has not, as the template has
    rewritten it; their text is empty). Order and nulls are as ``in_order`` has them; repeated rows are
    repeated turns. A conversation's rows come one after the other and are streamed, so with
    pieces its length is no matter of memory.
    """
    if piece is None and template is chat_markup:
        piece = PIECE_TURNS
    schema = pa.schema([
        ("conv_id", pa.int64()), ("piece", pa.int64()), ("formatted", pa.string()), ("spans", pa.list_(pa.list_(pa.int64()))),
        ("masked", pa.list_(pa.bool_())), ("rewrites", pa.list_(pa.int64())),
        ("lost", pa.list_(pa.int64())),
    ])

    def render(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def pieces() -> Iterator[tuple]:
            conv, number, renderer, masked = None, 0, None, []
            for own, _, role, text in _rows(batches):
                if renderer is not None and (own != conv or renderer.full):
                    yield (conv, number, *_piece(renderer, masked))
                    number, masked = number + 1, []
                if renderer is None or own != conv:
                    conv, number, renderer, masked = own, 0, Renderer(template, piece), []
                masked.append(role == masked_role)
                renderer.add((role, text), masked[-1])
            if renderer is not None:
                yield (conv, number, *_piece(renderer, masked))

        def _piece(renderer: Renderer, masked: list[bool]) -> tuple:
            output, spans, rewrites, lost = renderer.take()
            return output, spans, masked, rewrites, lost

        yield from _batched(pieces(), schema)

    return in_order(conversations).mapInArrow(render, _FORMATTED)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """What reading ``format_conversations``'s output back gives for each conversation: conv_id,
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites (how many).

    ``formatted`` must come straight from ``format_conversations`` with ``chat_markup``: its
    pieces are in order already and are streamed; the digests are chained through them.
    """
    fields = [("conv_id", "bigint"), ("n_turns", "bigint"), ("turns_sha256", "string"), ("loss_chars", "bigint"), ("loss_sha256", "string"), ("formatted_chars", "bigint"), ("rewrites", "bigint")]
    schema = pa.schema([(name, pa.int64() if kind == "bigint" else pa.string()) for name, kind in fields])

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def conversations() -> Iterator[tuple]:
            conv = turns = None
            for own, piece, text, spans, _, rewrites, _ in _rows(batches):
                if piece == 0:
                    if turns is not None:
                        yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, changed
                    conv, turns, loss = own, hashlib.sha256(), hashlib.sha256()
                    n = loss_chars = chars = changed = 0
                for role, body in read_markup(text):
                    turns.update(f"{role}\n{body}\n".encode())
                    n += 1
                for _, _, begin, end in spans:
                    body = unescape(text[begin:end])
                    loss.update(body.encode())
                    loss_chars += len(body)
                chars += len(text)
                changed += len(rewrites)
            if turns is not None:
                yield conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, changed

        yield from _batched(conversations(), schema)

    return formatted.mapInArrow(digest, ", ".join(f"{name} {kind}" for name, kind in fields))


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """Digests of all conversations and of conversation -1, whose texts are control strings."""
    rows = pick(conversations, "conv_id", "turn", "role", "text")
    trap = f"{TURN_CLOSE}{TURN_OPEN}assistant ok"
    extra = rows.sparkSession.createDataFrame([(-1, 0, "user", trap), (-1, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    return conversation_digests(format_conversations(rows.unionByName(extra)))
