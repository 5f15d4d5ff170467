"""Spans where a template rewrites history, and templates that cannot be cut into pieces."""

from __future__ import annotations

import pytest

from tourledger.llm import chat
from tourledger.llm.chat import Renderer, format_conversations

SCHEMA = "conv_id long, turn long, role string, text string"


def templates() -> dict:
    """Made inside a function, so that they go to workers by value."""

    def last_only(own):
        return "".join(f"[{r}:{t if k == len(own) - 1 else '...'}]" for k, (r, t) in enumerate(own))

    def late(own):
        return "".join(f"[{r}:{t}]" for r, t in (own if len(own) < 40 else own[1:]))

    def counted(own):
        return "".join(f"{k} {r}: {t};" for k, (r, t) in enumerate(own))

    def total_first(own):
        return f"{len(own)} turns: " + "".join(f"<{r}>{t}</{r}>" for r, t in own)

    return {f.__name__: f for f in (last_only, late, counted, total_first)} | {"chat_markup": chat.chat_markup}


def turns(n: int) -> list[tuple[str, str]]:
    return [("assistant" if k % 2 else "user", f"text {k}") for k in range(n)]


@pytest.mark.parametrize("n", [1, 4, 45])
@pytest.mark.parametrize("name", templates())
def test_masked_spans_read_their_texts_or_are_lost(spark, name, n):
    own, template = turns(n), templates()[name]
    made = spark.createDataFrame([(1, k, *turn) for k, turn in enumerate(own)], SCHEMA)
    piece = 100 if name == "chat_markup" else None
    row, = format_conversations(made, template, piece=piece).collect()
    assert row.formatted == template(own)
    size = len(row.formatted)
    for k, ((begin, end, low, high), masked) in enumerate(zip(row.spans, row.masked)):
        assert 0 <= begin <= end <= size and 0 <= low <= high <= size
        expected = own[k][1] if masked and k not in row.lost else ""
        assert row.formatted[low:high] == expected
    assistants = {k for k in range(n) if k % 2}
    shown = {k for k in assistants if f":{own[k][1]}]" in template(own)} if name == "last_only" else assistants
    assert set(row.lost) == assistants - shown


def test_templates_that_cannot_be_cut_are_refused():
    for name in ("counted", "total_first", "last_only"):
        renderer = Renderer(templates()[name], 3)
        with pytest.raises(ValueError, match="pieces"):
            for turn in turns(5):
                if renderer.full:
                    renderer.take()
                renderer.add(turn, True)


def test_pieces_are_checked_where_they_begin():
    calls = []

    def template(own):
        calls.append(len(own))
        return chat.chat_markup(own)

    renderer, own, text = Renderer(template, 4), turns(11), ""
    for turn in own:
        if renderer.full:
            text += renderer.take()[0]
        renderer.add(turn, False)
    assert text + renderer.take()[0] == chat.chat_markup(own)
    assert max(calls) == 6  # the context, a whole piece and the next one's first turn
