"""Chat formatting by incremental black-box rendering.

A template is a function ``render(turns, open_reply=False) -> str`` whose inside
is never looked at.  Rendering turns 1..k and 1..k+1 and comparing the two
outputs locates turn k+1's span; an output that does not start with the
previous one shows a template that rewrites history.  The text inside an
assistant turn is located the same way: its header is what ``open_reply`` adds,
its trailer what a reply of empty text has beyond the header.

Rows come sorted by conversation and turn and stream through the task, one
piece of output a turn.  A template sees every true prefix, so memory holds one
conversation and work grows with the square of its turns.  Only a template that
says that it renders each turn by itself (``turnwise = True``, as the default one's)
is rendered after the first turn and the last ``window - 1`` ones: the output is the
same, memory holds ``window`` turns and work is linear.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 32

Turn = tuple[str, str]  # role, text
Template = Callable[..., str]

# The control strings of the template.
START, END = "<|im_start|>", "<|im_end|>"


def escape(text: str) -> str:
    """No control string survives in the result; ``unescape`` gives the text back."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role, flags=re.DOTALL)


def marked_turns(turns: list[Turn], open_reply: bool = False) -> str:
    """The default template: ``<|im_start|>role`` newline text ``<|im_end|>`` newline for each turn."""
    out = "".join(f"{START}{escape_role(role)}\n{escape(text)}{END}\n" for role, text in turns)
    return out + f"{START}assistant\n" if open_reply else out


marked_turns.turnwise = True  # the output is a join over turns: none depends on another or on its place


class Spans:
    """Feeds one conversation's turns in order; each call returns that turn's piece and its place."""

    def __init__(self, render: Template, window: int = WINDOW):
        self.render, self.first = render, None
        self.last = deque(maxlen=window - 1 if getattr(render, "turnwise", False) else None)
        self.offset = 0

    def add(self, turn: Turn) -> dict:
        before = ([self.first] if self.first is not None and self.first is not self.last[0] else []) + list(self.last) \
            if self.last else []
        old, new = self.render(before), self.render([*before, turn])
        rewrites = not new.startswith(old)
        common = len(old) if not rewrites else _common_prefix(old, new)
        piece, loss = new[common:], (0, 0)
        if turn[0] == "assistant":
            opened = self.render(before, open_reply=True)
            empty = self.render([*before, (turn[0], "")])
            if not rewrites and new.startswith(opened) and empty.startswith(opened):
                loss = (len(opened) - common, len(new) - (len(empty) - len(opened)) - common)
            else:  # the header is rewritten as well: the whole turn counts
                loss = (0, len(piece))
        out = {"piece": piece, "start": self.offset - (len(old) - common), "loss_from": loss[0], "loss_to": loss[1],
               "rewrites": rewrites}
        self.offset = out["start"] + len(piece)
        if self.first is None:
            self.first = turn
        self.last.append(turn)
        return out


def _common_prefix(a: str, b: str) -> int:
    lo, hi = 0, min(len(a), len(b))
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid - 1)
    return lo


PIECES = "conv_id long, turn long, ord long, piece string, start long, loss_from int, loss_to int, rewrites boolean"


def format_turns(conversations: DataFrame, render: Template = marked_turns, window: int = WINDOW) -> DataFrame:
    """One row a turn: its piece of the formatted text, its place and its loss span.

    ``piece`` strings of a conversation in order of ``ord`` are the formatted text;
    ``[loss_from, loss_to)`` is the part of the piece under the loss mask (assistant text).
    ``rewrites`` marks a turn whose rendering changed text before it; ``start`` then points at
    the change.  Turns are ordered by (turn, role, text), nulls first, so ties and repeated
    rows have one order; a null text or role is empty; null conv_id is one conversation.
    Other columns are ignored.  ``window`` is for templates that are ``turnwise``; others see all turns.
    """
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                                 F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, now, n = None, object(), 0
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for conv, turn, role, text in zip(rows["conv_id"], rows["turn"], rows["role"], rows["text"]):
                if spans is None or conv != now:
                    spans, now, n = Spans(render, window), conv, 0
                out.append({"conv_id": conv, "turn": turn, "ord": n, **spans.add((role, text))})
                n += 1
            yield pa.RecordBatch.from_pylist(out, schema=_PIECES)

    return (turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .mapInArrow(run, PIECES))


_PIECES = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("ord", pa.int64()), ("piece", pa.string()),
                     ("start", pa.int64()), ("loss_from", pa.int32()), ("loss_to", pa.int32()), ("rewrites", pa.bool_())])
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"
_DIGESTS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                      ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                      ("rewrites", pa.bool_())])

_TURN = re.compile(re.escape(START) + r"(.*?)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def read_back(pieces: DataFrame) -> DataFrame:
    """Parse the formatted pieces again and digest each conversation.

    Role and text come from the marked piece alone, the loss text from the mask's span.
    Pieces stream in order, so a conversation of any length needs the memory of one turn.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            rows, out = batch.to_pydict(), []
            for conv, piece, a, b, rewrites in zip(rows["conv_id"], rows["piece"], rows["loss_from"], rows["loss_to"],
                                                   rows["rewrites"]):
                if state is None or conv != now:
                    if state is not None:
                        out.append(_digest(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                for m in _TURN.finditer(piece):
                    state[0] += 1
                    state[1].update(f"{unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
                loss = unescape(piece[a:b])
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(piece)
                state[5] |= rewrites
            yield pa.RecordBatch.from_pylist(out, schema=_DIGESTS)
        if state is not None:
            yield pa.RecordBatch.from_pylist([_digest(now, state)], schema=_DIGESTS)

    return (pieces.select("conv_id", "ord", "piece", "loss_from", "loss_to", "rewrites")
            .repartition("conv_id").sortWithinPartitions("conv_id", "ord").mapInArrow(run, DIGESTS))


def _digest(conv: int | None, s: list) -> dict:
    return {"conv_id": conv, "n_turns": s[0], "turns_sha256": s[1].hexdigest(), "loss_chars": s[2],
            "loss_sha256": s[3].hexdigest(), "formatted_chars": s[4], "rewrites": s[5]}
