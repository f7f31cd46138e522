"""Chat formatting by incremental rendering of a black-box template.

A template is any function from a list of (role, text) to one string. The turns of a conversation are rendered as
growing prefixes; what a prefix adds to the one before is the span of its last turn. Where the earlier output is
not the beginning of the later one, the template rewrites history: the turn is marked and says how much of the output so far
it takes back. Which part of a span is the text itself is found by rendering the turn with two other texts: what stays alike
at both ends is the template's.

Every prefix begins at the first turn, so history that any turn rewrites is seen; the work for a conversation grows with the
square of its turns. For a template declared append-only (the span of a turn depends on this turn alone and nothing before it
changes, as with ``marked_turns``) the earlier turns need not be rendered again: ``context`` then lets prefixes begin at most
``2 * context`` turns back, which gives the same spans with bounded work and memory for a turn. A conversation is streamed in
order through one task.

Turns are ordered by (turn, role, text), nulls first; repeated rows are turns of their own. Null roles and texts are empty.
Rows with a null conversation are one conversation. An empty table gives an empty result. A very long text is a turn like others, rendered
whole. Columns other than these four are not kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# For templates declared append-only, as ``marked_turns`` is.
APPEND_ONLY_CONTEXT = 4
BEGIN, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLES = ("assistant",)

Messages = list[tuple[str, str]]


def escape(text: str) -> str:
    """No control string can be read in the result: a backslash goes between ``<`` and ``|``, and one more where some are."""
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def marked_turns(messages: Messages) -> str:
    """The template: each turn between marks, its role on the first line."""
    return "".join(f"{BEGIN}{_role(role)}\n{escape(text)}{END}\n" for role, text in messages)


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def read_turn(span: str) -> tuple[str, str]:
    """Role and text of a turn that ``marked_turns`` has rendered."""
    head, _, rest = span.removeprefix(BEGIN).partition("\n")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(head))
    return role, unescape(rest[: rest.index(END)])


def _alike(one: str, other: str) -> int:
    """Length of the common prefix, by halving."""
    if other.startswith(one):
        return len(one)
    low, high = 0, min(len(one), len(other))
    while low < high:
        middle = (low + high + 1) // 2
        if one[:middle] == other[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Renderer:
    """Renders the turns of one conversation, one after another."""

    def __init__(self, template: Callable[[Messages], str], context: int | None):
        self.template, self.context = template, context
        self.messages: Messages = []
        self.output = template([])

    def add(self, role: str, text: str) -> tuple[str, int, int, int]:
        """What the turn adds, how much it takes back, and where its text begins and ends in what it adds."""
        if self.context is not None and len(self.messages) >= 2 * self.context:
            self.messages = self.messages[-self.context :] if self.context else []
            self.output = self.template(self.messages)
        after = self.template([*self.messages, (role, text)])
        same = _alike(self.output, after)
        head, tail = self._frame(role, same)
        back = len(self.output) - same
        self.messages.append((role, text))
        self.output = after
        span = after[same:]
        begin = min(head, len(span))
        return span, back, begin, max(begin, len(span) - tail)

    def _frame(self, role: str, same: int) -> tuple[int, int]:
        one, other = (self.template([*self.messages, (role, text)]) for text in "01")
        head = _alike(one, other)
        tail = _alike(one[head:][::-1], other[head:][::-1])
        return max(0, head - same), tail


def format_conversations(
    frame: DataFrame,
    template: Callable[[Messages], str] = marked_turns,
    context: int | None = None,
    trained_roles: tuple[str, ...] = TRAINED_ROLES,
) -> DataFrame:
    """A row for each turn, in order: ``conv_id, position, span, takes_back, start, loss_start, loss_end``.

    ``span`` is what the turn adds to the formatted conversation and ``start`` where; ``loss_start`` and ``loss_end`` are code points
    of the span under the loss mask (equal: none); ``takes_back`` is above 0 where the template rewrites history.
    A ``context`` is right for append-only templates only.
    """

    def run(batches):
        started, current, renderer, position, length = False, None, None, 0, 0
        for batch in batches:
            out = []
            for conv, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != current:
                    started, current, renderer, position, length = True, conv, Renderer(template, context), 0, 0
                    prelude = renderer.output
                span, back, begin, end = renderer.add(role, text)
                if position == 0:
                    span, begin, end = prelude[: len(prelude) - back] + span, begin + len(prelude) - back, end + len(prelude) - back
                    back = 0
                length -= back
                if role not in trained_roles:
                    begin = end = 0
                out.append((conv, position, span, back, length, begin, end))
                length += len(span)
                position += 1
            if out:
                columns = list(zip(*out, strict=True))
                arrays = [pa.array(c, pa.string() if k == 2 else pa.int64()) for k, c in enumerate(columns)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["conv_id", "position", "span", "takes_back", "start", "loss_start", "loss_end"]
    schema = "conv_id bigint, position bigint, span string, takes_back bigint, start bigint, loss_start bigint, loss_end bigint"
    turns = frame.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    dealt = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from the spans of ``marked_turns``, a row for each conversation.

    The rows of a conversation must stand together in order, as ``format_conversations`` leaves them.
    """
    import hashlib

    def run(batches):
        started, current, state = False, None, None
        done = []
        for batch in batches:
            for conv, span, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not started or conv != current:
                    if started:
                        done.append(_closed(current, state))
                    started, current = True, conv
                    state = [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = read_turn(span)
                learnt = unescape(span[begin:end])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += len(span)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=target)
                done = []
        if started:
            yield pa.RecordBatch.from_pylist([_closed(current, state)], schema=target)

    def _closed(conv, state):
        turns, whole, chars, learnt, length = state
        return {
            "conv_id": conv,
            "n_turns": turns,
            "turns_sha256": whole.hexdigest(),
            "loss_chars": chars,
            "loss_sha256": learnt.hexdigest(),
            "formatted_chars": length,
        }

    from featurepipe.llm.common import _parsed, arrow_schema

    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    target = arrow_schema(_parsed(schema))
    return formatted.select("conv_id", "span", "loss_start", "loss_end").mapInArrow(run, schema)
