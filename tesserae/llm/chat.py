"""Chat formatting by incremental black-box rendering.

A template is any function from messages to a string. Successive prefixes of a conversation are
rendered and compared: what render(turns[:k + 1]) adds to render(turns[:k]) is turn k's span, and a
template that changes what it has already written rewrites history. Any template may look at all
turns, so all of them are rendered each time, and a conversation costs the square of its length.

A template may be declared local (`template.local = True`): it adds the same text for a turn
whatever stood before it, and never rewrites. This module's is. Of its conversations the last
`WINDOW` turns at most are rendered with each new one, which keeps long ones linear. The declaration
is held against a rendering of the whole conversation, or of its first `VERIFIED` code points; where
it proves false all prefixes are rendered, as for any other template.

A digest of a conversation is a chain over its turns, so each conversation passes through one task;
it is streamed there in order of its turns, and with a local template one of any length needs the
memory of a window only.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .rows import stream_lists

Template = Callable[[list[tuple[str, str]]], str]

WINDOW = 16
#: Code points of a conversation's turns that are held, and over which a local template is verified.
VERIFIED = 1 << 20
BEGIN, OPEN, SEP, CLOSE = "<s>", "<|turn|>", "<|text|>", "<|end|>"
#: Strings that have a meaning to this template or to others; inside texts they are escaped.
CONTROL = (OPEN, SEP, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(["\\\\", *map(re.escape, CONTROL)]))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before every control string and backslash."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(messages: list[tuple[str, str]]) -> str:
    """The template of this module."""
    return BEGIN + "".join(f"{OPEN}{escape(role)}{SEP}{escape(text)}{CLOSE}\n" for role, text in messages)


render.local = True


def read_turn(piece: str) -> tuple[str, str, int, int] | None:
    """(role, text, start, end) read back from a rendered turn: start and end are those of the text as written."""
    if not piece.startswith(OPEN) or not piece.endswith(CLOSE + "\n"):
        return None
    sep = _unescaped(piece, SEP, len(OPEN))
    end = len(piece) - len(CLOSE) - 1
    return unescape(piece[len(OPEN) : sep]), unescape(piece[sep + len(SEP) : end]), sep + len(SEP), end


def _unescaped(piece: str, mark: str, at: int) -> int:
    """The first place of `mark` without a backslash before it."""
    while True:
        at = piece.index(mark, at)
        before = at
        while piece[before - 1] == "\\":
            before -= 1
        if (at - before) % 2 == 0:
            return at
        at += 1


class Incremental:
    """Renders a conversation turn by turn; of local templates only the last `window` turns are rendered with each."""

    def __init__(self, template: Template = render, window: int = WINDOW, local: bool | None = None) -> None:
        self.template, self.window = template, window
        self.local = getattr(template, "local", False) if local is None else local
        self.held: list[tuple[str, str]] = []
        self.before = template([])
        self.length = len(self.before)
        self.rewrites = False

    def add(self, role: str, text: str) -> tuple[int, str, bool]:
        """(start of the span, what the turn adds, whether it rewrote what was there).

        When a template rewrites, the span begins where the two renderings part.
        """
        self.held.append((role, text))
        now = self.template(self.held)
        shared = len(self.before)
        rewrote = not now.startswith(self.before)
        if rewrote:
            self.rewrites = True
            shared = next((i for i, (a, b) in enumerate(zip(self.before, now, strict=False)) if a != b), min(len(self.before), len(now)))
        piece = now[shared:]
        start = self.length - len(self.before) + shared
        self.length = start + len(piece)
        if self.local and len(self.held) >= self.window:
            self.held = self.held[-1:]
            now = self.template(self.held)
        self.before = now
        return start, piece, rewrote


def verified(turns: list[tuple[str, str]], template: Template = render, window: int = WINDOW) -> tuple[Incremental, list[tuple[int, str, bool]]]:
    """The spans of `turns`, and the state to go on from; a local template's are held against the whole rendering."""
    state = Incremental(template, window)
    out = [state.add(*t) for t in turns]
    if state.local and (state.rewrites or template([]) + "".join(piece for _, piece, _ in out) != template(turns)):
        state = Incremental(template, window, local=False)
        out = [state.add(*t) for t in turns]
    return state, out


TURNS = "conv_id long, n int, start long, piece string, rewrote boolean"


def format_turns(conversations: DataFrame, template: Template = render, window: int = WINDOW) -> DataFrame:
    """(conv_id, n, start, piece, rewrote): every turn's number, the start of its span and its rendering.

    In each partition the rows come by conversation and turn; end to end, after what the template
    begins with, the pieces are the conversation's formatted text, as long as nothing was rewritten.
    Turns are ordered by turn, role and text, nulls first, so ties and repeated rows have one order;
    null roles and texts are empty; rows without conv_id are one conversation with a null id.
    """
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict]:
        conv, state, n = object(), None, 0
        held: list[tuple[str, str]] = []
        size = 0
        out: dict[str, list] = {}

        def emit(spans: list[tuple[int, str, bool]]) -> None:
            nonlocal n
            for start, piece, rewrote in spans:
                for name, value in (("conv_id", conv), ("n", n), ("start", start), ("piece", piece), ("rewrote", rewrote)):
                    out[name].append(value)
                n += 1

        def settle() -> None:
            nonlocal state, held
            if held:
                state, spans = verified(held, template, window)
                emit(spans)
                held = []

        for b in batches:
            out = {name: [] for name in ("conv_id", "n", "start", "piece", "rewrote")}
            for c, role, text in zip(b["conv_id"], b["role"], b["text"], strict=True):
                if c != conv:
                    settle()
                    conv, state, n, size = c, None, 0, 0
                turn = (role or "", text or "")
                if state:
                    emit([state.add(*turn)])
                else:
                    held.append(turn)
                    size += len(turn[0]) + len(turn[1])
                    if size > VERIFIED:
                        settle()
            yield out
        out = {name: [] for name in ("conv_id", "n", "start", "piece", "rewrote")}
        settle()
        yield out

    return stream_lists(rows, run, TURNS)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean"


def digests(turns: DataFrame) -> DataFrame:
    """What format_turns() wrote with this module's template, read back, as one row for each conversation.

    `turns` are its rows as they stand in their partitions. The loss mask covers the texts of
    assistant turns as written.
    """

    names = [part.split()[0] for part in DIGEST.split(", ")]

    def run(batches: Iterator[dict[str, list]]) -> Iterator[dict]:
        state: list | None = None

        def row() -> tuple:
            conv, n, turns_sha, chars, loss_sha, end, rewrites = state
            return conv, n, turns_sha.hexdigest(), chars, loss_sha.hexdigest(), end, rewrites

        for b in batches:
            out = []
            for c, n, start, piece, rewrote in zip(b["conv_id"], b["n"], b["start"], b["piece"], b["rewrote"], strict=True):
                if n == 0:
                    if state:
                        out.append(row())
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                role, text, begin, end = read_turn(piece)
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                if role == "assistant":
                    loss = unescape(piece[begin:end])
                    state[3] += len(loss)
                    state[4].update(loss.encode("utf-8", "replace"))
                state[5] = start + len(piece)
                state[6] |= bool(rewrote)
            if out:
                yield dict(zip(names, map(list, zip(*out, strict=True)), strict=True))
        if state:
            yield {name: [value] for name, value in zip(names, row(), strict=True)}

    return stream_lists(turns, run, DIGEST)


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one made of control strings, formatted and read back."""
    tricky = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(tricky).alias("text")
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(format_turns(rows))


_SQL_ESCAPE = r"regexp_replace(coalesce({}, ''), '(\\|<\|turn\|>|<\|text\|>|<\|end\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>)', '\\\1', 'g')"
OP5_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    3 + sum(length({_SQL_ESCAPE.format("role")}) + length({_SQL_ESCAPE.format("text")}) + 24) AS chars
  FROM c GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars, false AS rewrites FROM g
"""
