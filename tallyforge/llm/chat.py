"""Chat formatting by incremental black-box rendering.

The template is any function from a list of turns to text. Successive prefixes of a conversation are rendered; where one
output continues the previous one, the new part is the span of the new turn, and where it does not, the template
rewrites history and the conversation is flagged. Where a turn's own text lies in its span is found the same way: the
last turn is rendered once more with a text of one character that occurs nowhere else, and what stands around that
character must stand around the text. Nothing else about the template needs to be known.

A template may look at a whole conversation, so a conversation is one unit of work: its turns stream to one task, which
holds the text of that conversation and the output for two prefixes. Conversations share tasks, in order.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import common as C
from tallyforge.session import ship

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

#: The marks of this template, and control strings of widespread templates that texts must not carry.
OPEN, CLOSE = "<|turn|>", "<|end|>"
_CONTROL = re.compile(r"(<(?=\|)|<(?=/?s>)|\[(?=/?INST\])|<(?=<SYS>>)|<(?=</SYS>>))")
_TURN = re.compile(r"<\|turn\|>((?:\\.|[^\\\n])*)\n((?:\\.|[^\\])*?)<\|end\|>\n", re.DOTALL)
#: Private characters, one of which stands for a text while its place is found.
_MARKS = (range(0xE000, 0xF900), range(0xF0000, 0xFFFFE), range(0x100000, 0x10FFFE))
#: Formatted text of one output row; a longer conversation continues in the next row.
PART_CHARS = 64 << 20


def escape(text: str) -> str:
    """Double backslashes and break every control string with one after its first character."""
    return _CONTROL.sub(r"\1\\", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(n|\\|)", lambda m: {"n": "\n", "\\": "\\", "": ""}[m[1]], role)


def _render_turn(turn: Turn) -> str:
    return f"{OPEN}{_escape_role(turn[0])}\n{escape(turn[1])}{CLOSE}\n"


#: Rendered turns that are remembered: short ones only, so that what a worker keeps is bounded (some 40 MB).
_SHORT = 2048
_remembered = lru_cache(maxsize=4096)(_render_turn)


def render(turns: list[Turn]) -> str:
    """The template of this module: marked turns, escaped texts."""
    return "".join(_remembered(t) if len(t[0]) + len(t[1]) <= _SHORT else _render_turn(t) for t in turns)


@dataclass
class Rendered:
    """A conversation rendered so far: its text, the span of each turn and of the text inside it (None where it cannot be
    told), whether the template rewrote what it had said before, and the error if it refused the last prefix."""

    text: str = ""
    spans: list[tuple[int, int]] = field(default_factory=list)
    texts: list[tuple[int, int] | None] = field(default_factory=list)
    rewrites: bool = False
    error: str | None = None


class Prefixes:
    """Feeds a conversation to a template turn by turn and compares each output with the one before. What a template says of
    no turns at all belongs to no turn; one that can't be asked that says nothing. A prefix that it refuses leaves the
    output as it was, with an empty span, and is part of what the next prefix adds."""

    def __init__(self, template: Render = render) -> None:
        self.template, self.turns = template, []
        self.done = Rendered(self._said([]) or "")

    def _said(self, turns: list[Turn]) -> str | None:
        """The template's output, None if it raises or gives no text; the error of the last call is kept."""
        self.failed = None
        try:
            out = self.template(turns)
        except Exception as e:  # noqa: BLE001
            self.failed = f"{type(e).__name__}: {e}"[:200]
            return None
        if not isinstance(out, str):
            self.failed = f"TypeError: the template gave {type(out).__name__}"
            return None
        return out

    def add(self, turn: Turn, inside: bool = True) -> None:
        """A turn that changes earlier output gets the span from the first changed character. ``inside``: find the turn's
        own text, too."""
        before = self.done.text
        self.turns.append(turn)
        now = self._said(self.turns)
        self.done.error = self.failed
        at = len(before)
        if now is None:
            self.done.spans.append((at, at))
            self.done.texts.append(None)
            return
        if not now.startswith(before):
            self.done.rewrites = True
            at = next((i for i, (a, b) in enumerate(zip(before, now, strict=False)) if a != b), min(len(before), len(now)))
        self.done.text = now
        self.done.spans.append((at, len(now)))
        self.done.texts.append(self._inside(turn, at) if inside else None)

    def _inside(self, turn: Turn, at: int) -> tuple[int, int] | None:
        now = self.done.text
        taken = {*now, *turn[0]}
        mark = next((c for area in _MARKS for c in map(chr, area) if c not in taken), None)
        if mark is None:  # a text that holds every private character
            return None
        self.turns[-1] = (turn[0], mark)
        probe = self._said(self.turns)
        self.turns[-1] = turn
        if probe is None:
            return None
        head, _, tail = probe.partition(mark)
        if probe.count(mark) != 1 or len(head) < at or len(head) + len(tail) > len(now) or not (now.startswith(head) and now.endswith(tail)):
            return None
        return len(head), len(now) - len(tail)


def spans_of(turns: list[Turn], template: Render = render) -> Rendered:
    """All turns of a conversation, one after the other."""
    prefixes = Prefixes(template)
    for turn in turns:
        prefixes.add(turn)
    return prefixes.done


_FORMATTED = "conv_id long, part int, turns int, formatted string, loss array<struct<start:int,end:int>>, rewrites boolean, unlocated int, error string"


def _formatter(template: Render, trained: str, part_chars: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, prefixes = None, None

        def rows() -> Iterator[tuple]:
            """The conversation, in parts that end between turns."""
            done = prefixes.done
            found = [None if done.rewrites or role != trained else span for (role, _), span in zip(prefixes.turns, done.texts, strict=True)]
            lost = 0 if done.rewrites else sum(role == trained and span is None for (role, _), span in zip(prefixes.turns, found, strict=True))
            begin = first = part = 0
            for i, (_, end) in enumerate(done.spans):
                if i + 1 < len(done.spans) and done.spans[i + 1][1] - begin <= part_chars:
                    continue
                stop = end if i + 1 < len(done.spans) else len(done.text)
                loss = [{"start": s[0] - begin, "end": s[1] - begin} for s in found[first : i + 1] if s]
                yield key[1], part, i + 1 - first, done.text[begin:stop], loss, done.rewrites, lost, done.error
                begin, first, part = stop, i + 1, part + 1

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.bool_(), pa.int32(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["conv_id", "part", "turns", "formatted", "loss", "rewrites", "unlocated", "error"])

        for batch in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (conv is None, conv) != key:
                    if prefixes:
                        out += rows()
                    key, prefixes = (conv is None, conv), Prefixes(template)
                prefixes.add((role, text), inside=role == trained)
            if out:
                yield batch_of(out)
        if prefixes:
            for row in rows():
                yield batch_of([row])

    return run


def format_conversations(rows: DataFrame, template: Render = render, trained: str = "assistant", part_chars: int = PART_CHARS) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` to formatted conversations: ``conv_id, part, turns, formatted, loss, rewrites,
    unlocated, error``. A conversation is one row unless it is longer than ``part_chars``; then it goes on in further rows.

    Turns go by turn number (null first), then role and text, so ties are the same on every run; repeated rows are
    turns of their own. Null roles and texts count as empty. Rows without ``conv_id`` form one conversation of
    their own. ``loss`` holds code-point spans, inside ``formatted``, of the trained role's texts; it is empty where the
    template rewrites history, and leaves out turns whose text the template changes beyond finding (counted in
    ``unlocated``). A template that refuses a prefix (roles must alternate, say) ends no job: its turn is counted so, and where it
    refuses the whole conversation ``error`` says why, beside what it last said. Other columns are ignored; an empty table gives none. Rendering every prefix takes time quadratic in
    the turns of a conversation.
    """
    ship(rows.sparkSession)
    clean = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("turn").cast("long").alias("turn"),
    )
    ordered = clean.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(C.tidy(_formatter(template, trained, part_chars)), _FORMATTED)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
    key, state = None, None
    out: list[tuple] = []

    def close() -> None:
        if state is not None:
            out.append((key[1], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5]))

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)
        out.clear()
        return made

    for batch in batches:
        for conv, text, loss, rewrites in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if (conv is None, conv) != key:
                close()
                key, state = (conv is None, conv), [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
            for m in _TURN.finditer(text):
                state[0] += 1
                state[1].update(f"{_unescape_role(m[1])}\n{unescape(m[2])}\n".encode())
            for s in loss:
                part = unescape(text[s["start"] : s["end"]])
                state[2] += len(part)
                state[3].update(part.encode())
            state[4] += len(text)
            state[5] |= rewrites
        if out:
            yield flush()
    close()
    if out:
        yield flush()


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation of this module's template, from the formatted text alone: turns, trained text and their hashes."""
    ship(formatted.sparkSession)
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss", "rewrites")
    return ordered.mapInArrow(C.tidy(_reader), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites boolean")
