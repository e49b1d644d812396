"""Chat formatting by incremental black-box rendering.

A template is any function from a list of (role, text) to a string; nothing else of it is used. Successive prefixes of a
conversation are rendered and consecutive outputs compared: where the shorter output is a prefix of the longer, the
difference is the new turn's span; where it isn't, the template rewrites history, which is counted and reported. Within
an assistant turn's span the text is found by rendering the turn with two probe texts: what both probes share before and
after is the frame, what lies between is the text. Loss spans are these places.

`marked_turns` is the production template: it marks turns and escapes its own control characters inside texts and roles,
so that any text, control strings included, is read back exactly by `read_marked`.

Whole prefixes are rendered, which costs the square of a conversation's turns, unless the template is declared to append
only: then prefixes go back at most `window` turns, and n_cut counts the turns rendered so. That is proved, not trusted: each
time the turns have doubled since, and at the end, the whole conversation is rendered and must equal the spans so far, one
after another; where it doesn't, the conversation is done over with whole prefixes. is_whole tells of every conversation that
its spans are its whole rendering. A conversation is streamed through one task in turn order; its turns and its formatted
text are held.

Nulls: a null text or role is empty; rows with a null conv_id form one conversation; a null turn stands first; rows with
equal turns stand in order of role and text, repeated rows are turns of their own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turns = list[tuple[str, str]]
SCHEMA = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_rewrites long, n_unlocated long, loss_spans array<struct<start:long,end:long>>, formatted_sha256 string, formatted string, n_cut long, is_whole boolean"
_KINDS = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_rewrites", pa.int64()), ("n_unlocated", pa.int64()), ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("formatted_sha256", pa.string()), ("formatted", pa.string()), ("n_cut", pa.int64()), ("is_whole", pa.bool_())])


def escape(text: str) -> str:
    return re.sub(r"([\\<>])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def marked_turns(turns: Turns) -> str:
    return "".join(f"<turn {escape(role)}>\n{escape(text)}\n</turn>\n" for role, text in turns)


_TURN = re.compile(r"<turn ((?:[^\\<>]|\\.)*)>\n((?:[^\\<>]|\\.)*)\n</turn>\n", re.DOTALL)


def read_marked(output: str) -> Turns:
    """The turns of an output of marked_turns; raises where it is none."""
    found, at = [], 0
    for m in _TURN.finditer(output):
        if m.start() != at:
            break
        found.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(output):
        raise ValueError(f"not an output of marked_turns at {at}")
    return found


def common_prefix(a: str, b: str) -> int:
    """Length of the longest common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class IncrementalRender:
    """Feeds one conversation turn by turn; `push` gives the new turn's span and where its text lies in the span."""

    PROBES = ("a", "b")

    def __init__(self, template: Callable[[Turns], str], window: int | None = 512):
        self.template, self.window = template, window
        self.turns: Turns = []
        self.output = template([])
        self.is_cut, self.n_cut = False, 0

    def push(self, role: str, text: str, locate: bool) -> tuple[str, tuple[int, int] | None, bool]:
        """The span, the text's place in the span (None if not asked for or not found), whether history was rewritten."""
        if self.window is not None and len(self.turns) >= self.window:
            self.is_cut = True
            self.turns = self.turns[-(self.window // 2) :]
            self.output = self.template(self.turns)
        self.n_cut += self.is_cut
        before, prefix = self.output, list(self.turns)
        self.turns.append((role, text))
        self.output = self.template(self.turns)
        kept = common_prefix(before, self.output)
        rewritten = kept < len(before)
        place = None
        if locate:
            probes = [self.template([*prefix, (role, p)]) for p in self.PROBES]
            head = common_prefix(*probes)
            tail = common_prefix(probes[0][::-1], probes[1][::-1])
            frame = len(probes[0]) - head - tail == len(self.PROBES[0]) and len(self.output) >= head + tail
            if frame and self.output[:head] == probes[0][:head] and self.output[len(self.output) - tail :] == probes[0][len(probes[0]) - tail :]:
                place = (head - kept, len(self.output) - tail - kept)
        return self.output[kept:], place, rewritten


class _Digest:
    """What the rows of one conversation come to, with everything read back from the rendered output."""

    def __init__(self, conv_id, template, read, undo, loss_roles, window):
        self.conv_id, self.template, self.read, self.undo, self.loss_roles = conv_id, template, read, undo, loss_roles
        self._begin(window)
        self.said: Turns = []

    def _begin(self, window: int | None) -> None:
        self.render = IncrementalRender(self.template, window)
        self.proof_at = None if window is None else 2 * window
        self.turns, self.loss, self.formatted = hashlib.sha256(), hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = self.rewrites = self.unlocated = 0
        self.spans: list[dict] = []
        self.parts: list[str] = []

    def _is_whole(self) -> bool:
        """Whether the spans so far are the rendering of all turns so far."""
        whole = self.template(self.said) if self.render.n_cut else self.render.output
        return whole == "".join(self.parts)

    def _prove(self) -> None:
        if self.render.n_cut and not self._is_whole():
            self._begin(None)
            for role, text in self.said:
                self._add(role, text)

    def add(self, role: str, text: str) -> None:
        self.said.append((role, text))
        self._add(role, text)
        if self.proof_at and len(self.said) >= self.proof_at:
            self.proof_at *= 2
            self._prove()

    def _add(self, role: str, text: str) -> None:
        wanted = role in self.loss_roles
        span, place, rewritten = self.render.push(role, text, wanted)
        self.rewrites += rewritten
        for r, t in self.read(span):
            self.n_turns += 1
            self.turns.update(f"{r}\n{t}\n".encode("utf-8", "surrogatepass"))
        if wanted:
            if place is None:
                self.unlocated += 1
            else:
                self.spans.append({"start": self.chars + place[0], "end": self.chars + place[1]})
                said = self.undo(span[place[0] : place[1]])
                self.loss_chars += len(said)
                self.loss.update(said.encode("utf-8", "surrogatepass"))
        self.chars += len(span)
        self.parts.append(span)
        self.formatted.update(span.encode("utf-8", "surrogatepass"))

    def row(self) -> dict:
        self._prove()
        return {"conv_id": self.conv_id, "n_turns": self.n_turns, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars, "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars, "n_rewrites": self.rewrites, "n_unlocated": self.unlocated, "loss_spans": self.spans, "formatted_sha256": self.formatted.hexdigest(), "formatted": "".join(self.parts), "n_cut": self.render.n_cut, "is_whole": self._is_whole()}


def _formatter(template, read, undo, loss_roles: tuple[str, ...], window: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None
        done: list[dict] = []
        chars = 0
        for b in batches:
            for conv_id, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if now is None or now.conv_id != conv_id:
                    if now is not None:
                        done.append(now.row())
                        chars += now.chars
                    now = _Digest(conv_id, template, read, undo, loss_roles, window)
                now.add(role, text)
                if len(done) >= 1000 or chars >= 1 << 22:
                    yield pa.RecordBatch.from_pylist(done, _KINDS)
                    done, chars = [], 0
        if now is not None:
            done.append(now.row())
        if done:
            yield pa.RecordBatch.from_pylist(done, _KINDS)

    return run


def format_chats(chats: DataFrame, template: Callable[[Turns], str] = marked_turns, read: Callable[[str], Turns] = read_marked, undo: Callable[[str], str] = unescape, loss_roles: tuple[str, ...] = ("assistant",), window: int = 512, append_only: bool | None = None) -> DataFrame:
    """One row for each conversation of `chats` (conv_id, turn, role, text; other columns are not read).

    append_only declares that the template only adds to its output, turn by turn, whatever stands before, so that the window
    is worth trying; by default only marked_turns counts as such.
    formatted is the text that loss_spans point into: the spans of all turns one after another.
    n_rewrites counts turns whose rendering changed earlier output, n_unlocated loss turns whose text was not found in
    their span; both are 0 for a template that only appends and frames texts.
    """
    rows = chats.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_formatter(template, read, undo, loss_roles, window if (template is marked_turns if append_only is None else append_only) else None), SCHEMA)
