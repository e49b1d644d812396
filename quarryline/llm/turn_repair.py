"""Conversation structure repair as a scan of min-plus matrices.

The roles of a sound conversation are read by four states: nothing yet, after a system turn, after a user turn, after an
assistant turn. A turn is a 4x4 matrix: its entry (i, j) is the cheapest way to lead from state i to j by edits of this
turn, any inserts before it counted in (the insert closure). Entries are pairs (cost, audit), audit being the edits'
initials; costs add up, audits are joined, and the smaller pair wins. Two ways of equal cost never have one audit begin
the other (the longer would hold more inserts and cost more), so the order holds when both are continued, and the product
of matrices is associative: every stretch of turns has one matrix, whatever its neighbours are.

1. Faults: a turn's text is told by its digest; equal turns are counted before the shuffle, the first of each role and text
   is found by a minimum, so no text and no repeated key gathers anywhere.
2. Turns are dealt out by ranges of (conversation, turn): a long conversation lies in many partitions. Each task multiplies
   the matrices of its stretches as a balanced tree and gives one element for each conversation and `block` turns.
3. Elements of a conversation with more than one are multiplied in rounds of `FAN`, in their order.
4. The texts are streamed past the audit, in order, for the digest of the repaired conversation (which is a chain, so one
   conversation is one stream; only a turn is held).

Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (the only one for blank and duplicate turns), Insert of an empty
user or assistant turn 5; a truncated turn that is not deleted adds 5. Roles go by their first character; an empty role
has none and can't be kept.

Nulls: a null role or text is one space (so the text is blank); a null turn stands first and is left out of the gaps;
rows with a null conv_id form one conversation. Rows of equal turns stand in order of role and of the text's SHA-256;
repeated rows are turns of their own, all but the first of them duplicates. An empty table gives no rows. Extra columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant. Which role leads from where to where.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {"s": ((NONE, SYSTEM),), "u": ((NONE, USER), (SYSTEM, USER), (ASSISTANT, USER)), "a": ((USER, ASSISTANT),)}
LEGAL = ("su", "ua", "au")

Element = tuple[int, str]
Matrix = dict[tuple[int, int], Element]


def times(a: Matrix, b: Matrix) -> Matrix:
    out: Matrix = {}
    for (i, k), (cost, audit) in a.items():
        for j in range(4):
            if (more := b.get((k, j))) is not None:
                new = (cost + more[0], audit + more[1])
                if (i, j) not in out or new < out[i, j]:
                    out[i, j] = new
    return out


def _closure() -> Matrix:
    """Any number of inserts; three lead everywhere that they can."""
    one: Matrix = {(i, i): (0, "") for i in range(4)}
    for i, j in (*STEPS["u"], *STEPS["a"]):
        one[i, j] = (INSERT, "I")
    return times(times(one, one), one)


CLOSURE = _closure()


def turn_matrix(initial: str, must_go: bool, truncated: bool) -> Matrix:
    own: Matrix = {(i, i): (DELETE, "D") for i in range(4)}
    if not must_go:
        extra = TRUNCATED if truncated else 0
        for role in ("u", "a"):
            for step in STEPS[role]:
                own[step] = (KEEP + extra, "K") if initial == role else (REROLE + extra, "R")
        if initial == "s":
            own[NONE, SYSTEM] = (KEEP + extra, "K")
    return times(CLOSURE, own)


#: One matrix for each kind of turn; roles other than these three are alike.
MATRICES = {(r, *f): turn_matrix(r, *f) for r in ("s", "u", "a", "") for f in ((False, False), (False, True), (True, False))}


def cheapest(stretch: Matrix) -> Element:
    """The cheapest edits of a whole conversation, inserts after its last turn counted in."""
    closed = times(stretch, CLOSURE)
    return min(closed[end] for end in ((NONE, NONE), (NONE, ASSISTANT)) if end in closed)


class Stretch:
    """Consecutive turns: counts, ends and the matrix, which is kept as products of 2^n turns until it is asked for."""

    COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal", "distinct")

    def __init__(self):
        self.n = dict.fromkeys(self.COUNTS, 0)
        self.low = self.high = None
        self.first = self.last = None  # (turn, initial)
        self.powers: list[tuple[int, Matrix]] = []

    def _join(self, first: tuple, last: tuple, low, high) -> None:
        """What follows begins with first; ends meet."""
        if self.last is not None:
            self.n["illegal"] += self.last[1] + first[1] not in LEGAL
            self.n["distinct"] -= first[0] is not None and first[0] == self.last[0]
        self.first = self.first or first
        self.last = last
        if low is not None:
            self.low, self.high = (low, high) if self.low is None else (min(self.low, low), max(self.high, high))

    def _multiply(self, size: int, matrix: Matrix) -> None:
        while self.powers and self.powers[-1][0] <= size:
            before, left = self.powers.pop()
            size, matrix = size + before, times(left, matrix)
        self.powers.append((size, matrix))

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        self._join((turn, initial), (turn, initial), turn, turn)
        self.n["turns"] += 1
        self.n["distinct"] += turn is not None
        if fault:
            self.n[fault] += 1
        self._multiply(1, MATRICES[initial if initial in "sua" else "", fault in ("blank", "duplicate"), fault == "truncated"])

    def append(self, row: dict) -> None:
        """Another stretch, as `row` gave it."""
        self._join((row["first_turn"], row["first_initial"]), (row["last_turn"], row["last_initial"]), row["low"], row["high"])
        for c in self.COUNTS:
            self.n[c] += row[c]
        self._multiply(row["turns"], dict(zip(map(tuple, row["entries"]), zip(row["costs"], row["audits"], strict=True), strict=True)))

    def matrix(self) -> Matrix:
        out = self.powers[-1][1]
        for _, left in reversed(self.powers[:-1]):
            out = times(left, out)
        return out

    def row(self) -> dict:
        m = self.matrix()
        ends = {"first_turn": self.first[0], "first_initial": self.first[1], "last_turn": self.last[0], "last_initial": self.last[1]}
        return {**self.n, "low": self.low, "high": self.high, **ends, "entries": [list(e) for e in m], "costs": [c for c, _ in m.values()], "audits": [a for _, a in m.values()]}


#: An element as a row; part and number keep the elements' order.
_PART_KINDS = pa.schema([(c, pa.int64()) for c in ("conv_id", "part", "number", *Stretch.COUNTS, "low", "high", "first_turn", "last_turn")] + [("first_initial", pa.string()), ("last_initial", pa.string()), ("entries", pa.list_(pa.list_(pa.int32()))), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
_PART = ", ".join(f"{c} long" for c in ("conv_id", "part", "number", *Stretch.COUNTS, "low", "high", "first_turn", "last_turn")) + ", first_initial string, last_initial string, entries array<array<int>>, costs array<long>, audits array<string>"
FAN = 16


class _Elements:
    """Rows of finished stretches, given out when they come to some size."""

    def __init__(self):
        self.rows: list[dict] = []
        self.letters = self.number = 0

    def take(self, stretch: Stretch, **of) -> None:
        self.rows.append({**of, "number": self.number, **stretch.row()})
        self.number += 1
        self.letters += stretch.n["turns"]

    def full(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (last or len(self.rows) > 10_000 or self.letters > 1 << 20):
            yield pa.RecordBatch.from_pylist(self.rows, _PART_KINDS)
            self.rows, self.letters = [], 0


def _scan(block: int):
    """Products of the turns of one partition, which come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, of = _Elements(), None, None
        for b in batches:
            for part, conv_id, turn, initial, n, fault in zip(*(b.column(c).to_pylist() for c in ("part", "conv_id", "turn", "initial", "n", "fault")), strict=True):
                for copy in range(n):
                    if now is None or conv_id != of["conv_id"] or now.n["turns"] >= block:
                        if now is not None:
                            done.take(now, **of)
                            yield from done.full()
                        now, of = Stretch(), {"conv_id": conv_id, "part": part}
                    now.add(turn, initial, fault if not copy or fault == "blank" else "duplicate")
        if now is not None:
            done.take(now, **of)
        yield from done.full(last=True)

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of the elements of equal (conv_id, k div FAN), which come in order; k is the new part."""
    done, now, of = _Elements(), None, None
    for b in batches:
        for row in b.to_pylist():
            own = {"conv_id": row["conv_id"], "part": row["k"] // FAN}
            if own != of:
                if now is not None:
                    done.take(now, **of)
                    yield from done.full()
                now, of = Stretch(), own
            now.append(row)
    if now is not None:
        done.take(now, **of)
    yield from done.full(last=True)


_EDITS = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_EDIT_KINDS = pa.schema([(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string())])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cheapest edits of each conversation from its one element."""
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            out = []
            for row in b.slice(at, 1000).to_pylist():
                cost, audit = cheapest(dict(zip(map(tuple, row["entries"]), zip(row["costs"], row["audits"], strict=True), strict=True)))
                gaps = 0 if row["low"] is None else row["high"] - row["low"] + 1 - row["distinct"]
                out.append({**{c: row[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal")}, "gaps": gaps, "cost": cost, "audit": audit})
            yield pa.RecordBatch.from_pylist(out, _EDIT_KINDS)


def _turns(chats: DataFrame) -> DataFrame:
    """The columns that count, without nulls, and the text's digest, which orders rows of equal turn and role."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return chats.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), filled("role").alias("role"), filled("text").alias("text")).withColumn("digest", F.sha2("text", 256))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def conversation_edits(chats: DataFrame, block: int = 4096) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation of `chats` (conv_id, turn, role,
    text): faults of its turns and the cheapest edits that make its structure sound."""
    spark = chats.sparkSession
    scratch = Scratch(spark, "turn-repair")
    end = F.rtrim("text", F.lit(SPACES))
    told = _turns(chats).select("conv_id", "turn", "role", "digest", (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    turns = scratch.save(told.groupBy("conv_id", "turn", "role", "digest", "blank", "truncated").agg(F.count("*").alias("n")))
    first = scratch.save(turns.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first")))
    t, f = turns.alias("t"), first.hint("merge").alias("f")
    seen = ~same(F.col("t.turn"), F.col("f.first.turn"))
    fault = F.when(F.col("t.blank"), "blank").when(seen, "duplicate").when(F.col("t.truncated"), "truncated").otherwise("")
    known = t.join(f, same(F.col("t.conv_id"), F.col("f.conv_id")) & (F.col("t.role") == F.col("f.role")) & (F.col("t.digest") == F.col("f.digest"))).select("t.conv_id", "t.turn", "t.role", "t.digest", "t.n", fault.alias("fault"))
    judged = scratch.save(known)  # a range partitioning reads its input twice
    order = ("conv_id", "turn", "role", "digest")
    ranged = judged.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order)
    parts = scratch.save(ranged.select(F.spark_partition_id().alias("part"), "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "n", "fault").mapInArrow(_scan(block), _PART))
    whole: list[DataFrame] = []
    while True:
        own = Window.partitionBy("conv_id")
        numbered = scratch.save(parts.withColumns({"k": F.row_number().over(own.orderBy("part", "number")) - 1, "of": F.count("*").over(own)}))
        whole.append(numbered.where("of = 1").select(parts.columns))
        several = numbered.where("of > 1")
        if not several.limit(1).count():
            break
        group = F.floor(F.col("k") / FAN)
        parts = scratch.save(several.withColumn("group", group).repartition("conv_id", "group").sortWithinPartitions("conv_id", "k").mapInArrow(_merge, _PART))
    every = whole[0]
    for more in whole[1:]:
        every = every.unionByName(more)
    return scratch.finish(every.mapInArrow(_settle, _EDITS))


_REPAIRED = "conv_id long, place long, turn long, role string, text string, edit string"
_REPAIRED_KINDS = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())])


class _Editor:
    """Applies an audit to the turns of a conversation, one after another."""

    def __init__(self, conv_id: int | None, audit: str):
        self.conv_id, self.audit, self.at, self.place, self.before = conv_id, audit, 0, 0, ""

    def _said(self, edit: str, turn: int | None, role: str | None, text: str) -> dict:
        role = ("assistant" if self.before == "u" else "user") if role is None else role
        self.before = role[:1]
        self.place += 1
        return {"conv_id": self.conv_id, "place": self.place - 1, "turn": turn, "role": role, "text": text, "edit": edit}

    def inserts(self) -> Iterator[dict]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self._said("I", None, None, "")

    def edit(self, turn: int | None, role: str, text: str) -> Iterator[dict]:
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            yield self._said(letter, turn, role if letter == "K" else None, text)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's audit comes first, then its turns in order."""
    now, out, chars = None, [], 0

    def full() -> bool:
        return len(out) >= 5000 or chars >= 1 << 22

    for b in batches:
        for kind, conv_id, turn, role, text in zip(*(b.column(c).to_pylist() for c in ("kind", "conv_id", "turn", "role", "text")), strict=True):
            if kind:
                out += now.edit(turn, role, text)
                chars += len(text)
            else:
                out += now.inserts() if now else []
                now = _Editor(conv_id, text)
            if full():
                yield pa.RecordBatch.from_pylist(out, _REPAIRED_KINDS)
                out, chars = [], 0
    out += now.inserts() if now else []
    if out:
        yield pa.RecordBatch.from_pylist(out, _REPAIRED_KINDS)


def repaired_turns(chats: DataFrame, edits: DataFrame) -> DataFrame:
    """conv_id, place, turn, role, text, edit of the turns that `edits` (of conversation_edits) leaves or inserts: each
    conversation in one partition, in order. An inserted turn has no turn number."""
    told = edits.select(F.lit(0).alias("kind"), "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("digest"), F.col("audit").alias("text"))
    turns = _turns(chats).select(F.lit(1).alias("kind"), "conv_id", "turn", "role", "digest", "text")
    both = told.unionByName(turns).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return both.mapInArrow(_apply, _REPAIRED)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, sha, out = (), None, []
    for b in batches:
        for conv_id, role, text in zip(*(b.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
            if now != (conv_id,):
                if sha:
                    out.append((now[0], sha.hexdigest()))
                now, sha, joint = (conv_id,), hashlib.sha256(), ""
            sha.update(f"{joint}{role}:{text}".encode("utf-8", "surrogatepass"))
            joint = "\n"
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.string()), strict=True)], ["conv_id", "repaired_sha256"])
            out = []
    if sha:
        out.append((now[0], sha.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), (pa.int64(), pa.string()), strict=True)], ["conv_id", "repaired_sha256"])


def repaired_digests(repaired: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 (of role:text lines) of the conversations that repaired_turns left a turn of; narrow."""
    return repaired.mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def damaged(chats: DataFrame) -> DataFrame:
    """`chats` with faults put in by a checksum of conversation and turn: dropped, emptied, cut, repeated or relabelled turns."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    what = F.crc32(F.concat_ws(":", filled("conv_id"), filled("turn"))) % 20
    text = F.when(what == 1, "").when(what == 2, F.translate(filled("text"), ".!?", "")).otherwise(filled("text"))
    role = F.when(what == 4, "user").otherwise(filled("role"))
    times_ = F.when(what == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return chats.where(what != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times_).alias("copy")).drop("copy")


def repair_report(chats: DataFrame, before: DataFrame, block: int = 4096) -> DataFrame:
    """The edits and the repaired text's digest of each conversation of `before`, zeros and an empty audit where `chats`
    (what is left of them) has no turn."""
    edits = conversation_edits(chats, block)
    digests = repaired_digests(repaired_turns(chats, edits))
    ids = before.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().alias("i")
    e, d = edits.alias("e"), digests.alias("d")
    long = lambda c: F.coalesce(F.col(f"e.{c}"), F.lit(0)).cast("long").alias(c)
    joined = ids.join(e, same(F.col("i.conv_id"), F.col("e.conv_id")), "left").join(d, same(F.col("i.conv_id"), F.col("d.conv_id")), "left")
    return joined.select("i.conv_id", *map(long, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("e.audit", F.lit("")).alias("audit"), F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
