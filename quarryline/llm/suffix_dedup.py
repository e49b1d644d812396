"""Exact substring deduplication by hash-compared suffix sorting.

Every byte that a string of `length` bytes covers which also starts anywhere else, in any document, is removed; strings
are judged on the input.

1. Sampled suffixes. In each window of `length` bytes the gram of `gram` bytes with the smallest hash is the window's
   anchor (the leftmost of equals). Equal windows have equal anchors at equal offsets, so suffixes that start at anchors,
   about one in a hundred, stand for all. An anchor's windows are consecutive: they span a segment of the text.
2. Suffixes are dealt out by the anchor's gram. Segments with equal 128-bit digests (BLAKE2b) are one: all their windows
   repeat. Groups in which no other segment is left are done.
3. In what remains, the distinct segments of a gram are sorted as suffixes from the anchor on, and as reversed prefixes
   before it, by mergesort. A comparison finds the common extension of two suffixes by binary search over their prefix
   polynomial hashes, so it takes a logarithmic number of steps; the extensions of neighbours are verified byte by byte,
   and a group with a hash collision is sorted again on the bytes. At each offset, windows are equal where neither order
   has a shorter common extension between them.
4. A group of more than `most` distinct segments is dealt out further, by half of the bytes that its windows have beyond
   what they share: a window has that many either behind the shared bytes or before them. The parts are treated like the
   groups before: equal ones are one, the others are sorted or dealt out again. What is shared doubles towards the whole
   window, so this ends after a few rounds, for a passage in however many contexts.
5. The repeated windows of each document are united and cut out; what stays comes out with the spans that went. Both are
   bytes, as a repeat may begin or end inside a character.

Nulls: a null text is empty. Texts shorter than `length` lose nothing. Each row is a document: rows that repeat an id and
a text are copies, which lose every string that they share, rows of one id with different texts are told apart by a hash of
the text, and rows with a null id take part like others. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import mix, prefix_hash, range_hash, slices, texts_of
from .common import Scratch, deal, id_text

_BYTES = mix(np.arange(1, 257, dtype=np.uint64))
_PLACE = (1 << 24) - 1
#: Bytes of a document that are looked at together; more than that go in parts that overlap by one window.
_PART = 1 << 22


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest key of each `width` neighbours, by minima from both ends of blocks."""
    n = len(keys)
    pad = -n % width
    blocks = np.concatenate([keys, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])


def anchors(data: np.ndarray, length: int, gram: int, part: int = _PART) -> tuple[np.ndarray, ...]:
    """For each anchor of one text: gram hash, first window, anchor minus first window, windows minus one."""
    out: list[tuple[np.ndarray, ...]] = []
    for at in range(0, max(1, len(data) - length + 1), part):
        some = data[at : at + part + length - 1]
        if len(some) < length:
            break
        prefix = prefix_hash(_BYTES[some])
        start = np.arange(len(some) - gram + 1)
        grams = range_hash(prefix, start, start + gram)
        keys = (grams & ~np.uint64(_PLACE)) | start.astype(np.uint64)
        place = (sliding_argmin(keys, length - gram + 1) & np.uint64(_PLACE)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        last = np.append(first[1:], len(place)) - 1
        place = place[first]
        out.append((grams[place], first + at, place - first, last - first))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _digest(data) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)


def _sample(length: int, gram: int, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 22):
                ids, keys = piece.column("doc_id").to_numpy(), piece.column("text_key").to_numpy()
                offsets, data = texts_of(piece.column("text"))
                found, rows, digests = [], [], []
                for k in np.flatnonzero(np.diff(offsets) >= length).tolist():
                    raw = data[offsets[k] : offsets[k + 1]]
                    found.append(anchors(raw, length, gram, part))
                    rows.append(np.full(len(found[-1][0]), k))
                    view = memoryview(raw)
                    digests += [_digest(view[a : a + m + length]) for a, m in zip(found[-1][1].tolist(), found[-1][3].tolist(), strict=True)]
                if found:
                    g, first, before, more = (np.concatenate(c) for c in zip(*found, strict=True))
                    at = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(digests, pa.binary()), pa.array(ids[at]), pa.array(keys[at]), pa.array(first), pa.array(before.astype(np.int32)), pa.array(more.astype(np.int32))], ["gram", "segment", "doc_id", "text_key", "first", "before", "more"])

    return run


class SuffixOrder:
    """Suffixes in order, with the common extension of each and its predecessor."""

    def __init__(self, suffixes: list[bytes]):
        self.suffixes = suffixes
        self.prefixes = [mix(prefix_hash(_BYTES[np.frombuffer(s, np.uint8)])).tolist() for s in suffixes]
        self.order = sorted(range(len(suffixes)), key=cmp_to_key(self._compare))
        self.common = [0, *(self.extension(i, j) for i, j in zip(self.order, self.order[1:], strict=False))]
        if not all(suffixes[i][:n] == suffixes[j][:n] for i, j, n in zip(self.order, self.order[1:], self.common[1:], strict=False)):
            self.order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
            self.common = [0, *(_common_bytes(suffixes[i], suffixes[j]) for i, j in zip(self.order, self.order[1:], strict=False))]

    def extension(self, i: int, j: int) -> int:
        """Length of the longest common prefix, by binary search over the prefix hashes."""
        a, b = self.prefixes[i], self.prefixes[j]
        low, high = 0, min(len(a), len(b)) - 1
        while low < high:
            mid = (low + high + 1) // 2
            if a[mid] == b[mid]:
                low = mid
            else:
                high = mid - 1
        return low

    def _compare(self, i: int, j: int) -> int:
        n = self.extension(i, j)
        a, b = self.suffixes[i], self.suffixes[j]
        if n == len(a) or n == len(b):
            return len(a) - len(b)
        return a[n] - b[n]


def _common_bytes(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    other = np.flatnonzero(x != y)
    return int(other[0]) if len(other) else n


def repeated_windows(segments: list[bytes], before: list[int], more: list[int], copies: list[int], length: int) -> list[np.ndarray]:
    """For each segment with one copy: which of its windows (0 to more) are equal to a window of another segment.

    before: where the anchor stands in the segment; all segments have the same gram there.
    """
    m = len(segments)
    right = SuffixOrder([s[b:] for s, b in zip(segments, before, strict=True)])
    left = SuffixOrder([s[:b][::-1] for s, b in zip(segments, before, strict=True)])
    low = min(b - w for b, w in zip(before, more, strict=True))
    high = max(before)
    offsets = np.arange(low, high + 1)  # anchor minus window start
    b, w, n = np.array(before), np.array(more), np.array(copies)
    valid = (offsets[:, None] <= b) & (offsets[:, None] >= b - w)

    def classes(order: SuffixOrder, need: np.ndarray) -> np.ndarray:
        out = np.zeros((len(offsets), m), np.int64)
        out[:, order.order] = np.cumsum(np.array(order.common)[None, :] < need[:, None], axis=1)
        return out

    # A window whose start lies behind the anchor needs nothing before it, and its right part starts in the gram.
    key = (classes(right, length - offsets) * (m + 1) + classes(left, np.maximum(offsets, 0))) + np.arange(len(offsets))[:, None] * (m + 1) ** 2
    at = key[valid]
    _, which = np.unique(at, return_inverse=True)
    many = np.bincount(which, np.broadcast_to(n, valid.shape)[valid]) > 1
    repeated = np.zeros(valid.shape, bool)
    repeated[valid] = many[which]
    return [repeated[b[k] - w[k] - low : b[k] - low + 1, k][::-1] if n[k] == 1 else np.zeros(0, bool) for k in range(m)]


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values, ends excluded."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


#: A segment in a group of suffixes to be sorted: shared are the bytes around the anchor that the group has in common.
_OPEN = pa.schema([("gram", pa.int64()), ("level", pa.int32()), ("copies", pa.int64()), ("doc_id", pa.int64()), ("text_key", pa.int64()), ("first", pa.int64()), ("before", pa.int32()), ("more", pa.int32()), ("left", pa.int32()), ("right", pa.int32()), ("bytes", pa.binary())])
_OPEN_DDL = "gram long, level int, copies long, doc_id long, text_key long, first long, before int, more int, left int, right int, bytes binary"
_FIELDS = [f.name for f in _OPEN]


def _cut_out(length: int, gram: int):
    """Rows of documents with a list of wanted segments -> the segments with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in slices(batch, "text", 1 << 21):
                rows = []
                for doc, key, raw, wanted in zip(b.column("doc_id").to_pylist(), b.column("text_key").to_pylist(), b.column("text").cast(pa.large_binary()).to_pylist(), b.column("wanted").to_pylist(), strict=True):
                    rows += [(x["gram"], 0, x["copies"], doc, key, x["first"], x["before"], x["more"], 0, gram, raw[x["first"] : x["first"] + x["more"] + length]) for x in wanted]
                if rows:
                    yield _batch(rows, _OPEN)

    return run


def split_segment(before: int, more: int, left: int, right: int, length: int) -> list[tuple[int, int, int, int, int, int]]:
    """Parts of a segment whose windows all hold half of the bytes beyond the shared ones on one side: first window and
    windows minus one, then how many bytes left and right of the anchor the part's windows all hold, and which bytes (from,
    to, counted from the anchor) tell the parts of the same side apart."""
    rest = length - left - right
    half = (rest + 1) // 2
    # A window that begins o bytes before the anchor has length - o - right bytes behind the shared ones.
    edge = before - (length - right - half)  # windows from this number on have at least half of them there
    out = []
    low = max(0, edge)
    if low <= more:
        out.append((low, more - low, left, right + half, right, right + half))
    if edge > 0:  # the others have all but half - 1 of them before the shared ones
        further = left + rest - half + 1
        out.append((0, min(more, edge - 1), further, right, -further, -left))
    return out


def _refine(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([*_OPEN, pa.field("segment", pa.binary())])
        for b in batches:
            rows = []
            for x in b.to_pylist():
                raw, before = x["bytes"], x["before"]
                for low, more, left, right, a, z in split_segment(before, x["more"], x["left"], x["right"], length):
                    told = _digest(f"{x['gram']} {left} {right} ".encode() + raw[before + a : before + z])
                    part = raw[low : low + more + length]
                    rows.append((int.from_bytes(told[:8], "little", signed=True), x["level"] + 1, x["copies"], x["doc_id"], x["text_key"], x["first"] + low, before - low, more, left, right, part, _digest(part)))
            if rows:
                yield _batch(rows, schema)

    return run


def _sort_groups(length: int):
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "text_key", "start", "end")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, held = None, []

        def settle() -> list[tuple[int, int, int, int]]:
            out = []
            if len(held) > 1:
                found = repeated_windows([r[5] for r in held], [r[3] for r in held], [r[4] for r in held], [r[6] for r in held], length)
                for (doc, key, first, *_), mask in zip(held, found, strict=True):
                    out += [(doc, key, first + a, first + b - 1 + length) for a, b in _runs(mask)]
            return out

        done: list[tuple[int, int, int, int]] = []
        for b in batches:
            for *g, doc, key, first, before, more, raw, copies in zip(*(b.column(c).to_pylist() for c in ("gram", "level", "doc_id", "text_key", "first", "before", "more", "bytes", "copies")), strict=True):
                if g != gram:
                    done += settle()
                    gram, held = g, []
                held.append((doc, key, first, before, more, raw, copies))
            if len(done) > 10_000:
                yield _batch(done, schema)
                done = []
        done += settle()
        if done:
            yield _batch(done, schema)

    return run


_KINDS = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for b in slices(batch, "text", 1 << 22):
            rows = []
            for doc, text, spans in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                raw = (text or "").encode("utf-8", "surrogatepass")
                kept, removed, at = [], [], 0
                low = high = -1
                for x in [*sorted((s["start"], s["end"]) for s in spans or ()), (len(raw) + 1, 0)]:
                    if x[0] > high:
                        if high > low:
                            kept.append(raw[at:low])
                            removed.append({"start": low, "end": high})
                            at = high
                        low, high = x
                    else:
                        high = max(high, x[1])
                kept.append(raw[at:])
                rows.append((doc, len(raw), b"".join(kept), removed))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)], ["doc_id", "n_bytes", "kept", "removed"])


def remove_repeats(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the hash of the bytes that stay, for every row of docs; options as for deduplicate."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return deduplicate(docs, **options).select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def deduplicate(docs: DataFrame, length: int = 400, gram: int = 160, most: int = 2000, part: int = _PART, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, kept (the bytes that stay) and removed (spans of bytes of the text, ends excluded), for every row of docs."""
    if not 8 <= gram < length:
        raise ValueError("gram must be at least 8 and under length")
    scratch = Scratch(docs.sparkSession, "repeats")
    no_id = F.lit(-(2**63))
    texts = id_text(docs, id_col, text_col).select(F.coalesce("doc_id", no_id).alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    known = texts.where(F.octet_length("text") >= length)
    sampled = scratch.save(known.mapInArrow(_sample(length, gram, part), "gram long, segment binary, doc_id long, text_key long, first long, before int, more int"))
    grams = scratch.save(sampled.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    shared = scratch.save(sampled.join(grams.hint("merge"), "gram"))
    scratch.drop(sampled, grams)

    same = ["gram", "segment", "before", "more"]
    span = ["doc_id", "text_key", F.col("first").alias("start"), (F.col("first") + F.col("more") + length).alias("end")]
    one = F.min(F.struct("doc_id", "text_key", "first")).alias("one")
    segments = scratch.save(shared.groupBy(*same).agg(F.count("*").alias("copies"), one))
    twice = scratch.save(segments.where("copies > 1").select(*same))
    # Written before they are joined, so that Spark can split a segment that very many rows share.
    spans = [scratch.save(shared.join(twice.hint("merge"), same).select(*span))]
    scratch.drop(shared, twice)
    sizes = scratch.save(segments.groupBy("gram").agg(F.count("*").alias("m"), F.min("copies").alias("least")).where("m > 1 AND least = 1").select("gram", (F.col("m") > most).alias("large")))
    wanted = segments.join(sizes.hint("merge"), "gram").groupBy("one.doc_id", "one.text_key").agg(F.collect_list(F.struct("gram", "copies", "one.first", "before", "more")).alias("wanted"))
    wanted = scratch.save(wanted)
    scratch.drop(segments)
    cut = scratch.save(known.join(wanted.hint("merge"), ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"]).mapInArrow(_cut_out(length, gram), _OPEN_DDL))
    scratch.drop(wanted)
    cut_of_level, sizes_of_level = cut, sizes
    while True:
        placed = cut_of_level.join(sizes_of_level.hint("merge"), "gram")
        to_sort = deal(placed.where("NOT large").select(*_FIELDS), "gram", "level").sortWithinPartitions("gram", "level")
        spans.append(scratch.save(to_sort.mapInArrow(_sort_groups(length), "doc_id long, text_key long, start long, end long")))
        if not sizes_of_level.where("large").limit(1).count():
            break
        parts = scratch.save(placed.where("large").select(*_FIELDS).mapInArrow(_refine(length), _OPEN_DDL + ", segment binary"))
        scratch.drop(cut_of_level, sizes_of_level)
        # Copies of a part: what stands for several segments already counts as two.
        found = scratch.save(parts.groupBy(*same).agg(F.sum(F.least("copies", F.lit(2))).alias("copies"), one))
        twice = scratch.save(found.where("copies > 1").select(*same))
        spans.append(scratch.save(parts.where("copies = 1").join(twice.hint("merge"), same).select(*span)))
        sizes_of_level = scratch.save(found.groupBy("gram").agg(F.count("*").alias("m"), F.min("copies").alias("least")).where("m > 1 AND least = 1").select("gram", (F.col("m") > most).alias("large")))
        left = found.join(sizes_of_level.hint("merge"), "gram").select(*same, F.col("copies").alias("n"), "one.doc_id", "one.text_key", "one.first")
        cut_of_level = scratch.save(parts.join(left.hint("merge"), [*same, "doc_id", "text_key", "first"]).withColumn("copies", F.col("n")).select(*_FIELDS))
        scratch.drop(parts, found, twice)
    every = spans[0]
    for more in spans[1:]:
        every = every.unionByName(more)
    gone = scratch.save(every.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    scratch.drop(*spans)
    out = texts.join(gone.hint("merge"), ["doc_id", "text_key"], "left").select("doc_id", "text", "spans").mapInArrow(_remove, "doc_id long, n_bytes long, kept binary, removed array<struct<start:long,end:long>>")
    return out.withColumn("doc_id", F.nullif("doc_id", no_id))
