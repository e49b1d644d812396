"""Hierarchical multi-length packing.

Every document is its token ids and an end id. Lengths are routed to tiers, which are powers of two up to the longest
window. A document longer than the window is first cut into whole windows; the rest of it, like any short document,
goes to the smallest tier that holds it. Tiers are packed from the longest down: a window takes one document of its tier,
the longest first, and its gap is filled from shorter tiers in order of arrival, longest tier first, at last by the head of
a shorter document, which is cut there: no padding, at the price of about one cut for each window. What is left when the input ends forms windows whose sizes are powers of two. Windows are dealt to step groups
so that each group has the same mix of sizes.

The unit of work is a buffer of at most `buffer_docs` documents or `buffer_tokens` ids of one input partition, so memory
is bounded and nothing is shuffled. A window is padded to the longest size unless its length is a power of two.

Nulls: a null text is empty, so the document is its end id alone. Repeated rows and equal ids each lie in pieces of their
own. Rows come out as they are packed, with the ids of their piece: those of a sequence, by offset, are its content; sequence ids hold the partition number in their upper bits.
"""

from __future__ import annotations

import heapq
import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import giving_back, id_text
from .vocab import vocabulary

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, tier long, step_group long, ids array<int>"
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def tiers_of(max_len: int, shortest: int = 64) -> list[int]:
    """Powers of two from `shortest` to max_len, longest first."""
    out = []
    while max_len >= shortest:
        out.append(max_len)
        max_len //= 2
    return out


def pack(lengths: list[int], max_len: int = 2048, shortest: int = 64) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of (document, start, length). Every id of every document lies in exactly one of them.

    Cuts are made only where a document is longer than the window, where a gap is filled, and among the pieces left when
    no shorter tier has any more: those stand one after another, the last windows in sizes that are powers of two.
    """
    tiers = tiers_of(max_len, shortest)
    waiting: dict[int, deque] = {t: deque() for t in tiers}
    windows: list[list[tuple[int, int, int]]] = []
    last: list[tuple[int, int, int]] = []

    def tier(n: int) -> int:
        return next((t for t in reversed(tiers) if n <= t), max_len)

    for doc, n in enumerate(lengths):
        whole = n // max_len
        windows += [[(doc, k * max_len, max_len)] for k in range(whole)]
        if rest := n - whole * max_len:
            waiting[tier(rest)].append((doc, whole * max_len, rest))
    for i, size in enumerate(tiers):
        pool = sorted(waiting[size], key=lambda p: (-p[2], p[0]))
        waiting[size].clear()
        for piece in pool:
            window, gap = [piece], size - piece[2]
            for shorter in tiers[i + 1 :]:  # whole documents of shorter tiers first
                queue = waiting[shorter]
                while queue and gap >= queue[0][2]:
                    window.append(queue.popleft())
                    gap -= window[-1][2]
                if not gap:
                    break
            if gap and (queue := next((waiting[t] for t in tiers[i + 1 :] if waiting[t]), None)):
                doc, start, n = queue.popleft()  # it doesn't fit whole: its head fills the gap, the rest goes to its new tier
                window.append((doc, start, gap))
                waiting[tier(n - gap)].append((doc, start + gap, n - gap))
                gap = 0
            if gap:  # nothing shorter is left
                last += window
            else:
                windows.append(window)
    return windows + _windows(last, max_len)


def _windows(pieces: list[tuple[int, int, int]], max_len: int) -> list[list[tuple[int, int, int]]]:
    """The pieces one after another in whole windows, and in windows of the powers of two in what is left."""
    total = sum(p[2] for p in pieces)
    rest = total % max_len
    sizes = [max_len] * (total // max_len) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    out, todo = [], deque(pieces)
    for size in sizes:
        window = []
        while size:
            doc, start, n = todo.popleft()
            window.append((doc, start, min(n, size)))
            if n > size:
                todo.appendleft((doc, start + size, n - size))
            size -= min(n, size)
        out.append(window)
    return out


def step_groups(sizes: list[int], group_tokens: int) -> list[int]:
    """A group for each window: the longest first, each to the group with the fewest ids so far."""
    groups = max(1, round(sum(sizes) / group_tokens))
    heap = [(0, g) for g in range(groups)]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        load, g = heapq.heappop(heap)
        out[i] = g
        heapq.heappush(heap, (load + sizes[i], g))
    return out


def _packer(tokenizer: str, folder: str | None, end_id: int, max_len: int, shortest: int, group_tokens: int, buffer_docs: int, buffer_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab = vocabulary("word", tokenizer, folder)
        part = TaskContext.get().partitionId() << 36
        made = groups_made = 0
        docs: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, groups_made, docs, ids, held
            rows: list[tuple] = []
            content: list[np.ndarray] = []
            windows = pack([len(x) for x in ids], max_len, shortest)
            sizes = [sum(p[2] for p in w) for w in windows]
            groups = step_groups(sizes, group_tokens)
            for window, size, group in zip(windows, sizes, groups, strict=True):
                offset = 0
                for doc, start, n in window:
                    content.append(ids[doc][start : start + n].view("<i4"))
                    rows.append((docs[doc], start, n, zlib.crc32(content[-1].tobytes()), len(ids[doc]), part + made, offset, size, min(max_len, 1 << (size - 1).bit_length()), part + groups_made + group))
                    offset += n
                made += 1
            groups_made += 1 + max(groups, default=-1)
            docs, ids, held = [], [], 0
            ends = np.concatenate([[0], np.cumsum([len(x) for x in content], dtype=np.int64)]).astype(np.int32)
            packed = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(content) if content else np.zeros(0, np.int32)))
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else [[]] * (len(_NAMES) - 1))), packed], _NAMES)

        for b in batches:
            texts = [t or "" for t in b.column("text").to_pylist()]
            for k in range(0, len(texts), 256):
                for doc, x in zip(b.column("doc_id")[k : k + 256].to_pylist(), vocab.ids_of(texts[k : k + 256]), strict=True):
                    docs.append(doc)
                    ids.append(np.append(x, end_id).astype("<u4"))
                    held += len(x) + 1
                    if len(docs) >= buffer_docs or held >= buffer_tokens:
                        yield flush()
        if docs:
            yield flush()

    return run


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", tokenizer_dir: str | None = None, end_id: int = 1, max_len: int = 2048, shortest_tier: int = 64, group_tokens: int = 2048 * 64, buffer_docs: int = 20_000, buffer_tokens: int = 8_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece of a document, with its place in its window (`sequence_id`, `offset`) and its token ids."""
    return id_text(docs, id_col, text_col).mapInArrow(giving_back(_packer(tokenizer, tokenizer_dir, end_id, max_len, shortest_tier, group_tokens, buffer_docs, buffer_tokens)), SCHEMA)
