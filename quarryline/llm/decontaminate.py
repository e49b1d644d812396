"""Benchmark decontamination by latent semantic retrieval.

1. One pass over all documents cuts them into passages and gathers, for every term (a hashed word), its passage frequency
   and its row of D'D X, where D holds the passages' term counts over the square root of their length and X is a random
   test matrix. Scaled by the inverse passage frequencies W, that is A'A Y with A = DW, the TF-IDF passages, and
   Y = X / W: the single-pass randomised (Nystrom) decomposition of A'A gives the singular values and right vectors.
   Tasks send partial sums of a fixed size, which are added up in a shuffle; the driver gets terms x columns numbers.
2. A second pass embeds sliding windows of each text (sums of term vectors over blocks) and the benchmark items, which are
   a stated query set handled in blocks, and takes window-item pairs whose cosine reaches `min_cosine`.
3. Beside it stands an exact path, so that nothing hangs on the latent space: a match within a span of twice the item's
   length needs a fixed number of the item's rarest words there, so the places of these words give every such span. Items
   under `min_words` words are looked for verbatim.
4. Candidates are verified on the words themselves: an upper bound on the common words first, then the longest common
   subsequence of item and span over the item's length, and the answer check: the share of the item's rarest words that
   the span holds. Paraphrases that keep order and most words, and lose little of the rare ones, pass.

Nothing of a text leaves its task but verified matches, so no key can be hot.

The query set is searched in blocks of a bounded size, however many items it has.

Nulls: null or empty texts match nothing; null items and items without words are not searched for, an item with a null id is
reported as -1; items with equal texts are each reported; repeated documents each give their rows. Empty tables give an empty
result. Extra columns of either table are not read.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import LETTERS, prefix_hash, range_hash, slices, texts_of, words_of
from .common import giving_back, id_text

SCHEMA = "doc_id long, item_id long, cosine double, lcs_share double, answer_share double, first_word long, last_word long"
_COLUMNS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()), ("answer_share", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])
#: Window widths in words (four blocks, each twice as wide as the last), for items of so many words. A window moves on by
#: a quarter of its width.
WIDTHS = ((16, 0, 24), (32, 24, 48), (64, 48, 1 << 30))


@dataclass(frozen=True)
class Latent:
    """What the retrieval needs: a vector for each term, scaled to unit variance of the passages."""

    vectors: np.ndarray
    weights: np.ndarray
    singular: np.ndarray


def terms_of(hashes: np.ndarray, n_terms: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(n_terms)).astype(np.uint16 if n_terms <= 1 << 16 else np.int64)


#: Zero rows after each text's blocks, so that sums over neighbouring blocks need no test for the end of a text.
GAP = 3


@dataclass(frozen=True)
class Blocks:
    """Sums over blocks of `width` words of each text, in order, with GAP zero rows after each text."""

    width: int
    sums: np.ndarray
    counts: np.ndarray  # blocks of each text
    text: np.ndarray  # of each row
    within: np.ndarray  # number of the row's block in its text; from counts on it is a gap

    @property
    def real(self) -> np.ndarray:
        return self.within < self.counts[self.text]

    @staticmethod
    def layout(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        text = np.repeat(np.arange(len(counts)), counts + GAP)
        return text, np.arange(len(text)) - np.repeat(np.cumsum(counts + GAP) - counts - GAP, counts + GAP)


def first_blocks(table: np.ndarray, term: np.ndarray, before: np.ndarray, width: int = 4) -> Blocks:
    """Blocks of the table rows of the words' terms; the table's last row is zero."""
    counts = -(-np.diff(before) // width)
    text, within = Blocks.layout(counts)
    start, last = before[:-1][text] + within * width, before[1:][text]
    padded = np.append(term, term.dtype.type(len(table) - 1))
    sums = np.zeros((len(text), table.shape[1]), table.dtype)
    for q in range(width):
        at = start + q
        sums += table[padded[np.where(at < last, at, len(term))]]
    return Blocks(width, sums, counts, text, within)


def doubled(b: Blocks) -> Blocks:
    """Blocks of twice the width."""
    counts = -(-b.counts // 2)
    text, within = Blocks.layout(counts)
    at = (np.cumsum(b.counts + GAP) - b.counts - GAP)[text] + 2 * within
    real = within < counts[text]
    at[~real] = b.counts[0]  # a gap row
    sums = b.sums[at]
    sums += b.sums[np.where(real, at + 1, at)]
    return Blocks(2 * b.width, sums, counts, text, within)


def windows(b: Blocks) -> np.ndarray:
    """Unit sums of four blocks from each row on."""
    out = b.sums.copy()
    for q in range(1, GAP + 1):
        out[:-q] += b.sums[q:]
    out /= np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-12)[:, None]
    return out


def _test_matrix(n_terms: int, columns: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((n_terms, columns)).astype(np.float32)


def _gather(n_terms: int, columns: int, passage: int, seed: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = np.vstack([_test_matrix(n_terms, columns, seed), np.zeros((1, columns), np.float32)])
        total = np.zeros((n_terms, columns + 1))
        passages = 0
        for batch in batches:
            for piece in slices(batch, "text"):
                _, _, hashes, before = words_of(*texts_of(piece.column("text")), LETTERS)
                if not len(hashes):
                    continue
                term = terms_of(hashes, n_terms)
                sums = first_blocks(x, term, before)
                while sums.width < passage:
                    sums = doubled(sums)
                real = sums.real
                size = np.minimum(np.diff(before)[sums.text[real]] - sums.within[real] * passage, passage)
                y = np.ascontiguousarray((sums.sums[real] / size[:, None].astype(np.float32)).T)
                owner = np.repeat(np.arange(len(size)), size)
                for c in range(columns):
                    total[:, c] += np.bincount(term, y[c][owner], n_terms)
                order = np.argsort(term, kind="stable")
                term, owner = term[order], owner[order]
                fresh = np.concatenate([[True], (term[1:] != term[:-1]) | (owner[1:] != owner[:-1])])
                total[:, -1] += np.bincount(term[fresh], minlength=n_terms)
                passages += len(size)
        if passages:
            for k, part in enumerate(np.array_split(total, parts)):
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary()), pa.array([passages], pa.int64())], ["part", "sums", "passages"])

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by part, one of them held for each part of this task."""
    held: dict[int, list] = {}
    for b in batches:
        for k, raw, n in zip(b.column("part").to_pylist(), b.column("sums").to_pylist(), b.column("passages").to_pylist(), strict=True):
            values = np.frombuffer(raw)
            if k in held:
                held[k][0] = held[k][0] + values
                held[k][1] += n
            else:
                held[k] = [values, n]
    for k, (values, n) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([values.tobytes()], pa.binary()), pa.array([n], pa.int64())], ["part", "sums", "passages"])


def fit_latent(docs: DataFrame, n_terms: int = 8192, rank: int = 32, extra: int = 8, passage: int = 32, seed: int = 11, parts: int = 16) -> Latent:
    """The latent space of all documents' passages."""
    columns = rank + extra
    schema = "part int, sums binary, passages long"
    partial = id_text(docs).mapInArrow(giving_back(_gather(n_terms, columns, passage, seed, parts)), schema)
    rows = sorted(partial.repartition(parts, "part").mapInArrow(_add_up, schema).collect())
    if not rows:
        return Latent(np.zeros((n_terms, rank), np.float32), np.ones(n_terms, np.float32), np.zeros(rank))
    total = np.concatenate([np.frombuffer(r["sums"]).reshape(-1, columns + 1) for r in rows])
    weights = np.log((rows[0]["passages"] + 1) / (total[:, -1] + 1)) + 0.1
    y = _test_matrix(n_terms, columns, seed) / weights[:, None]
    scale = np.linalg.norm(y, axis=0)
    b = total[:, :-1] * weights[:, None] / scale  # A'A applied to the scaled test matrix
    y = y / scale
    shift = 1e-9 * np.linalg.norm(b)
    core = y.T @ b + shift * (y.T @ y)
    values, axes = np.linalg.eigh((core + core.T) / 2)
    keep = values > 1e-12 * max(values.max(), 1e-300)
    u, s, _ = np.linalg.svd((b + shift * y) @ (axes[:, keep] / np.sqrt(values[keep])), full_matrices=False)
    singular = np.sqrt(np.maximum(s[:rank] ** 2 - shift, 0))
    good = singular > 1e-6 * max(singular.max(initial=0), 1e-300)
    u, singular = u[:, :rank][:, good], singular[good]
    return Latent((weights[:, None] * u / singular).astype(np.float32), weights.astype(np.float32), singular)


def lcs_length(masks: dict, length: int, other: list) -> int:
    """Longest common subsequence with the sequence of `length` whose words' places are in masks, bit-parallel."""
    full = (1 << length) - 1
    v = full
    for w in other:
        if m := masks.get(w):
            u = v & m
            v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


class ItemIndex:
    """The benchmark items: latent vectors, word sets and rare words."""

    def __init__(self, items: list[tuple[int, str]], latent: Latent, min_words: int, answer_part: float):
        texts = pa.array([t for _, t in items], pa.string())
        _, _, hashes, before = words_of(*texts_of(texts), LETTERS)
        n_terms = len(latent.weights)
        chosen = [k for k in range(len(items)) if before[k + 1] > before[k]]
        self.min_words = min_words
        self.ids = [items[k][0] for k in chosen]
        words = [hashes[before[k] : before[k + 1]] for k in chosen]
        self.words = [w.tolist() for w in words]
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.masks, self.answers = [], []
        for w in words:
            places: dict = defaultdict(int)
            for i, x in enumerate(w.tolist()):
                places[x] |= 1 << i
            self.masks.append(dict(places))
            rare = sorted(set(w.tolist()), key=lambda x: (-latent.weights[int(terms_of(np.array([x], np.uint64), n_terms)[0])], x))
            self.answers.append(frozenset(rare[: max(3, round(answer_part * len(rare)))]))
        vectors = np.array([latent.vectors[terms_of(w, n_terms)].sum(0) for w in words], np.float32).reshape(len(words), latent.vectors.shape[1])
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        self.vocabulary = np.unique(np.concatenate(words)) if words else np.zeros(0, np.uint64)
        pairs = [np.searchsorted(self.vocabulary, np.unique(w)) * len(words) + k for k, w in enumerate(words)]
        self.pairs = np.sort(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.ids)

    def has(self, words: np.ndarray, items: np.ndarray) -> np.ndarray:
        """Whether each word (number in the vocabulary; its length stands for any other word) is in the item beside it."""
        wanted = words * len(self.ids) + items
        return self.pairs[np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)] == wanted

    def needed(self, items: np.ndarray, min_lcs: float, min_answer: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words (numbers in the vocabulary, in order) with the item (number in items) of each, and how many of them a match
        holds at least: answer words, or any words of the item where no answer words are asked for."""
        words, owners, least = [], [], []
        for k, item in enumerate(items.tolist()):
            asked = self.answers[item] if min_answer > 0 else self.masks[item].keys()
            words.append(np.searchsorted(self.vocabulary, np.array(list(asked), np.uint64)))
            owners.append(np.full(len(asked), k))
            least.append(next(c for c in range(1, len(asked) + 2) if c / len(asked) >= min_answer) if min_answer > 0 else max(1, int(np.ceil(min_lcs * self.sizes[item] - 1e-9))))
        word, owner = np.concatenate(words), np.concatenate(owners)
        order = np.argsort(word, kind="stable")
        return word[order], owner[order], np.array(least, np.int64)


def _starts(known: np.ndarray, ends: np.ndarray, begins: np.ndarray, word: np.ndarray, owner: np.ndarray, least: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, ...]:
    """Item (number in the block), first and last start of all spans of `width` words that hold `least` of its words.
    ends, begins: of each word's text."""
    low, high = np.searchsorted(word, known, "left"), np.searchsorted(word, known, "right")
    at = np.flatnonzero(high > low)
    many = (high - low)[at]
    place = np.repeat(at, many)
    item = owner[np.repeat(low[at] - np.cumsum(many) + many, many) + np.arange(len(place))]
    order = np.argsort(item, kind="stable")
    place, item = place[order], item[order]
    k = np.arange(len(place))
    to = k + least[item] - 1
    k, to = k[to < len(place)], to[to < len(place)]
    near = (item[k] == item[to]) & (ends[place[k]] == ends[place[to]]) & (place[to] - place[k] < width[item[k]])
    k, to = k[near], to[near]
    item, last = item[k], place[k]
    first = np.maximum(begins[last], place[to] - width[item] + 1)
    if not len(k):
        return item, first, last
    new = np.concatenate([[True], (item[1:] != item[:-1]) | (begins[last[1:]] != begins[last[:-1]]) | (first[1:] > last[:-1] + 1)])
    cut = np.flatnonzero(new)
    return item[cut], first[cut], last[np.append(cut[1:], len(new)) - 1]


def _best_span(hashes: np.ndarray, mine: np.ndarray, first: int, last: int, end: int, index: ItemIndex, item: int, min_lcs: float, min_answer: float) -> tuple[float, float, int] | None:
    """lcs share, answer share and start of the best span of twice the item's length that starts in first to last; mine
    tells which of the words from first on are the item's. A span may as well start at a word of the item."""
    size = int(index.sizes[item])
    place = np.flatnonzero(mine) + first
    if len(place) < min_lcs * size:
        return None
    words, place = hashes[place].tolist(), place
    if lcs_length(index.masks[item], size, words) < min_lcs * size:
        return None
    stop = np.searchsorted(place, np.minimum(place + 2 * size, end)).tolist()
    best = None
    for k in range(int(np.searchsorted(place, last, "right"))):
        span = words[k : stop[k]]
        if len(span) >= min_lcs * size and (answer := len(index.answers[item].intersection(span)) / len(index.answers[item])) >= min_answer:
            share = lcs_length(index.masks[item], size, span) / size
            if share >= min_lcs and (best is None or (share, answer) > best[:2]):
                best = (share, answer, int(place[k]))
                if share == answer == 1:
                    break
    return best


def find_by_words(hashes: np.ndarray, known: np.ndarray, before: np.ndarray, index: ItemIndex, min_lcs: float, min_answer: float, block_items: int = 512) -> list[tuple[int, int, float, float, int, int]]:
    """(text, item, lcs share, answer share, first, end) of all items with a span of twice their length that passes, and of
    short items that stand verbatim; first and end count in hashes."""
    text = np.repeat(np.arange(len(before) - 1), np.diff(before))
    begins, ends = before[:-1][text], before[1:][text]
    best: dict[tuple[int, int], tuple] = {}
    chosen = np.flatnonzero(index.sizes >= index.min_words)
    for k in range(0, len(chosen), block_items):
        items = chosen[k : k + block_items]
        size = index.sizes[items]
        for i, low, high in zip(*(v.tolist() for v in _starts(known, ends, begins, *index.needed(items, min_lcs, min_answer), 2 * size)), strict=True):
            item, n, end, doc = int(items[i]), int(size[i]), int(ends[low]), int(text[low])
            for first in range(low, high + 1, 2 * n):
                if best.get((doc, item), (0, 0))[:2] == (1, 1):
                    break
                last = min(high, first + 2 * n - 1)
                found = _best_span(hashes, index.has(known[first : min(last + 2 * n, end)], item), first, last, end, index, item, min_lcs, min_answer)
                if found and found[:2] > best.get((doc, item), (0, 0))[:2]:
                    best[doc, item] = (*found, min(found[2] + 2 * n, end))
    short = np.flatnonzero(index.sizes < index.min_words)
    rolling = prefix_hash(hashes) if len(short) else None
    for n in np.unique(index.sizes[short]).tolist():
        start = np.flatnonzero(np.arange(len(hashes)) + n <= ends)
        window = range_hash(rolling, start, start + n)
        wanted: dict[int, list[int]] = defaultdict(list)
        for item in short[index.sizes[short] == n].tolist():
            wanted[int(range_hash(prefix_hash(np.array(index.words[item], np.uint64)), np.array([0]), np.array([n]))[0])].append(item)
        for k in np.flatnonzero(np.isin(window, np.array(list(wanted), np.uint64))).tolist():
            at = int(start[k])
            for item in wanted[int(window[k])]:
                if hashes[at : at + n].tolist() == index.words[item]:
                    best.setdefault((int(text[at]), item), (1.0, 1.0, at, at + n))
    return [(doc, item, *found) for (doc, item), found in best.items()]


def find_leaks(texts: pa.Array, latent: Latent, index: ItemIndex, min_cosine: float, min_lcs: float, min_answer: float, block_items: int = 512) -> list[tuple[int, int, float, float, float, int, int]]:
    """(text, item, cosine, lcs share, answer share, first word, last word) of the verified matches, one for each pair."""
    _, _, hashes, before = words_of(*texts_of(texts), LETTERS)
    if not len(hashes) or not len(index):
        return []
    at = np.minimum(np.searchsorted(index.vocabulary, hashes), len(index.vocabulary) - 1)
    known = np.where(index.vocabulary[at] == hashes, at, len(index.vocabulary))
    table = np.vstack([latent.vectors, np.zeros((1, latent.vectors.shape[1]), np.float32)])
    term = terms_of(hashes, len(latent.weights))
    blocks = first_blocks(table, term, before)
    best: dict[tuple[int, int], tuple] = {}
    for width, low, high in WIDTHS:
        while 4 * blocks.width < width:
            blocks = doubled(blocks)
        chosen = np.flatnonzero((index.sizes >= max(low, index.min_words)) & (index.sizes < high))
        if not len(chosen):
            continue
        window, real = windows(blocks), blocks.real
        text, starts = blocks.text, before[:-1][blocks.text] + blocks.within * blocks.width
        for k in range(0, len(chosen), block_items):
            items = chosen[k : k + block_items]
            cosine = window @ index.vectors[items].T
            w, i = np.nonzero(cosine >= min_cosine)
            w, i = w[real[w]], i[real[w]]
            if not len(w):
                continue
            similar, item = cosine[w, i], items[i]
            first = starts[w]
            # An upper bound of the subsequence: the window's words that the item has, which must be a good part of the
            # smaller of window and item. A quarter's shift can lose a quarter of them.
            common = np.zeros(len(w), np.int32)
            last_of = before[1:][text[w]]
            for step in range(width):
                where = first + step
                inside = where < last_of
                common += index.has(np.where(inside, known[np.minimum(where, len(known) - 1)], len(index.vocabulary)), item)
            hopeful = common >= 0.75 * min_lcs * np.minimum(width, index.sizes[item])
            for doc, it, start, cos in zip(text[w[hopeful]].tolist(), item[hopeful].tolist(), first[hopeful].tolist(), similar[hopeful].tolist(), strict=True):
                size = int(index.sizes[it])
                a = max(int(before[doc]), start - max(size, width) // 2)
                b = min(int(before[doc + 1]), start + width + max(size - width, 0) + size // 2)
                span = hashes[a:b].tolist()
                share = lcs_length(index.masks[it], size, span) / size
                answer = len(index.answers[it].intersection(span)) / len(index.answers[it])
                if share >= min_lcs and answer >= min_answer:
                    found = (share, cos, answer, a - int(before[doc]), b - int(before[doc]))
                    if found > best.get((doc, it), (0,)):
                        best[doc, it] = found
    for doc, it, share, answer, a, b in find_by_words(hashes, known, before, index, min_lcs, min_answer, block_items):
        vector = table[term[a:b]].sum(0)
        cos = float(vector @ index.vectors[it] / max(np.linalg.norm(vector), 1e-12))
        found = (share, cos, answer, a - int(before[doc]), b - int(before[doc]))
        if found > best.get((doc, it), (0,)):
            best[doc, it] = found
    return [(doc, it, cos, share, answer, a, b) for (doc, it), (share, cos, answer, a, b) in sorted(best.items())]


def benchmark_items(benchmark: DataFrame, block_items: int = 50_000, block_bytes: int = 1 << 26) -> Iterator[list[tuple[int, str]]]:
    """The query set in blocks of about block_items items and block_bytes of text at most, as every task holds one whole.
    A null id becomes -1."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-size // block_bytes))
    for k in range(blocks):
        some = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        yield sorted((r[0] if r[0] is not None else -1, r[1]) for r in some)


@dataclass(frozen=True)
class Decontaminator:
    """A fitted search: `matches` reports, `keep_clean` filters."""

    latent: Latent
    items: list[tuple[int, str]]
    min_cosine: float = 0.63
    min_lcs: float = 0.55
    min_answer: float = 0.5
    min_words: int = 8
    answer_part: float = 0.34

    def _search(self):
        index = ItemIndex(self.items, self.latent, self.min_words, self.answer_part)
        return index, lambda texts: find_leaks(texts, self.latent, index, self.min_cosine, self.min_lcs, self.min_answer)

    def matches(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, search = self._search()
            for batch in batches:
                for piece in slices(batch, "text"):
                    ids = piece.column("doc_id").to_pylist()
                    rows = [(ids[d], index.ids[i], *rest) for d, i, *rest in search(piece.column("text"))]
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _COLUMNS.types, strict=True)], schema=_COLUMNS)

        return id_text(docs, id_col, text_col).mapInArrow(giving_back(run), SCHEMA)

    def keep_clean(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """The rows of docs, all columns, in which no item is found."""
        where, names = docs.columns.index(text_col), docs.columns

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            _, search = self._search()
            for batch in batches:
                if batch.num_rows:
                    batch = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
                    for piece in slices(batch, f"c{where}"):
                        found = {d for d, *_ in search(piece.column(where))}
                        yield piece.filter(pa.array([k not in found for k in range(piece.num_rows)])).rename_columns(names)

        return docs.mapInArrow(giving_back(run), docs.schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Verified matches of benchmark items in documents; one pass over the documents for each block of items."""
    latent = fit_latent(docs)
    found = [Decontaminator(latent, items, **options).matches(docs) for items in benchmark_items(benchmark)]
    return functools.reduce(DataFrame.unionByName, found)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, all columns, in which no item is found."""
    latent = fit_latent(docs.select(F.lit(0).alias("doc_id"), F.col(text_col).alias("text")))
    for items in benchmark_items(benchmark):
        docs = Decontaminator(latent, items, **options).keep_clean(docs, text_col)
    return docs
