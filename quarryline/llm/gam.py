"""Quality classifier: a generalised additive model with pairwise interactions.

Features of the text alone are cut into quantile bins. Shallow trees (three leaves on one feature, four on a pair) are
boosted in turn over the features, cycle by cycle, and each adds its leaf values to its feature's lookup table; then the
pairs with the largest gain on what is left get tables the same way. A score is the sigmoid of a sum of table entries, so
scoring is vectorised bin lookups.

The fit uses at most about `max_rows` labelled rows (a documented bound: chosen by a hash of the id, so alike at every
size); everything else covers all documents.

Nulls: a null text is empty and gets a score; labels that are null are not learnt from; an id that has several labels is
learnt from once for each. Without two classes to learn from, every score is the base rate (0.5 without any label).
Repeated rows give a row each. Extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, free_name, giving_back, id_text
from .fertility import SPACES, SYMBOLS, repeated_window_words

FEATURES = ("log_words", "word_length", "symbols", "upper", "exclaims", "dup_lines", "distinct_words", "top_word", "punctuation", "digits", "line_words", "repeats", "capital_words", "short_words", "pipes", "byte_entropy")


def features(text: str | None) -> list[float]:
    """The measures of one text, all computed from the whole of it; zeros where it has nothing to measure."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, size = len(words), len(raw)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper, lower = int(seen[65:91].sum()), int(seen[97:123].sum())
    share = seen[seen > 0] / size
    lines = [x for x in raw.split(b"\n") if x.strip(SPACES)]
    counts = Counter(words)
    return [
        float(np.log1p(n)),
        (size - sum(int(seen[c]) for c in SPACES)) / n,
        sum(int(seen[c]) for c in SYMBOLS) / size,
        upper / max(1, upper + lower),
        int(seen[33]) / n,
        (len(lines) - len(set(lines))) / len(lines),
        len(counts) / n**0.8,
        counts.most_common(1)[0][1] / n,
        sum(int(seen[c]) for c in b".,;:") / n,
        int(seen[48:58].sum()) / size,
        float(np.log1p(n / len(lines))),
        repeated_window_words(words) / n,
        sum(w[:1].isupper() for w in words) / n,
        sum(len(w) <= 3 for w in words) / n,
        int(seen[124]) / n,
        float(-(share * np.log2(share)).sum()),
    ]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([features(t) for t in b.column("text").to_pylist()], pa.list_(pa.float32()))], ["doc_id", "f"])


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return id_text(docs, id_col, text_col).mapInArrow(giving_back(_extract), "doc_id long, f array<float>")


@dataclass
class Gam:
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)
    bias: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.bias)
        for j, (edge, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edge, x[:, j], "right")]
        coarse = {j: np.searchsorted(self.pair_edges[j], x[:, j], "right") for pair in self.pairs for j in pair}
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return 1 / (1 + np.exp(-total))


def _best_cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Gain and place of the best cut of a histogram of gradients and curvatures."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain[(left_h < 1e-3) | (right_h < 1e-3)] = 0
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def tree_1d(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Leaf values by bin of a tree that cuts one feature's histogram best-first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        gain, cut, k = max((*_best_cut(g[a:b], h[a:b], ridge), i) for i, (a, b) in enumerate(parts))
        if gain <= 1e-9:
            break
        a, b = parts[k]
        parts[k : k + 1] = [(a, a + cut), (a + cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def tree_2d(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and leaf values of a tree of two levels over a pair's grid."""

    def cut(block) -> tuple[float, int, int]:
        return max((*_best_cut(g[block].sum(1 - axis), h[block].sum(1 - axis), ridge), axis) for axis in (0, 1))

    def halves(block, at: int, axis: int):
        s = block[axis]
        lo, hi = list(block), list(block)
        lo[axis], hi[axis] = slice(s.start, s.start + at), slice(s.start + at, s.stop)
        return [tuple(lo), tuple(hi)]

    whole = (slice(0, g.shape[0]), slice(0, g.shape[1]))
    gain, at, axis = cut(whole)
    out, blocks = np.zeros(g.shape), []
    if gain <= 1e-9:
        return 0.0, out
    for half in halves(whole, at, axis):
        more, at2, axis2 = cut(half)
        gain += max(more, 0)
        blocks += halves(half, at2, axis2) if more > 1e-9 else [half]
    for block in blocks:
        out[block] = -g[block].sum() / (h[block].sum() + ridge)
    return gain, out


def fit_gam(x: np.ndarray, y: np.ndarray, bins: int = 24, pair_bins: int = 8, rounds: int = 120, pair_rounds: int = 60, n_pairs: int = 6, rate: float = 0.15, leaves: int = 3, ridge: float = 2.0) -> Gam:
    """Cyclic boosting on the logistic loss. x: rows by features; y: 0 or 1."""
    rows, width = x.shape
    share = float(y.mean()) if rows else 0.5
    if not rows or not 0 < share < 1:
        bias = 0.0 if not rows else (10.0 if share else -10.0)
        return Gam([np.zeros(0)] * width, [np.zeros(1)] * width, bias=bias)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    coarse = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, pair_bins + 1)[1:-1])) for j in range(width)]
    model = Gam(edges, [np.zeros(len(e) + 1) for e in edges], pair_edges=coarse, bias=float(np.log(share / (1 - share))))
    at = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    total = np.full(rows, model.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j in range(width):
            g, h = slopes()
            k = len(edges[j]) + 1
            step = rate * tree_1d(np.bincount(at[j], g, k), np.bincount(at[j], h, k), leaves, ridge)
            model.tables[j] += step
            total += step[at[j]]
    small = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        a, b = len(coarse[i]) + 1, len(coarse[j]) + 1
        return np.bincount(small[i] * b + small[j], values, a * b).reshape(a, b)

    g, h = slopes()
    ranked = sorted(((tree_2d(grid(i, j, g), grid(i, j, h), ridge)[0], i, j) for i in range(width) for j in range(i + 1, width)), reverse=True)
    model.pairs = [(i, j) for _, i, j in ranked[:n_pairs]]
    model.pair_tables = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in model.pairs]
    for _ in range(pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            g, h = slopes()
            step = rate * tree_2d(grid(i, j, g), grid(i, j, h), ridge)[1]
            model.pair_tables[k] += step
            total += step[small[i], small[j]]
    return model


def held_out(id_col: str = "doc_id"):
    """Rows that are never learnt from: crc32 of the id as text divides by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learnt_from(labels: DataFrame, max_rows: int = 60_000, label_col: str = "quality", id_col: str = "doc_id") -> DataFrame:
    """doc_id, y of the labels that are learnt from: about max_rows at most, chosen by a hash of the id."""
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    share = min(1.0, max_rows / max(1, known.count()))
    return known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int = 60_000, id_col: str = "doc_id") -> DataFrame:
    """The rows of docs that are learnt from. Their ids are broadcast: max_rows bounds them, at some 16 bytes each."""
    ids = F.broadcast(learnt_from(labels, max_rows, id_col=id_col).select("doc_id").distinct())
    return docs.join(ids.withColumnRenamed("doc_id", name := free_name("learnt_id", docs)), F.col(id_col).cast("long") == F.col(name), "left_semi")


def fit_quality(measured: DataFrame, labels: DataFrame, max_rows: int = 60_000, label_col: str = "quality", id_col: str = "doc_id") -> Gam:
    """The model for labels.quality from `measured` (doc_id, f), on at most about max_rows labelled ids.

    Of each id and label one row is learnt from, that of the smallest hash: rows that repeat an id neither weigh more nor
    reach the driver."""
    known = learnt_from(labels, max_rows, label_col, id_col).distinct()
    one = measured.join(known, "doc_id").groupBy("doc_id", "y").agg(F.min(F.struct(F.xxhash64("doc_id", "f").alias("at"), "f")).alias("row"))
    rows = one.select("row.f", "y", "row.at").toPandas().sort_values(["at", "y"])  # the fit doesn't depend on the order of arrival
    x = np.array(rows["f"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit_gam(x, rows["y"].to_numpy(np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_rows: int = 60_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of `docs`."""
    measured = Scratch(docs.sparkSession, "gam").save(text_features(docs, id_col, text_col))
    model = fit_quality(measured, labels, max_rows, id_col=id_col)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column("f").flatten()).reshape(-1, len(FEATURES)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    scored = measured.mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Gam, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose text scores at least the threshold: one narrow pass."""
    where = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([features(t) for t in b.column(where).to_pylist()], np.float32).astype(np.float64)
                yield b.filter(pa.array(model.score(x) >= threshold))

    return docs.mapInArrow(giving_back(keep), docs.schema)
