"""Quality rules on tokeniser fertility.

Two public vocabularies are run over each whole text: one of pieces with byte fallback, and one of bytes for many
languages. Four measures come out: characters per token of either, the share of the first one's tokens that stand for a
single byte (characters that it lacks, and line ends), and the entropy of its tokens in bits. A text is kept if each
measure lies within the band of its language or script: the bands differ because a vocabulary spends more tokens on
scripts and languages that it saw less of. The script is that of most of a text's letters, by code point; the language of
Latin texts is told by function words. The entropy floor rises with the number of tokens, as the entropy of any sample
does; bands hold from their least number of tokens on.

Base counts (words, symbols, repeated lines and windows) are taken beside them, and a text that fails these is rejected
whatever its fertility.

Nulls: a null text has no words and fails the base rule, like an empty one. Repeated rows and equal ids give a row each.
Very long texts are taken whole, a document at a time.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bytewords import slices
from .common import id_text
from .vocab import vocabulary

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Band:
    """Limits of kept texts of at least `tokens` tokens: least and most characters per token of the two vocabularies, most
    byte share, and points (tokens, least bits of entropy), linear in the logarithm of the tokens between them."""

    piece: tuple[float, float]
    rank: tuple[float, float]
    byte_share: float
    entropy: tuple[tuple[int, float], ...]
    tokens: int = 100

    def least_entropy(self, tokens: int) -> float:
        if tokens < self.entropy[0][0]:
            return 0.0
        return float(np.interp(np.log2(tokens), [np.log2(n) for n, _ in self.entropy], [h for _, h in self.entropy]))

    def keeps(self, tokens: int, piece: float, rank: float, byte_share: float, entropy: float) -> bool:
        within = tokens < self.tokens or (self.piece[0] <= piece <= self.piece[1] and self.rank[0] <= rank <= self.rank[1] and byte_share <= self.byte_share)
        return within and entropy >= self.least_entropy(tokens)


_FLOOR = ((60, 4.45), (100, 5.15), (300, 5.9), (1000, 6.32), (4000, 6.45))
_LOW = ((60, 3.0), (1000, 4.5))
#: The four languages, and Latin texts without function words: set on labelled texts that are not held out, under all good ones (README). The others: wide, from what
#: the vocabularies spend on a script at most; no labelled text has them.
BANDS: dict[str, Band] = {
    "en": Band((1.95, 9.0), (2.08, 9.0), 0.10, _FLOOR),
    "fr": Band((1.90, 9.0), (2.02, 9.0), 0.10, _FLOOR),
    "de": Band((2.30, 9.0), (2.35, 9.0), 0.10, _FLOOR),
    "es": Band((2.05, 9.0), (2.18, 9.0), 0.10, _FLOOR),
    "latin": Band((1.85, 9.0), (1.98, 9.0), 0.15, _FLOOR),
    "greek": Band((0.5, 6.0), (0.4, 6.0), 0.40, _LOW),
    "cyrillic": Band((0.8, 6.0), (0.8, 6.0), 0.30, _LOW),
    "hebrew": Band((0.4, 5.0), (0.4, 5.0), 0.60, _LOW),
    "arabic": Band((0.4, 5.0), (0.4, 5.0), 0.60, _LOW),
    "indic": Band((0.25, 5.0), (0.25, 5.0), 0.80, _LOW),
    "han": Band((0.25, 3.0), (0.25, 3.0), 0.80, _LOW),
    "kana": Band((0.3, 3.0), (0.3, 3.0), 0.80, _LOW),
    "hangul": Band((0.25, 3.0), (0.25, 3.0), 0.80, _LOW),
    "other": Band((0.2, 9.0), (0.2, 9.0), 0.90, _LOW),
}

#: Frequent function words that only one of the languages has.
FUNCTION_WORDS = {
    "en": "the of and to that is was for with this from are by",
    "fr": "le les des et est une dans pour du au aux pas sur",
    "de": "der die das und ist ein mit den zu im dem auf nicht",
    "es": "el los las y una por con del como ha su al lo",
}
_LANGUAGE = {w.encode(): language for language, words in FUNCTION_WORDS.items() for w in words.split()}
#: First code points of the blocks of scripts; what lies before the next one belongs to it.
BLOCKS = ((0, "none"), (0x41, "latin"), (0x5B, "none"), (0x61, "latin"), (0x7B, "none"), (0xC0, "latin"), (0x250, "other"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"), (0x780, "other"), (0x8A0, "arabic"), (0x900, "indic"), (0xE00, "other"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "none"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"), (0x3190, "han"), (0xAC00, "hangul"), (0xD7B0, "none"), (0xF900, "han"), (0xFB00, "other"), (0x1F000, "none"), (0x20000, "han"))
_FIRST = np.array([b for b, _ in BLOCKS], np.uint32)
_SCRIPTS = sorted({s for _, s in BLOCKS})
_NUMBER = np.array([_SCRIPTS.index(s) for _, s in BLOCKS])


def script_of(text: str) -> str:
    """The script of most letters; "other" without any."""
    if text.isascii():
        return "latin"
    block = np.searchsorted(_FIRST, np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32), "right") - 1
    found = np.bincount(_NUMBER[block], minlength=len(_SCRIPTS))
    found[_SCRIPTS.index("none")] = 0
    return _SCRIPTS[int(found.argmax())] if found.any() else "other"


def group_of(text: str, words: list[bytes]) -> str:
    """The band that a text falls under: its language where function words tell it, else its script."""
    script = script_of(text)
    if script != "latin":
        return script
    found = Counter(map(_LANGUAGE.get, words))
    found.pop(None, None)
    best = max(found, key=lambda x: (found[x], x), default=None)
    return best if best and 40 * found[best] >= len(words) and 2 * found[best] > sum(found.values()) else script


def repeated_window_words(words: list[bytes], width: int = 5) -> int:
    """Words that lie in a window of `width` words which stands at two or more places."""
    n = len(words)
    if n <= width:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter(map(number.setdefault, words, itertools.count()), np.int64, n)
    base = n + 1
    key, span = ids, 1
    while span < width:
        step = min(span, width - span)
        top = int(key.max()) + 1
        if top * (base if step == 1 else top) >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            top = int(key.max()) + 1
        if step == 1:
            key = key[:-1] * base + ids[span:] if span + 1 <= n else key
        else:
            other = key[span : span + n - span - step + 1] if step == span else None
            key = key[: n - span - step + 1] * top + other
        span += step
    order = np.argsort(key, kind="stable")
    same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
    starts = order[same | np.concatenate([same[1:], [False]])]
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_counts(text: bytes, words: list[bytes], chars: int) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words; chars: code points of the text."""
    word_chars = chars - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return word_chars, symbols, len(lines) - len(set(lines)), repeated_window_words(words)


def token_entropy(ids: np.ndarray) -> float:
    """In bits; 0 without tokens."""
    if not len(ids):
        return 0.0
    counts = np.bincount(ids)
    share = counts[counts > 0] / len(ids)
    return float(-(share * np.log2(share)).sum())


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, band string, n_tokens long, chars_per_token double, chars_per_token_2 double, byte_share double, token_entropy double"
_TYPES = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string(), pa.int64()] + [pa.float64()] * 4
_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def _rules(bands: dict[str, Band], piece: str, rank: str, folder: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, ranks = vocabulary("piece", piece, folder), vocabulary("rank", rank, folder)
        for b in batches:
            for some in slices(b, "text", 1 << 21):
                texts = [t or "" for t in some.column("text").to_pylist()]
                rows = []
                for doc, text, ids in zip(some.column("doc_id").to_pylist(), texts, pieces.ids_of(texts), strict=True):
                    raw = text.encode("utf-8", "replace")
                    words = raw.split()
                    base = base_counts(raw, words, len(text))
                    failed = len(words) < 10 or 100 * base[-1] > 20 * len(words)
                    group, n, n_rank = group_of(text, words), len(ids), ranks.count(text)
                    measures = (len(text) / max(n, 1), len(text) / max(n_rank, 1), float(pieces.is_byte[ids].mean()) if n else 0.0, token_entropy(ids))
                    rows.append((doc, len(words), *base, failed, not failed and bands.get(group, bands["other"]).keeps(n, *measures), group, n, *measures))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

    return run


def fertility_rules(docs: DataFrame, bands: dict[str, Band] | None = None, piece_vocabulary: str = "piece_bpe_32k.model", rank_vocabulary: str = "byte_bpe_multi_50k.tiktoken", tokenizer_dir: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of `docs`: base counts, fertility measures and the verdict."""
    return id_text(docs, id_col, text_col).mapInArrow(_rules(bands or BANDS, piece_vocabulary, rank_vocabulary, tokenizer_dir), SCHEMA)
