"""Words and their hashes straight from a batch of UTF-8 texts, without a Python object for each word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_MULT = np.uint64(0x9E3779B97F4A7C15)


def class_table(word_bytes) -> np.ndarray:
    """uint64 for each byte value: 0 for separators, else an odd-spread value; A-Z count as a-z."""
    out = np.zeros(256, np.uint64)
    for b in word_bytes:
        low = b + 32 if 65 <= b <= 90 else b
        out[b] = (low + 1) * 0xBF58476D1CE4E5B9 & (2**64 - 1)
    return out


#: Everything but space, \t, \n, \v, \f, \r.
SPACED = class_table(b for b in range(256) if b not in b" \t\n\x0b\x0c\r")
#: Digits, letters and bytes of non-ASCII characters.
LETTERS = class_table(b for b in range(256) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)

_BASE = 0xD6E8FEB86659FD93
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2**64, at least n of each."""
    global _powers, _inverses
    if len(_powers) < n:
        n = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            _powers, _inverses = (np.concatenate([np.ones(1, np.uint64), np.full(n, x, np.uint64)]).cumprod(dtype=np.uint64) for x in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _powers, _inverses


#: A second ring for the hashes of words: modulo a prime, so that no word can collide in both by its structure alone.
_PRIME, _BASE_2 = np.uint64((1 << 31) - 1), 1_315_423_911
_powers_2 = np.ones(1, np.uint64)
_inverses_2 = np.ones(1, np.uint64)


def _fold(x: np.ndarray) -> np.ndarray:
    """A value below 2**33 that equals x modulo the prime."""
    return (x & _PRIME) + (x >> np.uint64(31))


def _modulo(x: np.ndarray) -> np.ndarray:
    x = _fold(_fold(x))
    return np.where(x >= _PRIME, x - _PRIME, x)


def _tables_2(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers_2, _inverses_2
    if len(_powers_2) < n:
        n = max(n, 1 << 20)
        found = []
        for base in (_BASE_2, pow(_BASE_2, -1, int(_PRIME))):
            out, step = np.ones(1, np.uint64), base
            while len(out) < n:  # twice as many powers by one product
                out = np.concatenate([out, _modulo(out * np.uint64(step))])
                step = step * step % int(_PRIME)
            found.append(out)
        _powers_2, _inverses_2 = found
    return _powers_2, _inverses_2


def range_hash_2(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash modulo the prime of values[start:end], for values below 2**31."""
    powers, inverses = _tables_2(len(values) + 1)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_fold(values * powers[: len(values)]), dtype=np.uint64)])
    return _modulo(_modulo(prefix[end] - prefix[start]) * inverses[start])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads a 64-bit value over all bits; a bijection."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Polynomial prefix hashes of a sequence of uint64: n + 1 of them."""
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _tables(len(values))[0][: len(values)], dtype=np.uint64)])


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of [start, end): equal for equal contents wherever they stand in the sequence."""
    with np.errstate(over="ignore"):
        return mix((prefix[end] - prefix[start]) * _tables(len(prefix))[1][start])


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1) and bytes of a string column; nulls are empty."""
    raw = column.cast(pa.large_binary())
    if raw.null_count:
        raw = raw.fill_null(b"")
    _, offsets, data = raw.buffers()
    at = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
    return at - at[0], np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)


def words_of(offsets: np.ndarray, data: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, end (in data) and hash of each word, and for each text the number of words before it (n + 1).

    A hash is made of two, over different rings: words that collide in one by their structure differ in the other."""
    value = table[data]
    inside = value != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        hashes = mix(range_hash(prefix_hash(value), start, end) + range_hash_2(value >> np.uint64(33), start, end) * _MULT)
    return start, end, hashes, np.searchsorted(start, offsets)


def slices(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about most_bytes of text (one row at least): arrays over bytes take some 60 times as much."""
    offsets, _ = texts_of(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to
