"""Public vocabularies, encoded word by word with a bounded cache.

Both vocabularies split a text into pre-tokens before merging, and no pre-token crosses a single space that has no
white space beside it. So a text can be encoded as its space-separated chunks, and a chunk that was met before costs a
dictionary lookup. Anything outside the plain case goes to the library itself.
"""

from __future__ import annotations

import functools
import itertools
import os
import re

import numpy as np
import regex

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Byte-to-character table of byte-level vocabularies: printable bytes stand for themselves, the rest from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _PRINTABLE} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Characters whose handling is the same everywhere: printable ASCII but "<" (special strings), and Latin-1 letters.
_PLAIN = regex.compile(r"[ !-;=-~À-ÖØ-öø-ÿ]*")
_PLAIN_TEXT = regex.compile(r"[\n -;=-~À-ÖØ-öø-ÿ]*")
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def tokenizer_path(name: str, folder: str | None = None) -> str:
    """Where a vocabulary file is: in `folder`, or where the public_tokenizers package of the executing machine has it."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=8)
def load_tokenizer(name: str, folder: str | None = None):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(name, folder))


@functools.lru_cache(maxsize=8)
def load_pieces(name: str, folder: str | None = None):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(name, folder))


class ChunkCache:
    """Chunk -> token ids, at most `limit` chunks (more only while one text has more).

    `encode` gets distinct chunks and returns the number of ids of each and all ids in order. When full, the chunks
    that were met again since they came in get a second chance and the others go.
    """

    def __init__(self, encode, limit: int = 400_000):
        self.encode_chunks, self.limit = encode, limit
        self._fill({}, np.zeros(0, np.int32), np.zeros(0, np.int32))

    def _fill(self, index: dict, size: np.ndarray, flat: np.ndarray) -> None:
        n = len(size)
        self.index, self.used = index, len(flat)
        room = max(1024, n)
        self.size, self.start, self.met = np.zeros(room, np.int32), np.zeros(room, np.int64), np.zeros(room, bool)
        self.flat = np.zeros(max(8192, len(flat)), np.int32)
        self.size[:n], self.start[:n], self.flat[: len(flat)] = size, np.cumsum(size) - size, flat

    def _make_room(self) -> None:
        kept = [c for c, i in self.index.items() if self.met[i]]
        if len(kept) > self.limit // 2:
            kept = []
        rows = np.array([self.index[c] for c in kept], np.int64)
        self._fill(dict(zip(kept, range(len(kept)), strict=True)), self.size[rows], self._gather(rows))

    def _add(self, chunks: list) -> None:
        lengths, ids = self.encode_chunks(chunks)
        n, k, total = len(self.index), len(chunks), len(ids)
        while n + k > len(self.size):
            self.size, self.start, self.met = (np.concatenate([x, np.zeros_like(x)]) for x in (self.size, self.start, self.met))
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.size[n : n + k] = lengths
        self.start[n : n + k] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + total] = ids
        self.used += total
        self.index.update(zip(chunks, range(n, n + k), strict=True))

    def rows(self, chunks: list) -> np.ndarray:
        out = np.fromiter(map(self.index.get, chunks, itertools.repeat(-1)), np.int64, len(chunks))
        if (lacking := np.flatnonzero(out < 0)).size:
            missing = list(dict.fromkeys(map(chunks.__getitem__, lacking.tolist())))
            if len(self.index) + len(missing) > self.limit:
                self._make_room()
                missing = [c for c in dict.fromkeys(chunks) if c not in self.index]
                self._add(missing)
                return np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
            self._add(missing)
            self.met[out[out >= 0]] = True
            out[lacking] = np.fromiter(map(self.index.__getitem__, map(chunks.__getitem__, lacking.tolist())), np.int64, lacking.size)
        else:
            self.met[out] = True
        return out

    def _gather(self, rows: np.ndarray) -> np.ndarray:
        size = self.size[rows].astype(np.int64)
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[rows] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]

    def count(self, chunks: list) -> int:
        rows = self.rows(chunks)  # first: it may put new arrays in the place of size
        return int(self.size[rows].sum())

    def ids(self, chunks: list) -> np.ndarray:
        return self._gather(self.rows(chunks)) if chunks else np.zeros(0, np.int32)

    def ids_of(self, lists: list[list]) -> list[np.ndarray]:
        """The ids of each list of chunks; lists go in groups, so that a group's new chunks are encoded together."""
        out: list[np.ndarray] = []
        group: list[list] = []
        n = 0
        for i, chunks in enumerate(lists):
            group.append(chunks)
            n += len(chunks)
            if n >= 20_000 or i + 1 == len(lists):
                rows = self.rows(list(itertools.chain.from_iterable(group)))
                ids = self._gather(rows) if len(rows) else np.zeros(0, np.int32)
                ends = np.concatenate([[0], np.cumsum(self.size[rows], dtype=np.int64)])[np.cumsum([len(c) for c in group])]
                out += np.split(ids, ends[:-1])
                group, n = [], 0
        return out


def _joined(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return sizes, np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum()))


class _Chunked:
    """Chunks of plain characters are encoded together by their merge ranks, others one by one by the library."""

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        plain = list(map(_PLAIN.fullmatch, chunks))
        if None not in plain:
            return self._encode_plain(chunks)
        some = [c for c, m in zip(chunks, plain, strict=True) if m]
        rest = [c for c, m in zip(chunks, plain, strict=True) if not m]
        sizes, ids = self._encode_plain(some)
        ends = np.cumsum(sizes)
        own = iter(np.split(ids, ends[:-1]) if len(some) else [])
        other = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        return _joined([next(own).tolist() if m else next(other).ids for m in plain])


class WordVocabulary(_Chunked):
    """ids of a `tokenizers` file that lower-cases, drops white space and marks word ends (word_bpe_49k.json)."""

    #: Stands for the end of a word in the merge ranks; no plain chunk has it.
    END = "\0"

    def __init__(self, name: str = "word_bpe_49k.json", folder: str | None = None, limit: int = 400_000):
        import tiktoken

        self.tokenizer = load_tokenizer(name, folder)
        back = {c: bytes([b]) for b, c in _BYTE_CHARS.items()}
        ranks: dict[bytes, int] = {}
        ends = []
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            body = token.removesuffix("</w>") if len(token) > 4 else token
            if all(c in back for c in body):
                ranks[b"".join(back[c] for c in body) + (self.END.encode() if body != token else b"")] = i
                ends += [i] if body != token else []
        ranks.setdefault(self.END.encode(), 1 + max(ranks.values()))
        self.is_end = np.zeros(2 + max(ranks.values()), bool)
        self.is_end[ends] = True
        self.by_rank = tiktoken.Encoding(name, pat_str="[^ ]+", mergeable_ranks=ranks, special_tokens={})
        self.cache = ChunkCache(self._encode, limit)

    def _encode_plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces: list[str] = []
        counts = []
        for low in " ".join(chunks).lower().split(" "):
            if low.isalpha():
                pieces.append(low)
                counts.append(1)
            else:
                own = _WORDS.findall(low)
                pieces += own
                counts.append(len(own))
        ids = np.array(self.by_rank.encode_ordinary(f"{self.END} ".join([*pieces, ""])), np.int32)
        ends = np.flatnonzero(self.is_end[ids]) + 1
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)]
        return np.diff(bounds), ids

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        return self.cache.ids_of([[c for c in t.replace("\n", " ").split(" ") if c] for t in texts])


class ByteVocabulary(_Chunked):
    """Token counts or ids of a byte-level `tokenizers` file without normaliser (byte_bpe_50k.json)."""

    def __init__(self, name: str = "byte_bpe_50k.json", folder: str | None = None, limit: int = 400_000):
        import public_tokenizers
        import tiktoken

        self.tokenizer = load_tokenizer(name, folder)
        back = {c: bytes([b]) for b, c in _BYTE_CHARS.items()}
        ranks = {b"".join(back[c] for c in t): i for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if all(c in back for c in t)}
        self.by_rank = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache = ChunkCache(self._encode, limit)

    def _encode_plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _joined(list(map(self.by_rank.encode_ordinary, chunks)))

    def chunks(self, text: str) -> list[str] | None:
        """Chunks with their leading space, or None where white space stands beside a space and cuts are unsafe."""
        if regex.search(r" \s|\s ", text):
            return None
        head, *tail = text.split(" ")
        return [*([head] if head else []), *(f" {c}" for c in tail)]

    def ids(self, text: str) -> np.ndarray:
        chunks = self.chunks(text)
        if chunks is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32)
        return self.cache.ids(chunks)

    def count(self, text: str) -> int:
        """Without the cache: counting whole plain texts by rank costs less than cutting them."""
        if _PLAIN_TEXT.fullmatch(text):
            return len(self.by_rank.encode_ordinary(text))
        chunks = self.chunks(text)
        if chunks is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return self.cache.count(chunks)


#: White space other than spaces and line ends, and characters that a normaliser may turn into such.
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\u2581\u00a8\u00af\u00b4\u00b8\u02d8-\u02dd\u037a\u0384\u0385\u1fbd-\u1ffe\u2017\u203e\u2800\u3164\ufdfa\ufdfb\ufe49-\ufe4c\ufe70-\ufe7f\uffe3]")


def evenly_spaced(text: str) -> bool:
    """Whether words stand one space apart, with line ends as the only other white space."""
    return "  " not in text and not text.startswith(" ") and not text.endswith(" ") and not _ODD.search(text)


class PieceVocabulary:
    """ids of a sentencepiece model; knows which ids stand for single bytes.

    No piece holds a space behind other characters, so a text whose words stand one space apart is encoded as these, line
    ends and all, and a word that was met before costs a lookup. Other texts go to the library whole."""

    def __init__(self, name: str = "piece_bpe_32k.model", folder: str | None = None, limit: int = 400_000):
        self.model = load_pieces(name, folder)
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.model.vocab_size())])
        self.begins = np.array([self.model.id_to_piece(i).startswith("\u2581") for i in range(self.model.vocab_size())])
        self.cache = ChunkCache(self._encode, limit)

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All chunks as one text: each begins with the only piece of it that begins with a space."""
        ids = np.array(self.model.encode(" ".join(chunks), num_threads=1), np.int32)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(chunks) or "" in chunks:
            return _joined(self.model.encode(chunks, num_threads=1))
        return np.diff(np.append(starts, len(ids))), ids

    def ids(self, text: str) -> np.ndarray:
        return self.ids_of([text])[0]

    def ids_of(self, texts: list[str]) -> list[np.ndarray]:
        plain = list(map(evenly_spaced, texts))
        out = self.cache.ids_of([t.split(" ") if t and ok else [] for t, ok in zip(texts, plain, strict=True)])
        for k, (t, ok) in enumerate(zip(texts, plain, strict=True)):
            if not ok:
                out[k] = np.array(self.model.encode(t, num_threads=1), np.int32)
        return out


class RankVocabulary:
    """Token counts of a tiktoken rank file. The pattern cuts before a single space between words, so of an evenly spaced
    text each word is counted with the space before it, and a word that was met before costs a lookup."""

    def __init__(self, name: str = "byte_bpe_multi_50k.tiktoken", folder: str | None = None, limit: int = 400_000):
        import base64

        import public_tokenizers
        import tiktoken

        with open(tokenizer_path(name, folder), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(1 + max(ranks.values()), bool)
        self.begins[[i for token, i in ranks.items() if token.startswith(b" ")]] = True
        self.limit, self.known = limit, {}

    def _counts(self, words: list[str]) -> list[int]:
        """Tokens of each word with a space before it. All are one text: each has one token that begins with a space."""
        ids = np.array(self.encoding.encode_ordinary(" " + " ".join(words)), np.int64)
        starts = np.flatnonzero(self.begins[ids])
        if len(starts) != len(words):
            return [len(self.encoding.encode_ordinary(f" {w}")) for w in words]
        return np.diff(np.append(starts, len(ids))).tolist()

    def count(self, text: str) -> int:
        if not text or " \n" in text or "\n " in text or not evenly_spaced(text):
            return len(self.encoding.encode_ordinary(text))
        head, *tail = text.split(" ")
        found = list(map(self.known.get, tail))
        if None in found:
            new = list({w for w, n in zip(tail, found, strict=True) if n is None})
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
                new = list(set(tail))
            self.known.update(zip(new, self._counts(new), strict=True))
            found = map(self.known.__getitem__, tail)
        return len(self.encoding.encode_ordinary(head)) + sum(found)


@functools.lru_cache(maxsize=8)
def vocabulary(kind: str, name: str, folder: str | None = None, limit: int = 400_000):
    """One vocabulary object for a worker process, kept across tasks."""
    return {"word": WordVocabulary, "byte": ByteVocabulary, "piece": PieceVocabulary, "rank": RankVocabulary}[kind](name, folder, limit)
