"""Exact n-gram Jaccard self-join with signature trees.

A document's set is its distinct shingles of k words. Two documents link when 100 * intersection >= percent * union.

1. Documents with equal sets are one class (equal digests of the sorted shingle hashes, each made of two hashes over
   different rings); the smallest id stands for it.
2. Sets that reach the threshold share one of the shingles that come first in a fixed order (the prefix filter), and they
   share `more` of them when so many more are looked at. A class with fewer shared ones than its smallest partner would
   need has no partner and goes: a passage that many documents hold is far less than that. The rest is put in buckets by
   the first shingles; buckets of one class go.
3. In every bucket a signature tree is built: classes in order of size, nodes with the OR of their members' token bitmaps,
   ranges of size and of group, and the most tokens that can hide behind a shared bit. A dual traversal goes down pairs of
   nodes and drops those whose sizes don't fit, whose members are all in one group by now, or whose largest possible
   overlap is too small. Pairs that remain join their groups, so a bucket gives as many rows as it has members, whatever
   pairs it holds. Small buckets are traversed together. Buckets of more than `block` classes are dealt out as pairs of
   blocks, so that no task holds more than two blocks.
4. The groups of all buckets are joined. Every link lies inside a group. There the texts themselves meet, large groups
   dealt out as pairs of blocks: words are numbered by their bytes, so that overlaps are counted on words, not on hashes,
   and all links of every pair of classes are found. Link counts and the links' components leave the tasks, no pairs. A
   group costs the square of its classes, as many as it can have links.

Nulls: a null or empty text, or one without words, has an empty set and links with nothing. Each row is a document: rows
that repeat an id and a text are equal, rows of one id with different texts are different documents, and a row with a null
id takes part but is nobody's smallest id (its component_id is null where no other is in reach). Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytewords import SPACED, prefix_hash, range_hash, slices, texts_of, words_of
from .common import Scratch, free_name, giving_back
from .components import connected_components, merge_labels

SMALL_BITS, LARGE_BITS = 1024, 8192


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer than k words is one shingle."""
    _, _, hashes, before = words_of(*texts_of(texts), SPACED)
    prefix = prefix_hash(hashes)
    starts = np.arange(max(0, len(hashes) - k + 1))
    rolled = range_hash(prefix, starts, starts + k)
    out = []
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            out.append(range_hash(prefix, np.array([a]), np.array([b])))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def prefix_length(n: int, percent: int) -> int:
    """Tokens of which a set of n and any set that reaches the threshold with it share at least one."""
    return n - -(-percent * n // 100) + 1 if n else 0


def more_shared(n: int, percent: int, slack: int) -> int:
    """Shingles beyond the prefix that a set of n looks at: slack percent of it."""
    return min(slack * n // 100, n - prefix_length(n, percent)) if n else 0


def least_overlap(a, b, percent: int):
    return -(-percent * (a + b) // (100 + percent))


def signature(tokens: np.ndarray) -> bytes:
    bits = SMALL_BITS if len(tokens) <= SMALL_BITS else LARGE_BITS
    out = np.zeros(bits, bool)
    out[(tokens & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(out).tobytes()


def _sketch(k: int, percent: int, slack: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = shingle_sets(piece.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        piece.column("text_key"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array([s[: prefix_length(len(s), percent) + more_shared(len(s), percent, slack)].view(np.int64) for s in sets], pa.list_(pa.int64())),
                        pa.array([signature(s) for s in sets], pa.binary()),
                    ],
                    ["doc_id", "text_key", "n", "digest", "prefix", "sig"],
                )

    return run


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


class Signatures:
    """The bitmaps of a list of sets: folded to the small size for all, and at full size for those that have it."""

    def __init__(self, n: np.ndarray, sigs: list[bytes]):
        small, large = SMALL_BITS // 8, LARGE_BITS // 8
        self.n, self.is_large = n, np.fromiter((len(s) == large for s in sigs), bool, len(sigs))
        self.full = np.frombuffer(b"".join(s for s in sigs if len(s) == large), np.uint64).reshape(-1, large // 8)
        self.row = np.cumsum(self.is_large) - 1
        self.folded = np.zeros((len(sigs), small // 8), np.uint64)
        self.folded[~self.is_large] = np.frombuffer(b"".join(s for s in sigs if len(s) == small), np.uint64).reshape(-1, small // 8)
        if len(self.full):
            self.folded[self.is_large] = np.bitwise_or.reduce(self.full.reshape(len(self.full), -1, small // 8), axis=1)
        self.hidden = n - _popcount(self.folded)  # tokens that share a bit with another of the same set
        self.hidden_full = n[self.is_large] - _popcount(self.full)

    def may_link(self, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
        """Whether sizes and bitmaps allow the threshold, for each pair of numbers."""
        a, b = self.n[i], self.n[j]
        need = least_overlap(a, b, percent)
        out = (100 * a >= percent * b) & (100 * b >= percent * a)
        at = np.flatnonzero(out)
        out[at] = _popcount(self.folded[i[at]] & self.folded[j[at]]) + np.minimum(self.hidden[i[at]], self.hidden[j[at]]) >= need[at]
        at = np.flatnonzero(out & self.is_large[i] & self.is_large[j])
        x, y = self.row[i[at]], self.row[j[at]]
        out[at] = _popcount(self.full[x] & self.full[y]) + np.minimum(self.hidden_full[x], self.hidden_full[y]) >= need[at]
        return out


class SignatureTree:
    """Levels of nodes over sets in order of size; level 0 are the sets."""

    FAN = 8
    #: Pairs of nodes that are looked at together.
    CHUNK = 20_000

    def __init__(self, members: np.ndarray, sigs: Signatures, full: bool, side: np.ndarray):
        n = sigs.n[members]
        bits, hidden = (sigs.full[sigs.row[members]], sigs.hidden_full[sigs.row[members]]) if full else (sigs.folded[members], sigs.hidden[members])
        self.members, self.sigs = members, sigs
        self.levels = [{"low": n, "high": n, "sig": bits, "hidden": hidden, "sides": 1 << side[members]}]
        ops = {"low": np.minimum, "high": np.maximum, "sig": np.bitwise_or, "hidden": np.maximum, "sides": np.bitwise_or}
        while len(self.levels[-1]["low"]) > 1:
            below = self.levels[-1]
            at = np.arange(0, len(below["low"]), self.FAN)
            self.levels.append({name: op.reduceat(below[name], at, axis=0) for name, op in ops.items()})

    def _ranges(self, label: np.ndarray) -> None:
        """First and last group of each node."""
        first = last = label[self.members]
        for level in self.levels:
            level["first"], level["last"] = first, last
            at = np.arange(0, len(first), self.FAN)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)

    def join_groups(self, label: np.ndarray, percent: int, cross: bool) -> None:
        """Dual traversal that joins, in label, the groups of every pair that may link; where cross, of sets on different
        sides. Nodes are paired with themselves before they are paired with others, so that groups grow early."""
        self._ranges(label)
        todo = [(len(self.levels) - 1, np.zeros((1, 2), np.int64))]
        while todo:
            level, pairs = todo.pop()
            if len(pairs) > self.CHUNK:
                todo += [(level, part) for part in np.array_split(pairs, -(-len(pairs) // self.CHUNK))[::-1]]
                continue
            x = self.levels[level]
            i, j = pairs.T
            ok = 100 * x["high"][i] >= percent * x["low"][j]
            ok &= 100 * x["high"][j] >= percent * x["low"][i]
            ok &= (x["first"][i] != x["last"][j]) | (x["first"][j] != x["last"][i])
            if cross:
                ok &= (x["sides"][i] | x["sides"][j]) == 3
            i, j = i[ok], j[ok]
            most = np.minimum(_popcount(x["sig"][i] & x["sig"][j]) + np.minimum(x["hidden"][i], x["hidden"][j]), np.minimum(x["high"][i], x["high"][j]))
            ok = most >= least_overlap(x["low"][i], x["low"][j], percent)
            i, j = i[ok], j[ok]
            if not level:
                a, b = self.members[i], self.members[j]
                ok = (a != b) & self.sigs.may_link(a, b, percent)
                if merge_labels(label, a[ok], b[ok]):
                    self._ranges(label)
                continue
            width = len(self.levels[level - 1]["low"])
            a = (i[:, None] * self.FAN + np.arange(self.FAN))[:, :, None]
            b = (j[:, None] * self.FAN + np.arange(self.FAN))[:, None, :]
            a, b = (v.ravel() for v in np.broadcast_arrays(a, b))
            inside = (a < width) & (b < width) & (a <= b)
            a, b = a[inside], b[inside]
            for some in (a != b, a == b):
                if some.any():
                    todo.append((level - 1, np.stack([a[some], b[some]], 1)))


def bucket_groups(sigs: Signatures, side: np.ndarray, percent: int, cross: bool) -> np.ndarray:
    """A label for each member of a bucket: equal where a chain of pairs that may link leads from one to the other."""
    label = np.arange(len(sigs.n))
    star = np.flatnonzero(sigs.may_link(np.zeros_like(label), label, percent) & ((side != side[0]) | (not cross)))
    merge_labels(label, np.zeros_like(star), star)
    if label.any():
        by_size = np.lexsort((label, sigs.n))
        # Large sets meet at full size among themselves, and folded with the small ones that they can still reach.
        for full, chosen in ((True, sigs.is_large), (False, ~sigs.is_large | (percent * sigs.n <= 100 * SMALL_BITS))):
            members = by_size[chosen[by_size]]
            if len(members) > 1:
                SignatureTree(members, sigs, full, side).join_groups(label, percent, cross)
    return label


def _groups_of(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole runs of rows with equal columns, with the places where runs begin and end; several runs at a time."""
    held: list[pa.RecordBatch] = []
    last = None

    def settled() -> tuple[pa.Table, np.ndarray]:
        t = pa.Table.from_batches(held).combine_chunks()
        key = np.stack([t.column(c).to_numpy() for c in columns], 1)
        return t, np.array([0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1), len(key)])

    for b in batches:
        if b.num_rows:
            key = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in columns], 1)
            differs = (key != key[-1]).any(1)
            cut = int(np.flatnonzero(differs)[-1]) + 1 if differs.any() else 0
            if cut or (last is not None and (key[0] != last).any()):
                if cut:
                    held.append(b.slice(0, cut))
                yield settled()
                held = []
            held.append(b.slice(cut))
            last = key[-1]
    if held:
        yield settled()


#: Buckets up to this size are traversed together: they are leaves whose pairs are tested at once.
_TOGETHER = 16


def _bucket_edges(percent: int):
    def small(t: pa.Table, of: np.ndarray) -> np.ndarray:
        """Links of groups in many small buckets; of: each row's bucket."""
        ids = t.column("cid").to_numpy()
        sigs = Signatures(t.column("n").to_numpy(), t.column("sig").to_pylist())
        label = np.arange(len(ids))
        for step in range(1, _TOGETHER):
            i = np.flatnonzero(of[:-step] == of[step:])
            if not len(i):
                break
            ok = (label[i] != label[i + step]) & sigs.may_link(i, i + step, percent)
            merge_labels(label, i[ok], i[ok] + step)
        moved = np.flatnonzero(label != np.arange(len(ids)))
        return np.stack([ids[moved], ids[label[moved]]], 1)

    def large(t: pa.Table) -> np.ndarray:
        ids, i, j, own = (t.column(c).to_numpy() for c in ("cid", "i", "j", "own"))
        sigs = Signatures(t.column("n").to_numpy(), t.column("sig").to_pylist())
        label = bucket_groups(sigs, (own != i).astype(np.int64), percent, i[0] != j[0])
        moved = np.flatnonzero(label != np.arange(len(ids)))
        return np.stack([ids[moved], ids[label[moved]]], 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            pairs = np.unique(np.concatenate(found), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for t, cuts in _groups_of(batches, ("key", "i", "j")):
            size = np.diff(cuts)
            cross = t.column("i").to_numpy()[cuts[:-1]] != t.column("j").to_numpy()[cuts[:-1]]
            big = (size > _TOGETHER) | cross
            if (~big).any():
                of = np.repeat(np.arange(len(size)), size)
                found.append(small(t.filter(pa.array(~big[of])), of[~big[of]]))
            for g in np.flatnonzero(big).tolist():
                found.append(large(t.slice(cuts[g], size[g])))
            if sum(map(len, found)) > 200_000:
                yield out()
                found = []
        if found:
            yield out()

    return run


def _windows(ids: np.ndarray, k: int) -> np.ndarray:
    """A number for each window of k ids, equal for equal windows."""
    width = int(ids.max(initial=0)) + 1
    key = ids
    for step in range(1, k):
        if (int(key.max(initial=0)) + 1) * width >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
        key = key[:-1] * width + ids[step:]
    return key


def word_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Set and token number of each distinct k-word shingle of each text, and the sizes of the sets: exact, as words are
    told apart by their bytes. A text of fewer than k words equals no other class and gets no shingle."""
    number: dict[bytes, int] = {}
    found, total = [], 0
    for t in texts:  # only one text's words are objects at a time
        words = t.lower().split()
        found.append(np.fromiter(map(number.setdefault, words, count(total)), np.int64, len(words)))
        total += len(words)
    if total < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    size, ids = np.array([len(x) for x in found]), np.concatenate(found)
    rank = np.zeros(total, np.int64)
    rank[np.fromiter(number.values(), np.int64, len(number))] = np.arange(len(number))
    token = _windows(rank[ids], k)
    owner = np.repeat(np.arange(len(texts)), size)[: len(token)]
    inside = np.arange(len(token)) + k <= np.repeat(np.cumsum(size), size)[: len(token)]
    token, owner = np.unique(token[inside], return_inverse=True)[1], owner[inside]
    width = int(token.max(initial=0)) + 1
    both = np.unique(owner * width + token)
    owner, token = both // width, both % width
    return owner, token, np.bincount(owner, minlength=len(texts))


def overlaps(owner: np.ndarray, token: np.ndarray, m: int, columns: int = 2048) -> np.ndarray:
    """How many tokens each two of m sets share. Tokens that many sets hold are columns of an incidence matrix, whose
    product is taken; for the others all pairs of their holders are counted."""
    times = np.bincount(token)
    held = times[token] > 1
    owner, token = owner[held], token[held]
    order = np.argsort(token, kind="stable")
    owner, holders = owner[order], times[token[order]]
    common = np.zeros((m, m), np.float32)
    often = holders * 12 > m
    flat = common.ravel()
    for c in np.unique(holders[~often]).tolist():
        group = owner[holders == c].reshape(-1, c)
        for at in range(0, len(group), max(1, 1_000_000 // c**2)):
            part = group[at : at + max(1, 1_000_000 // c**2)]
            np.add.at(flat, (part[:, :, None] * m + part[:, None, :]).ravel(), np.float32(1))
    if often.any():
        owner, token = owner[often], token[order][often]
        token = np.concatenate([[0], np.cumsum(token[1:] != token[:-1])])
        for low in range(0, int(token[-1]) + 1, columns):
            a, b = np.searchsorted(token, [low, low + columns])
            part = np.zeros((m, min(columns, int(token[b - 1]) + 1 - low)), np.float32)
            part[owner[a:b], token[a:b] - low] = 1
            for at in range(0, m, 512):
                common[at : at + 512] += part[at : at + 512] @ part.T
    return common


def links_of(texts: list[bytes], side: np.ndarray, k: int, percent: int, cross: bool) -> tuple[np.ndarray, np.ndarray]:
    """For each text, the number of others (where cross: on the other side) that it links with, and a label that is equal
    for texts which links lead between."""
    owner, token, n = word_sets(texts, k)
    common = overlaps(owner, token, len(texts))
    links, label = np.zeros(len(texts), np.int64), np.arange(len(texts))
    for at in range(0, len(texts), 256):
        some = common[at : at + 256].astype(np.int64)
        linked = (some > 0) & (100 * some >= percent * (n[at : at + 256, None] + n[None, :] - some))
        linked[np.arange(len(some)), at + np.arange(len(some))] = False
        if cross:
            linked &= side[at : at + 256, None] != side[None, :]
        links[at : at + 256] = linked.sum(1)
        i, j = np.nonzero(linked)
        merge_labels(label, i + at, j)
    return links, label


def _verify(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, cuts in _groups_of(batches, ("component", "i", "j")):
            every = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                g = t.slice(a, b - a)
                ids = g.column("cid").to_numpy()
                one = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))  # repeated rows stand together
                ids, own = ids[one], g.column("own").to_numpy()[one]
                i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
                texts = g.column("text").cast(pa.large_binary()).take(pa.array(one)).to_pylist()
                links, label = links_of(texts, own, k, percent, i != j)
                every.append((ids, links, ids[label]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*every, strict=True)], ["cid", "links", "other"])

    return run


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, slack: int = 5, block: int = 16_384, block_words: int = 750_000, block_sets: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (smallest id with an equal set), n_links (all links of its class to other
    classes), text_key (a hash of the text) and is_first of every row.

    is_first marks the rows of one text of each component: the one of the smallest id.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("text_key", F.xxhash64("text"))
    sketches = scratch.save(texts.mapInArrow(giving_back(_sketch(k, percent, slack)), "doc_id long, text_key long, n long, digest binary, prefix array<long>, sig binary"))
    rows = scratch.save(sketches.select("doc_id", "text_key", "n", "digest"))
    # Of equal sets any row's size, prefix and signature will do: they are equal too.
    classes = sketches.where("n > 0").groupBy("digest").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_key"))).alias("known"), F.min("text_key").alias("any_key"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sig").alias("sig"))
    reps = scratch.save(classes.select(F.monotonically_increasing_id().alias("cid"), "digest", F.col("known.doc_id").alias("rep_id"), F.coalesce("known.text_key", "any_key").alias("rep_key"), "n", "prefix", "sig"))
    scratch.drop(sketches)

    looked_at = reps.select("cid", F.explode("prefix").alias("key"))
    shared = scratch.save(looked_at.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key"))
    least = F.ceil(F.col("n") * percent / 100)
    # The smallest partner has `least` shingles; what it looks at beyond its prefix is the fewest that they share.
    counted = scratch.save(looked_at.join(shared.hint("merge"), "key", "left_semi").groupBy("cid").agg(F.count("*").alias("shared")))
    scratch.drop(shared)
    hopeful = scratch.save(reps.join(counted.hint("merge"), "cid").where(F.col("shared") > F.floor(least * slack / 100)).select("cid", "n", F.slice("prefix", F.lit(1), (F.col("n") - least + 1).cast("int")).alias("prefix"), "sig"))
    scratch.drop(counted)
    keys = hopeful.select("cid", F.explode("prefix").alias("key"))
    buckets = scratch.save(keys.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key", F.ceil(F.col("m") / block).cast("int").alias("blocks")))
    members = scratch.save(keys.join(buckets.hint("merge"), "key").select("key", "cid", "blocks"))
    scratch.drop(buckets)
    dealt = members.join(hopeful.select("cid", "n", "sig").hint("merge"), "cid").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    edges = scratch.save(_pairs_of_blocks(dealt, "key").select("key", "i", "j", "cid", "n", "sig", "own").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(giving_back(_bucket_edges(percent)), "a long, b long").distinct())
    scratch.drop(members, hopeful)
    groups = connected_components(edges, scratch).withColumnRenamed("id", "cid")
    scratch.drop(edges)

    of = scratch.save(groups.join(reps.select("cid", "rep_id", "rep_key", "n"), "cid"))
    size = scratch.save(of.groupBy("component").agg(F.count("*").alias("m"), F.sum("n").alias("words")).select("component", F.greatest(F.ceil(F.col("m") / block_sets), F.ceil(F.col("words") / block_words)).cast("int").alias("blocks")))
    wanted = scratch.save(of.join(size, "component").withColumn("own", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")))
    scratch.drop(of, size)
    # By shuffle at every size: the ids grow with the input, so a broadcast would only serve small ones.
    found = texts.join(wanted.hint("merge"), (F.col("text_key") == F.col("rep_key")) & F.col("doc_id").eqNullSafe(F.col("rep_id"))).select("component", "blocks", "own", "cid", F.col("text").cast("binary").alias("text"))
    verified = scratch.save(_pairs_of_blocks(found, "component").repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "cid").mapInArrow(giving_back(_verify(k, percent)), "cid long, links long, other long"))
    scratch.drop(wanted)
    joined = connected_components(verified.select(F.col("cid").alias("a"), F.col("other").alias("b")), scratch)
    n_links = scratch.save(verified.groupBy("cid").agg(F.sum("links").alias("n_links")))

    ends = scratch.save(reps.select("cid", "digest", "rep_id", "rep_key").join(joined.withColumnRenamed("id", "cid"), "cid", "left").join(n_links, "cid", "left").withColumn("component", F.coalesce("component", "cid")))
    scratch.drop(reps, verified, n_links)
    smallest = scratch.save(ends.groupBy("component").agg(F.min(F.when(F.col("rep_id").isNotNull(), F.struct("rep_id", "rep_key"))).alias("known"), F.min("rep_key").alias("any_key")).select("component", F.col("known.rep_id").alias("first_id"), F.coalesce("known.rep_key", "any_key").alias("first_key")))
    of_class = scratch.save(ends.join(smallest, "component").select("digest", F.col("rep_id").alias("class_id"), F.col("first_id"), "first_key", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    alone = F.col("n") == 0
    own = lambda c: F.when(alone, F.col("doc_id")).otherwise(F.col(c))
    first = alone | (F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key")))
    out = rows.join(of_class, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), own("first_id").alias("component_id"), own("class_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "text_key", first.alias("is_first"))
    return scratch.finish(out)


def _pairs_of_blocks(rows: DataFrame, key: str) -> DataFrame:
    """Each row once for each pair (i, j) of blocks that its own block is in; key and blocks tell what is dealt out."""
    other = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", "blocks")


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that stay when of each component only the text of the smallest id does.

    Of rows that repeat its id and text one stays. Documents without words link with nothing, so they stay.
    """
    first = jaccard_components(docs, k, percent, id_col=id_col, text_col=text_col).where("is_first").select(F.col("doc_id").alias(f := free_name("first_id", docs)), F.col("text_key").alias(g := free_name("first_key", docs))).distinct()
    keyed = docs.withColumns({(i := free_name("own_id", docs)): F.col(id_col).cast("long"), (t := free_name("own_key", docs)): F.xxhash64(F.col(text_col).cast("string"))})
    return keyed.join(first.hint("merge"), F.col(t).eqNullSafe(F.col(g)) & F.col(i).eqNullSafe(F.col(f))).dropDuplicates([i, t]).select(docs.columns)
