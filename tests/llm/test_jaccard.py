"""The n-gram Jaccard join against brute force on words."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import jaccard
from quarryline.llm.components import merge_labels

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
THUE_MORSE = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
OTHER = THUE_MORSE.translate(str.maketrans("ab", "ba"))


def texts():
    rng = random.Random(4)
    words = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    out = [None, "", " \n\t", "one", "ONE", "one two", "one two three", "One two  three", "a b a b a b a b a b a b a b", "a b a b a b a b a b"]
    out += [f"p {THUE_MORSE} q", f"p {OTHER} q", f"p {THUE_MORSE} q"]
    for n, copies, rate in ((60, 30, 0.006), (200, 25, 0.02), (400, 12, 0.01), (1500, 6, 0.01), (90, 40, 0.0)):
        base = words(n)
        for _ in range(copies):
            out.append(" ".join(w + "x" * rng.randrange(1, 4) if rng.random() < rate else w for w in base).replace("w1", rng.choice(["w1", "W1"])))
    passage = words(80)
    out += [" ".join(words(30) + passage + words(25)) for _ in range(30)]
    out += [" ".join(f"y{i}" for i in range(s, s + 100)) for s in (0, 4, 8, 12)] + ["É " * 9, "é " * 9, " ".join(words(20_000))]
    out.append(out[-1] + " end")
    return out


def brute_force(texts, k, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(ASCII))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    link = lambda a, b: bool(common := len(a & b)) and 100 * common >= percent * (len(a) + len(b) - common)
    label, linked = list(range(len(sets))), {}
    for i in range(len(sets)):
        for j in range(i):
            if link(sets[i], sets[j]):
                linked.setdefault(sets[i], set()).add(sets[j])
                linked.setdefault(sets[j], set()).add(sets[i])
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    first = {}
    for i, s in enumerate(sets):
        first.setdefault(s or i, i)
    return [(len(s), label[i], first[s or i], len(linked.get(s, set()) - {s})) for i, s in enumerate(sets)]


@pytest.mark.parametrize("k,percent,options", [(3, 90, {}), (5, 80, {"block": 3, "block_sets": 4}), (3, 90, {"block": 20, "block_words": 3000})])
def test_equals_brute_force(spark, k, percent, options):
    rows = texts()
    df = spark.createDataFrame([(t, i, "k", i, 0) for i, t in enumerate(rows)], "text string, doc_id long, key string, cid long, n int").repartition(5)
    got = {r["doc_id"]: r for r in jaccard.jaccard_components(df, k, percent, **options).collect()}
    want = brute_force(rows, k, percent)
    assert [(got[i]["n_shingles"], got[i]["component_id"], got[i]["class_id"], got[i]["n_links"]) for i in range(len(rows))] == want
    assert {i for i, r in got.items() if r["is_first"]} == {i for i, w in enumerate(want) if w[1] == i}
    if k == 3:
        assert got[10]["component_id"] == got[12]["component_id"] == 10 and got[11]["component_id"] == 11 and max(w[3] for w in want) >= 10


def test_repeated_ids_null_ids_and_empty_table(spark):
    long = " ".join(f"w{i}" for i in range(100))
    rows = [(1, long), (1, long), (1, "other words than these"), (None, long + " x"), (None, "quite alone here"), (7, "other words than these"), (3, long + " x"), (4, None), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"], r["is_first"]) for r in jaccard.jaccard_components(df).collect()), key=str)
    assert got == sorted([(1, 98, 1, 1, True), (1, 98, 1, 1, True), (1, 2, 1, 0, True), (None, 99, 1, 1, False), (None, 1, None, 0, True), (7, 2, 1, 0, False), (3, 99, 1, 1, False), (4, 0, 4, 0, True), (4, 0, 4, 0, True)], key=str)
    assert jaccard.jaccard_components(df.limit(0)).count() == 0
    extra = df.withColumn("first_id", F.lit("x")).withColumn("own_key", F.lit(2)).withColumn("first_key", F.col("doc_id"))
    kept = jaccard.keep_one(extra, 3, 90)
    assert kept.columns == extra.columns and sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, long), (1, "other words than these"), (None, "quite alone here"), (4, None)], key=str)


def test_bucket_groups_hold_all_links_and_leave_strangers():
    rng = np.random.default_rng(1)
    new = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    sets = []
    for n, copies in ((300, 60), (2000, 40), (990, 30)):
        base = new(n)
        sets += [np.unique(np.concatenate([base[rng.random(n) < 0.97], new(n // 60)])) for _ in range(copies)] + [np.unique(new(n)) for _ in range(20)]
    order = rng.permutation(len(sets))
    sets = [sets[i] for i in order]
    n = np.array([len(s) for s in sets])
    sigs = jaccard.Signatures(n, [jaccard.signature(s) for s in sets])
    side = rng.integers(0, 2, len(sets))
    for cross in (False, True):
        label = jaccard.bucket_groups(sigs, side, 90, cross)
        linked = 0
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= 90 * (n[i] + n[j] - common) and (not cross or side[i] != side[j]):
                    assert label[i] == label[j]
                    linked += 1
        assert linked > 500 and len(set(label.tolist())) > 30


def test_overlaps_by_matrix_and_by_holders():
    rng = np.random.default_rng(2)
    sets = [np.unique(np.concatenate([rng.integers(0, 50, 20), rng.integers(50, 3000, 60)])) for _ in range(80)]
    owner, token = np.repeat(np.arange(80), [len(s) for s in sets]), np.concatenate(sets)
    assert (jaccard.overlaps(owner, token, 80, columns=7) - np.diag([0] * 80) == [[len(np.intersect1d(a, b)) if i != j else jaccard.overlaps(owner, token, 80)[i, i] for j, b in enumerate(sets)] for i, a in enumerate(sets)]).all()
    label = np.arange(6)
    assert merge_labels(label, np.array([5, 4, 3]), np.array([4, 3, 1])) and label.tolist() == [0, 1, 2, 1, 1, 1] and not merge_labels(label, np.array([5]), np.array([1]))
