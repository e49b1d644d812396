"""The pipeline's stages: on the smallest tables, and against brute force on a table of nulls, repeats, ties and odd columns."""

import collections
import random
import re
import zlib

import pytest

import corpus_pipeline
from quarryline.llm import decontaminate, gam
from quarryline.llm.common import Scratch, documents
from quarryline.llm.vocab import load_tokenizer

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "first_id long, text string, doc_id long, lang string, own_key int, found string, source string, c0 string"


def test_stages_and_run(spark):
    scratch = Scratch(spark, "test-pipeline")
    docs = documents(spark, SF)
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = scratch.save(stage(spark, docs, SF))
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[3] == sizes[4] > 0
    packed = STAGES["packing"](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == sizes[-1]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """Rows (doc_id, text) and a folder with documents, labels and benchmark."""
    rng = random.Random(6)
    lexicon = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7))) for _ in range(600)]
    prose = lambda n: ". ".join(" ".join(rng.choice(lexicon) for _ in range(9)).capitalize() for _ in range(n // 9 + 1)) + "."
    junk = lambda n: "###$$$ BUY!!! " * (n // 3)
    items = [(1, prose(40)), (None, prose(30)), (3, None), (4, ""), (1, prose(50))]
    base = prose(200)
    near = base.replace(base.split()[50], "changed", 1)
    texts = [base, base, near, near + " and a tail", None, "", " \n", "few words here", items[0][1], prose(60) + " " + items[4][1] + " " + prose(30), prose(20_000), "call +1 (309) 555-7741 or a.b@example.com, card 4111 1111 1111 1111", base.upper()]
    texts += [prose(rng.randrange(40, 200)) for _ in range(60)] + [junk(rng.randrange(30, 300)) + prose(9) for _ in range(25)]
    rows = list(enumerate(texts)) + [(0, base), (7, prose(80)), (None, near), (None, prose(90)), (None, None)]
    folder = tmp_path_factory.mktemp("made")
    docs = spark.createDataFrame([(5, t, i, "en", 1, "x", None, "y") for i, t in rows], SCHEMA)
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int("###" not in (t or "")), 0) for i, t in rows if i is not None] + [(2, None, 0), (None, 1, 0), (10_000, 1, 0), (9, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(t, i, 1) for i, t in items], "text string, item_id long, doc_id int").write.parquet(f"{folder}/benchmark.parquet")
    return rows, items, str(folder)


def pairs(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.collect())


def test_quality_keeps_what_the_model_scores(spark, made):
    rows, _, folder = made
    got = STAGES["quality"](spark, documents(spark, folder), folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = gam.fit_quality(gam.text_features(documents(spark, folder)), labels)
    want = collections.Counter((i, t) for i, t in rows if model.score(gam.np.array([gam.features(t)], "f4").astype(float))[0] >= 0.3)
    assert pairs(got) == want and got.columns == documents(spark, folder).columns
    assert not [t for _, t in want if t and "###" in t] and sum(want.values()) > 60


def test_near_copies_keep_one_of_each_component(spark, made):
    rows, _, folder = made
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()})
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    want = set()
    for group in set(label):
        own = [rows[i] for i in range(len(rows)) if label[i] == group]
        known = [r[0] for r in own if r[0] is not None]
        want.add((min(known) if known else None, None if len({t for _, t in own}) > 1 else own[0][1], group))
    got = pairs(STAGES["near_copies"](spark, documents(spark, folder), folder))
    assert len(got) == sum(got.values())
    empties = {(i, t) for i, t in rows if not (t or "").split()}
    assert empties <= set(got) and collections.Counter(i for i, _ in got if (i, _) not in empties) == collections.Counter(i for i, _, g in want if sets[g])
    assert {(i, t) for i, t, g in want if t is not None and sets[g]} <= set(got)


def test_benchmark_private_and_packing(spark, made):
    rows, items, folder = made
    docs = documents(spark, folder)
    clean = STAGES["benchmark"](spark, docs, folder)
    words = lambda t: re.findall(r"[0-9a-z]+", (t or "").lower())
    holds = lambda t: any(f" {' '.join(words(x))} " in f" {' '.join(words(t))} " for _, x in items if words(x))
    assert pairs(clean) == collections.Counter((i, t) for i, t in rows if not holds(t)) and len([1 for _, t in rows if holds(t)]) == 2
    hidden = pairs(STAGES["private"](spark, docs, folder))
    assert sum(hidden.values()) == len(rows) and not [t for _, t in hidden if t and re.search(r"555-7741|a\.b@|4111 1111 1111", t)]
    assert sum((collections.Counter((i, t) for i, t in rows) - hidden).values()) == 1
    library = load_tokenizer("word_bpe_49k.json")
    whole = collections.Counter()
    for i, t in rows:
        whole[i] += len(library.encode(t or "", add_special_tokens=False).ids) + 1
    packed, got = STAGES["packing"](spark, docs, folder).collect(), collections.Counter()
    for r in packed:
        got[r["doc_id"]] += r["length"]
        assert len(r["ids"]) == r["length"] and zlib.crc32(gam.np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
    assert got == whole


def test_empty_tables_go_through_all_stages(spark, made, tmp_path):
    _, _, folder = made
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert decontaminate.keep_clean(documents(spark, folder), spark.read.parquet(f"{tmp_path}/benchmark.parquet")).count() == documents(spark, folder).count()
