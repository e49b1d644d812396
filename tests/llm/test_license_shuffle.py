"""The license scan over more grams than are broadcast."""

import random
import re

from quarryline.llm import license_scan


def plain(rows):
    return sorted((str(r.asDict(recursive=True)) for r in rows))


def test_shuffled_templates_give_what_broadcast_ones_give(spark, monkeypatch):
    rng = random.Random(4)
    full = [f"{a}{b}" for a in ("term", "grant", "notice", "copy") for b in range(50)]
    texts = [" ".join(full), " ".join(full[66:]), "MIT license and apache license", None, "", "x " * 20_000 + " ".join(full), "cc by", *(" ".join(rng.choice(full[:9]) for _ in range(60)) for _ in range(40))]
    df = spark.createDataFrame([(i % 30, t, "w") for i, t in enumerate(texts)], "doc_id long, text string, w0 string").repartition(3)
    own = {"own": [" ".join(full)], "few": [" ".join(full[:9])]}
    want = plain(license_scan.license_scan(df, notices=own).collect())
    monkeypatch.setattr(license_scan, "_MOST_BROADCAST", 0)
    monkeypatch.setattr(license_scan, "_SALTS", 5)
    shuffled = license_scan.license_scan(df, notices=own)
    assert plain(shuffled.collect()) == want and len(want) == len(texts)
    told = shuffled._jdf.queryExecution().optimizedPlan().toString()
    join = told[told.index("Join Inner") :]
    assert not re.search(r"\bwords#", join.split("Project")[1])  # what is shuffled: a position with its three words


def test_a_template_of_a_hundred_thousand_grams_and_a_long_text(spark):
    long = [f"w{i}" for i in range(100_003)]
    texts = [" ".join(long[:70_000]), " ".join(["so"] * 20_000), "mit license", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_words"], r["labels"], [(s["label"], s["first_word"], s["end_word"]) for s in r["spans"]]) for r in license_scan.license_scan(df, notices={"long": [" ".join(long)]}).collect()}
    assert got == {0: (70_000, "long", [("long", 0, 70_000)]), 1: (20_000, "", []), 2: (2, "mit", []), 3: (0, "", [])}
