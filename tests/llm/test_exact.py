"""Pseudonyms against a plain-Python twin for every kind and length, and token counts of texts that need the cache."""

import hashlib
import random
import re
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import pseudonyms
from quarryline.llm.common import shared_dir
from quarryline.llm.digest_cache import token_counts
from quarryline.llm.gam import FEATURES, fit_quality
from quarryline.llm.vocab import ByteVocabulary, load_tokenizer

KEY, ROUNDS = "twin key", 10


def twin(left, right, a, b, tweak):
    for i in range(ROUNDS):
        told = int(hashlib.sha256("|".join([KEY, tweak, str(i), str(right if i % 2 == 0 else left), KEY]).encode()).hexdigest()[:15], 16)
        left, right = ((left + told) % a, right) if i % 2 == 0 else (left, (right + told) % b)
    return left, right


def twin_digits(d, tweak):
    half = len(d) // 2
    rest = len(d) - half
    x, y = twin(int(d[:half]), int(d[half:]), 10**half, 10**rest, tweak + str(len(d)))
    return f"{x:0{half}}{y:0{rest}}"


def luhn_digit(d):
    return str(-sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(d))) % 10)


def refill(shape, digits):
    it = iter(digits)
    return re.sub("[0-9]", lambda _: next(it), shape)


def with_check(country, body):
    n = int("".join(str(int(c, 36)) for c in (body + country + "00").replace(" ", "")))
    return f"{country}{98 - n % 97:02}{body}"


def cases(rng):
    """kind -> {value: pseudonym by the twin}"""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    out = {k: {} for k in ("card", "iban", "phone", "ipv4", "ssn", "date")}
    for first, n in (("4", 13), ("4", 16), ("4", 19), ("51", 16), ("2221", 16), ("34", 15), ("30", 14), ("38", 19), ("352", 16), ("6", 17), ("6", 18)):
        for _ in range(40):
            d = first + digits(n - 1 - len(first))
            new = d[:4] + twin_digits(d[4:], "card" + d[:4])
            out["card"][d + luhn_digit(d)] = new + luhn_digit(new)
    for n in (11, 12, 15, 18, 19, 20, 23, 27, 28, 30):
        for _ in range(60):
            country, body = rng.choice(["FR", "DE", "MT"]), digits(n)
            body = body if n % 4 else body[:-4] + "ABCD"
            own = re.sub("[^0-9]", "", body)
            out["iban"][with_check(country, body)] = with_check(country, refill(body, twin_digits(own, "iban" + country)))
    for n in (7, 8, 10, 12):
        for _ in range(60):
            d = digits(n)
            shape = lambda x: "+49 " + " ".join([x[:3], x[3:5], *(x[i : i + 3] for i in range(5, len(x) - 1, 3))]) if n in (8, 7) else "+49 " + " ".join(x[i : i + 2] for i in range(0, n, 2))  # noqa: E731, B023
            if n in (10, 12, 8):
                show = (lambda x: "+49 " + " ".join(x[i : i + 4] for i in range(0, len(x), 4))) if n != 10 else shape
                out["phone"][show(d)] = show(twin_digits(d, "phone+49"))
    for _ in range(300):
        o = [rng.randrange(256) for _ in range(4)]
        x, y = twin(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, "ipv4")
        out["ipv4"][".".join(map(str, o))] = f"{x >> 8}.{x % 256}.{y >> 8}.{y % 256}"
        area, group, serial = rng.choice([a for a in range(1, 900) if a != 666]), rng.randrange(1, 100), rng.randrange(1, 10_000)
        x, y = twin((area - 2 if area > 666 else area - 1) * 99 + group - 1, serial - 1, 898 * 99, 9999, "ssn")
        at = x // 99
        out["ssn"][f"{area:03}-{group:02}-{serial:04}"] = f"{at + 2 if at >= 665 else at + 1:03}-{x % 99 + 1:02}-{y + 1:04}"
    for year in (1999, 2000, 2024):
        leap = year != 1999
        a, b = (6, 61) if leap else (5, 73)
        for n in range(366 if leap else 365):
            x, y = twin(n // b, n % b, a, b, f"date{year}")
            out["date"][str(date(year, 1, 1) + timedelta(n))] = str(date(year, 1, 1) + timedelta(x * b + y))
    return out


def test_pseudonyms_equal_a_plain_twin_for_every_kind_and_length(spark):
    known = cases(random.Random(3))
    df = spark.createDataFrame([(k, v, new) for k, some in known.items() for v, new in some.items()], "kind string, text string, expected string")
    kinds = F.concat_ws(",", *[F.when(F.col(f"n_{k}") > 0, F.lit(k)) for k in pseudonyms.KINDS])
    got = pseudonyms.pseudonymise(df.withColumn("doc_id", F.monotonically_increasing_id()), KEY).select("doc_id", F.col("text").alias("new"), kinds.alias("found"))
    rows = df.withColumn("doc_id", F.monotonically_increasing_id()).join(got, "doc_id").collect()
    assert len(rows) == sum(map(len, known.values()))
    assert [(r["kind"], r["text"], r["new"]) for r in rows if r["found"] != r["kind"] or r["new"] != r["expected"]] == []


@pytest.mark.parametrize("n", [19, 20, 23, 26, 30])
def test_long_ibans_and_names_stay_different(spark, n):
    body = F.lpad((F.col("id") * 7919 + 10**9).cast("string"), n, "7")
    total = lambda c: F.aggregate(F.split(c, ""), F.lit(0), lambda s, d: F.when(d == "", s).otherwise((s * 10 + d.cast("int")) % 97))
    check = F.lpad((98 - total(F.concat(body, F.lit("152700")))).cast("string"), 2, "0")
    ibans = spark.range(10_000).select("id", F.concat(F.lit("FR"), check, body, F.lit(f" u{n}x"), F.col("id").cast("string"), F.lit("@example.com")).alias("text"))
    out = pseudonyms.pseudonymise(ibans, KEY, id_col="id")
    row = out.agg(F.countDistinct(F.split("text", " ")[0]).alias("ibans"), F.countDistinct(F.split("text", " ")[1]).alias("names"), F.sum("n_iban").alias("n"), F.sum("n_email").alias("m")).first()
    assert (row["ibans"], row["names"], row["n"], row["m"]) == (10_000,) * 4


def strange_words(seed):
    rng = random.Random(seed)
    alphabets = ["абвгдежзиклмнопрстуфхцчшщ", "日本語中文字漢的一是不了人我在有他这为之", "don’tcan’tit’sabcdefgh", "αβγδεζηθικλμνξο", "אבגדהוזחטי", "😀🎉a‍é"]
    return [["".join(rng.choice(a) for _ in range(rng.randrange(1, 9))) for _ in range(5000)] for a in alphabets]


@pytest.mark.parametrize("limit", [50, 3000, 400_000])
def test_counts_of_many_words_outside_latin_equal_the_library(limit):
    v = ByteVocabulary(limit=limit)
    for words in strange_words(limit):
        for at in (0, 7, 1500, 0):
            text = " ".join(words[at:])
            assert v.count(text) == len(v.tokenizer.encode(text, add_special_tokens=False).ids)


def test_token_counts_of_texts_that_need_the_cache(spark):
    texts = [" ".join(w[at : at + 1700]) for w in strange_words(1) for at in range(0, 5000, 1700)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    library = load_tokenizer("byte_bpe_50k.json")
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(df, f"{shared_dir(spark)}/strange-cache").collect()}
    assert got == {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_an_id_that_repeats_is_learnt_from_once(spark):
    rng = random.Random(5)
    rows = [(i, [float(i % 2) + rng.random() / 9] * len(FEATURES)) for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, f array<float>")
    often = once.union(spark.createDataFrame([rows[1]] * 5000, once.schema))
    a, b = fit_quality(once, labels), fit_quality(often, labels.union(labels))
    x = [[0.05] * len(FEATURES), [1.05] * len(FEATURES)]
    one, other = a.score(np.array(x)), b.score(np.array(x))
    assert np.array_equal(one, other) and one[0] < 0.5 < one[1]
