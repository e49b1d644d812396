"""Each operator against brute force on small tables: nulls, empty and long texts, repeats, empty tables, extra columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarryline.llm import chat_format, decontaminate, fertility, gam, license_scan, packing, pseudonyms, suffix_dedup
from quarryline.llm.common import shared_dir
from quarryline.llm.digest_cache import token_counts
from quarryline.llm.vocab import load_tokenizer, vocabulary

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
RNG = random.Random(5)
WORDS = ["alpha", "Beta", "gamma,", "délta", "the", "of", "Zeta.", "eta", "θeta", "iota", "x1"]


def prose(n):
    return " ".join(RNG.choice(WORDS) + (str(RNG.randrange(40)) if RNG.random() < 0.5 else "") for _ in range(n)) + RNG.choice(["", "\n", "\nend."])


BASE = prose(150)
TEXTS = [BASE, BASE, BASE + " tail", BASE.replace("alpha", "omega", 1), prose(60) + BASE[:500], None, "", "  \n ", "one", "one two", prose(4000), "a\n\nb\na\nb  c <|endoftext|> d", *[prose(RNG.randrange(5, 80)) for _ in range(12)]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", i, "k") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, key string").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_fertility_base_counts(docs, empty):
    got = by_id(fertility.fertility_rules(docs))
    for i, t in enumerate(TEXTS):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        repeated = {k + d for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for d in range(5)}
        seen, dup = set(), 0
        for line in (t or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(repeated))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(repeated) > 20 * len(words)) and not (r["kept"] and r["base_failed"])
    assert fertility.fertility_rules(empty).count() == 0


def test_fertility_measures_equal_the_library_and_each_rejects(spark, docs):
    model, ranks = vocabulary("piece", "piece_bpe_32k.model").model, vocabulary("rank", "byte_bpe_multi_50k.tiktoken").encoding
    got = by_id(fertility.fertility_rules(docs))
    for i, t in enumerate(TEXTS):
        ids, counts = model.encode(t or ""), collections.Counter(model.encode(t or ""))
        entropy = -sum(c / len(ids) * np.log2(c / len(ids)) for c in counts.values())
        share = sum(map(model.is_byte, ids)) / max(1, len(ids))
        want = (len(ids), len(t or "") / max(1, len(ids)), len(t or "") / max(1, len(ranks.encode_ordinary(t or ""))), share, entropy)
        assert np.allclose([got[i][c] for c in ("n_tokens", "chars_per_token", "chars_per_token_2", "byte_share", "token_entropy")], want)
    rng = random.Random(1)
    english = [w for w in "the of and house river stone letter number people country school water story paper city world life hand part child eye woman place work week case point company question government group problem fact with this from are by for was".split()]
    good = " ".join(rng.choice(english) for _ in range(900))
    noise = " ".join("".join(rng.choice("qxzjkvwbpQXZJK") for _ in range(7)) for _ in range(400))
    unknown = " ".join(rng.choice(english) + chr(0x10A00 + rng.randrange(60)) for _ in range(300))
    cyrillic = " ".join(rng.choice("дом река камень слово город жизнь рука часть место работа вопрос время люди страна школа вода".split()) + rng.choice(["", "а", "ы", "ом", "ами"]) for _ in range(300))
    df = spark.createDataFrame(list(enumerate([good, noise, unknown, cyrillic, good[:40] * 60])), "doc_id long, text string")
    wide = fertility.Band((0.0, 99.0), (0.0, 99.0), 1.0, ((60, 0.0),))
    bands = {k: fertility.Band(b.piece, b.rank, b.byte_share, ((60, 0.0),)) for k, b in fertility.BANDS.items()}
    alone = lambda **kw: [r["kept"] for r in sorted(fertility.fertility_rules(df, {k: fertility.Band(**{**vars(wide), **{f: getattr(bands[k], f) for f in kw}}) for k in bands}).collect())]
    assert alone(piece=1)[:2] == [True, False] and alone(rank=1)[:2] == [True, False] and alone(byte_share=1)[:3] == [True, True, False]
    rows = by_id(fertility.fertility_rules(df))
    assert [rows[i]["band"] for i in (0, 3)] == ["en", "cyrillic"] and [rows[i]["kept"] for i in range(4)] == [False, False, False, True]
    assert rows[0]["token_entropy"] < fertility.BANDS["en"].least_entropy(rows[0]["n_tokens"])  # 48 different words only


def test_chat_round_trip_and_rewriting_template(spark):
    rows = [(1, 0, "user", "a </turn> \\ <turn x>\n"), (1, 1, "assistant", "\\### ok"), (1, 2, "assistant", None), (2, None, None, "x"), (None, 1, "user", "n"), (3, 0, "assistant", "s" * 5000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_format.format_chats(df, window=4).collect()}
    assert set(got) == {1, 2, 3, None} and got[1]["n_turns"] == 3 and got[1]["n_rewrites"] == got[1]["n_unlocated"] == 0
    assert got[1]["loss_sha256"] == hashlib.sha256(b"\\### ok").hexdigest() and got[3]["loss_chars"] == 5000
    turns = [(r, t or "") for _, _, r, t in rows[:3]]
    assert chat_format.read_marked(chat_format.marked_turns(turns)) == turns
    forgets = lambda ts: "".join(f"[{r}]{t if r == 'user' or k == len(ts) - 1 else ''}|" for k, (r, t) in enumerate(ts))
    bad = {r["conv_id"]: r for r in chat_format.format_chats(df, forgets, read=lambda s: [], undo=str).collect()}
    assert bad[1]["n_rewrites"] == 1 and got[3]["n_rewrites"] == 0
    assert chat_format.format_chats(df.limit(0)).count() == 0


def _kept(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("most,part", [(2, 1 << 22), (2000, 1 << 22), (5, 700)])
def test_suffix_dedup_equals_brute_force(spark, docs, empty, most, part):
    got = by_id(suffix_dedup.remove_repeats(docs, length=50, gram=20, most=most, part=part))
    want = _kept(TEXTS, 50)
    assert [tuple(got[i])[1:] for i in range(len(TEXTS))] == want
    assert suffix_dedup.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("most", [3, 2000])
def test_suffix_dedup_of_many_contexts_and_of_rows_of_one_id(spark, most):
    """A passage in many contexts makes groups beyond `most`; rows of one id with different texts are different documents."""
    rng = random.Random(8)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, other = noise(130), noise(70)
    texts = [noise(rng.randrange(0, 90)) + passage + noise(rng.randrange(0, 90)) for _ in range(40)] + [noise(60) + other + passage[:90] + noise(20) for _ in range(12)] + ["ab" * 300, "a" * 500, noise(400), None, ""]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, noise(200) + other), (5, texts[5]), (None, passage), (None, noise(100))]
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, first int, gram string").repartition(4)
    got = sorted((tuple(r) for r in suffix_dedup.remove_repeats(df, length=50, gram=20, most=most).collect()), key=str)
    assert got == sorted(((i, *k) for (i, _), k in zip(rows, _kept([t for _, t in rows], 50), strict=True)), key=str)


def test_suffix_order_survives_hash_collisions(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "mix", lambda x: np.zeros_like(x))
    order = suffix_dedup.SuffixOrder([b"abc", b"abd", b"ab", b"b"])
    assert [order.suffixes[i] for i in order.order] == [b"ab", b"abc", b"abd", b"b"] and order.common == [0, 2, 2, 0]


def test_license_scan(spark, empty):
    texts = ["Under the MIT License, or (GNU General Public License) cc-by, CC BY-NC 4.0", None, "", "apache  LICENSE" * 2, "Permission is hereby granted, free of charge, to any one person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction", "nothing here"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(license_scan.license_scan(df))
    for i, t in enumerate(texts):
        words = re.findall(license_scan.WORD, (t or "").translate(ASCII))
        places = [(k, label) for phrase, label in license_scan.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (len(words), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[4]["labels"] == "mit" and got[4]["score"] < 1 and got[5]["labels"] == ""
    assert license_scan.license_scan(empty).count() == 0


def test_license_templates_of_any_length_and_rows_of_one_id(spark):
    full = [f"{a}{b}" for a in ("term", "grant", "notice", "copy") for b in range(50)]
    late, early = " ".join(full[66:]), " ".join(full[:60])
    changed = " ".join(w for k, w in enumerate(full) if k % 40 != 7)
    scattered = " ".join(f"{' '.join(full[k : k + 3])} {'filler ' * 9}" for k in range(0, 198, 3))
    texts = [" ".join(full), late, early, changed, scattered, "x " * 30_000 + " ".join(full), "MIT license", "mit license mit license", "a\u212a b\u212a", None]
    rows = [(i % 8 if i < 9 else None, t, 5) for i, t in enumerate(texts)] + [(6, "mit license", 1), (None, "apache license", 2), (6, "mit license", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    got = sorted(((r["doc_id"], r["n_words"], r["n_base"], r["labels"], round(r["score"], 3), [(s["label"], s["first_word"], s["end_word"]) for s in r["spans"]]) for r in license_scan.license_scan(df, notices={"own": [" ".join(full)], "k": ["ak bk"]}).collect()), key=str)
    own = lambda a, b: [("own", a, b)]
    assert got == sorted([(0, 200, 0, "own", 1.0, own(0, 200)), (1, 134, 0, "own", round(132 / 198, 3), own(0, 134)), (2, 60, 0, "", 0.0, []), (3, 195, 0, "own", round((198 - 15) / 198, 3), own(0, 195)), (4, 792, 0, "", 0.0, []), (5, 30_200, 0, "own", 1.0, own(30_000, 30_200)), (6, 2, 1, "mit", 1.0, []), (7, 4, 2, "mit", 1.0, []), (0, 2, 0, "", 0.0, []), (None, 0, 0, "", 0.0, []), (6, 2, 1, "mit", 1.0, []), (None, 2, 1, "apache", 1.0, []), (6, 2, 1, "mit", 1.0, [])], key=str)


def test_token_counts_and_cache(spark, docs, empty):
    path = f"{shared_dir(spark)}/cache-test"
    library = load_tokenizer("byte_bpe_50k.json")
    for _ in range(2):
        got = by_id(token_counts(docs, path))
        for i, t in enumerate(TEXTS):
            n = len(library.encode(t or "", add_special_tokens=False).ids)
            assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 1024)
        assert spark.read.parquet(path).count() == len({t or "" for t in TEXTS})
    assert token_counts(empty, path).count() == 0


@pytest.mark.parametrize("kind,name", [("word", "word_bpe_49k.json"), ("byte", "byte_bpe_50k.json"), ("piece", "piece_bpe_32k.model")])
def test_cached_vocabularies_equal_the_library(kind, name):
    odd = ["a  b", " a", "a ", "a\n\n b", "I'LL don't x’s", "é x ́y", "日本 語", "\x00 a\x1cb c", "ǅ İi 12 3½", "x <|endoftext|> <|startoftext|>", "a\r\n b"]
    v = vocabulary(kind, name, None, 50)
    if kind == "piece":
        ranks = vocabulary("rank", "byte_bpe_multi_50k.tiktoken", None, 50)
        rng = random.Random(2)
        odd += ["".join(rng.choice(["a", "é", " ", "\n", "日", " x", "the ", "ß", "▁", "\t", "1"]) for _ in range(rng.randrange(20))) for _ in range(3000)]
        for t in [*odd, *(t for t in TEXTS if t), ""]:
            assert v.ids(t).tolist() == v.model.encode(t), t
            assert ranks.count(t) == len(ranks.encoding.encode_ordinary(t)), t
        return
    for t in [*odd, *(t for t in TEXTS if t)]:
        assert v.ids(t).tolist() == v.tokenizer.encode(t, add_special_tokens=False).ids


def test_gam_learns_an_interaction_and_ignores_held_out(spark, docs):
    rng = np.random.default_rng(0)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = gam.fit_gam(x[:3000], y[:3000], rounds=20, pair_rounds=40)
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95 and (0, 1) in model.pairs
    assert gam.fit_gam(np.zeros((0, 16)), np.zeros(0)).score(np.zeros((1, 16)))[0] == 0.5
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(TEXTS))] + [(3, None, 0)], "doc_id long, quality int, toxic int")
    got = by_id(gam.quality_scores(docs, labels))
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for i, r in got.items())
    flipped = labels.withColumn("quality", F.when(gam.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {i: r["score"] for i, r in by_id(gam.quality_scores(docs, flipped)).items()} == {i: r["score"] for i, r in got.items()}


def test_pseudonyms(spark, empty):
    def luhn(s):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0

    text = "pay 4111 1111 1111 1111 or 4111111111111112, call +1 (309) 555-7741, 10.0.0.300 1.2.3.4 on 2024-02-29 and 30.02.2023 ssn 123-45-6789 a.b@example.com password=abcdef1234567"
    df = spark.createDataFrame([(1, text), (2, text), (3, None), (4, ""), (5, "4111-1111-1111-1111")], "doc_id long, text string")
    got = by_id(pseudonyms.pseudonymise(df, "k"))
    out = got[1]["text"]
    assert out == got[2]["text"] and got[3]["text"] is None and got[4]["text"] == ""
    for secret in ("4111 1111 1111 1111", "(309) 555-7741", "1.2.3.4", "123-45-6789", "a.b@", "abcdef1234567"):
        assert secret not in out
    for plain in ("4111111111111112", "10.0.0.300", "30.02.2023", "@example.com", "2024-"):
        assert plain in out
    card = re.search(r"pay ([\d ]{19})", out)[1].replace(" ", "")
    assert luhn(card) and got[5]["text"].replace("-", "") == card
    assert {k: got[1][f"n_{k}"] for k in pseudonyms.KINDS} == {"email": 1, "ssn": 1, "date": 1, "ipv4": 1, "ipv6": 0, "phone": 1, "card": 1, "iban": 0, "secret": 1}
    assert by_id(pseudonyms.pseudonymise(df, "other"))[1]["text"] != out and pseudonyms.pseudonymise(empty, "k").count() == 0


def test_pseudonyms_of_more_formats(spark, empty):
    cases = {
        "Password: Hunter2hunter2x": "secret", "API_KEY=abcdef0123456789": "secret", "ghp_abcdefghijklmnopqrstuvwxyz0123456789": "secret", "(309) 555-7741": "phone", "309-555-7741": "phone", "03/25/2024": "date", "25/03/2024": "date",
        "2024-02-29T10:00:00Z": "date", "GB82 WEST 1234 5698 7654 32": "iban", "DE89370400440532013000": "iban", "2001:0db8:85a3:0000:0000:8a2e:0370:7334": "ipv6", "fe80::1ff:fe23:4567:890a": "ipv6", "4000000000002": None, "378282246310005": "card", "6011111111111117": "card",
        "9000000000000001": None, "GB82WEST12345698765433": None, "12:30:45": None, "31/31/2024": None, "2024-02-30": None, "192.168.1.1": "ipv4", "4222222222222": "card",
    }
    rows = [(i, f"see {v} now", "x", 1) for i, v in enumerate(cases)] + [(99, "x " * 100_000 + "ssn 123-45-6789", "y", 2), (99, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string, secret int")
    out = pseudonyms.pseudonymise(df, "own secret key")
    got = out.collect()
    for (value, kind), r in zip(cases.items(), got, strict=False):
        counts = {k: r[f"n_{k}"] for k in pseudonyms.KINDS if r[f"n_{k}"]}
        assert counts == ({kind: 1} if kind else {}), value
        assert (r["text"] == f"see {value} now") == (kind is None) and (kind == "ipv4" or len(r["text"]) == len(value) + 8), (value, r["text"])
    mod = lambda s: int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97
    for i, value in enumerate(cases):
        new = got[i]["text"][4:-4]
        if cases[value] == "iban":
            assert mod(new.replace(" ", "")) == 1 and [c == " " for c in new] == [c == " " for c in value]
        again = pseudonyms.pseudonymise(df.where(df.doc_id == i).withColumn("text", F.lit(got[i]["text"])), "own secret key").collect()[0] if cases[value] in ("card", "iban") else None
        assert again is None or again[f"n_{cases[value]}"] == 1
    assert got[-2]["n_ssn"] == 1 and got[-1]["text"] is None
    kept = pseudonyms.pseudonymise(df, "own secret key", keep_columns=True)
    assert kept.columns == df.columns and [(r["found"], r["secret"]) for r in kept.collect()] == [(r[2], r[3]) for r in rows]
    out.collect()
    assert "own secret key" not in out._jdf.queryExecution().toString()


def test_feistel_is_a_permutation_that_can_be_undone(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d")).withColumn("e", pseudonyms.permute_digits(F.col("d"), "k", F.lit("t")))
    rows = df.withColumn("back", pseudonyms.permute_digits(F.col("e"), "k", F.lit("t"), decrypt=True)).collect()
    assert len({r["e"] for r in rows}) == 1000 and all(r["back"] == r["d"] and len(r["e"]) == 3 for r in rows)


def test_packing(docs, empty):
    rows = packing.pack_documents(docs, buffer_docs=9).collect()
    library = load_tokenizer("word_bpe_49k.json")
    pieces, places = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append(r)
    for i, t in enumerate(TEXTS):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for window in places.values():
        at = 0
        for r in sorted(window, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and (at & (at - 1)) == 0
    assert packing.pack_documents(empty).count() == 0


def test_decontamination_finds_paraphrases_and_leaves_the_rest(spark, empty):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 6)))
    lexicon = [word() for _ in range(400)]
    text = lambda n: " ".join(rng.choice(lexicon) for _ in range(n))
    items = [(i, text(40)) for i in range(5)] + [(9, None), (10, "too short")]
    rows = [(i, text(200)) for i in range(60)] + [(100 + i, f"{text(50)} {t} {text(30)}") for i, t in items[:5]]
    changed = items[0][1].split()
    for k in range(3, 40, 9):
        changed[k] = "swapped"
    rows += [(200, f"{text(60)} {' '.join(changed)} {text(9)}"), (300, None), (301, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.decontaminate(df, bench).collect()}
    assert found == {(100 + i, i) for i in range(5)} | {(200, 0)}
    clean = decontaminate.keep_clean(df.withColumn("item_id", F.lit(1)).withColumn("c0", F.lit("x")), bench.withColumn("doc_id", F.lit(1)))
    assert {r["doc_id"] for r in clean.collect()} == {*range(60), 300, 301}
    assert decontaminate.decontaminate(empty, bench).count() == 0 and decontaminate.decontaminate(df, bench.limit(0)).count() == 0


def test_decontamination_of_a_large_benchmark_in_blocks(spark, monkeypatch):
    items = spark.range(100_001).select(F.col("id").alias("item_id"), F.concat_ws(" ", *[F.concat(F.lit(chr(97 + k)), F.hex(F.xxhash64("id", F.lit(k)))) for k in range(9)]).alias("text"))
    blocks = list(decontaminate.benchmark_items(items))
    assert len(blocks) == 3 and sum(map(len, blocks)) == 100_001 and max(map(len, blocks)) < 40_000
    some = [x for b in blocks for x in b[:2]]
    rows = [(k, f"some words before {t} and behind") for k, (_, t) in enumerate(some)] + [(99, "none here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    own = decontaminate.benchmark_items
    monkeypatch.setattr(decontaminate, "benchmark_items", lambda b: own(b, 3))
    small = spark.createDataFrame([*some, (None, "none here")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.decontaminate(df, small).collect()} == {(k, i) for k, (i, _) in enumerate(some)} | {(99, -1)}
    assert [r["doc_id"] for r in decontaminate.keep_clean(df, small).collect()] == []


def test_lcs_by_bits():
    for _ in range(50):
        a, b = ([RNG.randrange(4) for _ in range(RNG.randrange(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        masks = collections.defaultdict(int)
        for i, x in enumerate(a):
            masks[x] |= 1 << i
        assert decontaminate.lcs_length(masks, len(a), b) == table[-1][-1]


def test_decontamination_recall_against_brute_force(spark):
    """Every span of twice the item's length that passes is found, at each item length and rewrite rate; short items verbatim."""
    rng = random.Random(7)
    lexicon = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 6))) for _ in range(500)]
    text = lambda n: [rng.choice(lexicon) for _ in range(n)]
    items = [(n * 10 + i, text(n)) for n in (2, 5, 8, 10, 24, 40, 90) for i in range(4)]
    docs, planted = [(k, text(60)) for k in range(100)], {}
    for item, words in items:
        for rate in (0, 20, 30, 40):
            if not rate or len(words) >= 8:
                doc = 1000 + len(planted)
                planted[doc] = (item, rate)
                docs.append((doc, text(37) + [rng.choice(lexicon) if rng.random() * 100 < rate else w for w in words] + text(35)))
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id long, text string").coalesce(2)
    bench = [(i, " ".join(w)) for i, w in items]
    search = decontaminate.Decontaminator(decontaminate.fit_latent(df), bench)
    index = decontaminate.ItemIndex(bench, search.latent, search.min_words, search.answer_part)
    hashed = lambda words: decontaminate.words_of(*decontaminate.texts_of(decontaminate.pa.array([" ".join(words)])), decontaminate.LETTERS)[2].tolist()
    want = collections.Counter()
    got = {(r["doc_id"], r["item_id"]) for r in search.matches(df).collect()}
    for doc, words in docs:
        h = hashed(words)
        for k, item in enumerate(index.ids):
            n = int(index.sizes[k])
            width = 2 * n if n >= search.min_words else n
            passes = False
            for s in range(len(h)):
                span = h[s : s + width]
                if n < search.min_words:
                    passes |= span == index.words[k]
                elif len(index.answers[k].intersection(span)) / len(index.answers[k]) >= search.min_answer:
                    passes |= decontaminate.lcs_length(index.masks[k], n, span) / n >= search.min_lcs
                if passes:
                    break
            if passes:
                want[(n, planted.get(doc, (None, None))[1])] += 1
                assert (doc, item) in got, (n, planted.get(doc))
    assert all(want[n, 0] >= 4 for n in (2, 5, 8, 10, 24, 40, 90)) and all(want[n, 30] for n in (8, 10, 24, 40, 90))


def test_operators_return_their_content(spark, docs):
    got = by_id(suffix_dedup.deduplicate(docs, length=50, gram=20))
    for i, (size, gone, runs, digest) in enumerate(_kept(TEXTS, 50)):
        raw, spans = (TEXTS[i] or "").encode(), [(s["start"], s["end"]) for s in got[i]["removed"]]
        kept = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), size], strict=True))
        assert bytes(got[i]["kept"]) == kept and hashlib.sha256(kept).hexdigest() == digest and (sum(e - s for s, e in spans), len(spans)) == (gone, runs)
    library = load_tokenizer("word_bpe_49k.json")
    whole = {i: library.encode(t or "", add_special_tokens=False).ids + [1] for i, t in enumerate(TEXTS)}
    sequences = collections.defaultdict(list)
    for r in sorted(packing.pack_documents(docs, buffer_docs=9).collect(), key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["ids"] == whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        sequences[r["sequence_id"], r["sequence_length"]] += r["ids"]
    assert all(len(ids) == n for (_, n), ids in sequences.items())
    turns = [("user", "a </turn>"), ("assistant", "b \\"), ("user", "c"), ("assistant", "dé")]
    df = spark.createDataFrame([(1, k, *t) for k, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    (r,) = chat_format.format_chats(df).collect()
    assert r["formatted"] == chat_format.marked_turns(turns) and hashlib.sha256(r["formatted"].encode()).hexdigest() == r["formatted_sha256"]
    assert [chat_format.unescape(r["formatted"][s["start"] : s["end"]]) for s in r["loss_spans"]] == ["b \\", "dé"]


def test_chat_renders_whole_prefixes_of_any_template(spark):
    turns = [("assistant" if k % 2 else "user", f"t{k}") for k in range(40)]
    df = spark.createDataFrame([(1, k, *t) for k, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    numbers = lambda ts: "".join(f"{k}[{r}]{t}|" for k, (r, t) in enumerate(ts))
    (r,) = chat_format.format_chats(df, numbers, read=lambda s: [], undo=str, window=8).collect()
    assert r["formatted"] == numbers(turns) and r["n_cut"] == r["n_rewrites"] == r["n_unlocated"] == 0
    (r,) = chat_format.format_chats(df, window=8).collect()
    assert r["formatted"] == chat_format.marked_turns(turns) and r["n_cut"] == 32


def test_quality_on_held_out_labels(spark):
    """On the labels that the fit never saw: ranked and told apart."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = gam.quality_scores(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good, bad = [r["score"] for r in rows if r["quality"] == 1], [r["score"] for r in rows if r["quality"] == 0]
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert len(rows) > 700 and auc > 0.99 and np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.98


def test_rows_of_one_id_null_ids_extra_columns_and_long_texts(spark):
    """Each row counts as a row of its own in the operators that judge row by row."""
    long = prose(30_000)
    rows = [(1, BASE, "q", 1, "f"), (1, BASE, "q", 1, "f"), (1, "another text", "q", 2, "f"), (None, BASE, None, None, None), (None, None, None, None, None), (2, long, "q", 3, "f"), (3, "", "q", 4, "f")]
    df = spark.createDataFrame(rows, "doc_id long, text string, kept string, score int, f string").repartition(3)
    same = lambda got: sorted(((r["doc_id"], r[1]) for r in got), key=str)
    sizes = lambda f: sorted(((i, f(t or "")) for i, t, *_ in rows), key=str)
    library = load_tokenizer("byte_bpe_50k.json")
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert same(fertility.fertility_rules(df).collect()) == sizes(words)
    assert same(license_scan.license_scan(df).collect()) == sizes(lambda t: len(re.findall(license_scan.WORD, t.translate(ASCII))))
    assert same(token_counts(df, f"{shared_dir(spark)}/cache-rows").select("doc_id", "n_tokens").collect()) == sizes(lambda t: len(library.encode(t, add_special_tokens=False).ids))
    assert same(pseudonyms.pseudonymise(df, "k").select("doc_id", F.length("text")).collect()) == sorted(((i, len(t) if t is not None else None) for i, t, *_ in rows), key=str)
    scores = gam.quality_scores(df, spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, quality int")).collect()
    assert sorted((r["doc_id"] for r in scores), key=str) == sorted((r[0] for r in rows), key=str) and not [r for r in scores if r["doc_id"] is None and r["held_out"]]
    pieces = packing.pack_documents(df).collect()
    word = load_tokenizer("word_bpe_49k.json")
    assert sum(r["length"] for r in pieces) == sum(1 + len(word.encode(t or "", add_special_tokens=False).ids) for _, t, *_ in rows)
    chats = spark.createDataFrame([(1, 1, "assistant", "a", "x"), (1, 1, "assistant", "a", "y"), (1, 0, "user", "b" * 200_000, "z")], "conv_id long, turn long, role string, text string, formatted string")
    (r,) = chat_format.format_chats(chats).collect()
    assert r["n_turns"] == 3 and r["loss_chars"] == 2
