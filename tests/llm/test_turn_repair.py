import hashlib
import itertools
import random
import re
import zlib

import pytest

from quarryline.llm import turn_repair as tr

SOUND = re.compile("(s?(ua)+)?")
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = BLANK.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_force(rows, most_inserts=3):
    """The cheapest (cost, audit, repaired rows), by trying all edits and up to so many inserts in each gap."""
    best = None
    kinds = faults(rows)
    choices = []
    for (_, role, text), fault in zip(rows, kinds, strict=True):
        own = [(2, "D", None)]
        if fault not in ("blank", "duplicate"):
            extra = 5 * (fault == "truncated")
            own += [(extra, "K", (role, text))] + [(1 + extra, "R", (r, text)) for r in ("user", "assistant")]
        choices.append(own)
    gaps = [list(itertools.chain.from_iterable(itertools.product(("user", "assistant"), repeat=n) for n in range(most_inserts + 1))) for _ in range(len(rows) + 1)]
    for edits in itertools.product(*choices):
        base = sum(e[0] for e in edits)
        if best and base > best[0]:
            continue
        for inserts in itertools.product(*gaps):
            cost = base + 5 * sum(map(len, inserts))
            if best and cost > best[0]:
                continue
            out, audit = [(r, "") for r in inserts[0]], "I" * len(inserts[0])
            for e, more in zip(edits, inserts[1:], strict=True):
                out += [e[2]] if e[2] else []
                out += [(r, "") for r in more]
                audit += e[1] + "I" * len(more)
            initials = [r[:1] for r, _ in out]
            if all(initials) and SOUND.fullmatch("".join(initials)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


def expected(rows):
    """By a search from left to right over the four states."""
    kinds = faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    best = {0: (0, "", ())}

    def better(now, state, new):
        if state not in now or new[:2] < now[state][:2]:
            now[state] = new

    def inserted(now):
        for _ in range(3):
            for s, (c, a, said) in list(now.items()):
                role = "assistant" if s == 2 else "user"
                better(now, 3 if s == 2 else 2, (c + 5, a + "I", (*said, f"{role}:")))
        return now

    for (_, role, text), fault in zip(rows, kinds, strict=True):
        best, now = inserted(best), {}
        for s, (c, a, said) in best.items():
            better(now, s, (c + 2, a + "D", said))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 * (fault == "truncated")
            for new in ("system", "user", "assistant"):
                if (new == "system" and s != 0) or (new == "user" and s == 2) or (new == "assistant" and s != 2):
                    continue
                to = {"system": 1, "user": 2, "assistant": 3}[new]
                if role[:1] == new[:1]:
                    better(now, to, (c + extra, a + "K", (*said, f"{role}:{text}")))
                elif new != "system":
                    better(now, to, (c + 1 + extra, a + "R", (*said, f"{new}:{text}")))
        best = now
    best = inserted(best)
    cost, audit, said = min(best[s] for s in (0, 3) if s in best)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, **{k: kinds.count(k) for k in ("blank", "duplicate", "truncated")},
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(said).encode()).hexdigest(),
    }


TEXTS = ["Yes.", "No", " ", "", "Why?", "a\n", "b! \t", "Yes.", "é…", "x.\x0b"]
ROLES = ["user", "assistant", "system", "tool", "", " ", "use", "assistant", "user"]


def conversation(rng, n):
    return sorted(((rng.randrange(n + 2), rng.choice(ROLES), rng.choice([*TEXTS, f"t{rng.randrange(9)}."])) for _ in range(n)), key=lambda r: (r[0], r[1], hashlib.sha256(r[2].encode()).hexdigest()))


def test_left_to_right_search_equals_brute_force():
    rng = random.Random(0)
    for _ in range(150):
        rows = conversation(rng, rng.randrange(0, 4))
        cost, audit, out = brute_force(rows, 2)
        want = expected(rows)
        assert (cost, audit) == (want["cost"], want["audit"]), rows
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest() == want["repaired_sha256"]


def test_products_are_associative_and_ends_meet():
    rng = random.Random(1)
    for _ in range(200):
        rows = conversation(rng, rng.randrange(2, 40))
        kinds = faults(rows)
        cut = rng.randrange(1, len(rows))
        a, b, both = tr.Stretch(), tr.Stretch(), tr.Stretch()
        for k, ((turn, role, _), fault) in enumerate(zip(rows, kinds, strict=True)):
            (a if k < cut else b).add(turn, role[:1], fault)
            both.add(turn, role[:1], fault)
        joined = tr.Stretch()
        joined.append(a.row())
        joined.append(b.row())
        order = lambda row: {**row, "entries": None, "costs": None, "audits": sorted(zip(map(tuple, row["entries"]), row["costs"], row["audits"], strict=True))}
        assert order(joined.row()) == order(both.row())
        assert tr.cheapest(joined.matrix()) == (expected(rows)["cost"], expected(rows)["audit"])


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_repair_equals_the_search_in_blocks_of_any_size(spark, block):
    rng = random.Random(block)
    chats = {i: conversation(rng, rng.randrange(1, 12)) for i in range(40)} | {99: conversation(rng, 400), None: conversation(rng, 5)}
    rows = [(c, t, r, x, "extra", 1) for c, some in chats.items() for t, r, x in some]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, digest string, kind int").repartition(5)
    got = {r["conv_id"]: r.asDict() for r in tr.repair_report(df, df, block).collect()}
    assert got == {c: {"conv_id": c, **expected(some)} for c, some in chats.items()}
    turns = tr.repaired_turns(df, tr.conversation_edits(df, block)).where("conv_id = 99").orderBy("place").collect()
    assert SOUND.fullmatch("".join(r["role"][:1] for r in turns)) and [r["place"] for r in turns] == list(range(len(turns)))


def test_nulls_empty_tables_and_null_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    empty = spark.createDataFrame([], schema)
    assert tr.repair_report(empty, empty).count() == 0
    rows = [(1, None, "user", "Hi."), (1, 4, None, "Hm."), (1, 2, "assistant", None), (1, None, "user", "Hi."), (2, None, "user", "a" * 300_000 + "."), (3, 1, "user", "gone")]
    df = spark.createDataFrame(rows, schema)
    got = {r["conv_id"]: r.asDict() for r in tr.repair_report(df.where("conv_id < 3"), df).collect()}
    filled = [(None, "user", "Hi."), (None, "user", "Hi."), (2, "assistant", " "), (4, " ", "Hm.")]
    assert got[1] == {"conv_id": 1, **expected(filled)} and got[1]["gaps"] == 1 and got[1]["audit"] == "KDDR"
    assert got[2] == {"conv_id": 2, **expected([(None, "user", "a" * 300_000 + ".")])} and got[2]["gaps"] == 0
    assert got[3] == {"conv_id": 3, **expected([])} and got[3]["audit"] == ""


def test_damage_follows_the_checksum(spark):
    rows = [(c, t, "assistant", f"Say {c}. Or {t}?") for c in range(30) for t in range(8)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = []
    for c, t, r, x in rows:
        what = zlib.crc32(f"{c}:{t}".encode()) % 20
        if what:
            row = (c, t, "user" if what == 4 else r, "" if what == 1 else re.sub("[.!?]", "", x) if what == 2 else x)
            want += [row] * (1 + (what == 3))
    assert sorted(map(tuple, tr.damaged(df).collect())) == sorted(want)
