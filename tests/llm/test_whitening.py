import math

import numpy as np
import pytest

from quarryline.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, v int"


def exact(vectors):
    """By numpy over the whole matrix."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 100_000
    n = len(x)
    top = n * x - x.sum(0)
    centred = top / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    return (top**2).sum(1), centred @ parts[:, :8] / np.sqrt(values[:8]), values[:8] / values.sum()


@pytest.mark.parametrize("decay,expands", [(0.6, False), (0.97, True)])
def test_whitening_equals_numpy(spark, decay, expands):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((700, 24)) * decay ** np.arange(24) * 3 + rng.standard_normal(24)) @ np.linalg.qr(rng.standard_normal((24, 24)))[0]
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(vectors)], SCHEMA).repartition(7)
    deviation, white, explained = exact(vectors)
    got = whitening.by_component(whitening.whiten(df)).collect()
    assert len(got) == 700 * 8 and {r["n"] for r in got} == {700} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    own = np.zeros((700, 8))
    for r in got:
        assert r["deviation"] == deviation[r["vec_id"]] and math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-9)
        own[r["vec_id"], r["component"] - 1] = r["whitened"]
    own *= np.sign((own * white).sum(0))
    assert np.abs(own - white).max() < 1e-6
    rows = whitening.complete(df)
    assert whitening.components(rows, whitening.fit_list(rows), passes=3 if expands else 12).expanded == expands


def test_sum_groups_keep_integers_exact(spark):
    df = spark.range(0, 5000, 1, 60).selectExpr("id AS vec_id", "array(float(id % 7), float(-id)) AS embedding")
    fit = whitening.fit_list(whitening.complete(df))
    assert (fit.n, fit.sums.tolist()) == (5000, [sum(1024 * (i % 7) + 100_000 for i in range(5000)), sum(-1024 * i + 100_000 for i in range(5000))])


def test_nulls_ties_ranks_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 0.5], 0), (2, [0.0, 2.0, 0.5], 0), (2, [0.0, 2.0, 0.5], 0), (None, [1.0, 3.0, 0.5], 0), (3, None, 0), (4, [], 0), (5, [1.0, None, 2.0], 0), (6, [nan, 1.0, 1.0], 0), (7, [1.0, 1.0, -inf], 0), (8, [9.0, 9.0], 0)]
    got = whitening.by_component(whitening.whiten(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sorted((str(r["vec_id"]), r["component"]) for r in got) == sorted((i, c) for i in ("1", "2", "2", "None") for c in (1, 2))
    assert {r["n"] for r in got} == {4} and got[0]["identity_error"] < 1e-9
    for few in ([], rows[4:7], [rows[0]], [rows[1], rows[2]]):
        assert whitening.by_component(whitening.whiten(spark.createDataFrame(few, SCHEMA))).count() == 0
    huge = spark.createDataFrame([(1, [1e30, 0.0], 0), (2, [-3e38, 1.0], 0), (3, [0.0, 2.0], 0)], SCHEMA)
    out = whitening.by_component(whitening.whiten(huge)).collect()
    x = [[whitening.MOST + whitening.SHIFT, 100_000], [-whitening.MOST + whitening.SHIFT, 101_024], [100_000, 102_048]]
    want = {i + 1: sum((3 * a - sum(r[k] for r in x)) ** 2 for k, a in enumerate(row)) for i, row in enumerate(x)}
    assert {(r["vec_id"], r["deviation"]) for r in out} == {(i, d if d < 1 << 63 else None) for i, d in want.items()}
