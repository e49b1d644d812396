"""Keyed changes of catalog tables."""

import uuid
from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline.sources.lake import Lake

SCHEMA = "k string, v long, at long, day date"


@pytest.fixture
def lake(spark):
    name = f"lake_{uuid.uuid4().hex[:8]}"
    yield Lake(spark, name, buckets=4)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def frame(spark, rows):
    return spark.createDataFrame([(k, v, at, date(2026, 3, d) if d else None) for k, v, at, d in rows], SCHEMA)


def rows_of(lake):
    return sorted((r["k"], r["v"], r["day"] and r["day"].day) for r in lake.read("t").collect())


def test_a_corrected_day_leaves_one_row_and_only_touched_days_are_written(spark, lake):
    lake.upsert("t", frame(spark, [("a", 1, 1, 1), ("b", 2, 1, 1), ("c", 3, 1, 2), ("d", 4, 1, 3)]), "k", ("at",), "day")
    files = lambda: {f: d for f, d in ((r["f"], r["day"].day) for r in lake.read("t").select(F.input_file_name().alias("f"), "day").collect())}
    before = files()
    assert lake.upsert("t", frame(spark, [("a", 10, 2, 5), ("e", 5, 1, 2)]), "k", ("at",), "day") == ["2026-03-01"]
    assert rows_of(lake) == [("a", 10, 5), ("b", 2, 1), ("c", 3, 2), ("d", 4, 3), ("e", 5, 2)]
    after = files()
    assert {f for f, d in before.items() if d in (2, 3)} <= set(after)  # an unseen key is appended: its day keeps its files
    assert not {f for f, d in before.items() if d == 1} & set(after)
    assert lake.upsert("t", frame(spark, [("d", 40, 1, 2), ("d", 41, 2, 1)]), "k", ("at",), "day") == ["2026-03-03"]
    assert rows_of(lake) == [("a", 10, 5), ("b", 2, 1), ("c", 3, 2), ("d", 41, 1), ("e", 5, 2)]
    parts = [r[0] for r in spark.sql(f"SHOW PARTITIONS {lake.database}.t").collect()]
    assert "day=2026-03-03" not in parts  # a day that is left empty goes


def test_replay_null_days_and_removed_keys(spark, lake):
    rows = frame(spark, [("a", 1, 1, 1), ("n", 2, 1, None), ("b", 3, 1, None)])
    for _ in range(3):
        lake.upsert("t", rows, "k", ("at",), "day")
    assert rows_of(lake) == [("a", 1, 1), ("b", 3, None), ("n", 2, None)]
    lake.replace("t", frame(spark, [("n", 7, 1, 4)]), "k", "day", gone=spark.createDataFrame([("b",), ("zz",)], "k string"))
    assert rows_of(lake) == [("a", 1, 1), ("n", 7, 4)]
    lake.replace("t", frame(spark, []), "k", "day", gone=spark.createDataFrame([("a",), ("n",)], "k string"))
    assert rows_of(lake) == []
    lake.upsert("t", rows.limit(0), "k", ("at",), "day")
    assert rows_of(lake) == []


@pytest.mark.parametrize("dies_in", ["_index", "overwrite_partitions", "append"])
def test_a_writer_that_dies_leaves_nothing_that_a_second_try_does_not_mend(spark, lake, monkeypatch, dies_in):
    lake.upsert("t", frame(spark, [("a", 1, 1, 1), ("b", 2, 1, 2)]), "k", ("at",), "day")
    change = frame(spark, [("a", 10, 2, 2), ("b", 20, 2, 3), ("c", 30, 2, 4)])
    own = getattr(Lake, dies_in)
    with monkeypatch.context() as m:

        def dies(self, table, *args):
            if table.endswith("__keys") == (dies_in == "_index") or dies_in == "_index":
                own(self, table, *args)
                raise OSError("gone")
            return own(self, table, *args)

        m.setattr(Lake, dies_in, dies)
        with pytest.raises(OSError):
            lake.upsert("t", change, "k", ("at",), "day")
    lake.upsert("t", change, "k", ("at",), "day")
    assert rows_of(lake) == [("a", 10, 2), ("b", 20, 3), ("c", 30, 4)]


def test_index_is_pruned_by_bucket_and_compacted(spark, lake):
    for n in range(3):
        lake.upsert("t", frame(spark, [(f"k{i}", n, n, n + 1) for i in range(12)]), "k", ("at",), "day")
    assert lake.read("t__keys").count() == 36
    one = lake.days_of("t", spark.createDataFrame([("k1",)], "k string"))
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().toString() or "bucket" in one._jdf.queryExecution().executedPlan().toString()
    lake.compact_keys("t")
    assert lake.read("t__keys").count() == 12 and {r["day"].day for r in lake.read("t__keys").collect()} == {3}
    lake.upsert("t", frame(spark, [("k1", 9, 9, 1)]), "k", ("at",), "day")
    assert ("k1", 9, 1) in rows_of(lake) and len(rows_of(lake)) == 12


batches = st.lists(st.lists(st.tuples(st.sampled_from("abcdef"), st.integers(0, 99), st.integers(1, 5)), max_size=5, unique_by=lambda r: r[0]), min_size=1, max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_any_batches_leave_the_last_row_of_each_key(spark, some):
    lake = Lake(spark, f"lake_{uuid.uuid4().hex[:8]}", buckets=2)
    want = {}
    for n, rows in enumerate(some):
        lake.upsert("t", frame(spark, [(k, v, n, d) for k, v, d in rows]), "k", ("at",), "day")
        want |= {k: (k, v, d) for k, v, d in rows}
    assert rows_of(lake) == sorted(want.values())
    spark.sql(f"DROP DATABASE {lake.database} CASCADE")
