"""Rules, columns, models against SQL, the table store."""

import bisect
import os
import re
import shutil
import subprocess
import sys
import uuid
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from pathlib import Path

import duckdb
import pytest
import yaml
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarryline import contract, fixture
from quarryline.functions.columns import surrogate_key, uuid5
from quarryline.operators import constraints
from quarryline.operators.checks import side_by_side
from quarryline.operators.enrich import latest_by_key
from quarryline.operators.upsert import merged
from quarryline.plans.models import Project, quantile
from quarryline.plans.oracle import ORACLES
from quarryline.plans.queries import QUERIES
from quarryline.rules import RuleError, annotate, load_rules, parse_rules, split
from quarryline.sources.store import Commit, CommitConflict, TableStore, maintain

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def _rows(frame):
    def plain(v):
        if v is None or v != v:
            return "~"
        if isinstance(v, float):
            return f"{v:.8g}"
        return str(v).removesuffix(" 00:00:00").removesuffix(".0")

    columns = sorted(frame.columns)
    return sorted(tuple(plain(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", ["stg_telemetry", "json_parse", "incident_json", "interpolated", "replay_sample", "ref_integrity", "reconciliation_balance", "fact_driver_incident", "derive_flags", "trip_metrics", "fleet_daily_summary", "route_performance", "vehicle_performance", "data_quality_summary", "dq_split_quarantine", "corruption_counts", "upsert_merge", "incremental_upsert", "row_conservation", "dim_date", "route_daily", "percentile_rank_error", "distinct_sketches", "data_tests", "data_tests_of_sources", "upsert_moved_day", "record_bytes", "injection_ledger"])
def test_queries_equal_sql(spark, duck, name):
    assert _rows(QUERIES[name](spark, SF).toPandas()) == _rows(duck.sql(ORACLES[name]).df())


def test_every_query_has_sql_but_file_metadata():
    assert set(QUERIES) - set(ORACLES) == {"file_stats"}


def test_model_order_and_cycle(spark):
    p = Project(spark, SF)
    order = p.build_order(["fleet_daily_summary"])
    assert order.index("vehicle_daily") < order.index("fact_vehicle_daily") < order.index("fleet_daily_summary")


@pytest.mark.parametrize("bad", [{}, {"rules": []}, {"rules": ["x"]}, {"rules": [{"name": "a", "severity": "critical"}]}, {"rules": [{"name": "a", "severity": "odd", "expression": "true"}]}, {"rules": [{"name": "a", "severity": "warning", "expression": "true"}] * 2}])
def test_rule_files_that_are_refused(bad):
    with pytest.raises(RuleError):
        parse_rules(yaml.safe_load(yaml.safe_dump(bad)))


def test_null_counts_as_failure_and_warnings_pass(spark):
    rules = parse_rules({"rules": [{"name": "p", "severity": "critical", "expression": "x > 0"}, {"name": "w", "severity": "warning", "expression": "x < 5"}]})
    rows = {r["x"]: r for r in annotate(spark.createDataFrame([(1,), (None,), (9,), (-1,)], "x int"), rules).collect()}
    assert [rows[x]["dq_valid"] for x in (1, None, 9, -1)] == [True, False, True, False]
    assert rows[9]["dq_warnings"] == ["w"] and rows[None]["dq_failed"] == ["p"]
    assert len(load_rules().of("critical")) == 17 and len(load_rules().of("warning")) == 1


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3)), max_size=8))
def test_split_is_a_partition(spark, values):
    rules = parse_rules({"rules": [{"name": "p", "severity": "critical", "expression": "x > 0"}, {"name": "q", "severity": "critical", "expression": "x > 1"}]})
    good, bad = split(spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x int"), rules)
    kept, gone = {r["i"] for r in good.collect()}, {r["i"] for r in bad.collect()}
    assert kept | gone == set(range(len(values))) and not kept & gone


def test_uuid5_and_keys(spark):
    ns = uuid.UUID("6ba7b810-9dad-11d1-80b4-00c04fd430c8")
    names = [f"V{i}|T{i % 7}|{i}" for i in range(50)]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", uuid5(str(ns), "n").alias("u"), surrogate_key("n", F.lit(None)).alias("k")).collect()
    assert all(r["u"] == str(uuid.uuid5(ns, r["n"])) for r in got)
    assert len({r["k"] for r in got}) == 50


def test_contract_agrees_with_itself():
    schema = contract.json_schema()
    assert schema["additionalProperties"] is False and set(schema["required"]) < set(schema["properties"])
    assert contract.parse_schema().fieldNames() == [f.name for f in contract.TELEMETRY]
    assert "raw_payload" in contract.bronze_ddl() and "raw_payload" not in contract.silver_ddl()


def test_upsert_is_idempotent_where_append_is_not(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"), (F.col("id") % 3).cast("string").alias("p"), F.lit(0).alias("at"))
    for _ in range(3):
        store.upsert("t", rows, "k", ("at",), "p")
    assert store.read("t").count() == 100
    store.upsert("t", rows.limit(10).withColumn("v", F.lit(2)).withColumn("p", F.lit("moved")), "k", ("at",), "p")
    assert store.read("t").count() == 100 and store.read("t").where("v = 2 AND p = 'moved'").count() == 10
    assert store.read("t", 1).where("v = 2").count() == 0
    for _ in range(2):
        store.append("a", rows)
    assert store.read("a").count() == 200


def test_store_batches_conflicts_and_maintenance(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/store")
    rows = spark.range(10).select("id", F.lit("x").alias("p"))
    for n in range(6):
        store.append("t", rows, "p", batch=("q", n))
    assert store.append("t", rows, "p", batch=("q", 3)).number == 6 and store.read("t").count() == 60
    with pytest.raises(CommitConflict):
        store._save("t", store.commit("t", 6))
    report = maintain(store, snapshot_hours=0, orphan_hours=0)
    assert report["t"]["compacted"][0] > report["t"]["compacted"][1] and "error" not in report["t"]
    assert report["t"]["expired"] >= 1 and store.read("t").count() == 60
    assert maintain(store, ["absent"])["absent"]["compacted"] == (0, 0)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=10), st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), max_size=10))
def test_merge_keeps_one_row_per_key_the_last(spark, old, new):
    target = dict(old)
    order = "k int, at int"
    a = spark.createDataFrame([(k, v) for k, v in target.items()], order)
    got = {r["k"]: r["at"] for r in merged(a, spark.createDataFrame(new, order), "k", "at").collect()}
    want = target | {k: max(v for x, v in new if x == k) for k, _ in new}
    assert got == want


def test_every_corruption_breaks_its_rule(spark):
    rows = QUERIES["corruption_counts"](spark, SF).collect()
    assert rows and all(r["records"] == r["caught"] for r in rows)
    assert {r["injection"] for r in rows} <= set(fixture.CORRUPTIONS)


def test_entry_without_the_subpackage_and_with_a_broken_dependency(tmp_path):
    root = Path(__file__).parents[1]
    shutil.copytree(root / "quarryline", tmp_path / "quarryline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    run = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert run().stdout.split()[0] == str(len(QUERIES))
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_library")
    assert "no_such_library" in run().stderr
    assert not [p for p in root.joinpath("quarryline").rglob("*.py") if "/llm/" not in str(p) and "quarryline.llm" in p.read_text()]


def test_one_of_many_writers_makes_each_commit(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/s")
    df = spark.range(3).withColumn("day", F.lit("a"))
    store.append("t", df, "day")
    row = store.commit("t")

    def write(k):
        try:
            return store._save("t", Commit(2, row.schema, row.folders, {"who": k}))
        except CommitConflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        made = [c for c in pool.map(write, range(16)) if c]
    assert len(made) == 1 and store.commit("t").batches == made[0].batches and store.commits("t") == [1, 2]


def test_a_table_of_many_appends_is_one_scan_and_overwrite_remembers_batches(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/s")
    for n in range(25):
        store.append("t", spark.range(n, n + 1).withColumn("day", F.lit(n % 3)), "day", batch=("b", n))
        store.append("u", spark.range(n, n + 1), batch=("b", n))
    for table in "tu":
        plan = store.read(table)._jdf.queryExecution().analyzed().toString()
        assert plan.count("Relation [") == 1 and "Union" not in plan and sorted(r["id"] for r in store.read(table).collect()) == list(range(25))
    assert store.read("t").columns == ["id", "day"] and store.read("t", None, ["day=1"]).count() == 8
    store.overwrite("u", spark.range(2))
    store.append("u", spark.range(5), batch=("b", 24))
    assert store.read("u").count() == 2


def test_pruned_upsert_reads_only_the_partitions_of_the_updates(spark, tmp_path):
    store = TableStore(spark, f"file://{tmp_path}/s")
    rows = spark.range(90).select("id", (F.col("id") % 9).alias("day"), F.lit(0).alias("v"))
    store.upsert("t", rows, "id", ("v",), "day", pruned=True)
    before = store.commit("t").folders
    store.upsert("t", rows.where("id < 20 AND day = 1").withColumn("v", F.lit(1)).union(spark.createDataFrame([(1000, 1, 1)], rows.schema)), "id", ("v",), "day", pruned=True)
    after = store.commit("t").folders
    assert [p for p in after if after[p] != before[p]] == ["day=1"] and store.read("t").count() == 91 and store.read("t").where("v = 1").count() == 4


def test_helper_columns_clash_with_no_input_column(spark):
    df = spark.createDataFrame([(1, 5, 7), (1, 6, 8)], "k int, rank int, one int")
    assert [tuple(r) for r in latest_by_key(df, "k", "rank").collect()] == [(1, 6, 8)]
    assert [tuple(r) for r in side_by_side(df.agg(F.max("one").alias("one")), df.agg(F.count("*").alias("n"))).collect()] == [(8, 2)]


def test_sketches_merge_to_what_one_sketch_gives_and_stay_small(spark):
    n, k = 300_000, 4096
    rows = spark.range(n).selectExpr("id", "id % 30 AS day", "(id * 7919) % 1000003 AS seconds")
    days = rows.groupBy("day").agg(F.kll_sketch_agg_bigint("seconds", k).alias("s"), F.hll_sketch_agg(F.col("seconds") % 50_000, F.lit(12)).alias("d"))
    got = days.agg(F.kll_merge_agg_bigint("s", k).alias("s"), F.hll_sketch_estimate(F.hll_union_agg("d")).alias("d"), F.max(F.length("s")).alias("bytes")).select("d", "bytes", F.length("s").alias("merged"), *[quantile("s", r).alias(f"q{i}") for i, r in enumerate((0.01, 0.5, 0.95))]).first()
    values = sorted((i * 7919) % 1000003 for i in range(n))
    for i, rank in enumerate((0.01, 0.5, 0.95)):
        assert abs(bisect.bisect_right(values, got[f"q{i}"]) / n - rank) < 0.002
    distinct = len({v % 50_000 for v in values})
    assert abs(got["d"] - distinct) < 3 * 0.0163 * distinct and got["merged"] < 120_000


def test_plans_of_sketches_and_data_tests(spark):
    p = Project(spark, SF)
    plan = p["vehicle_day_sketches"]._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "count(distinct" not in plan
    assert "percentile_approx" not in p["route_performance"]._jdf.queryExecution().optimizedPlan().toString()
    line = fixture.table(spark, SF, "lineitem")
    told = constraints.parse_constraints({"lineitem": {"unique": [["l_orderkey"], ["l_orderkey", "l_linenumber"]], "l_quantity": {"range": [0, 5], "not_null": True}, "l_tax": {"values": [0.1]}}})
    failed = constraints.failures(lambda _: line, told)
    scans = re.findall("FileScan|Relation \\[", failed._jdf.queryExecution().executedPlan().toString())
    assert len(scans) == 1 and failed.count() == 5


@pytest.mark.parametrize("bad", [{}, {"t": {"c": {}}}, {"t": {"c": {"odd": 1}}}, {"t": {"c": {"values": []}}}, {"t": {"c": {"range": [None, None]}}}, {"t": {"c": {"range": 3}}}, {"t": {"c": {"parent": "x"}}}, {"t": {"c": {"not_null": True, "severity": "high"}}}])
def test_constraints_that_are_refused(spark, bad):
    with pytest.raises(constraints.ConstraintError):
        constraints.parse_constraints(bad)


def test_nulls_in_tests_and_tables_without_keys_or_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 5), (None, 5)], "k string, n int")
    told = constraints.parse_constraints({"t": {"unique": [["k"]], "k": {"not_null": True, "parent": "p.k"}, "n": {"values": [1], "range": [None, 4]}}, "u": {"n": {"not_null": True}}})
    tables = {"t": df, "p": df.where("k = 'zz'"), "u": df.where("false")}
    got = {(r["table"], r["test"], r["column"]): r["failures"] for r in constraints.failures(tables.__getitem__, told).collect()}
    assert got == {("t", "not_null", "k"): 2, ("t", "values", "n"): 2, ("t", "range", "n"): 2, ("t", "unique", "k"): 1, ("t", "parent", "k"): 2, ("u", "not_null", "n"): 0}
