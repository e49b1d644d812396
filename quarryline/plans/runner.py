"""Stored models: change-driven facts, and the daily run freshness -> reconciliation -> build -> test -> report.

Facts follow silver's changes, not a window of days: a mark keeps how far silver's processing time was taken in, and what was
written since then, however old its own time is, tells which readings, trips and vehicle days are stale. These are built whole
again and replace what the tables held of them. A reading that moved to another day or trip makes both stale, the old one as
fact_telemetry still has it.

`python -m quarryline.plans.runner <database> [yyyy-mm-ddThh:mm:ss]`
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date, datetime, timedelta
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.functions.columns import surrogate_key
from quarryline.operators import checks, constraints
from quarryline.plans.models import Project
from quarryline.plans.parallel import DONE, run_graph
from quarryline.sources.lake import Lake, staging

#: Key and partition column of each stored fact. The key is what changes are told by: an incident goes with its reading.
FACTS = {
    "fact_telemetry": ("event_id", "event_date"),
    "fact_driver_incident": ("event_id", "event_date"),
    "fact_vehicle_daily": ("vehicle_day_key", "event_date"),
    "fact_trip": ("trip_id", "trip_start_date"),
}
#: Stored rollups and reports with the stored tables that they read.
REPORTS = {
    "route_daily": {"fact_trip"},
    "route_durations": {"fact_trip"},
    "vehicle_day_sketches": {"fact_telemetry"},
    "fleet_distincts": {"vehicle_day_sketches"},
    "fleet_daily_summary": {"fact_vehicle_daily"},
    "driver_performance": {"fact_trip"},
    "vehicle_performance": {"fact_vehicle_daily"},
    "route_performance": {"fact_trip", "route_daily", "route_durations"},
    "data_quality_summary": {"fact_telemetry"},
}
MARK = "silver"


def source_project(lake: Lake, as_of: datetime, silver: DataFrame | None = None, **more: DataFrame) -> Project:
    """A project over the tables of a lake."""
    names = {"vehicles": "dim_vehicle", "drivers": "dim_driver", "routes": "dim_route", "quarantine": "quarantine"}
    sources = {model: lake.read(table) for model, table in names.items() if lake.exists(table)}
    return Project(lake.spark, "", as_of, sources | {"silver": lake.read("silver") if silver is None else silver} | more)


def report_project(lake: Lake, as_of: datetime) -> Project:
    """A project whose reports read the stored facts and rollups."""
    return source_project(lake, as_of, **{name: lake.read(name) for name in (*FACTS, *REPORTS) if lake.exists(name)})


class Stale(NamedTuple):
    """What changed in silver since the mark: keys of readings, trips and vehicle days, and the days that they lie in."""

    events: DataFrame
    trips: DataFrame
    vehicle_days: DataFrame
    days: list[date]
    trip_days: list[date]


def _days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def stale_since(lake: Lake, mark: datetime, work) -> Stale:
    """Old and new places of the readings that silver got since the mark. The batch at the mark is taken in again."""
    place = ("event_id", "trip_id", "vehicle_id", "event_date")
    new = work.save(lake.read("silver").where(F.col("processed_at") >= mark).select(*place))
    old = lake.read("fact_telemetry").join(new.select("event_id"), "event_id", "left_semi").select(*place)
    places = work.save(new.union(old))
    trips = work.save(places.select("trip_id").where("trip_id IS NOT NULL").distinct())
    days = [r["event_date"] for r in places.select("event_date").distinct().collect()]
    # A trip's other readings lie between its ends, as the stored trips have them.
    spans = lake.read("fact_trip").join(trips, "trip_id", "left_semi").select("trip_start_date", F.to_date("trip_ended_at").alias("last")).distinct().collect()
    trip_days = {d for s in spans for d in _days_between(s["trip_start_date"], s["last"])} | set(days)
    return Stale(work.save(new.select("event_id").distinct()), trips, work.save(places.select("vehicle_id", "event_date").distinct()), days, sorted(trip_days))


def fact_steps(lake: Lake, as_of: datetime, work) -> dict[str, Callable[[], object]]:
    """A step for each fact: its whole table where there is none yet or no mark, else what is stale of it."""
    mark = lake.mark(MARK)
    if mark is None or not all(lake.exists(name) for name in FACTS):

        def whole(name: str) -> str:
            key, day = FACTS[name]
            lake.overwrite(name, source_project(lake, as_of)[name], day, key)
            return "whole"

        return {name: lambda name=name: whole(name) for name in FACTS}
    stale = stale_since(lake, mark, work)
    silver = lake.read("silver")
    day = F.col("event_date")
    of_events = silver.where(day.isin(stale.days)).join(stale.events, "event_id", "left_semi")
    of_days = silver.where(day.isin(stale.days)).join(stale.vehicle_days, ["vehicle_id", "event_date"], "left_semi")
    of_trips = silver.where(day.isin(stale.trip_days)).join(stale.trips, "trip_id", "left_semi")
    keys = {"fact_telemetry": stale.events, "fact_driver_incident": stale.events, "fact_vehicle_daily": stale.vehicle_days.select(surrogate_key("vehicle_id", "event_date").alias("k")), "fact_trip": stale.trips}
    readings = {"fact_telemetry": of_events, "fact_driver_incident": of_events, "fact_vehicle_daily": of_days, "fact_trip": of_trips}

    def again(name: str) -> str:
        key, partition = FACTS[name]
        rows = source_project(lake, as_of, readings[name])[name]
        days = lake.replace(name, rows, key, partition, gone=keys[name])
        return f"{len(days)} days anew"

    return {name: lambda name=name: again(name) for name in FACTS}


def build(lake: Lake, as_of: datetime, at_once: int = 4) -> dict[str, tuple[str, str]]:
    """Builds facts and reports side by side, each after those it reads; the outcome of each. The mark moves on only when all
    facts are done, so a failed build is made up for by the next."""
    upto = lake.read("silver").agg(F.max("processed_at")).first()[0]
    reports = {name: needs for name, needs in REPORTS.items() if name != "data_quality_summary" or lake.exists("quarantine")}
    with staging(lake.spark) as work:
        facts = fact_steps(lake, as_of, work)
        steps = facts | {name: lambda name=name: lake.overwrite(name, report_project(lake, as_of)[name]) for name in reports}
        out = run_graph(lake.spark, steps, reports, at_once)
    if upto is not None and all(out[name][0] == DONE for name in facts):
        lake.set_mark(MARK, upto)
    return out


class Step(NamedTuple):
    name: str
    passed: bool
    detail: str


def data_tests(lake: Lake, as_of: datetime) -> DataFrame:
    """All declared tests, over the stored facts."""
    p = report_project(lake, as_of)
    return constraints.failures(p.__getitem__, constraints.load_constraints())


def daily_run(lake: Lake, as_of: datetime, max_age_hours: float = 24, most_unbalanced: int = 0) -> list[Step]:
    """The steps in order; a failed one stops the run, and what was not reached is not in the list."""
    done: list[Step] = []

    def fresh() -> tuple[bool, str]:
        newest = lake.read("silver").agg(F.max("ingestion_time")).first()[0]
        age = (as_of - newest).total_seconds() / 3600 if newest else float("inf")
        return age <= max_age_hours, f"newest reading {age:.1f} h old"

    def reconciled() -> tuple[bool, str]:
        r = checks.reconciliation_balance(lake.read("reconciliation")).first()
        return r["unbalanced"] <= most_unbalanced, f"{r['unbalanced']} of {r['batches']} batches don't balance"

    def built() -> tuple[bool, str]:
        outcome = build(lake, as_of)
        lost = {name: told for name, told in outcome.items() if told[0] != DONE}
        return not lost, "; ".join(f"{name} {what}: {detail}" for name, (what, detail) in lost.items()) or f"{len(outcome)} tables"

    def tested() -> tuple[bool, str]:
        bad = data_tests(lake, as_of).where("failures > 0").collect()
        short = lake.read("silver").join(lake.read("fact_telemetry"), "event_id", "left_anti").limit(1).count()
        errors = [f"{r['table']}.{r['column']} {r['test']}: {r['failures']}" for r in bad if r["severity"] == "error"] + ["readings lack in fact_telemetry"] * bool(short)
        warned = [f"{r['table']}.{r['column']} {r['test']}: {r['failures']} (warning)" for r in bad if r["severity"] != "error"]
        return not errors, ", ".join(errors + warned) or "all hold"

    def report() -> tuple[bool, str]:
        rows = lake.read("data_quality_summary").orderBy(F.desc("violation_count"), "rule_name").limit(5).collect() if lake.exists("data_quality_summary") else []
        return True, ", ".join(f"{r['rule_name']}={r['violation_count']}" for r in rows) or "nothing was quarantined"

    steps: dict[str, Callable[[], tuple[bool, str]]] = {"freshness": fresh, "reconciliation": reconciled, "build": built, "test": tested, "report": report}
    for name, step in steps.items():
        done.append(Step(name, *step()))
        if not done[-1].passed:
            break
    return done


def main(args: list[str]) -> int:
    from quarryline.session import build_session

    spark = build_session("daily-run", **{"spark.scheduler.mode": "FAIR"})
    as_of = datetime.fromisoformat(args[1]) if len(args) > 1 else datetime.now()
    run = daily_run(Lake(spark, args[0]), as_of)
    for step in run:
        print(f"{'PASS' if step.passed else 'FAIL'}  {step.name}: {step.detail}")
    return int(not run[-1].passed)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
