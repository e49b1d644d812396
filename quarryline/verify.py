"""End-to-end checks over a lake, as a report of lines. `python -m quarryline.verify <database> [bronze folder [manifest]]`. With a bronze folder, a sample is replayed, which
writes to the lake."""

from __future__ import annotations

import json
import sys
import uuid
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarryline.operators import checks
from quarryline.sources.lake import Lake
from quarryline.streaming.jobs import write_silver_batch


class Line(NamedTuple):
    name: str
    status: str
    detail: str


def _line(name: str, good: bool, detail: str) -> Line:
    return Line(name, "PASS" if good else "FAIL", detail)


#: Fixed value: how many rows may be missing, as a share of the records and at least.
MISSING_SHARE, MISSING_ROWS = 0.02, 500
#: Readings that a replay sends again at most.
SAMPLE = 500


def replay(lake: Lake, bronze: DataFrame, as_of: datetime | None = None, most: int = SAMPLE) -> Line:
    """Sends up to `most` stored readings through the write path once more: no count may change."""
    ids = [r["event_id"] for r in lake.read("silver").select("event_id").orderBy("event_id").limit(most).collect()]
    if not ids:
        return Line("replay changes nothing", "SKIP", "silver is empty")
    count = lambda: [lake.read(t).count() if lake.exists(t) else 0 for t in ("silver", "quarantine")]
    before = count()
    write_silver_batch(bronze.where(F.col("event_id").isin(ids)).drop("event_date"), 0, lake, f"replay-{uuid.uuid4().hex}", as_of=as_of)
    after = count()
    return _line("replay changes nothing", before == after, f"{len(ids)} readings sent again, rows {before} -> {after}")


def late_events(silver: DataFrame, late_seconds: int = 300) -> Line:
    """Late readings lie in the partition of their own day."""
    lag = F.unix_seconds("ingestion_time") - F.unix_seconds("event_time")
    c = silver.agg(F.count_if(lag > late_seconds).alias("late"), F.count_if((lag > late_seconds) & (F.col("event_date") != F.to_date("event_time"))).alias("astray")).first()
    return _line("late readings keep their day", not c["astray"], f"{c['astray']} of {c['late']} astray") if c["late"] else Line("late readings keep their day", "SKIP", "none came late")


def against_manifest(bronze: DataFrame, manifest: dict | None) -> Line:
    """All that the producer sent is in bronze."""
    if manifest is None:
        return Line("all that was sent came in", "SKIP", "no manifest was given")
    n = bronze.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("k")).first()
    return _line("all that was sent came in", (n["n"], n["k"]) == (manifest["produced"], manifest["clean"]), f"{n['n']} of {manifest['produced']} records, {n['k']} of {manifest['clean']} keys")


def verify(lake: Lake, bronze: DataFrame | None = None, injected: int | None = None, manifest: dict | None = None, with_replay: bool = False, as_of: datetime | None = None) -> list[Line]:
    """PASS, FAIL or SKIP for each check; SKIP where a table that it needs isn't there."""
    have = set(lake.tables())
    silver = lake.read("silver") if "silver" in have else None
    quarantine = lake.read("quarantine") if "quarantine" in have else None
    out: list[Line] = []
    if bronze is None:
        out.append(Line("bronze ingested", "SKIP", "no bronze table was given"))
    else:
        n = bronze.agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("k")).first()
        out.append(_line("bronze ingested", n["n"] > 0, f"{n['n']} rows, {n['k']} keys"))
        out.append(Line("duplicates injected", "PASS" if n["n"] > n["k"] else "SKIP", f"{n['n'] - n['k']} repeats"))
    if silver is None:
        out.append(Line("silver deduplicated", "SKIP", "no silver table"))
    else:
        again = checks.repeated_keys(silver, ["event_id"]).count()
        out.append(_line("silver deduplicated", not again, f"{again} keys repeat"))
        hot = silver.where("is_overheating").groupBy("vehicle_id").count().orderBy(F.desc("count"), "vehicle_id").limit(5).collect()
        out.append(Line("business query answers", "PASS" if hot else "SKIP", ", ".join(f"{r['vehicle_id']}={r['count']}" for r in hot)))
    if quarantine is None:
        out.append(Line("quarantine populated", "SKIP", "nothing was quarantined"))
    else:
        blank = quarantine.where("rule_name IS NULL OR failure_reason IS NULL OR run_id IS NULL").count()
        out.append(_line("quarantine populated", not blank, f"{blank} rows lack a rule, reason or run"))
        if injected:
            caught = quarantine.agg(F.count_distinct("event_id")).first()[0]
            out.append(_line("injected records caught", caught >= injected / 2, f"{caught} of {injected}"))
    if silver is not None and quarantine is not None:
        leaked = checks.leaked(silver, quarantine).count()
        out.append(_line("quarantine is exclusive", not leaked, f"{leaked} rows are in both"))
        if bronze is not None:
            c = checks.row_conservation(bronze, silver, quarantine).first()
            out.append(_line("rows conserved", abs(c["missing"]) <= max(MISSING_SHARE * c["records"], MISSING_ROWS), f"{c['missing']} of {c['records']} missing"))
    if silver is not None and bronze is not None:
        altered = checks.altered_times(silver, bronze).count()
        out.append(_line("event time preserved", not altered, f"{altered} times differ"))
    out.append(late_events(silver) if silver is not None else Line("late readings keep their day", "SKIP", "no silver table"))
    out.append(against_manifest(bronze, manifest) if bronze is not None else Line("all that was sent came in", "SKIP", "no bronze table was given"))
    if silver is not None and bronze is not None and with_replay:
        out.append(replay(lake, bronze, as_of))
    else:
        out.append(Line("replay changes nothing", "SKIP", "not asked for"))
    if "reconciliation" in have:
        r = checks.reconciliation_balance(lake.read("reconciliation")).first()
        out.append(_line("reconciliation balances", not r["unbalanced"], f"{r['unbalanced']} of {r['batches']} batches"))
    else:
        out.append(Line("reconciliation balances", "SKIP", "no ledger"))
    return out


def main(args: list[str]) -> int:
    from quarryline.session import build_session

    spark = build_session("verify")
    manifest = json.loads("".join(r["value"] for r in spark.read.text(args[2]).collect())) if len(args) > 2 else None
    report = verify(Lake(spark, args[0]), spark.read.parquet(args[1]) if len(args) > 1 else None, manifest=manifest, with_replay=len(args) > 1)
    for line in report:
        print(f"{line.status:4}  {line.name}: {line.detail}")
    return int(any(line.status == "FAIL" for line in report))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
