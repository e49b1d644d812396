"""The model graph: staging, trip and daily rollups, marts and performance reports.

A model is a function of a Project; it asks the project for the models that it reads, so the graph follows from the code.
Nothing is materialised: a report is one plan down to the scans unless the caller stores a model in between. The clock is
the project's as_of.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarryline import fixture
from quarryline.functions.columns import band, haversine_km, quarantine_key, ratio, seconds_between, surrogate_key
from quarryline.operators.enrich import CRITICAL_OVERHEAT_C, LOW_FUEL_PCT, OVERHEAT_C, SEVERE_OVERSPEED_KMH, enrich, latest_by_key
from quarryline.rules import VALID, annotate, explain_failures, split

MODELS: dict[str, Callable[["Project"], DataFrame]] = {}


class Project:
    """Sources of one run and the models over them; a model is built once and its plan reused."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: datetime = fixture.AS_OF, sources: dict[str, DataFrame] | None = None):
        self.spark, self.sf_dir, self.as_of = spark, sf_dir, as_of
        self._built: dict[str, DataFrame] = dict(sources or {})
        self._pending: list[str] = []
        self.edges: dict[str, set[str]] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if self._pending:
            self.edges.setdefault(self._pending[-1], set()).add(name)
        if name not in self._built:
            if name in self._pending:
                raise ValueError(f"models depend on each other: {' -> '.join([*self._pending, name])}")
            self._pending.append(name)
            try:
                self._built[name] = MODELS[name](self)
            finally:
                self._pending.pop()
        return self._built[name]

    def build_order(self, names: list[str] | None = None) -> list[str]:
        """Every model after the models it reads."""
        order: list[str] = []

        def visit(name: str) -> None:
            if name not in order:
                for below in sorted(self.edges.get(name, ())):
                    visit(below)
                order.append(name)

        for name in names or MODELS:
            _ = self[name]
            visit(name)
        return order


def model(f: Callable[[Project], DataFrame]) -> Callable[[Project], DataFrame]:
    MODELS[f.__name__] = f
    return f


@model
def telemetry(p: Project) -> DataFrame:
    return fixture.telemetry(p.spark, p.sf_dir)


@model
def bronze(p: Project) -> DataFrame:
    return fixture.bronze(p.spark, p.sf_dir)


@model
def vehicles(p: Project) -> DataFrame:
    return fixture.vehicles(p.spark, p.sf_dir)


@model
def drivers(p: Project) -> DataFrame:
    return fixture.drivers(p.spark, p.sf_dir)


@model
def routes(p: Project) -> DataFrame:
    return fixture.routes(p.spark, p.sf_dir)


@model
def silver(p: Project) -> DataFrame:
    """Good readings, one for each key, enriched: what the stream's upserts come to."""
    good, _ = split(p["bronze"], as_of=p.as_of)
    newest = latest_by_key(good.drop("raw_payload"), "event_id", "ingestion_time", "kafka_offset")
    return enrich(newest, p["vehicles"], p["drivers"]).withColumns({"processed_at": F.timestamp_add("SECOND", F.lit(60), "ingestion_time"), "silver_run_id": F.lit(fixture.RUN_ID)})


@model
def quarantine(p: Project) -> DataFrame:
    """One row for each record and failed rule. A record's repeats are one record: the newest, by its key or payload."""
    record = F.coalesce(F.col("event_id"), F.sha2("raw_payload", 256))
    bad = annotate(p["bronze"], as_of=p.as_of).where(~F.col(VALID)).withColumn("record", record)
    failed = explain_failures(latest_by_key(bad, "record", "ingestion_time", "kafka_offset"))
    return failed.select(quarantine_key("event_id", "rule_name", "raw_payload").alias("quarantine_id"), "event_id", "vehicle_id", "event_time", "rule_name", "rule_severity", "failure_reason", "raw_payload", F.timestamp_add("SECOND", F.lit(60), "ingestion_time").alias("quarantined_at"), F.lit(fixture.RUN_ID).alias("run_id"))


@model
def reconciliation(p: Project) -> DataFrame:
    """The ledger of daily batches, as the split and the stored rows have them. Duplicates are the good rows that are not the
    newest of their key, whatever was stored. Every tenth batch is given a lost row, so that there is something to find."""
    day = F.dayofmonth("event_time").cast("long").alias("batch_id")
    seen = annotate(p["bronze"], as_of=p.as_of).groupBy(day).agg(
        F.count("*").alias("source_count"),
        F.count_if(~F.col(VALID)).alias("rejected_count"),
        F.count_if(VALID).alias("good"),
        F.max("ingestion_time").alias("recorded_at"),
    )
    good = annotate(p["bronze"], as_of=p.as_of).where(VALID)
    newest = good.groupBy("event_id").agg(F.max_by(day, F.struct("ingestion_time", "kafka_offset")).alias("batch_id"))
    distinct = newest.groupBy("batch_id").agg(F.count("*").alias("distinct"))
    stored = p["silver"].groupBy(day).agg(F.count("*").alias("stored"))
    out = F.coalesce("stored", F.lit(0))
    return seen.join(distinct, "batch_id", "left").join(stored, "batch_id", "left").select(F.lit(fixture.RUN_ID).alias("run_id"), F.lit("silver").alias("stage"), "batch_id", "source_count", (F.col("good") - F.coalesce("distinct", F.lit(0))).alias("duplicate_count"), "rejected_count", (out - (F.col("batch_id") % 10 == 0).cast("long")).alias("output_count"), "recorded_at")


# staging


@model
def stg_telemetry(p: Project) -> DataFrame:
    same = ("event_id", "vehicle_id", "driver_id", "trip_id", "route_id", "event_time", "ingestion_time", "processed_at", "latitude", "longitude", "odometer_km", "vehicle_type", "manufacturer", "model", "region", "fleet_owner", "driver_name", "driver_category", "kafka_partition", "kafka_offset", "schema_version", "silver_run_id")
    renamed = {"speed_kmh": "speed", "fuel_level_pct": "fuel_level", "engine_temperature_c": "engine_temperature", "battery_level_pct": "battery_level"}
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("is_overspeed", "is_overheating", "is_low_fuel")]
    return p["silver"].select(*same, F.to_date("event_time").alias("event_date"), seconds_between("event_time", "ingestion_time").alias("ingestion_lag_seconds"), *[F.col(old).alias(new) for new, old in renamed.items()], *flags)


@model
def stg_quarantine(p: Project) -> DataFrame:
    return p["quarantine"].withColumn("quarantine_date", F.to_date("quarantined_at"))


# dimensions


@model
def dim_vehicle(p: Project) -> DataFrame:
    return p["vehicles"].withColumns({"vehicle_description": F.concat(F.col("manufacturer"), F.lit(" "), F.col("model")), "consumption_band": band("consumption_l_per_100km", (12, "efficient"), (22, "standard"), otherwise="heavy")})


@model
def dim_driver(p: Project) -> DataFrame:
    return p["drivers"].withColumn("risk_band", band("aggression_index", (0.8, "cautious"), (1.3, "normal"), otherwise="aggressive"))


@model
def dim_route(p: Project) -> DataFrame:
    return p["routes"].withColumnRenamed("distance_km", "planned_distance_km").withColumn("haul_type", band("planned_distance_km", (50, "short_haul"), (250, "medium_haul"), otherwise="long_haul"))


def date_spine(spark: SparkSession, first: str, as_of: datetime) -> DataFrame:
    """Every day from first to the day of as_of."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(as_of.date()), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias("date_key"))


@model
def dim_date(p: Project) -> DataFrame:
    d = F.col("date_key")
    iso = F.weekday(d) + 1
    return date_spine(p.spark, "2023-12-01", p.as_of).select("date_key", F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"), F.dayofmonth(d).alias("day_of_month"), iso.alias("day_of_week"), F.weekofyear(d).alias("week_of_year"), F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "EEEE").alias("day_name"), iso.isin(6, 7).alias("is_weekend"))


# rollups


@model
def gps_hops(p: Project) -> DataFrame:
    """Readings with the distance from the one before in the trip; the first has none."""
    order = W.partitionBy("trip_id").orderBy("event_time", "event_id")
    before = {f"prev_{c}": F.lag(c).over(order) for c in ("latitude", "longitude")}
    hop = F.when(F.col("prev_latitude").isNull(), F.lit(0.0)).otherwise(haversine_km("prev_latitude", "prev_longitude", "latitude", "longitude"))
    return p["stg_telemetry"].withColumns(before).withColumn("hop_km", hop)


def _count_if(column: str) -> Column:
    return F.count_if(F.col(column))


@model
def trip_metrics(p: Project) -> DataFrame:
    t = F.col
    rolled = p["gps_hops"].groupBy("trip_id").agg(
        F.min("vehicle_id").alias("vehicle_id"),
        F.min("driver_id").alias("driver_id"),
        F.min("route_id").alias("route_id"),
        F.count_distinct("vehicle_id").alias("distinct_vehicles"),
        F.min("event_time").alias("trip_started_at"),
        F.max("event_time").alias("trip_ended_at"),
        F.count("*").alias("event_count"),
        (F.max("odometer_km") - F.min("odometer_km")).alias("odometer_distance_km"),
        F.sum("hop_km").alias("gps_distance_km"),
        F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.max("fuel_level_pct").alias("fuel_level_start_pct"),
        F.min("fuel_level_pct").alias("fuel_level_end_pct"),
        F.max("engine_temperature_c").alias("max_engine_temperature_c"),
        F.avg("engine_temperature_c").alias("avg_engine_temperature_c"),
        F.min("battery_level_pct").alias("min_battery_level_pct"),
        _count_if("is_overspeed").alias("overspeed_event_count"),
        _count_if("is_overheating").alias("overheating_event_count"),
        _count_if("is_low_fuel").alias("low_fuel_event_count"),
        F.max("ingestion_lag_seconds").alias("max_ingestion_lag_seconds"),
    )
    ended = F.timestamp_add("MINUTE", F.lit(-30), F.lit(p.as_of).cast("timestamp"))
    return rolled.withColumns({"trip_start_date": F.to_date("trip_started_at"), "duration_seconds": seconds_between("trip_started_at", "trip_ended_at"), "is_complete": t("trip_ended_at") < ended, "has_sufficient_events": t("event_count") >= 5}).withColumn("implied_avg_speed_kmh", ratio(t("odometer_distance_km"), t("duration_seconds"), 3600))


@model
def vehicle_daily(p: Project) -> DataFrame:
    return p["stg_telemetry"].groupBy("vehicle_id", "event_date").agg(
        F.count("*").alias("event_count"),
        F.count_distinct("trip_id").alias("trip_count"),
        F.count_distinct("driver_id").alias("driver_count"),
        (F.max("odometer_km") - F.min("odometer_km")).alias("distance_km"),
        F.max("odometer_km").alias("odometer_end_km"),
        F.avg("speed_kmh").alias("avg_speed_kmh"),
        F.max("speed_kmh").alias("max_speed_kmh"),
        F.max("fuel_level_pct").alias("fuel_level_max_pct"),
        F.min("fuel_level_pct").alias("fuel_level_min_pct"),
        F.avg("engine_temperature_c").alias("avg_engine_temperature_c"),
        F.max("engine_temperature_c").alias("max_engine_temperature_c"),
        F.min("battery_level_pct").alias("min_battery_level_pct"),
        _count_if("is_overspeed").alias("overspeed_event_count"),
        _count_if("is_overheating").alias("overheating_event_count"),
        _count_if("is_low_fuel").alias("low_fuel_event_count"),
        F.count_distinct(F.date_trunc("minute", "event_time")).alias("active_minutes"),
        F.min("event_time").alias("first_event_at"),
        F.max("event_time").alias("last_event_at"),
    )


@model
def int_incidents(p: Project) -> DataFrame:
    """Readings that breach a limit, by priority, at the grain of the breach."""
    temperature = F.col("engine_temperature_c")
    kind = (
        F.when(temperature > CRITICAL_OVERHEAT_C, "engine_critical_overheat")
        .when(temperature > OVERHEAT_C, "engine_overheat")
        .when(F.col("speed_kmh") > SEVERE_OVERSPEED_KMH, "severe_overspeed")
        .when(F.col("is_overspeed"), "overspeed")
        .when(F.col("fuel_level_pct") < LOW_FUEL_PCT, "low_fuel")
    )
    kinds = F.col("incident_type")
    severity = F.when(kinds == "engine_critical_overheat", "critical").when(kinds.isin("engine_overheat", "severe_overspeed"), "high").when(kinds.isin("overspeed", "low_fuel"), "medium").otherwise("low")
    columns = ("event_id", "vehicle_id", "driver_id", "trip_id", "route_id", "event_time", "event_date", "latitude", "longitude", "speed_kmh", "engine_temperature_c", "fuel_level_pct", "battery_level_pct", "vehicle_type", "region", "driver_name", "driver_category")
    found = p["stg_telemetry"].select(*columns, kind.alias("incident_type")).where("incident_type IS NOT NULL")
    return found.withColumns({"incident_id": surrogate_key("event_id", "incident_type"), "severity": severity})


# facts


@model
def fact_telemetry(p: Project) -> DataFrame:
    return p["stg_telemetry"].select("event_id", "vehicle_id", "driver_id", "trip_id", "route_id", "event_time", "event_date", "ingestion_time", "ingestion_lag_seconds", "latitude", "longitude", "speed_kmh", "fuel_level_pct", "engine_temperature_c", "battery_level_pct", "odometer_km", "is_overspeed", "is_overheating", "is_low_fuel", "kafka_partition", "schema_version")


@model
def fact_driver_incident(p: Project) -> DataFrame:
    return p["int_incidents"]


@model
def fact_trip(p: Project) -> DataFrame:
    """All trips, with a flag for those that have ended; fuel in litres of the vehicle's own tank."""
    tank = p["vehicles"].select("vehicle_id", "fuel_capacity_l", F.col("consumption_l_per_100km").alias("rated_l_per_100km"))
    used = F.col("fuel_level_start_pct") - F.col("fuel_level_end_pct")
    joined = p["trip_metrics"].join(tank, "vehicle_id", "left").withColumnRenamed("odometer_distance_km", "distance_km")
    return joined.withColumns({"duration_minutes": F.col("duration_seconds") / F.lit(60.0), "distance_discrepancy_km": F.abs(F.col("distance_km") - F.col("gps_distance_km")), "fuel_consumed_pct": used, "fuel_consumed_l": used / 100.0 * F.col("fuel_capacity_l")}).withColumn("actual_l_per_100km", ratio(F.col("fuel_consumed_l"), F.col("distance_km"), 100)).drop("fuel_capacity_l")


@model
def fact_vehicle_daily(p: Project) -> DataFrame:
    dim = p["vehicles"].select("vehicle_id", "vehicle_type", "region", "fleet_owner", "fuel_capacity_l")
    joined = p["vehicle_daily"].join(dim, "vehicle_id", "left").withColumnsRenamed({"distance_km": "total_distance_km", "overheating_event_count": "engine_overheat_count"})
    used = (F.col("fuel_level_max_pct") - F.col("fuel_level_min_pct")) / 100.0 * F.col("fuel_capacity_l")
    return joined.withColumns(
        {
            "vehicle_day_key": surrogate_key("vehicle_id", "event_date"),
            "date_key": F.col("event_date"),
            "total_fuel_consumed_l": used,
            "incident_count": F.col("overspeed_event_count") + F.col("engine_overheat_count") + F.col("low_fuel_event_count"),
            "utilisation_pct": F.round(F.col("active_minutes").cast("double") / F.lit(1440.0) * 100, 2),
        }
    ).drop("fuel_capacity_l", "fuel_level_max_pct", "fuel_level_min_pct")


# reports


def _r(value: Column, digits: int, name: str) -> Column:
    return F.round(value, digits).alias(name)


def _mean_use() -> Column:
    """Mean utilisation from whole hundredths, whose sum is exact in any order."""
    hundredths = F.round(F.col("utilisation_pct") * 100).cast("long")
    return F.sum(hundredths).cast("double") / F.count("*") / F.lit(100.0)


@model
def fleet_daily_summary(p: Project) -> DataFrame:
    """Days of the fleet, from the vehicle days."""
    fuel, distance = F.sum("total_fuel_consumed_l"), F.sum("total_distance_km")
    return p["fact_vehicle_daily"].groupBy("event_date").agg(
        F.count_distinct("vehicle_id").alias("active_vehicles"),
        F.sum("trip_count").alias("total_trips"),
        F.sum("event_count").alias("total_events"),
        _r(distance, 2, "total_distance_km"),
        _r(fuel, 2, "total_fuel_consumed_l"),
        _r(ratio(fuel, distance, 100), 2, "fleet_l_per_100km"),
        _r(F.avg("avg_speed_kmh"), 2, "avg_speed_kmh"),
        _r(F.max("max_speed_kmh"), 2, "max_speed_kmh"),
        F.sum("incident_count").alias("total_incidents"),
        F.sum("engine_overheat_count").alias("overheat_incidents"),
        F.sum("overspeed_event_count").alias("overspeed_incidents"),
        F.sum("low_fuel_event_count").alias("low_fuel_incidents"),
        _r(_mean_use(), 2, "avg_utilisation_pct"),
        F.count_if(F.col("max_engine_temperature_c") > OVERHEAT_C).alias("vehicles_overheating"),
    )


@model
def driver_performance(p: Project) -> DataFrame:
    rolled = p["fact_trip"].where("is_complete").groupBy("driver_id").agg(
        F.count("*").alias("total_trips"),
        F.sum("distance_km").alias("km"),
        (F.sum("duration_seconds") / F.lit(3600.0).cast("double")).alias("hours"),
        (F.avg("duration_seconds") / 60).alias("minutes"),
        F.avg("avg_speed_kmh").alias("speed"),
        F.max("max_speed_kmh").alias("top"),
        F.sum("overspeed_event_count").alias("overspeed_event_count"),
        F.sum("overheating_event_count").alias("overheating_event_count"),
        F.sum("fuel_consumed_l").alias("litres"),
    )
    c = F.col
    return rolled.join(p["dim_driver"], "driver_id").select("driver_id", "driver_name", "driver_category", "license_type", "risk_band", "total_trips", _r(c("km"), 2, "total_distance_km"), _r(c("hours"), 2, "total_driving_hours"), _r(c("minutes"), 1, "avg_trip_minutes"), _r(c("speed"), 2, "avg_speed_kmh"), _r(c("top"), 2, "max_speed_kmh"), "overspeed_event_count", "overheating_event_count", _r(ratio(c("overspeed_event_count"), c("km"), 100), 3, "overspeed_events_per_100km"), _r(ratio(c("litres"), c("km"), 100), 2, "l_per_100km"))


@model
def vehicle_performance(p: Project) -> DataFrame:
    rolled = p["fact_vehicle_daily"].groupBy("vehicle_id").agg(
        F.count_distinct("event_date").alias("active_days"),
        F.sum("trip_count").alias("total_trips"),
        F.sum("total_distance_km").alias("km"),
        F.sum("total_fuel_consumed_l").alias("litres"),
        F.avg("avg_speed_kmh").alias("speed"),
        F.max("max_speed_kmh").alias("top"),
        F.max("max_engine_temperature_c").alias("hottest"),
        F.avg("avg_engine_temperature_c").alias("warmth"),
        F.sum("engine_overheat_count").alias("overheat_event_count"),
        F.sum("overspeed_event_count").alias("overspeed_event_count"),
        F.sum("incident_count").alias("total_incidents"),
        _mean_use().alias("use"),
        F.max("event_date").alias("last_active_date"),
    )
    c = F.col
    rated = c("consumption_l_per_100km")
    dim = p["dim_vehicle"].select("vehicle_id", "vehicle_description", "vehicle_type", "region", "fleet_owner", "consumption_band", "has_faulty_cooling", "consumption_l_per_100km")
    return rolled.join(dim, "vehicle_id").select("vehicle_id", "vehicle_description", "vehicle_type", "region", "fleet_owner", "consumption_band", "has_faulty_cooling", "active_days", "total_trips", _r(c("km"), 2, "total_distance_km"), _r(c("litres"), 2, "total_fuel_consumed_l"), _r(ratio(c("litres"), c("km"), 100), 2, "actual_l_per_100km"), rated.alias("rated_l_per_100km"), _r(F.when(rated > 0, ratio(c("litres"), c("km"), 100) / rated), 3, "consumption_vs_rated_ratio"), _r(c("speed"), 2, "avg_speed_kmh"), _r(c("top"), 2, "max_speed_kmh"), _r(c("hottest"), 2, "max_engine_temperature_c"), _r(c("warmth"), 2, "avg_engine_temperature_c"), "overheat_event_count", "overspeed_event_count", "total_incidents", _r(c("use"), 2, "avg_utilisation_pct"), "last_active_date", ((c("overheat_event_count") > 0) | (c("hottest") > CRITICAL_OVERHEAT_C)).alias("needs_maintenance_review"))


#: Size of the duration sketches: up to about so many values they are exact, beyond that ranks are off by some 0.13 %
#: (99 % sure), and a sketch stays under 100 kB however many trips it has seen.
DURATION_K = 4096
#: Size of the distinct sketches, as a power of two: a standard error of 1.04 / sqrt(2^12), 1.6 %, in some 4 kB.
DISTINCT_LG = 12
#: Size of the sketches of which the fleet's distinct counts are told. These are held to three standard errors of DISTINCT_LG,
#: 4.9 %, which with that size itself one estimate in some 370 misses. With this one the bound lies 12 standard errors away.
#: A merged day takes 66 kB; a vehicle day lists what it has seen up to about 6,000 values (8 kB at 1,440, 33 kB at 6,000).
FLEET_LG = 16


def _sums(*columns: str) -> list[Column]:
    """Sum and count of each column, from which means over any span follow."""
    return [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("sum", F.sum), ("n", F.count))]


def _mean(column: str) -> Column:
    return F.sum(f"sum_{column}") / F.sum(f"n_{column}")


@model
def route_daily(p: Project) -> DataFrame:
    """Ended trips of each route and day: sums, and sketches of durations, vehicles and drivers, all of which merge."""
    seconds = F.col("duration_seconds")
    ended = p["fact_trip"].where(F.col("is_complete") & F.col("route_id").isNotNull())
    return ended.groupBy("route_id", "trip_start_date").agg(
        F.count("*").alias("trip_count"),
        F.sum(seconds).alias("sum_seconds"),
        F.min(seconds).alias("least_seconds"),
        F.max(seconds).alias("most_seconds"),
        F.kll_sketch_agg_bigint(seconds, DURATION_K).alias("duration_sketch"),
        F.hll_sketch_agg("vehicle_id", F.lit(DISTINCT_LG)).alias("vehicle_sketch"),
        F.hll_sketch_agg("driver_id", F.lit(DISTINCT_LG)).alias("driver_sketch"),
        *_sums("distance_km", "avg_speed_kmh", "fuel_consumed_l"),
        F.sum("overspeed_event_count").alias("overspeed_event_count"),
        F.sum("overheating_event_count").alias("overheating_event_count"),
    )


@model
def route_durations(p: Project) -> DataFrame:
    """How many ended trips of each route and day took how many seconds: exact counts, which add up over any span."""
    ended = p["fact_trip"].where(F.col("is_complete") & F.col("route_id").isNotNull() & F.col("duration_seconds").isNotNull())
    return ended.groupBy("route_id", "trip_start_date", "duration_seconds").agg(F.count("*").alias("trips"))


def exact_quantiles(durations: DataFrame, *keys: str, **percents: int) -> DataFrame:
    """For each key the least duration that so many percent of its trips don't exceed. A key's window sees a row for each
    duration, not for each trip, and ranks are compared in whole numbers."""
    trips = F.col("trips")
    of_key = W.partitionBy(*keys)
    ranked = durations.groupBy(*keys, "duration_seconds").agg(F.sum("trips").alias("trips")).withColumns({"upto": F.sum(trips).over(of_key.orderBy("duration_seconds").rowsBetween(W.unboundedPreceding, W.currentRow)), "of": F.sum(trips).over(of_key)})
    return ranked.groupBy(*keys).agg(*[F.min(F.when(F.col("upto") * 100 >= F.col("of") * percent, F.col("duration_seconds"))).alias(name) for name, percent in percents.items()])


def quantile(sketch: Column | str, rank: float) -> Column:
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(rank))


@model
def route_performance(p: Project) -> DataFrame:
    """Sums of the days; percentiles from the counted durations, vehicles and drivers from the trips themselves, all exact."""
    days = p["route_daily"].groupBy("route_id").agg(
        F.sum("trip_count").alias("total_trips"),
        (F.sum("sum_seconds").cast("double") / F.sum("trip_count") / 60).alias("mean"),
        (F.min("least_seconds").cast("double") / 60).alias("low"),
        (F.max("most_seconds").cast("double") / 60).alias("high"),
        _mean("distance_km").alias("km"),
        _mean("avg_speed_kmh").alias("speed"),
        _mean("fuel_consumed_l").alias("litres"),
        F.sum("overspeed_event_count").alias("overspeed_event_count"),
        F.sum("overheating_event_count").alias("overheating_event_count"),
    )
    ranks = exact_quantiles(p["route_durations"], "route_id", median=50, p95=95)
    minutes = {name: F.col(name).cast("double") / 60 for name in ("median", "p95")}
    rolled = days.join(ranks.withColumns(minutes), "route_id", "left")
    who = p["fact_trip"].where("is_complete").groupBy("route_id").agg(F.count_distinct("vehicle_id").alias("distinct_vehicles"), F.count_distinct("driver_id").alias("distinct_drivers"))
    c = F.col
    # The spread is rounded as SQL does it, scaled first: a difference of minutes may lie just below a tie.
    return rolled.join(who, "route_id").join(p["dim_route"], "route_id").select("route_id", "route_name", "haul_type", "planned_distance_km", "total_trips", "distinct_vehicles", "distinct_drivers", _r(c("km"), 2, "avg_actual_distance_km"), _r(c("km") - c("planned_distance_km"), 2, "avg_distance_variance_km"), _r(c("mean"), 1, "avg_duration_minutes"), _r(c("median"), 1, "median_duration_minutes"), _r(c("p95"), 1, "p95_duration_minutes"), _r(c("low"), 1, "min_duration_minutes"), _r(c("high"), 1, "max_duration_minutes"), (F.round((c("p95") - c("median")) * 10) / 10).alias("duration_spread_minutes"), _r(c("speed"), 2, "avg_speed_kmh"), _r(c("litres"), 2, "avg_fuel_consumed_l"), _r(ratio(c("litres"), c("km"), 100), 2, "avg_l_per_100km"), "overspeed_event_count", "overheating_event_count")


@model
def vehicle_day_sketches(p: Project) -> DataFrame:
    """Vehicle days with sketches in the place of distinct counts: one pass that multiplies no row, and they merge."""
    sketch = lambda column, name: F.hll_sketch_agg(column, F.lit(FLEET_LG)).alias(name)
    minute = F.date_trunc("minute", "event_time").cast("string")
    return p["stg_telemetry"].groupBy("vehicle_id", "event_date").agg(F.count("*").alias("event_count"), sketch("trip_id", "trip_sketch"), sketch("driver_id", "driver_sketch"), sketch(minute, "minute_sketch"))


@model
def fleet_distincts(p: Project) -> DataFrame:
    """Days of the fleet: how many trips, drivers and active minutes, estimated from the vehicle days' merged sketches."""
    of = lambda c: F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch"))
    return p["vehicle_day_sketches"].groupBy("event_date").agg(F.sum("event_count").alias("event_count"), of("trip").alias("trips"), of("driver").alias("drivers"), of("minute").alias("minutes"))


@model
def data_quality_summary(p: Project) -> DataFrame:
    """Failures by day of processing against readings by day of the event, as the two ledgers have them."""
    failed = p["stg_quarantine"].groupBy("quarantine_date", "rule_name", "rule_severity").agg(F.count("*").alias("violation_count"), F.count_distinct("event_id").alias("rejected_event_count"))
    accepted = p["stg_telemetry"].groupBy(F.col("event_date").alias("quarantine_date")).agg(F.count("*").alias("accepted"))
    accepted_or_none = F.coalesce("accepted", F.lit(0))
    rejected = F.col("rejected_event_count")
    return failed.join(accepted, "quarantine_date", "left").select(F.col("quarantine_date").alias("report_date"), "rule_name", "rule_severity", "violation_count", "rejected_event_count", accepted_or_none.alias("accepted_event_count"), _r(F.when(F.col("accepted").isNotNull(), ratio(rejected, F.col("accepted") + rejected, 100)).otherwise(F.lit(None).cast("double")), 4, "rejection_rate_pct"))
