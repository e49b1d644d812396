"""The queries in DuckDB SQL, written apart from the DataFrame code: common table expressions per model, one statement per query."""

from __future__ import annotations

import re

from quarryline.fixture import CORRUPTIONS

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

_DIM = {
    "vehicles": """SELECT CAST(c_custkey AS VARCHAR) AS vehicle_id, c_mktsegment AS vehicle_type, n_name AS manufacturer, c_name AS model, r_name AS region,
      'owner-' || c_nationkey AS fleet_owner, (c_custkey % 7) * 1e1 + 6e1 AS max_speed_kmh, (c_custkey % 5) * 2e1 + 4e1 AS fuel_capacity_l,
      (c_custkey % 9) * 2.5e0 + 8e0 AS consumption_l_per_100km, c_custkey % 11 = 0 AS has_faulty_cooling
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "drivers": """SELECT CAST(s_suppkey AS VARCHAR) AS driver_id, s_name AS driver_name,
      CASE s_nationkey % 3 WHEN 0 THEN 'local' WHEN 1 THEN 'regional' ELSE 'long_distance' END AS driver_category,
      CASE WHEN s_suppkey % 2 = 0 THEN 'C' ELSE 'CE' END AS license_type, (s_suppkey % 10) * 1e-1 + 5e-1 AS aggression_index FROM supplier""",
    "routes": """SELECT event_type AS route_id, 'Route ' || event_type AS route_name, length(event_type) * 45e0 - 16e1 AS planned_distance_km FROM (SELECT DISTINCT event_type FROM events)""",
}

_RULES = {
    "vehicle_id_not_null": "length(trim(vehicle_id)) > 0",
    "event_id_not_null": "length(trim(event_id)) > 0",
    "event_time_not_null": "event_time IS NOT NULL",
    "trip_id_not_null": "length(trim(trip_id)) > 0",
    "speed_type_valid": "json_extract_string(raw_payload, '$.speed') IS NULL OR speed IS NOT NULL",
    "fuel_level_type_valid": "json_extract_string(raw_payload, '$.fuel_level') IS NULL OR fuel_level IS NOT NULL",
    "engine_temperature_type_valid": "json_extract_string(raw_payload, '$.engine_temperature') IS NULL OR engine_temperature IS NOT NULL",
    "speed_non_negative": "speed IS NULL OR speed >= 0",
    "speed_within_plausible_max": "speed IS NULL OR speed <= 200",
    "fuel_level_range": "fuel_level IS NULL OR (fuel_level >= 0 AND fuel_level <= 100)",
    "battery_level_range": "battery_level IS NULL OR (battery_level >= 0 AND battery_level <= 100)",
    "engine_temperature_range": "engine_temperature IS NULL OR (engine_temperature >= -50 AND engine_temperature <= 200)",
    "latitude_range": "latitude IS NULL OR (latitude >= -90 AND latitude <= 90)",
    "longitude_range": "longitude IS NULL OR (longitude >= -180 AND longitude <= 180)",
    "odometer_non_negative": "odometer_km IS NULL OR odometer_km >= 0",
    "event_time_not_in_future": f"event_time IS NULL OR event_time <= {AS_OF} + INTERVAL 1 DAY",
    "event_time_not_ancient": "event_time IS NULL OR event_time >= TIMESTAMP '2020-01-01 00:00:00'",
}
_FAILED = "list_filter([" + ", ".join(f"CASE WHEN coalesce({e}, false) THEN NULL ELSE '{n}' END" for n, e in _RULES.items()) + "], lambda x: x IS NOT NULL)"

_KINDS = "[" + ", ".join(f"'{k}'" for k in CORRUPTIONS) + "]"

_RULE_OF = "CASE injection " + " ".join(f"WHEN '{k}' THEN '{r}'" for k, r in CORRUPTIONS.items()) + " END"

_HOP = """CASE WHEN prev_latitude IS NULL THEN 0e0 ELSE 2 * 6371.0088e0 * asin(sqrt(power(sin(radians(latitude - prev_latitude) / 2), 2)
      + cos(radians(prev_latitude)) * cos(radians(latitude)) * power(sin(radians(longitude - prev_longitude) / 2), 2))) END"""

#: Models by name; each is a query over the driver's tables and other models.
CTES: dict[str, str] = {
    **_DIM,
    "telemetry": """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS vehicle_id, CAST(user_id % 13 AS VARCHAR) AS driver_id,
      user_id || '-' || CAST(ts AS DATE) AS trip_id, event_type AS route_id, ts AS event_time, value % 90e0 AS latitude, value % 179e0 AS longitude,
      value - 2e0 AS speed, k * 1.02e0 AS fuel_level, 6e1 + k * 6e-1 + value * 2e-1 AS engine_temperature, 1e2 - k * 9e-1 AS battery_level,
      event_id * 5e-2 AS odometer_km, CASE WHEN event_id % 97 = 0 THEN '0.9' ELSE '1.0' END AS schema_version,
      ts + to_seconds(event_id % 1800) AS ingestion_time, CAST(user_id % 12 AS INTEGER) AS kafka_partition, event_id AS kafka_offset, props AS raw_payload
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
    "bronze": """SELECT * FROM telemetry UNION ALL SELECT * REPLACE (ingestion_time + INTERVAL 60 SECOND AS ingestion_time, kafka_offset + 1000000000 AS kafka_offset) FROM telemetry WHERE kafka_offset % 50 = 0""",
    "judged": f"SELECT *, {_FAILED} AS failed FROM bronze",
    "enriched": """SELECT t.*, v.vehicle_type, v.manufacturer, v.model, v.region, v.fleet_owner, d.driver_name, d.driver_category,
      speed > max_speed_kmh AS is_overspeed, engine_temperature > 100 AS is_overheating, fuel_level < 15 AS is_low_fuel
    FROM telemetry t LEFT JOIN vehicles v USING (vehicle_id) LEFT JOIN drivers d USING (driver_id)""",
    "silver": """SELECT t.* EXCLUDE (failed, raw_payload), v.vehicle_type, v.manufacturer, v.model, v.region, v.fleet_owner, d.driver_name, d.driver_category,
      speed > max_speed_kmh AS is_overspeed, engine_temperature > 100 AS is_overheating, fuel_level < 15 AS is_low_fuel, ingestion_time + INTERVAL 60 SECOND AS processed_at
    FROM (SELECT * FROM judged WHERE len(failed) = 0 QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC, kafka_offset DESC) = 1) t
    LEFT JOIN vehicles v USING (vehicle_id) LEFT JOIN drivers d USING (driver_id)""",
    "quarantine": """SELECT event_id, vehicle_id, rule_name, 'critical' AS rule_severity, ingestion_time + INTERVAL 60 SECOND AS quarantined_at
    FROM (SELECT *, unnest(failed) AS rule_name FROM judged) QUALIFY row_number() OVER (PARTITION BY event_id, rule_name ORDER BY ingestion_time DESC, kafka_offset DESC) = 1""",
    "stg": """SELECT event_id, vehicle_id, driver_id, trip_id, route_id, event_time, ingestion_time, latitude, longitude, odometer_km, vehicle_type, manufacturer, model, region, fleet_owner,
      driver_name, driver_category, kafka_partition, kafka_offset, schema_version, CAST(event_time AS DATE) AS event_date, date_sub('second', event_time, ingestion_time) AS ingestion_lag_seconds,
      speed AS speed_kmh, fuel_level AS fuel_level_pct, engine_temperature AS engine_temperature_c, battery_level AS battery_level_pct,
      coalesce(is_overspeed, false) AS is_overspeed, coalesce(is_overheating, false) AS is_overheating, coalesce(is_low_fuel, false) AS is_low_fuel, processed_at, 'run-1' AS silver_run_id FROM silver""",
    "hops": f"""SELECT *, {_HOP} AS hop_km FROM (SELECT *, lag(latitude) OVER w AS prev_latitude, lag(longitude) OVER w AS prev_longitude FROM stg WINDOW w AS (PARTITION BY trip_id ORDER BY event_time, event_id))""",
    "trips": f"""SELECT *, CAST(trip_started_at AS DATE) AS trip_start_date, trip_ended_at < {AS_OF} - INTERVAL 30 MINUTE AS is_complete, event_count >= 5 AS has_sufficient_events,
      CASE WHEN duration_seconds > 0 THEN odometer_distance_km / (duration_seconds / 36e2) END AS implied_avg_speed_kmh
    FROM (SELECT trip_id, min(vehicle_id) AS vehicle_id, min(driver_id) AS driver_id, min(route_id) AS route_id, count(DISTINCT vehicle_id) AS distinct_vehicles,
      min(event_time) AS trip_started_at, max(event_time) AS trip_ended_at, date_sub('second', min(event_time), max(event_time)) AS duration_seconds, count(*) AS event_count,
      max(odometer_km) - min(odometer_km) AS odometer_distance_km, sum(hop_km) AS gps_distance_km, avg(speed_kmh) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh,
      max(fuel_level_pct) AS fuel_level_start_pct, min(fuel_level_pct) AS fuel_level_end_pct, max(engine_temperature_c) AS max_engine_temperature_c,
      avg(engine_temperature_c) AS avg_engine_temperature_c, min(battery_level_pct) AS min_battery_level_pct, count_if(is_overspeed) AS overspeed_event_count,
      count_if(is_overheating) AS overheating_event_count, count_if(is_low_fuel) AS low_fuel_event_count, max(ingestion_lag_seconds) AS max_ingestion_lag_seconds
    FROM hops GROUP BY trip_id)""",
    "daily": """SELECT vehicle_id, event_date, count(*) AS event_count, count(DISTINCT trip_id) AS trip_count, count(DISTINCT driver_id) AS driver_count,
      max(odometer_km) - min(odometer_km) AS distance_km, max(odometer_km) AS odometer_end_km, avg(speed_kmh) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh,
      max(fuel_level_pct) AS fuel_level_max_pct, min(fuel_level_pct) AS fuel_level_min_pct, avg(engine_temperature_c) AS avg_engine_temperature_c,
      max(engine_temperature_c) AS max_engine_temperature_c, min(battery_level_pct) AS min_battery_level_pct, count_if(is_overspeed) AS overspeed_event_count,
      count_if(is_overheating) AS overheating_event_count, count_if(is_low_fuel) AS low_fuel_event_count, count(DISTINCT date_trunc('minute', event_time)) AS active_minutes,
      min(event_time) AS first_event_at, max(event_time) AS last_event_at FROM stg GROUP BY vehicle_id, event_date""",
    "incidents": """SELECT *, md5(event_id || '-' || incident_type) AS incident_id, CASE WHEN incident_type = 'engine_critical_overheat' THEN 'critical'
      WHEN incident_type IN ('engine_overheat', 'severe_overspeed') THEN 'high' ELSE 'medium' END AS severity
    FROM (SELECT event_id, vehicle_id, driver_id, trip_id, route_id, event_time, event_date, latitude, longitude, speed_kmh, engine_temperature_c, fuel_level_pct, battery_level_pct,
      vehicle_type, region, driver_name, driver_category, CASE WHEN engine_temperature_c > 115 THEN 'engine_critical_overheat' WHEN engine_temperature_c > 100 THEN 'engine_overheat'
      WHEN speed_kmh > 140 THEN 'severe_overspeed' WHEN is_overspeed THEN 'overspeed' WHEN fuel_level_pct < 15 THEN 'low_fuel' END AS incident_type FROM stg) WHERE incident_type IS NOT NULL""",
    "fact_trip": """SELECT t.* EXCLUDE (odometer_distance_km), odometer_distance_km AS distance_km, duration_seconds / 6e1 AS duration_minutes, abs(odometer_distance_km - gps_distance_km) AS distance_discrepancy_km,
      fuel_level_start_pct - fuel_level_end_pct AS fuel_consumed_pct, (fuel_level_start_pct - fuel_level_end_pct) / 1e2 * fuel_capacity_l AS fuel_consumed_l,
      CASE WHEN odometer_distance_km > 0 THEN (fuel_level_start_pct - fuel_level_end_pct) / 1e2 * fuel_capacity_l / odometer_distance_km * 1e2 END AS actual_l_per_100km,
      consumption_l_per_100km AS rated_l_per_100km FROM trips t LEFT JOIN vehicles v USING (vehicle_id)""",
    "fact_daily": """SELECT md5(vehicle_id || '-' || event_date) AS vehicle_day_key, vehicle_id, event_date, event_date AS date_key, vehicle_type, region, fleet_owner, event_count, trip_count, driver_count,
      distance_km AS total_distance_km, odometer_end_km, avg_speed_kmh, max_speed_kmh, (fuel_level_max_pct - fuel_level_min_pct) / 1e2 * fuel_capacity_l AS total_fuel_consumed_l,
      avg_engine_temperature_c, max_engine_temperature_c, min_battery_level_pct, overspeed_event_count, overheating_event_count AS engine_overheat_count, low_fuel_event_count,
      overspeed_event_count + overheating_event_count + low_fuel_event_count AS incident_count, active_minutes, round(active_minutes / 1440e0 * 100, 2) AS utilisation_pct, first_event_at, last_event_at
    FROM daily LEFT JOIN (SELECT vehicle_id, vehicle_type, region, fleet_owner, fuel_capacity_l FROM vehicles) USING (vehicle_id)""",
    "fleet": """SELECT event_date, count(DISTINCT vehicle_id) AS active_vehicles, CAST(sum(trip_count) AS BIGINT) AS total_trips, CAST(sum(event_count) AS BIGINT) AS total_events,
      round(sum(total_distance_km), 2) AS total_distance_km, round(sum(total_fuel_consumed_l), 2) AS total_fuel_consumed_l,
      CASE WHEN sum(total_distance_km) > 0 THEN round(sum(total_fuel_consumed_l) / sum(total_distance_km) * 100, 2) END AS fleet_l_per_100km,
      round(avg(avg_speed_kmh), 2) AS avg_speed_kmh, round(max(max_speed_kmh), 2) AS max_speed_kmh, CAST(sum(incident_count) AS BIGINT) AS total_incidents,
      CAST(sum(engine_overheat_count) AS BIGINT) AS overheat_incidents, CAST(sum(overspeed_event_count) AS BIGINT) AS overspeed_incidents, CAST(sum(low_fuel_event_count) AS BIGINT) AS low_fuel_incidents,
      round(sum(CAST(round(utilisation_pct * 100) AS BIGINT)) / count(*) / 1e2, 2) AS avg_utilisation_pct, count_if(max_engine_temperature_c > 100) AS vehicles_overheating FROM fact_daily GROUP BY event_date""",
    "driver_report": """SELECT driver_id, driver_name, driver_category, license_type, CASE WHEN aggression_index < 0.8e0 THEN 'cautious' WHEN aggression_index < 1.3e0 THEN 'normal' ELSE 'aggressive' END AS risk_band,
      total_trips, round(km, 2) AS total_distance_km, round(hours, 2) AS total_driving_hours, round(minutes, 1) AS avg_trip_minutes, round(speed, 2) AS avg_speed_kmh, round(top, 2) AS max_speed_kmh,
      overspeed_event_count, overheating_event_count, CASE WHEN km > 0 THEN round(overspeed_event_count / km * 100, 3) END AS overspeed_events_per_100km,
      CASE WHEN km > 0 THEN round(litres / km * 100, 2) END AS l_per_100km
    FROM (SELECT driver_id, count(*) AS total_trips, sum(distance_km) AS km, sum(duration_seconds) / 36e2 AS hours, avg(duration_seconds) / 6e1 AS minutes, avg(avg_speed_kmh) AS speed, max(max_speed_kmh) AS top,
      CAST(sum(overspeed_event_count) AS BIGINT) AS overspeed_event_count, CAST(sum(overheating_event_count) AS BIGINT) AS overheating_event_count, sum(fuel_consumed_l) AS litres
      FROM fact_trip WHERE is_complete GROUP BY driver_id) JOIN drivers USING (driver_id)""",
    "vehicle_report": """SELECT vehicle_id, manufacturer || ' ' || model AS vehicle_description, vehicle_type, region, fleet_owner,
      CASE WHEN consumption_l_per_100km < 12 THEN 'efficient' WHEN consumption_l_per_100km < 22 THEN 'standard' ELSE 'heavy' END AS consumption_band, has_faulty_cooling, active_days, total_trips,
      round(km, 2) AS total_distance_km, round(litres, 2) AS total_fuel_consumed_l, CASE WHEN km > 0 THEN round(litres / km * 100, 2) END AS actual_l_per_100km, consumption_l_per_100km AS rated_l_per_100km,
      CASE WHEN km > 0 AND consumption_l_per_100km > 0 THEN round(litres / km * 100 / consumption_l_per_100km, 3) END AS consumption_vs_rated_ratio, round(speed, 2) AS avg_speed_kmh, round(top, 2) AS max_speed_kmh,
      round(hottest, 2) AS max_engine_temperature_c, round(warmth, 2) AS avg_engine_temperature_c, overheat_event_count, overspeed_event_count, total_incidents, round(use, 2) AS avg_utilisation_pct, last_active_date,
      overheat_event_count > 0 OR hottest > 115 AS needs_maintenance_review
    FROM (SELECT vehicle_id, count(DISTINCT event_date) AS active_days, CAST(sum(trip_count) AS BIGINT) AS total_trips, sum(total_distance_km) AS km, sum(total_fuel_consumed_l) AS litres, avg(avg_speed_kmh) AS speed,
      max(max_speed_kmh) AS top, max(max_engine_temperature_c) AS hottest, avg(avg_engine_temperature_c) AS warmth, CAST(sum(engine_overheat_count) AS BIGINT) AS overheat_event_count,
      CAST(sum(overspeed_event_count) AS BIGINT) AS overspeed_event_count, CAST(sum(incident_count) AS BIGINT) AS total_incidents, sum(CAST(round(utilisation_pct * 100) AS BIGINT)) / count(*) / 1e2 AS use, max(event_date) AS last_active_date
      FROM fact_daily GROUP BY vehicle_id) JOIN vehicles USING (vehicle_id)""",
    "route_report": """SELECT route_id, route_name, CASE WHEN planned_distance_km < 50 THEN 'short_haul' WHEN planned_distance_km < 250 THEN 'medium_haul' ELSE 'long_haul' END AS haul_type, planned_distance_km, total_trips,
      distinct_vehicles, distinct_drivers, round(km, 2) AS avg_actual_distance_km, round(km - planned_distance_km, 2) AS avg_distance_variance_km, round(mean, 1) AS avg_duration_minutes,
      round(median, 1) AS median_duration_minutes, round(p95, 1) AS p95_duration_minutes, round(low, 1) AS min_duration_minutes, round(high, 1) AS max_duration_minutes,
      round(p95 - median, 1) AS duration_spread_minutes, round(speed, 2) AS avg_speed_kmh, round(litres, 2) AS avg_fuel_consumed_l, CASE WHEN km > 0 THEN round(litres / km * 100, 2) END AS avg_l_per_100km,
      overspeed_event_count, overheating_event_count
    FROM (SELECT route_id, count(*) AS total_trips, count(DISTINCT vehicle_id) AS distinct_vehicles, count(DISTINCT driver_id) AS distinct_drivers, avg(duration_seconds) / 6e1 AS mean,
      min(duration_seconds) / 6e1 AS low, max(duration_seconds) / 6e1 AS high, quantile_disc(duration_seconds, 0.5) / 6e1 AS median, quantile_disc(duration_seconds, 0.95) / 6e1 AS p95,
      avg(distance_km) AS km, avg(avg_speed_kmh) AS speed, avg(fuel_consumed_l) AS litres, CAST(sum(overspeed_event_count) AS BIGINT) AS overspeed_event_count,
      CAST(sum(overheating_event_count) AS BIGINT) AS overheating_event_count FROM fact_trip WHERE is_complete AND route_id IS NOT NULL GROUP BY route_id) JOIN routes USING (route_id)""",
    "quality": """SELECT q.day AS report_date, rule_name, rule_severity, violation_count, rejected_event_count, coalesce(accepted, 0) AS accepted_event_count,
      CASE WHEN accepted IS NOT NULL THEN round(rejected_event_count * 1e2 / (accepted + rejected_event_count), 4) END AS rejection_rate_pct
    FROM (SELECT CAST(quarantined_at AS DATE) AS day, rule_name, rule_severity, count(*) AS violation_count, count(DISTINCT event_id) AS rejected_event_count FROM quarantine GROUP BY ALL) q
    LEFT JOIN (SELECT event_date AS day, count(*) AS accepted FROM stg GROUP BY 1) a USING (day)""",
    "ledger": """SELECT *, CAST(keys - CASE WHEN batch_id % 10 = 0 THEN 1 ELSE 0 END AS BIGINT) AS output_count FROM (SELECT day(event_time) AS batch_id, count(*) AS source_count, count_if(len(failed) > 0) AS rejected_count,
      count(DISTINCT event_id) FILTER (len(failed) = 0) AS keys, count_if(len(failed) = 0) - count(DISTINCT event_id) FILTER (len(failed) = 0) AS duplicate_count, max(ingestion_time) AS recorded_at FROM judged GROUP BY 1)""",
    "injected": f"""SELECT * REPLACE (CASE WHEN injection = 'null_vehicle_id' THEN NULL ELSE vehicle_id END AS vehicle_id, CASE WHEN injection = 'missing_event_time' THEN NULL ELSE event_time END AS event_time,
      CASE injection WHEN 'negative_speed' THEN -1 - least(greatest(speed, 0), 190) WHEN 'unparseable_speed' THEN NULL ELSE least(greatest(speed, 0), 190) END AS speed,
      CASE WHEN injection = 'fuel_out_of_range' THEN 160 ELSE least(fuel_level, 99) END AS fuel_level, CASE WHEN injection = 'latitude_out_of_range' THEN 123 ELSE latitude END AS latitude,
      CASE WHEN injection = 'longitude_out_of_range' THEN -200.5 ELSE longitude END AS longitude, CASE WHEN injection = 'battery_out_of_range' THEN -3 ELSE battery_level END AS battery_level,
      CASE WHEN injection = 'absurd_engine_temperature' THEN 500 ELSE least(engine_temperature, 190) END AS engine_temperature,
      CASE WHEN injection = 'unparseable_speed' THEN '{{"speed": "fast"}}' ELSE raw_payload END AS raw_payload)
    FROM (SELECT *, CASE WHEN kafka_offset % 200 = 3 THEN {_KINDS}[(kafka_offset // 200) % {len(CORRUPTIONS)} + 1] END AS injection FROM telemetry)""",
    "stream_incidents": """SELECT *, CASE WHEN incident_type = 'engine_critical_overheat' THEN 'critical' WHEN incident_type IN ('engine_overheat', 'severe_overspeed') THEN 'high' ELSE 'medium' END AS severity
    FROM (SELECT *, CASE WHEN engine_temperature > 115 THEN 'engine_critical_overheat' WHEN engine_temperature > 100 THEN 'engine_overheat' WHEN speed > 140 THEN 'severe_overspeed'
      WHEN fuel_level < 10 THEN 'low_fuel' WHEN battery_level < 20 THEN 'low_battery' END AS incident_type FROM telemetry) WHERE incident_type IS NOT NULL""",
    "target": "SELECT event_id, kafka_offset, vehicle_id, CAST(event_time AS DATE) AS event_date, round(speed, 4) AS speed FROM telemetry WHERE kafka_offset % 3 <> 0",
    "updates": "SELECT event_id, kafka_offset, vehicle_id, CAST(event_time AS DATE) AS event_date, round(round(speed, 4) + 1000, 4) AS speed FROM telemetry WHERE kafka_offset % 2 = 0 OR kafka_offset % 3 = 0",
    "merged": "SELECT * FROM updates UNION ALL SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM updates)",
}


def with_models(sql: str) -> str:
    """The statement with the common table expressions that it needs, in order."""
    order: list[str] = []

    def visit(text: str, own: str = "") -> None:
        for name in CTES:
            if name != own and name not in order and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                visit(CTES[name], name)
                order.append(name)

    visit(sql)
    return ("WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" if order else "") + sql


#: Sums of distances on the sphere differ in their last digits between engines.
_COARSE = ("gps_distance_km", "distance_discrepancy_km")


def _round(columns: str, model: str) -> str:
    return f"SELECT * REPLACE ({', '.join(f'round({c}, {4 if c in _COARSE else 9}) AS {c}' for c in columns.split())}) FROM {model}"


_STG = "latitude longitude odometer_km speed_kmh fuel_level_pct engine_temperature_c battery_level_pct"
_TRIP = "gps_distance_km avg_speed_kmh max_speed_kmh fuel_level_start_pct fuel_level_end_pct max_engine_temperature_c avg_engine_temperature_c min_battery_level_pct implied_avg_speed_kmh"
_DAY = "odometer_end_km avg_speed_kmh max_speed_kmh avg_engine_temperature_c max_engine_temperature_c min_battery_level_pct"

_SQL: dict[str, str] = {
    "scan_project": "SELECT event_id, vehicle_id, event_time, speed FROM telemetry WHERE speed > 100",
    "stg_telemetry": _round(_STG, "stg"),
    "json_parse": """SELECT event_id, vehicle_id, driver_id, trip_id, route_id, event_time, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude, CASE WHEN kafka_offset % 5 = 0 THEN NULL ELSE round(speed, 9) END AS speed,
      round(fuel_level, 9) AS fuel_level, round(engine_temperature, 9) AS engine_temperature, round(battery_level, 9) AS battery_level, round(odometer_km, 9) AS odometer_km, schema_version FROM telemetry""",
    "json_extract": "SELECT event_id, json_extract_string(raw_payload, '$.k') AS k, json_extract_string(raw_payload, '$.absent') IS NULL AS no_such_field FROM telemetry",
    "incident_json": """SELECT vehicle_id AS key, event_id, vehicle_id, driver_id, trip_id, date_trunc('millisecond', event_time) AS event_time, incident_type, severity, round(speed, 9) AS speed, round(engine_temperature, 9) AS engine_temperature,
      round(fuel_level, 9) AS fuel_level, round(battery_level, 9) AS battery_level, round(latitude, 9) AS latitude, round(longitude, 9) AS longitude FROM stream_incidents""",
    "interpolated": "SELECT event_id, round(latitude * least(greatest(fuel_level / 5e1, 0), 1), 9) AS latitude, round(longitude * least(greatest(fuel_level / 5e1, 0), 1), 9) AS longitude FROM telemetry",
    "derive_flags": "SELECT event_id, is_overspeed, is_overheating, is_low_fuel FROM enriched",
    "enrich_left_broadcast": "SELECT event_id, vehicle_type, manufacturer, model, region, fleet_owner, driver_name, driver_category FROM enriched",
    "ingestion_lag": "SELECT event_id, date_sub('second', event_time, ingestion_time) AS lag_seconds FROM telemetry",
    "late_over_5min": "SELECT count_if((CAST(floor(epoch(ingestion_time)) AS BIGINT) - CAST(floor(epoch(event_time)) AS BIGINT)) / 6e1 > 5) AS late, count_if(CAST(event_time AS DATE) <> CAST(ingestion_time AS DATE)) AS crossed_days FROM silver",
    "surrogate_keys": "SELECT event_id, md5(vehicle_id || '-' || CAST(event_time AS DATE)) AS day_key, md5(event_id || '-<null>') AS null_key FROM telemetry",
    "quarantine_keys": "SELECT event_id, sha256(event_id || '|speed_non_negative') AS key FROM telemetry",
    "dim_bands": """SELECT 'vehicle' AS dimension, vehicle_id AS id, CASE WHEN consumption_l_per_100km < 12 THEN 'efficient' WHEN consumption_l_per_100km < 22 THEN 'standard' ELSE 'heavy' END AS band FROM vehicles
      UNION ALL SELECT 'driver', driver_id, CASE WHEN aggression_index < 0.8e0 THEN 'cautious' WHEN aggression_index < 1.3e0 THEN 'normal' ELSE 'aggressive' END FROM drivers
      UNION ALL SELECT 'route', route_id, CASE WHEN planned_distance_km < 50 THEN 'short_haul' WHEN planned_distance_km < 250 THEN 'medium_haul' ELSE 'long_haul' END FROM routes""",
    "dim_date": """SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day_of_month,
      CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(week(d) AS INTEGER) AS week_of_year, strftime(d, '%B') AS month_name, strftime(d, '%A') AS day_name, isodow(d) IN (6, 7) AS is_weekend
    FROM (SELECT unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS d)""",
    "incident_detect_stream": "SELECT event_id, vehicle_id, incident_type, severity FROM stream_incidents",
    "dedupe_latest": "SELECT event_id, kafka_offset, ingestion_time FROM bronze QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time DESC, kafka_offset DESC) = 1",
    "dedupe_lineitem": "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1",
    "gps_hops": "SELECT event_id, trip_id, round(hop_km, 3) AS hop_km FROM hops",
    "trip_metrics": _round(_TRIP + " odometer_distance_km", "trips"),
    "vehicle_daily": _round(_DAY + " distance_km fuel_level_max_pct fuel_level_min_pct", "daily"),
    "int_incidents": _round("latitude longitude speed_kmh engine_temperature_c fuel_level_pct battery_level_pct", "incidents"),
    "fact_telemetry": "SELECT event_id, vehicle_id, driver_id, trip_id, route_id, event_time, event_date, ingestion_time, ingestion_lag_seconds, " + ", ".join(f"round({c}, 9) AS {c}" for c in _STG.split()) + ", is_overspeed, is_overheating, is_low_fuel, kafka_partition, schema_version FROM stg",
    "fact_trip": _round(_TRIP + " distance_km duration_minutes distance_discrepancy_km fuel_consumed_pct fuel_consumed_l actual_l_per_100km rated_l_per_100km", "fact_trip"),
    "fact_vehicle_daily": _round(_DAY + " total_distance_km total_fuel_consumed_l utilisation_pct", "fact_daily"),
    "fact_driver_incident": _round("latitude longitude speed_kmh engine_temperature_c fuel_level_pct battery_level_pct", "incidents"),
    "fleet_daily_summary": "SELECT * FROM fleet",
    "driver_performance": "SELECT * FROM driver_report",
    "vehicle_performance": "SELECT * FROM vehicle_report",
    "route_performance": "SELECT * FROM route_report",
    "data_quality_summary": "SELECT * FROM quality",
    "route_daily": """SELECT route_id, trip_start_date, count(*) AS trip_count, CAST(sum(duration_seconds) AS BIGINT) AS sum_seconds, CAST(quantile_disc(duration_seconds, 0.5) AS BIGINT) AS median_seconds,
      CAST(quantile_disc(duration_seconds, 0.95) AS BIGINT) AS p95_seconds, count(*) AS sketched FROM fact_trip WHERE is_complete AND route_id IS NOT NULL GROUP BY ALL""",
    "percentile_rank_error": "SELECT route_id, count(*) AS n, true AS within_error FROM stg GROUP BY 1",
    "distinct_sketches": "SELECT event_date, count(*) AS event_count, count(DISTINCT trip_id) AS n_trips, count(DISTINCT driver_id) AS n_drivers, count(DISTINCT date_trunc('minute', event_time)) AS n_minutes, true AS within_error FROM stg GROUP BY 1",
    "top_overheating": "SELECT vehicle_id, count(*) AS overheating_events FROM silver WHERE engine_temperature > 100 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "latest_day": "SELECT event_date, active_vehicles, total_trips, total_distance_km, total_incidents FROM fleet ORDER BY 1 DESC LIMIT 1",
    "maintenance_shortlist": "SELECT vehicle_id, vehicle_description, overheat_event_count, max_engine_temperature_c FROM vehicle_report WHERE needs_maintenance_review ORDER BY 3 DESC, 4 DESC, 1 LIMIT 25",
    "overheating_yesterday": "SELECT vehicle_id, engine_overheat_count, round(max_engine_temperature_c, 2) AS max_engine_temperature_c FROM fact_daily WHERE event_date = DATE '2024-01-30' AND engine_overheat_count > 0 ORDER BY 2 DESC, 1 LIMIT 20",
    "driver_ranking": "SELECT driver_id, driver_name, total_trips, overspeed_events_per_100km FROM driver_report WHERE total_trips >= 3 ORDER BY 4 DESC NULLS LAST, 1 LIMIT 25",
    "route_reliability": "SELECT route_id, median_duration_minutes, p95_duration_minutes, duration_spread_minutes FROM route_report ORDER BY 4 DESC, 1",
    "rejections_by_rule": "SELECT report_date, rule_name, violation_count, rejection_rate_pct FROM quality ORDER BY 1 DESC, 3 DESC, 2 LIMIT 50",
    "daily_series": """SELECT CAST(d AS TIMESTAMP) AS time, coalesce(total_incidents, 0) AS total_incidents, coalesce(overheat_incidents, 0) AS overheat_incidents, coalesce(total_events, 0) AS total_events
      FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS d) LEFT JOIN fleet ON event_date = d ORDER BY 1""",
    "violations_by_rule": "SELECT rule_name, rule_severity, count(*) AS n FROM quarantine GROUP BY ALL ORDER BY 3 DESC, 1",
    "unaccounted_batches": "SELECT batch_id, recorded_at, source_count - duplicate_count - rejected_count - output_count AS unaccounted FROM ledger WHERE source_count - duplicate_count - rejected_count <> output_count ORDER BY 2 DESC, 1",
    "violations_last_day": f"SELECT rule_name, rule_severity, count(*) AS violations FROM quarantine WHERE quarantined_at >= {AS_OF} - INTERVAL 1 DAY GROUP BY ALL",
    "dq_annotate": f"SELECT event_id, array_to_string(f, ',') AS failed, CASE WHEN schema_version = '1.0' THEN '' ELSE 'schema_version_known' END AS warnings, len(f) = 0 AS valid FROM (SELECT *, {_FAILED} AS f FROM telemetry)",
    "dq_split_valid": f"SELECT event_id, vehicle_id, trip_id FROM (SELECT *, {_FAILED} AS f FROM telemetry) WHERE len(f) = 0",
    "dq_split_quarantine": f"SELECT event_id, unnest(f) AS rule_name, 'critical' AS rule_severity FROM (SELECT *, {_FAILED} AS f FROM telemetry)",
    "corruption_counts": f"SELECT injection, count(*) AS records, count_if(list_contains(f, rule)) AS caught FROM (SELECT *, {_FAILED} AS f, {_RULE_OF} AS rule FROM injected WHERE injection IS NOT NULL) GROUP BY 1",
    "injection_ledger": "SELECT count(*) + count_if(kafka_offset % 50 = 0) AS total_produced, count_if(injection IS NULL) AS clean, count_if(kafka_offset % 50 = 0) AS duplicates, count(injection) AS invalid, count_if(CAST(floor(epoch(ingestion_time)) AS BIGINT) - CAST(floor(epoch(event_time)) AS BIGINT) > 300) AS late, (SELECT max(n) FROM (SELECT count(*) AS n FROM telemetry GROUP BY vehicle_id)) AS hot FROM injected",
    "upsert_merge": "SELECT event_id, vehicle_id, event_date, speed FROM merged",
    "upsert_moved_day": """SELECT event_id, CASE WHEN kafka_offset % 7 = 0 OR kafka_offset % 5 = 0 THEN round(round(speed, 4) + 1000, 4) ELSE round(speed, 4) END AS speed,
      CAST(CASE WHEN kafka_offset % 7 = 0 THEN CAST(event_time AS DATE) + 1 ELSE CAST(event_time AS DATE) END AS DATE) AS event_date FROM telemetry""",
    "record_bytes": "SELECT hex(encode(vehicle_id)) AS key_hex, vehicle_id AS key, event_id, trip_id, round(speed, 6) AS speed FROM telemetry",
    "replay_idempotent": "SELECT count(*) AS rows_before, count(*) AS rows_after, count(DISTINCT event_id) AS keys_after FROM merged",
    "replay_sample": """SELECT (SELECT count(*) FROM silver) AS rows_before, (SELECT count(*) FROM bronze WHERE event_id IN (SELECT event_id FROM silver ORDER BY 1 LIMIT 500)) AS replayed,
      (SELECT count(*) FROM silver) AS rows_after, (SELECT count(*) FROM silver) AS keys_after""",
    "incremental_window": "SELECT event_date, count(*) AS n FROM stg WHERE event_time >= TIMESTAMP '2024-01-29' GROUP BY 1",
    "incremental_upsert": """SELECT trip_id, CASE WHEN trip_id IN (SELECT trip_id FROM stg WHERE event_time >= TIMESTAMP '2024-01-29') THEN event_count ELSE -1 END AS event_count, round(max_speed_kmh, 4) AS max_speed_kmh FROM trips""",
    "row_conservation": """SELECT *, records - stored - rejected AS missing FROM (SELECT (SELECT count(DISTINCT event_id) FROM bronze) AS records, (SELECT count(*) FROM silver) AS stored, (SELECT count(DISTINCT event_id) FROM quarantine) AS rejected)""",
    "quarantine_exclusive": "SELECT count(*) AS leaked FROM silver WHERE event_id IN (SELECT event_id FROM quarantine)",
    "event_time_preserved": "SELECT count(*) AS altered FROM silver JOIN (SELECT event_id, min(event_time) AS first FROM bronze GROUP BY 1) USING (event_id) WHERE event_time <> first",
    "reconciliation_balance": """SELECT count(*) AS batches, count_if(source_count - duplicate_count - rejected_count <> output_count) AS unbalanced, CAST(sum(source_count) AS BIGINT) AS total_source,
      CAST(sum(rejected_count) AS BIGINT) AS total_rejected, CAST(sum(output_count) AS BIGINT) AS total_output FROM ledger""",
    "source_freshness": f"""SELECT *, CASE WHEN age_minutes > 120 THEN 'error' WHEN age_minutes > 30 THEN 'warn' ELSE 'fresh' END AS status
      FROM (SELECT max(event_time) AS latest_event, max(processed_at) AS latest_written, count(*) AS row_count, date_sub('minute', max(processed_at), {AS_OF}) AS age_minutes FROM silver)""",
    "distinct_count": "SELECT count(DISTINCT event_id) AS n FROM bronze",
    "grain_unique": """SELECT 'fact_trip' AS "table", (SELECT count(*) FROM (SELECT trip_id FROM fact_trip GROUP BY 1 HAVING count(*) > 1)) AS repeated
      UNION ALL SELECT 'fact_vehicle_daily', (SELECT count(*) FROM (SELECT vehicle_day_key FROM fact_daily GROUP BY 1 HAVING count(*) > 1))
      UNION ALL SELECT 'lineitem', (SELECT count(*) FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))""",
    "ref_integrity": """SELECT 'driver_id' AS key, driver_id AS value, count(*) AS readings FROM telemetry WHERE driver_id NOT IN (SELECT driver_id FROM drivers) GROUP BY 2
      UNION ALL SELECT 'vehicle_id', vehicle_id, count(*) FROM telemetry WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles) GROUP BY 2
      UNION ALL SELECT 'event_id', rule_name, count(*) FROM quarantine WHERE event_id NOT IN (SELECT event_id FROM silver) GROUP BY 2""",
    "accepted_range": "SELECT event_id, round(fuel_level, 4) AS fuel_level FROM telemetry WHERE fuel_level NOT BETWEEN 0 AND 100",
    "accepted_values": "SELECT severity, count(*) AS n FROM incidents WHERE severity NOT IN ('critical', 'high') GROUP BY 1",
    "not_null": "SELECT count_if(vehicle_id IS NULL) AS vehicle_id, count_if(event_time IS NULL) AS event_time, count_if(speed IS NULL) AS speed FROM injected",
    "partition_skew": "SELECT max(n) AS largest, round(avg(n), 9) AS mean, round(max(n) / avg(n), 9) AS skew, max(n) > 5 * avg(n) AS alert FROM (SELECT count(*) AS n FROM bronze GROUP BY kafka_partition)",
}

_MARTS = {
    "dim_vehicle": "(SELECT vehicle_id, CASE WHEN consumption_l_per_100km < 12 THEN 'efficient' WHEN consumption_l_per_100km < 22 THEN 'standard' ELSE 'heavy' END AS consumption_band FROM vehicles)",
    "dim_driver": "(SELECT driver_id, CASE WHEN aggression_index < 0.8e0 THEN 'cautious' WHEN aggression_index < 1.3e0 THEN 'normal' ELSE 'aggressive' END AS risk_band FROM drivers)",
    "dim_route": "(SELECT route_id, CASE WHEN planned_distance_km < 50 THEN 'short_haul' WHEN planned_distance_km < 250 THEN 'medium_haul' ELSE 'long_haul' END AS haul_type FROM routes)",
    "dim_date": "(SELECT unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY)) AS date_key)",
    "fact_telemetry": "(SELECT * FROM stg)",
    "fact_trip": "(SELECT * FROM fact_trip)",
    "fact_vehicle_daily": "(SELECT * FROM fact_daily)",
    "fact_driver_incident": "(SELECT * FROM incidents)",
    "lineitem": "lineitem",
    "readings": "(SELECT * FROM injected)",
}


def _test(table: str, test: str, column: str, failed: str, severity: str = "error") -> str:
    return f"""SELECT '{table}' AS "table", '{test}' AS test, '{column}' AS "column", '{severity}' AS severity, CAST(({failed}) AS BIGINT) AS failures"""


def _rows_where(table: str, test: str, column: str, condition: str, severity: str = "error") -> str:
    return _test(table, test, column, f"SELECT count(*) FROM {_MARTS[table]} WHERE {condition}", severity)


def _unique(table: str, *columns: str) -> str:
    held = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return _test(table, "unique", ",".join(columns), f"SELECT count(*) FROM (SELECT 1 FROM {_MARTS[table]} WHERE {held} GROUP BY {', '.join(columns)} HAVING count(*) > 1)")


_NOT_NULL = (("dim_vehicle", "vehicle_id"), ("dim_driver", "driver_id"), ("dim_route", "route_id"), ("dim_date", "date_key"), ("fact_telemetry", "event_id"), ("fact_telemetry", "vehicle_id"), ("fact_telemetry", "event_time"), ("fact_trip", "trip_id"), ("fact_trip", "vehicle_id"), ("fact_vehicle_daily", "vehicle_day_key"), ("fact_vehicle_daily", "vehicle_id"), ("fact_driver_incident", "incident_id"), ("fact_driver_incident", "incident_type"))
_VALUES = (("dim_vehicle", "consumption_band", "'efficient', 'standard', 'heavy'"), ("dim_driver", "risk_band", "'cautious', 'normal', 'aggressive'"), ("dim_route", "haul_type", "'short_haul', 'medium_haul', 'long_haul'"), ("fact_trip", "distinct_vehicles", "1"), ("fact_driver_incident", "incident_type", "'engine_critical_overheat', 'engine_overheat', 'severe_overspeed', 'overspeed', 'low_fuel'"), ("fact_driver_incident", "severity", "'critical', 'high', 'medium', 'low'"))
_RANGES = (("fact_telemetry", "speed_kmh", "speed_kmh < 0 OR speed_kmh > 200"), ("fact_telemetry", "fuel_level_pct", "fuel_level_pct < 0 OR fuel_level_pct > 100"), ("fact_telemetry", "battery_level_pct", "battery_level_pct < 0 OR battery_level_pct > 100"), ("fact_trip", "duration_seconds", "duration_seconds < 0"), ("fact_vehicle_daily", "total_distance_km", "total_distance_km < 0"), ("fact_vehicle_daily", "utilisation_pct", "utilisation_pct < 0 OR utilisation_pct > 100"))
_KEYS = (("dim_vehicle", "vehicle_id"), ("dim_driver", "driver_id"), ("dim_route", "route_id"), ("dim_date", "date_key"), ("fact_telemetry", "event_id"), ("fact_trip", "trip_id"), ("fact_vehicle_daily", "vehicle_day_key"), ("fact_vehicle_daily", "vehicle_id", "event_date"), ("fact_driver_incident", "incident_id"))
_PARENTS = (("fact_telemetry", "vehicle_id", "vehicles"), ("fact_telemetry", "driver_id", "drivers"), ("fact_trip", "vehicle_id", "vehicles"), ("fact_vehicle_daily", "vehicle_id", "vehicles"), ("fact_driver_incident", "vehicle_id", "vehicles"))

_SQL["data_tests"] = " UNION ALL ".join(
    [_rows_where(t, "not_null", c, f"{c} IS NULL") for t, c in _NOT_NULL]
    + [_rows_where(t, "values", c, f"{c} NOT IN ({v})") for t, c, v in _VALUES]
    + [_rows_where(t, "range", c, w) for t, c, w in _RANGES]
    + [_rows_where("fact_trip", "range", "fuel_consumed_pct", "fuel_consumed_pct < 0", "warn")]
    + [_unique(t, *k) for t, *k in _KEYS]
    + [_rows_where(t, "parent", c, f"{c} NOT IN (SELECT {c} FROM {parent})") for t, c, parent in _PARENTS]
)
_SQL["data_tests_of_sources"] = " UNION ALL ".join(
    [_unique("lineitem", "l_orderkey", "l_linenumber"), _unique("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"), _rows_where("lineitem", "range", "l_quantity", "l_quantity < 2 OR l_quantity > 49"), _rows_where("lineitem", "values", "l_returnflag", "l_returnflag NOT IN ('A', 'N')"), _rows_where("lineitem", "not_null", "l_orderkey", "l_orderkey IS NULL")]
    + [_unique("readings", "vehicle_id"), _rows_where("readings", "not_null", "vehicle_id", "vehicle_id IS NULL"), _rows_where("readings", "not_null", "event_time", "event_time IS NULL"), _rows_where("readings", "not_null", "speed", "speed IS NULL"), _rows_where("readings", "range", "speed", "speed < 0")]
    + [_rows_where("readings", "parent", "vehicle_id", "vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)"), _rows_where("readings", "parent", "driver_id", "driver_id NOT IN (SELECT driver_id FROM drivers)", "warn")]
)

ORACLES: dict[str, str] = {name: with_models(sql) for name, sql in _SQL.items()}
