"""A telemetry source for Spark: simulated vehicles, each with its own random stream, so any partitioning gives the same rows.

    spark.dataSource.register(SimulatedTelemetry)
    spark.read.format("simulated_telemetry").option("vehicles", 30).option("ticks", 100).load()

As a stream it emits `ticks_per_batch` ticks at a time. One vehicle, `hot`, reports `hot_factor` times as often.
"""

from __future__ import annotations

import heapq
import itertools
import json
import math
import random
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timedelta
from pathlib import Path

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from quarryline.contract import SCHEMA_VERSION, TELEMETRY, ddl

NAMESPACE = uuid.UUID("5f0c2a0e-7a0e-5a55-9a3b-0d6a4c1f7e21")
TICK_SECONDS = 6


def event_id(vehicle: str, trip: str, number: int) -> str:
    return str(uuid.uuid5(NAMESPACE, f"{vehicle}|{trip}|{number}"))


class Vehicle:
    """Drives trips along a line between two points, burns fuel and warms up; between trips it stands parked, cools down and,
    when low, refuels. So fuel never rises within a trip."""

    def __init__(self, name: str, seed: int, start: datetime):
        self.name, self.start = name, start
        self.random = random.Random(f"{seed}|{name}")
        self.odometer = self.random.uniform(1_000, 90_000)
        self.fuel = self.random.uniform(40, 100)
        self.heat, self.battery, self.speed = 70.0, 95.0, 0.0
        self.faulty_cooling = self.random.random() < 0.1
        self.number = self.trips = 0
        self.parked = 0.0  # seconds left
        self._new_trip()

    def _new_trip(self) -> None:
        self.trips += 1
        self.trip = f"{self.name}-T{self.trips}"
        self.driver, self.route = f"D{self.random.randrange(40)}", f"R{self.random.randrange(12):03d}"
        self.a, self.b = ((self.random.uniform(8, 34), self.random.uniform(68, 90)) for _ in range(2))
        self.length, self.done = self.random.uniform(10, 120), 0.0

    def _drive(self, seconds: float) -> None:
        target = self.random.gauss(65, 22)
        self.speed = min(max(self.speed + (target - self.speed) * 0.3, 0.0), 185.0)
        moved = self.speed * seconds / 3600
        self.odometer += moved
        self.done += moved
        self.fuel = max(0.0, self.fuel - moved * 0.22)
        ambient = 104.0 if self.faulty_cooling else 90.0
        self.heat += (ambient - self.heat) * 0.05 + self.random.gauss(0, 0.6)

    def _park(self, seconds: float) -> None:
        self.speed = 0.0
        self.heat += (35.0 - self.heat) * 0.01
        self.parked -= seconds

    def step(self, at: datetime, seconds: float) -> dict:
        if self.parked > 0:
            self._park(seconds)
        else:
            if self.done >= self.length or self.fuel < 8:  # it has stood after its trip
                if self.fuel < 30:
                    self.fuel = 100.0
                self._new_trip()
            self._drive(seconds)
            if self.done >= self.length or self.fuel < 8:
                self.parked = self.random.uniform(300, 2_400)
        self.battery = min(max(self.battery + self.random.gauss(0, 0.2), 15.0), 100.0)
        t = min(self.done / self.length, 1.0)
        self.number += 1
        return {
            "event_id": event_id(self.name, self.trip, self.number), "vehicle_id": self.name, "driver_id": self.driver, "trip_id": self.trip, "route_id": self.route, "event_time": at,
            "latitude": self.a[0] + (self.b[0] - self.a[0]) * t, "longitude": self.a[1] + (self.b[1] - self.a[1]) * t, "speed": self.speed, "fuel_level": self.fuel,
            "engine_temperature": self.heat, "battery_level": self.battery, "odometer_km": self.odometer, "schema_version": SCHEMA_VERSION,
        }

    def run(self, ticks: int, per_tick: int, first: int = 0) -> Iterator[dict]:
        """Readings of ticks first to ticks; the vehicle must stand at tick first."""
        for k in range(first * per_tick, ticks * per_tick):
            yield self.step(self.start + timedelta(seconds=k * TICK_SECONDS / per_tick), TICK_SECONDS / per_tick)


class Delivery:
    """The order in which readings are sent: some twice, some held back for minutes and released in order of their release
    times, the last of them by `flush`. The choice hangs on the reading's id alone."""

    def __init__(self, duplicates: float = 0.0, late: float = 0.0, hold: tuple[float, float] = (300.0, 1_200.0), hot: str | None = None):
        self.duplicates, self.late, self.hold, self.hot = duplicates, late, hold, hot
        self.waiting: list[tuple[datetime, int, dict]] = []
        self.counts = dict.fromkeys(("produced", "clean", "duplicates", "late", "hot"), 0)

    def _send(self, reading: dict) -> Iterator[dict]:
        chance = random.Random(f"again|{reading['event_id']}").random()
        self.counts["clean"] += 1
        self.counts["hot"] += reading["vehicle_id"] == self.hot
        for _ in range(2 if chance < self.duplicates else 1):
            self.counts["produced"] += 1
            yield reading
        self.counts["duplicates"] += chance < self.duplicates

    def pass_on(self, reading: dict) -> Iterator[dict]:
        """What is sent when this reading is made: held-back ones whose time has come, then this one if it isn't held."""
        while self.waiting and self.waiting[0][0] <= reading["event_time"]:
            yield from self._send(heapq.heappop(self.waiting)[2])
        own = random.Random(f"late|{reading['event_id']}")
        if own.random() < self.late:
            self.counts["late"] += 1
            heapq.heappush(self.waiting, (reading["event_time"] + timedelta(seconds=own.uniform(*self.hold)), len(self.waiting) + self.counts["late"], reading))
        else:
            yield from self._send(reading)

    def flush(self) -> Iterator[dict]:
        while self.waiting:
            yield from self._send(heapq.heappop(self.waiting)[2])


def produce(folder: str, options: dict, per_file: int = 5_000) -> dict:
    """Writes the readings of a run as JSON lines with a source's record columns, and manifest.json with the counts, to a local
    folder; returns the manifest. A file is written under a hidden name first, so a reader sees whole files."""
    settings, target = _Settings(options), Path(folder)
    target.mkdir(parents=True, exist_ok=True)
    delivery = Delivery(float(options.get("duplicates", 0.01)), float(options.get("late", 0.02)), hot=settings.hot)
    vehicles = [v.run(settings.ticks, settings.hot_factor if v.name == settings.hot else 1) for v in (Vehicle(n, settings.seed, settings.start) for n in settings.names)]
    in_time = heapq.merge(*vehicles, key=lambda r: (r["event_time"], r["vehicle_id"]))
    records = (r for r in itertools.chain(itertools.chain.from_iterable(map(delivery.pass_on, in_time)), delivery.flush()))
    offset = files = 0
    while some := list(itertools.islice(records, per_file)):
        lines = []
        for r in some:
            at = r["event_time"].isoformat(timespec="milliseconds") + "Z"
            lines.append(json.dumps({"key": r["vehicle_id"], "value": json.dumps(r | {"event_time": at}), "topic": "telemetry", "partition": zlib.crc32(r["vehicle_id"].encode()) % 12, "offset": offset, "timestamp": at}))
            offset += 1
        hidden = target / f".part-{files:05d}.json"
        hidden.write_text("\n".join(lines) + "\n", "utf-8")
        hidden.rename(target / f"part-{files:05d}.json")
        files += 1
    manifest = {"seed": settings.seed, "ticks": settings.ticks, "vehicles": len(settings.names), "files": files, **delivery.counts}
    (target / "manifest.json.tmp").write_text(json.dumps(manifest), "utf-8")
    (target / "manifest.json.tmp").rename(target.parent / f"{target.name}.manifest.json")
    return manifest


def kilometres(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0088 * math.asin(math.sqrt(h))


class _Settings:
    def __init__(self, options: dict):
        self.seed = int(options.get("seed", 7))
        self.ticks = int(options.get("ticks", 100))
        self.per_batch = int(options.get("ticks_per_batch", 10))
        self.hot_factor = int(options.get("hot_factor", 25))
        self.start = datetime.fromisoformat(options.get("start", "2026-01-01T06:00:00"))
        self.names = [f"V{1000 + i}" for i in range(int(options.get("vehicles", 30)))] + ([options["hot"]] if "hot" in options else [])
        self.hot = options.get("hot")

    def rows(self, name: str, first: int = 0, last: int | None = None) -> Iterator[tuple]:
        """Readings of ticks first to last. A worker keeps each vehicle as it left it, so the next batch goes on from there;
        a worker that lacks it, or has it further on, simulates from the start, with the same readings."""
        per = self.hot_factor if name == self.hot else 1
        key = (name, self.seed, self.start, per)
        at, vehicle = _LEFT.pop(key, (0, None))
        if vehicle is None or at > first:
            at, vehicle = 0, Vehicle(name, self.seed, self.start)
        last = self.ticks if last is None else last
        for _ in vehicle.run(first, per, at):
            pass
        for row in vehicle.run(last, per, first):
            yield tuple(row[f.name] for f in TELEMETRY)
        _LEFT[key] = (last, vehicle)


#: Vehicles where this worker process left them.
_LEFT: dict[tuple, tuple[int, Vehicle]] = {}


class _Ticks(InputPartition):
    def __init__(self, name: str, first: int, last: int):
        super().__init__(name)
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, settings: _Settings):
        self.settings = settings

    def partitions(self) -> list[InputPartition]:
        return [_Ticks(name, 0, self.settings.ticks) for name in self.settings.names]

    def read(self, partition: _Ticks) -> Iterator[tuple]:
        return self.settings.rows(partition.value, partition.first, partition.last)


class _StreamReader(DataSourceStreamReader):
    """A partition for each vehicle, read by the executors."""

    def __init__(self, settings: _Settings):
        self.settings, self.tick = settings, 0

    def initialOffset(self) -> dict:  # noqa: N802
        return {"tick": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.tick = min(self.tick + self.settings.per_batch, self.settings.ticks)
        return {"tick": self.tick}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.tick = max(self.tick, end["tick"])
        return [_Ticks(name, start["tick"], end["tick"]) for name in self.settings.names] if end["tick"] > start["tick"] else []

    def read(self, partition: _Ticks) -> Iterator[tuple]:
        return self.settings.rows(partition.value, partition.first, partition.last)


class SimulatedTelemetry(DataSource):
    @classmethod
    def name(cls) -> str:
        return "simulated_telemetry"

    def schema(self) -> str:
        return ddl(TELEMETRY)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(_Settings(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return _StreamReader(_Settings(self.options))
