"""Expressions that several models share. All stay in the JVM."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088
#: Stands for null in surrogate keys, so that null and the empty string differ.
NULL_KEY = "<null>"


def _col(x: Column | str) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def haversine_km(lat1: Column | str, lon1: Column | str, lat2: Column | str, lon2: Column | str) -> Column:
    """Great-circle distance."""
    lat1, lon1, lat2, lon2 = (F.radians(_col(x)) for x in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((lat2 - lat1) / 2), 2) + F.cos(lat1) * F.cos(lat2) * F.pow(F.sin((lon2 - lon1) / 2), 2)
    return F.asin(F.sqrt(half)) * (2 * EARTH_RADIUS_KM)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed seconds."""
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def ratio(numerator: Column, denominator: Column, scale: float = 1.0) -> Column:
    """numerator / denominator * scale in double, null where the denominator isn't positive."""
    return F.when(denominator > 0, numerator.cast("double") / denominator.cast("double") * F.lit(float(scale)))


def surrogate_key(*columns: Column | str) -> Column:
    return F.md5(F.concat_ws("-", *[F.coalesce(_col(c).cast("string"), F.lit(NULL_KEY)) for c in columns]))


def quarantine_key(event_id: Column | str, rule: Column | str, payload: Column | str | None = None) -> Column:
    """Deterministic key of a failure. With the payload, records that lost their id keep keys of their own."""
    parts = [F.coalesce(_col(event_id), F.lit("")), _col(rule)]
    if payload is not None:
        parts.append(F.when(_col(event_id).isNull(), F.sha2(F.coalesce(_col(payload), F.lit("")), 256)))
    return F.sha2(F.concat_ws("|", *parts), 256)


def uuid5(namespace: str, name: Column | str) -> Column:
    """RFC 9562 version 5: SHA-1 of namespace and name, with version and variant set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), F.encode(_col(name), "UTF-8")))
    variant = F.element_at(F.array(*[F.lit(c) for c in "89ab"]), F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4 + 1)
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def flag(value: Column, test: Column) -> Column:
    """Three-valued: null where what is tested is null."""
    return F.when(value.isNotNull(), test)


def band(value: Column | str, *limits: tuple[float, str], otherwise: str) -> Column:
    """The name of the first limit that the value lies under."""
    out = None
    for limit, name in limits:
        test = _col(value) < limit
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(otherwise)


def trailing_window(column: Column | str, as_of: date | datetime, days: int = 2, incremental: bool = True) -> Column:
    """Rows of the last days before as_of; all rows in a full build."""
    if not incremental:
        return F.lit(True)
    day = as_of.date() if isinstance(as_of, datetime) else as_of
    return _col(column) >= F.date_sub(F.lit(day), days)


def interpolate(a: Column, b: Column, t: Column) -> Column:
    """Linear, with t held to [0, 1]."""
    held = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
    return a + (b - a) * held


def unused(name: str, *frames) -> str:
    """`name`, with as many underscores after it as no column of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
