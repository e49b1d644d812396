"""Declared data tests, compiled: of each table one aggregate over one scan, and one join for each relationship.

All tests of a table's columns are counted where the table is grouped by its unique key, so that they share its scan and its
one shuffle, and counts are combined before it. A table with several unique keys gives a row for each of them to that
grouping. A relationship counts the child's values before it looks for them in the parent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "table string, test string, column string, severity string, failures long"
_KNOWN = {"not_null", "values", "range", "parent", "severity"}


class ConstraintError(ValueError):
    pass


@dataclass
class Test:
    """A test of one column; `broken` is true for a row that fails it."""

    test: str
    column: str
    severity: str
    broken: Column


@dataclass
class Declared:
    """The tests of one table."""

    table: str
    unique: list[list[str]] = field(default_factory=list)
    tests: list[Test] = field(default_factory=list)
    parents: list[tuple[str, str, str, str]] = field(default_factory=list)  # column, parent table, its column, severity


def _column_tests(table: str, column: str, rules: dict) -> list[Test]:
    value, severity, out = F.col(column), rules.get("severity", "error"), []
    if rules.get("not_null"):
        out.append(Test("not_null", column, severity, value.isNull()))
    if "values" in rules:
        if not isinstance(rules["values"], list) or not rules["values"]:
            raise ConstraintError(f"{table}.{column}: values must be a list that holds some")
        out.append(Test("values", column, severity, ~value.isin(rules["values"])))
    if "range" in rules:
        low, high = rules["range"] if isinstance(rules["range"], list) and len(rules["range"]) == 2 else (None, None)
        bounds = [b for b in (low is not None and value < low, high is not None and value > high) if b is not False]
        if not bounds:
            raise ConstraintError(f"{table}.{column}: a range has two ends, one of them null at most")
        out.append(Test("range", column, severity, reduce(lambda a, b: a | b, bounds)))
    return out


def parse_constraints(told: dict) -> list[Declared]:
    """The declared tests, or an error that names what is wrong with them."""
    if not isinstance(told, dict) or not told:
        raise ConstraintError("no tables are declared")
    out = []
    for table, columns in told.items():
        own = Declared(table, columns.get("unique", []))
        for column, rules in columns.items():
            if column == "unique":
                continue
            if not isinstance(rules, dict) or set(rules) - _KNOWN or not set(rules) - {"severity"}:
                raise ConstraintError(f"{table}.{column}: unknown or no rules in {rules}")
            if rules.get("severity", "error") not in ("error", "warn"):
                raise ConstraintError(f"{table}.{column}: severity is error or warn")
            own.tests += _column_tests(table, column, rules)
            if "parent" in rules:
                parent, _, key = rules["parent"].partition(".")
                if not key:
                    raise ConstraintError(f"{table}.{column}: a parent is table.column")
                own.parents.append((column, parent, key, rules.get("severity", "error")))
        out.append(own)
    return out


def load_constraints(path: str | Path = Path(__file__).parent.parent / "constraints.yml") -> list[Declared]:
    return parse_constraints(yaml.safe_load(Path(path).read_text(encoding="utf-8")))


def _rows(df: DataFrame, table: str, told: list[tuple[str, str, str, Column]]) -> DataFrame:
    """A row of RESULT for each (test, column, severity, count) of a frame of one row."""
    each = [F.struct(F.lit(t).alias("test"), F.lit(c).alias("column"), F.lit(s).alias("severity"), F.coalesce(n, F.lit(0)).cast("long").alias("failures")) for t, c, s, n in told]
    return df.select(F.lit(table).alias("table"), F.inline(F.array(*each)))


def table_failures(df: DataFrame, own: Declared) -> DataFrame:
    """Failures of every test of a table but its relationships, in one scan."""
    broken = {f"t{i}": t.broken for i, t in enumerate(own.tests)}
    told = [(t.test, t.column, t.severity, F.col(f"t{i}")) for i, t in enumerate(own.tests)]
    if not own.unique:
        return _rows(df.agg(*[F.count_if(b).alias(n) for n, b in broken.items()]), own.table, told)
    # A key with a null is no key; its row counts for the other tests alone.
    keys = [F.struct(F.lit(i).alias("i"), F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in k]), F.to_json(F.struct(*k))).alias("key")) for i, k in enumerate(own.unique)]
    rows = df.select(*[F.coalesce(b, F.lit(False)).alias(n) for n, b in broken.items()], F.explode(F.array(*keys)).alias("k")) if len(keys) > 1 else df.select(*[F.coalesce(b, F.lit(False)).alias(n) for n, b in broken.items()], keys[0].alias("k"))
    first = F.col("k.i") == 0
    by_key = rows.groupBy("k").agg(F.count("*").alias("n"), *[F.count_if(F.col(n) & first).alias(n) for n in broken])
    again = [F.count_if((F.col("n") > 1) & F.col("k.key").isNotNull() & (F.col("k.i") == i)).alias(f"u{i}") for i in range(len(keys))]
    one = by_key.agg(*[F.sum(n).alias(n) for n in broken], *again)
    return _rows(one, own.table, told + [("unique", ",".join(k), "error", F.col(f"u{i}")) for i, k in enumerate(own.unique)])


def orphan_failures(child: DataFrame, parent: DataFrame, own: Declared, column: str, key: str, severity: str) -> DataFrame:
    """How many rows name a parent that isn't there."""
    values = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    lost = values.join(parent.select(F.col(key).alias("value")), "value", "left_anti").agg(F.sum("n").alias("n"))
    return _rows(lost, own.table, [("parent", column, severity, F.col("n"))])


def failures(table: Callable[[str], DataFrame], declared: list[Declared]) -> DataFrame:
    """RESULT of all declared tests; `table` gives a table by its name."""
    parts = []
    for own in declared:
        if own.tests or own.unique:
            parts.append(table_failures(table(own.table), own))
        parts += [orphan_failures(table(own.table), table(parent), own, column, key, severity) for column, parent, key, severity in own.parents]
    return reduce(DataFrame.unionByName, parts)
