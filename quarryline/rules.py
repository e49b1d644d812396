"""Declarative row rules: loading, annotation and the split into good and quarantined rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from importlib import resources
from pathlib import Path

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEVERITIES = ("critical", "warning")
FAILED, WARNED, VALID = "dq_failed", "dq_warnings", "dq_valid"


class RuleError(ValueError):
    """A rule file that can't be used."""


@dataclass(frozen=True)
class Rule:
    name: str
    severity: str
    expression: str
    description: str = ""
    dimension: str = "validity"


@dataclass(frozen=True)
class Rules:
    version: int
    rules: tuple[Rule, ...]

    def of(self, severity: str) -> tuple[Rule, ...]:
        return tuple(r for r in self.rules if r.severity == severity)


def parse_rules(loaded: object) -> Rules:
    if not isinstance(loaded, dict) or "rules" not in loaded:
        raise RuleError("a rule file is a mapping with the key 'rules'")
    found: dict[str, Rule] = {}
    for at, entry in enumerate(loaded["rules"] or ()):
        if not isinstance(entry, dict):
            raise RuleError(f"entry {at} is no mapping")
        if lacking := [k for k in ("name", "severity", "expression") if k not in entry]:
            raise RuleError(f"entry {at} lacks {', '.join(lacking)}")
        values = {k: " ".join(str(entry[k]).split()) for k in ("name", "severity", "expression", "description", "dimension") if k in entry}
        rule = Rule(**values | {"severity": values["severity"].lower()})
        if rule.name in found:
            raise RuleError(f"two rules are named {rule.name}")
        if rule.severity not in SEVERITIES:
            raise RuleError(f"{rule.name}: unknown severity {rule.severity}")
        found[rule.name] = rule
    if not found:
        raise RuleError("the file has no rules")
    return Rules(int(loaded.get("version", 1)), tuple(found.values()))


def load_rules(path: str | Path | None = None) -> Rules:
    source = Path(path) if path else resources.files(__package__) / "rules.yml"
    return parse_rules(yaml.safe_load(source.read_text("utf-8")))


def _broken(rules: tuple[Rule, ...], as_of: datetime | None) -> Column:
    """Names of the rules that a row fails, in one projection; null counts as a failure."""
    clock = f"TIMESTAMP '{as_of:%Y-%m-%d %H:%M:%S}'" if as_of else "current_timestamp()"
    names = [F.when(F.coalesce(F.expr(r.expression.replace("{as_of}", clock)), F.lit(False)), F.lit(None).cast("string")).otherwise(r.name) for r in rules]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def annotate(df: DataFrame, rules: Rules | None = None, as_of: datetime | None = None) -> DataFrame:
    """df with the failed critical rules, the warnings, and whether no critical rule failed.

    The rules are the output of a generator of one row, so they are evaluated once: a plain projection is inlined into
    every filter and join above it, and the optimiser's constraints multiply it again.
    """
    rules = rules or load_rules()
    judged = F.struct(_broken(rules.of("critical"), as_of).alias(FAILED), _broken(rules.of("warning"), as_of).alias(WARNED))
    return df.select("*", F.inline_outer(F.array(judged))).withColumn(VALID, F.size(FAILED) == 0)


def explain_failures(annotated: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row for each failed rule of each bad row, with the rule's severity and reason."""
    rules = rules or load_rules()
    severity, reason = (F.create_map(*[F.lit(x) for r in rules.rules for x in (r.name, getattr(r, k))]) for k in ("severity", "description"))
    # Outer, then filtered: a plain explode makes the optimiser infer a filter that repeats the whole rule expression and
    # multiplies it through every projection below.
    exploded = annotated.withColumn("rule_name", F.explode_outer(FAILED)).where("rule_name IS NOT NULL")
    return exploded.withColumns({"rule_severity": severity[F.col("rule_name")], "failure_reason": reason[F.col("rule_name")]}).drop(FAILED, WARNED, VALID)


def split(df: DataFrame, rules: Rules | None = None, as_of: datetime | None = None, keep_warnings: bool = False) -> tuple[DataFrame, DataFrame]:
    """(good rows, one row for each failed rule). Nothing is cached: a caller that uses both sides persists df itself."""
    rules = rules or load_rules()
    marked = annotate(df, rules, as_of)
    good = marked.where(VALID).drop(FAILED, VALID, *([] if keep_warnings else [WARNED]))
    return good, explain_failures(marked, rules)
