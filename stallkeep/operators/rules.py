"""Rules as data: a code, a condition over named metrics, a message."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

METRIC_TYPE = "decimal(38,2)"


class ValidationError(RuntimeError):
    """A rule that does not hold; carries scope and code."""

    def __init__(self, scope: str, code: int, message: str):
        super().__init__(f"{code}: {scope} {message}")
        self.scope, self.code = scope, code


@dataclass(frozen=True)
class Rule:
    """``violated_when`` is SQL over the metrics of the scope.

    Names starting with ``baseline_`` refer to the caller's expectations; a
    rule whose expectations are not given is not evaluated (violated is NULL).
    """

    scope: str
    code: int
    violated_when: str
    message: str


def long_metrics(measured: DataFrame, scope: str) -> DataFrame:
    """A one-row frame of numbers as rows (scope, metric, value)."""
    rows = [
        F.struct(F.lit(name).alias("metric"), F.col(name).cast(METRIC_TYPE).alias("value"))
        for name in measured.columns
    ]
    return measured.select(F.lit(scope).alias("scope"), F.inline(F.array(*rows)))


def measures_to_metrics(df: DataFrame, measures: Mapping[str, Column], scope: str) -> DataFrame:
    return long_metrics(df.agg(*[m.alias(n) for n, m in measures.items()]), scope)


def _names(rules: Sequence[Rule]) -> list[str]:
    words = {w for r in rules for w in re.findall(r"[A-Za-z_]\w*", r.violated_when)}
    return sorted(words - {"OR", "AND", "NOT", "coalesce", "cast", "AS"})


def evaluate_rules(
    metrics: DataFrame,
    rules: Sequence[Rule],
    baseline: Mapping[str, Mapping[str, float | int | str | Decimal]] | None = None,
) -> DataFrame:
    """(scope, code, message, violated) for every rule; violated is 1, 0 or NULL.

    ``baseline`` holds the expectations per scope, without the prefix.
    ``metrics`` is long (scope, metric, value) with a bounded number of rows,
    one per metric; all rules of a scope are evaluated over one wide row.
    """
    baseline = baseline or {}
    results = []
    for scope in dict.fromkeys(r.scope for r in rules):
        own = [r for r in rules if r.scope == scope]
        used = _names(own)
        known = baseline.get(scope, {})
        measured = [n for n in used if not n.startswith("baseline_")]
        wide = metrics.filter(F.col("scope") == scope).agg(
            *[F.max(F.when(F.col("metric") == n, F.col("value"))).alias(n) for n in measured]
        )
        expectations = {
            n: F.lit(None if known.get(n[9:]) is None else str(known[n[9:]])).cast(METRIC_TYPE)
            for n in used
            if n.startswith("baseline_")
        }
        outcomes = [
            F.struct(
                F.lit(r.code).alias("code"),
                F.lit(r.message).alias("message"),
                F.expr(r.violated_when).cast("int").alias("violated"),
            )
            for r in own
        ]
        results.append(
            wide.withColumns(expectations).select(F.lit(scope).alias("scope"), F.inline(F.array(*outcomes)))
        )
    evaluated = results[0]
    for result in results[1:]:
        evaluated = evaluated.unionByName(result)
    return evaluated


def enforce(evaluated: DataFrame, order: Sequence[Rule]) -> None:
    """Raise for the first violated rule in the given order."""
    broken = {
        (r.scope, r.code): r.message
        for r in evaluated.filter("violated = 1").select("scope", "code", "message").collect()
    }
    for rule in order:
        if (rule.scope, rule.code) in broken:
            raise ValidationError(rule.scope, rule.code, rule.message)
