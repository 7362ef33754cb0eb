"""Row-quality expectations: warn, drop or fail on SQL conditions over finished rows.

A row passes a rule only when its condition is TRUE; FALSE and NULL both violate it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

WARN, DROP, FAIL = "warn", "drop", "fail"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str
    action: str = WARN

    @property
    def passed(self) -> str:
        """SQL that is TRUE or FALSE, never NULL."""
        return f"coalesce(({self.condition}), false)"


@dataclass(frozen=True)
class RuleSet:
    """The rules of one table."""

    table: str
    rules: tuple[Rule, ...]

    @classmethod
    def of(cls, table: str, **by_action: Mapping[str, str]) -> RuleSet:
        """``RuleSet.of("t", drop={"has_id": "id IS NOT NULL"}, warn={...})``"""
        rules = (
            Rule(name, condition, action)
            for action, conditions in by_action.items()
            for name, condition in conditions.items()
        )
        return cls(table, tuple(rules))

    def having(self, action: str) -> tuple[Rule, ...]:
        return tuple(r for r in self.rules if r.action == action)


def _all(rules: tuple[Rule, ...]) -> str:
    return " AND ".join(f"({r.condition})" for r in rules) or "true"


def enforce(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Drop and fail without counting, so that conditions can reach the scan.

    With a fail rule in the set both kinds become one conditional expression: the optimizer may
    not reorder it, so a bad row aborts the run even when a drop rule would have removed it.
    """
    # A filter lets only TRUE through, so the bare conditions do, and bare ones reach the scan.
    keep = _all(rules.having(DROP))
    for rule in rules.having(FAIL):
        message = f"{rules.table}: {rule.name} violated ({rule.condition})".replace("'", "\\'")
        abort = f"cast(raise_error('{message}') AS boolean)"
        keep = f"CASE WHEN ({rule.condition}) THEN ({keep}) ELSE {abort} END"
    return df if keep == "true" else df.filter(keep)


def rule_metrics(rules: RuleSet) -> list[Column]:
    """Aggregates of a rule set: total rows, rows kept, and violations per rule."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.expr(f"count_if({_all(rules.having(DROP))})").alias("kept_rows"),
        *(F.expr(f"count_if(NOT {r.passed})").alias(r.name) for r in rules.rules),
    ]


def apply_rules(
    df: DataFrame, rules: RuleSet, name: str | None = None
) -> tuple[DataFrame, Observation | None]:
    """Enforce rules and count them in the same pass over the data.

    In batch the second item yields the counts once an action has run. A stream reports them under
    the rule set's name (see ``streaming.quality_metrics``), and the second item is None.
    """
    label = name or f"quality_{rules.table}"
    observation = None if df.isStreaming else Observation(label)
    counted = df.observe(label if observation is None else observation, *rule_metrics(rules))
    return enforce(counted, rules), observation


def _single(df: DataFrame, action: str, conditions: Mapping[str, str]) -> DataFrame:
    return apply_rules(df, RuleSet.of("dataset", **{action: conditions}))[0]


def expect(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Count violations, keep every row."""
    return _single(df, WARN, conditions)


def expect_or_drop(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Count violations, drop the rows that have any."""
    return _single(df, DROP, conditions)


def expect_or_fail(df: DataFrame, conditions: Mapping[str, str]) -> DataFrame:
    """Abort the run at the first violating row."""
    return _single(df, FAIL, conditions)


def scorecard(df: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per rule: how many rows passed and failed, of how many. One aggregation pass."""
    sums = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *(F.expr(f"count_if({r.passed})").alias(f"r{i}") for i, r in enumerate(rules.rules)),
    )
    lines = F.array(
        *(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.lit(r.action).alias("action"),
                F.col(f"r{i}").alias("passed"),
            )
            for i, r in enumerate(rules.rules)
        )
    )
    return sums.select("total_rows", F.inline(lines)).select(
        F.lit(rules.table).alias("table_name"),
        "rule",
        "action",
        "total_rows",
        "passed",
        (F.col("total_rows") - F.col("passed")).alias("failed"),
    )


def violations(df: DataFrame, rules: RuleSet) -> DataFrame:
    """The quarantine side: rows breaking any rule, with the names of the rules they break."""
    names = (F.expr(f"CASE WHEN NOT {r.passed} THEN '{r.name}' END") for r in rules.rules)
    broken = F.array_compact(F.array(*names))
    return df.withColumn("violated_rules", broken).filter(F.size("violated_rules") > 0)
