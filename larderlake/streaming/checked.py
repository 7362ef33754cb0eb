"""Rule-checked streams: each batch is split into accepted and quarantined rows in one pass.

A target is a folder with two tables. ``rows`` holds every row of the stream once, partitioned by
batch, by verdict and by the columns asked for; ``counts`` holds what the rules found, per batch.
Rows are written and counted by the same job. Both partitions of a batch are its own: a batch that
runs again after a failure replaces them.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larderlake.operators.quality import DROP, FAIL, RuleSet, enforce, rule_metrics
from larderlake.streaming.counts import BATCH, run_totals, write_counts, write_own
from larderlake.streaming.runs import run_batches

VERDICT, VIOLATED = "_verdict", "violated_rules"
ACCEPTED, QUARANTINED = "accepted", "quarantined"


@dataclass(frozen=True)
class CheckedRun:
    """A finished run: its query, and the totals of its batches as stored."""

    query: StreamingQuery
    run: str
    counts: dict[str, int]


def judged(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Adds the names of violated rules and the verdict; a fail rule aborts.

    Rows that break a drop rule are quarantined; a warning only leaves its name on the row.
    """
    fatal = RuleSet(rules.table, rules.having(FAIL))
    soft = [r for r in rules.rules if r.action != FAIL]
    names = F.array_compact(F.array(*(F.expr(f"CASE WHEN NOT {r.passed} THEN '{r.name}' END") for r in soft)))
    dropped = F.lit(False)
    for rule in rules.having(DROP):
        dropped = dropped | ~F.expr(rule.passed)
    verdict = F.when(dropped, QUARANTINED).otherwise(ACCEPTED)
    return enforce(df, fatal).withColumns({VIOLATED: names.cast("array<string>"), VERDICT: verdict})


def run_checked(
    stream: DataFrame,
    rules: RuleSet,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> CheckedRun:
    """Take what has arrived, check it, store all of it and its counts."""
    run = str(uuid.uuid4())

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"checked_{rules.table}")
        rows = judged(batch.observe(seen, *rule_metrics(rules)), rules)
        write_own(rows, f"{path}/rows", batch_id, VERDICT, *partition_by)
        write_counts(batch.sparkSession, f"{path}/counts", batch_id, run, rules.table, seen.get)

    query = run_batches(stream, handle, checkpoint, name)
    return CheckedRun(query, run, run_totals(stream.sparkSession, f"{path}/counts", run))


def _stored(spark: SparkSession, path: str, verdict: str) -> DataFrame:
    rows = spark.read.option("mergeSchema", True).parquet(f"{path}/rows")
    return rows.filter(F.col(VERDICT) == verdict).drop(VERDICT, BATCH)


def read_accepted(spark: SparkSession, path: str) -> DataFrame:
    """The rows that broke no drop rule, as the table's users see them."""
    return _stored(spark, path, ACCEPTED).drop(VIOLATED)


def read_quarantined(spark: SparkSession, path: str) -> DataFrame:
    """The rows kept out, with the names of the rules they break."""
    return _stored(spark, path, QUARANTINED)
