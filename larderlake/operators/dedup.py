"""Deterministic de-duplication and latest-row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(
    df: DataFrame, keys: Sequence[str], by: Sequence[str], tiebreak: Sequence[str] | None = None
) -> DataFrame:
    """Per key, the row with the greatest ``by`` columns.

    Ties fall to ``tiebreak``, by default the remaining columns in order. The aggregate combines
    before the shuffle, so a key that holds most rows still sends one row per task.
    """
    attrs = [c for c in df.columns if c not in keys]
    if not attrs:
        return df.distinct()
    order = [*by, *(attrs if tiebreak is None else tiebreak)]
    order = [*dict.fromkeys([*order, *attrs])]
    best = F.max(F.struct(*order)).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col("best")[c].alias(c) for c in attrs))


def dedup(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key. Among rows that differ the smallest survives, on every run."""
    attrs = [c for c in df.columns if c not in keys]
    if not attrs:
        return df.distinct()
    best = F.min(F.struct(*attrs)).alias("best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(*(F.col("best")[c].alias(c) if c in attrs else c for c in df.columns))
