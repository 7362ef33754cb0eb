"""Equi-joins of the model. No hints: the small sides are narrow stored tables, so Spark's own size
threshold decides what is broadcast, and above it AQE splits hot keys of the shuffle join."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Lookup:
    """Columns ``take`` of ``table``, found through ``fact.fact_key = table.key``."""

    table: DataFrame
    fact_key: str
    key: str
    take: Sequence[str]


def lookup_join(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, take: Sequence[str]
) -> DataFrame:
    """Left join that adds ``take`` from a table unique on ``right_key``; unmatched rows get NULLs.

    Works the same for a streaming left side and a static right side.
    """
    probe = f"__{right_key}"
    narrow = right.select(F.col(right_key).alias(probe), *take)
    return left.join(narrow, F.col(left_key) == F.col(probe), "left").drop(probe)


def attach_keys(fact: DataFrame, lookups: Iterable[Lookup]) -> DataFrame:
    """Chain lookups. Neighbouring lookups on one fact key share its partitioning."""
    for lk in lookups:
        fact = lookup_join(fact, lk.table, lk.fact_key, lk.key, lk.take)
    return fact


def join_attrs(fact: DataFrame, dim: DataFrame, on: str, surrogate: str) -> DataFrame:
    """Inner join on a natural key; the fact's surrogate key wins over the dimension's."""
    return fact.join(dim.drop(surrogate), on=on)
