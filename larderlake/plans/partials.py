"""Marts kept up to date from partial sums of the months that changed.

Sales facts are summed once per month and store, and per month and customer. Sums of whole cents and
counts merge in any order, so a delivery of lines, however late, makes only its months be summed
anew: the facts of other months are not read, and their partitions not touched. Marts are derived
from the partial sums, whose size does not grow with the number of lines.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlake.functions import total
from larderlake.plans import marts
from larderlake.sources.tables import write_table

MONTH = ("transaction_year", "transaction_month")
#: Partial table -> what its rows are told apart by besides the month.
GRAINS = {"store_month": ("store_id", "store_sk"), "customer_month": ("customer_id", "customer_sk")}
Months = Iterable[tuple[int, int]]
#: Lines whose facts are built at once, unless a month has more: about 1.4 GB while it is shuffled.
LINES_AT_ONCE = 8_000_000


def partial_sums(fact: DataFrame, grain: str) -> DataFrame:
    """Revenue, profit, units and lines of each month at a grain."""
    return fact.groupBy(*MONTH, *GRAINS[grain]).agg(
        total("revenue").alias("revenue"),
        total("gross_profit").alias("gross_profit"),
        F.sum("quantity").alias("quantity"),
        F.count("date_key").alias("lines"),
    )


def in_months(months: Months) -> Column:
    """A filter on month partitions; literals, so that other partitions are not listed."""
    wanted = F.lit(False)
    for year, month in sorted(set(months)):
        wanted = wanted | ((F.col(MONTH[0]) == year) & (F.col(MONTH[1]) == month))
    return wanted


def touched_months(lines: DataFrame) -> list[tuple[int, int]]:
    """The months that lines fall into: as many as a calendar has, whatever the number of lines."""
    return sorted((r[0], r[1]) for r in lines.select(*MONTH).distinct().collect())


def spans(lines: DataFrame) -> list[list[tuple[int, int]]]:
    """The months that lines fall into, in runs of at most ``LINES_AT_ONCE`` lines; a larger month is alone.

    Facts that are built run by run need disk for the shuffles of one run, whatever the number of lines.
    """
    found: list[list[tuple[int, int]]] = []
    held = 0
    for year, month, n in sorted((r[0], r[1], r[2]) for r in lines.groupBy(*MONTH).count().collect()):
        if not found or held + n > LINES_AT_ONCE:
            found.append([])
            held = 0
        found[-1].append((year, month))
        held += n
    return found


def refresh_partials(spark: SparkSession, fact: DataFrame, path: str, months: Months | None = None) -> None:
    """Sum the given months anew (default: all) and replace their partitions under ``path``."""
    wanted = fact if months is None else fact.filter(in_months(months))
    for grain in GRAINS:
        write_table(
            partial_sums(wanted, grain),
            f"{path}/{grain}",
            MONTH,
            GRAINS[grain][:1],
            touched_partitions_only=months is not None,
        )


def read_partials(spark: SparkSession, path: str, grain: str, months: Months | None = None) -> DataFrame:
    stored = spark.read.parquet(f"{path}/{grain}")
    return stored if months is None else stored.filter(in_months(months))


def executive_overview(spark: SparkSession, path: str, months: Months | None = None) -> DataFrame:
    """Only the given months, or all."""
    return marts.executive_overview(read_partials(spark, path, "store_month", months))


def regional_sales(spark: SparkSession, path: str, dim_store: DataFrame, months: Months | None = None) -> DataFrame:
    """Only the given months, or all."""
    return marts.regional_sales(read_partials(spark, path, "store_month", months), dim_store)


def store_space(spark: SparkSession, path: str, dim_store: DataFrame) -> DataFrame:
    return marts.store_space(read_partials(spark, path, "store_month"), dim_store)


def customer_ltv(spark: SparkSession, path: str, dim_customer: DataFrame) -> DataFrame:
    sums = read_partials(spark, path, "customer_month")
    return marts.customer_ltv(sums, dim_customer, F.sum("lines"))
