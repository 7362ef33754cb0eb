"""Dimensions of the star schema: the current state of silver, under hashed keys.

Like all plans these compute rows; the rules of the table decide which are stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlake.functions import date_key, surrogate_key
from larderlake.operators.dedup import dedup
from larderlake.operators.joins import lookup_join
from larderlake.operators.scd import scd2_snapshot
from larderlake.plans.schemas import CUSTOMERS, PRODUCTS, STORES


def _loaded() -> Column:
    return F.current_timestamp().alias("gold_loaded_at")


def _names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.split(", ")]


def dim_date(calendar: DataFrame) -> DataFrame:
    """Days under a yyyyMMdd key; the fiscal year is the calendar year.

    Sorted at write (``schemas.CLUSTERING``): a stored table promises no order of its own.
    """
    days = calendar.select(
        date_key("date").alias("date_key"),
        "date",
        "year",
        "month",
        "quarter",
        "week_of_year",
        "day_of_week",
        "day_name",
        "month_name",
        "is_weekend",
        F.col("year").alias("fiscal_year"),
        F.col("quarter").alias("fiscal_quarter"),
    )
    keyed = dedup(days, ["date_key"])
    return keyed.select(surrogate_key("dim_date", "date_key").alias("date_sk"), "*", _loaded())


def dim_region(regions: DataFrame) -> DataFrame:
    rows = regions.select("region_id", "sales_district", "sales_region")
    keyed = dedup(rows, ["region_id"])
    return keyed.select(surrogate_key("dim_region", "region_id").alias("region_sk"), "*", _loaded())


def _versioned(history: DataFrame, table: str, key: str, cols: list[str]) -> DataFrame:
    """Current versions under a key made of natural key and start of the version."""
    sk = surrogate_key(table, key, "effective_from").alias(table.replace("dim_", "") + "_sk")
    return scd2_snapshot(history, *cols).select(sk, "*")


def stores_keyed(stores: DataFrame) -> DataFrame:
    """Current stores under their key, before the region columns join them."""
    return _versioned(stores, "dim_store", "store_id", _names(STORES))


def dim_store(stores: DataFrame, regions: DataFrame) -> DataFrame:
    """Current stores with the names of their region."""
    placed = lookup_join(
        stores_keyed(stores), regions, "region_id", "region_id", ["sales_district", "sales_region"]
    )
    return placed.select("*", _loaded())


def dim_customer(customers: DataFrame) -> DataFrame:
    cols = [*_names(CUSTOMERS), "full_name"]
    return _versioned(customers, "dim_customer", "customer_id", cols).select("*", _loaded())


def dim_product(products: DataFrame) -> DataFrame:
    cols = [*_names(PRODUCTS), "margin_pct"]
    return _versioned(products, "dim_product", "product_id", cols).select("*", _loaded())
