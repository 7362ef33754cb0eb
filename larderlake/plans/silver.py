"""Bronze to silver: typed, enriched rows. Batch and streaming frames alike.

The functions cleanse; ``plans.rules`` says which of the resulting rows stay, and
``operators.quality`` enforces it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlake.functions import conform, ratio, stock_status
from larderlake.operators.joins import lookup_join
from larderlake.operators.quality import enforce
from larderlake.operators.scd import current
from larderlake.plans import schemas
from larderlake.plans.rules import RULES
from larderlake.sources.files import unwrap_json

_ARRIVAL = "ingestion_time AS bronze_ingestion_time"


def _stamps(env: str) -> tuple[Column, Column]:
    return F.current_timestamp().alias("silver_ingestion_time"), F.lit(env).alias("environment")


def cleanse_transactions(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Sales lines with the calendar parts of their date."""
    lines = conform(bronze, schemas.TRANSACTIONS, _ARRIVAL, "source_file", strict=strict)
    day = F.col("transaction_date")
    return lines.select(
        "*",
        F.year(day).alias("transaction_year"),
        F.month(day).alias("transaction_month"),
        F.quarter(day).alias("transaction_quarter"),
        F.dayofweek(day).alias("transaction_day_of_week"),
        *_stamps(env),
    )


def cleanse_returns(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Return lines with year and month."""
    lines = conform(bronze, schemas.RETURNS, _ARRIVAL, strict=strict)
    day = F.col("return_date")
    return lines.select(
        "*", F.year(day).alias("return_year"), F.month(day).alias("return_month"), *_stamps(env)
    )


def cleanse_stores(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Store master data, ready for type-2 change application."""
    stores = conform(bronze, schemas.STORES, _ARRIVAL, strict=strict)
    return stores.withColumn("environment", F.lit(env))


def cleanse_regions(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Region hierarchy, ready for type-1 change application."""
    regions = conform(bronze, schemas.REGIONS, _ARRIVAL, strict=strict)
    return regions.withColumn("environment", F.lit(env))


def enrich_calendar(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Calendar days with their parts and names; Saturday and Sunday are the weekend."""
    day = F.col("date")
    return conform(bronze, schemas.CALENDAR, _ARRIVAL, strict=strict).select(
        "date",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        # A NULL date is no weekend.
        F.coalesce(F.weekday(day) >= 5, F.lit(False)).alias("is_weekend"),
        "bronze_ingestion_time",
        *_stamps(env),
    )


def parse_customers(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Customer documents, flat or as JSON text, with the full name."""
    flat = unwrap_json(bronze, "customer_id", schemas.CUSTOMER_DOCUMENT)
    return conform(flat, schemas.CUSTOMERS, _ARRIVAL, strict=strict).select(
        "*",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        F.lit(env).alias("environment"),
    )


def parse_products(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Product documents, flat or as JSON text, with the margin in percent.

    A zero price has no margin (NULL) and is left for the price rule to drop.
    """
    flat = unwrap_json(bronze, "product_id", schemas.PRODUCT_DOCUMENT)
    price, cost = F.col("product_retail_price"), F.col("product_cost")
    return conform(flat, schemas.PRODUCTS, _ARRIVAL, strict=strict).select(
        "*", ratio(price - cost, price, 100).alias("margin_pct"), F.lit(env).alias("environment")
    )


def normalise_orders(bronze: DataFrame, strict: bool = True) -> DataFrame:
    """Order events with their date parts, not yet enriched."""
    at = F.col("event_time")
    return conform(bronze, schemas.ORDERS, strict=strict).select(
        "order_id",
        at.alias("event_timestamp"),
        "product_id",
        "store_id",
        "customer_id",
        "quantity",
        F.to_date(at).alias("order_date"),
        F.year(at).alias("order_year"),
        F.month(at).alias("order_month"),
    )


def enrich_orders(orders: DataFrame, stores: DataFrame, env: str) -> DataFrame:
    """Add place and region of the current store version; orders without a store stay."""
    placed = lookup_join(
        orders, current(stores), "store_id", "store_id", ["store_city", "store_state", "region_id"]
    )
    return placed.select("*", *_stamps(env))


def cleanse_orders(
    bronze: DataFrame, stores: DataFrame, env: str, strict: bool = True
) -> DataFrame:
    """Normalised and enriched order events."""
    return enrich_orders(normalise_orders(bronze, strict), stores, env)


def cleanse_inventory(bronze: DataFrame, env: str, strict: bool = True) -> DataFrame:
    """Stock events with their band."""
    return conform(bronze, schemas.INVENTORY, strict=strict).select(
        "event_id",
        F.col("event_time").alias("event_timestamp"),
        "product_id",
        "store_id",
        "stock_level",
        "event_type",
        stock_status(F.col("stock_level")).alias("stock_status"),
        *_stamps(env),
    )


def accepted(df: DataFrame, table: str) -> DataFrame:
    """The rows of ``df`` that the rules of ``table`` let in."""
    return enforce(df, RULES[table])
