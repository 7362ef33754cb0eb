"""The six marts.

Marts that need dimension columns first aggregate the lines by natural key, then join: the join
sees one row per group instead of every line, and lines are never shuffled for it. Attributes of a
group depend on its key, so any aggregate would pick them; ``min`` does so repeatably.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlake.functions import ratio, surrogate_key, total
from larderlake.operators.joins import Lookup, attach_keys, join_attrs


def _any(*cols: str) -> list[Column]:
    return [F.min(c).alias(c) for c in cols]


def _counts(*cols: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in cols]


def _totals(*cols: str) -> list[Column]:
    return [total(c).alias(c) for c in cols]


def executive_overview(fact: DataFrame) -> DataFrame:
    """Revenue, profit and margin per month."""
    month = ["transaction_year", "transaction_month"]
    totals = fact.groupBy(*month).agg(
        total("revenue").alias("total_revenue"), total("gross_profit").alias("total_profit")
    )
    return totals.select(
        surrogate_key("agg_exec_overview", *month).alias("exec_overview_sk"),
        "*",
        ratio(F.col("total_profit"), F.col("total_revenue"), 100).alias("profit_margin_pct"),
    )


def inventory_alerts(inventory: DataFrame, dim_store: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Low and empty stock per store and product: last alert and lowest level.

    Unknown stores (or products) share the NULL key, hence the second aggregation.
    """
    place = ["store_id", "product_id", "stock_status"]
    alerts = inventory.filter(F.col("stock_status").isin("OUT_OF_STOCK", "LOW"))
    local = alerts.groupBy(*place).agg(
        F.max("event_timestamp").alias("last_alert_time"),
        F.min("stock_level").alias("lowest_stock_level"),
    )
    keyed = attach_keys(
        local,
        [
            Lookup(dim_store, "store_id", "store_id", ["store_sk"]),
            Lookup(dim_product, "product_id", "product_id", ["product_sk"]),
        ],
    )
    group = ["store_sk", "product_sk", "stock_status"]
    return (
        keyed.groupBy(*group)
        .agg(
            *_any("store_id", "product_id"),
            F.max("last_alert_time").alias("last_alert_time"),
            F.min("lowest_stock_level").alias("lowest_stock_level"),
        )
        .select(surrogate_key("agg_inventory_alert", *group).alias("inventory_alert_sk"), "*")
    )


def orders_per_minute(orders: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Orders and units per store and minute; orders of unknown stores share the NULL key."""
    minute = F.date_trunc("minute", "event_timestamp").alias("order_minute")
    local = orders.groupBy("store_id", minute).agg(
        F.count("order_id").alias("orders_per_minute"),
        F.sum("quantity").alias("total_quantity_per_minute"),
    )
    keyed = attach_keys(local, [Lookup(dim_store, "store_id", "store_id", ["store_sk"])])
    group = ["store_sk", "order_minute"]
    return (
        keyed.groupBy(*group)
        .agg(*_any("store_id"), *_counts("orders_per_minute", "total_quantity_per_minute"))
        .select(surrogate_key("agg_orders_per_min", *group).alias("orders_per_min_sk"), "*")
    )


def regional_sales(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Revenue and units per store and month, with the region the row filter reads."""
    month = ["transaction_year", "transaction_month"]
    local = fact.groupBy("store_id", "store_sk", *month).agg(
        total("revenue").alias("total_store_revenue"), F.sum("quantity").alias("total_items_sold")
    )
    group = ["store_sk", *month]
    return (
        join_attrs(local, dim_store, "store_id", "store_sk")
        .groupBy(*group)
        .agg(
            *_any("region_id", "sales_region", "store_id", "store_name"),
            *_totals("total_store_revenue"),
            *_counts("total_items_sold"),
        )
        .select(surrogate_key("agg_regional_sales", *group).alias("regional_sales_sk"), "*")
    )


def customer_ltv(fact: DataFrame, dim_customer: DataFrame, lines: Column | None = None) -> DataFrame:
    """Lifetime revenue and profit per customer. ``total_items_purchased`` counts lines.

    ``lines`` is how many lines a group of ``fact`` has (default: one a row).
    """
    local = fact.groupBy("customer_id", "customer_sk").agg(
        total("revenue").alias("lifetime_revenue"),
        total("gross_profit").alias("lifetime_profit"),
        (F.count("date_key") if lines is None else lines).alias("total_items_purchased"),
    )
    profile = ["first_name", "last_name", "customer_country", "yearly_income", "member_card"]
    totals = (
        join_attrs(local, dim_customer, "customer_id", "customer_sk")
        .groupBy("customer_sk")
        .agg(
            *_any("customer_id", *profile),
            *_totals("lifetime_revenue", "lifetime_profit"),
            *_counts("total_items_purchased"),
        )
    )
    return totals.select(
        surrogate_key("agg_customer_ltv", "customer_sk").alias("customer_ltv_sk"),
        "*",
        ratio(F.col("lifetime_revenue"), F.col("total_items_purchased")).alias("avg_item_value"),
    )


def store_space(fact: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Revenue and profit per square foot of each store."""
    local = fact.groupBy("store_id", "store_sk").agg(
        total("revenue").alias("total_revenue"), total("gross_profit").alias("total_profit")
    )
    totals = (
        join_attrs(local, dim_store, "store_id", "store_sk")
        .groupBy("store_sk")
        .agg(
            *_any("store_id", "store_name", "store_type", "total_sqft", "grocery_sqft"),
            *_totals("total_revenue", "total_profit"),
        )
    )
    area = F.col("total_sqft")
    return totals.select(
        surrogate_key("agg_store_space", "store_sk").alias("store_space_sk"),
        "*",
        ratio(F.col("total_revenue"), area).alias("revenue_per_sqft"),
        ratio(F.col("total_profit"), area).alias("profit_per_sqft"),
    )
