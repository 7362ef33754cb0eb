"""Dashboard datasets as metric views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlake.operators.joins import Lookup, attach_keys
from larderlake.operators.metrics import MetricView

#: Columns shown per alert.
ALERT_FIELDS = (
    "product_name",
    "product_brand",
    "store_name",
    "store_city",
    "stock_status",
    "lowest_stock_level",
    "last_alert_time",
)


def alert_details(alerts: DataFrame, dim_product: DataFrame, dim_store: DataFrame) -> MetricView:
    """Alerts with the names of product and store."""
    named = attach_keys(
        alerts,
        [
            Lookup(dim_product, "product_id", "product_id", ["product_name", "product_brand"]),
            Lookup(dim_store, "store_id", "store_id", ["store_name", "store_city"]),
        ],
    )
    return MetricView(named, measures={"count": "count(*)"})


def orders_source(orders: DataFrame, per_minute: DataFrame) -> DataFrame:
    """Order events beside the per-minute figures of their store."""
    minute = F.date_trunc("minute", "event_timestamp")
    figures = per_minute.select(
        F.col("store_id").alias("__store"),
        "order_minute",
        "orders_per_minute",
        "total_quantity_per_minute",
    )
    same = (F.col("store_id") == F.col("__store")) & (minute == F.col("order_minute"))
    return orders.join(figures, same, "left").select(
        "store_id",
        "order_id",
        "event_timestamp",
        "product_id",
        "customer_id",
        "quantity",
        "order_date",
        "order_year",
        "order_month",
        "store_city",
        "store_state",
        "region_id",
        "order_minute",
        "orders_per_minute",
        "total_quantity_per_minute",
    )


def orders_view(orders: DataFrame) -> MetricView:
    """Measures over order events.

    None of them reads a per-minute figure, and ``orders_source`` adds at most one match per order
    (a store and a minute have one mart row), so the view goes to the events without the join.
    """
    return MetricView(
        orders,
        dims={
            "event_minute": "date_trunc('MINUTE', event_timestamp)",
            "event_hour": "date_trunc('HOUR', event_timestamp)",
        },
        measures={
            "count": "count(*)",
            # Whole elapsed minutes between first and last event; none elapsed, no rate.
            "orders_per_minute": (
                "count(*) / nullif("
                "timestampdiff(MINUTE, min(event_timestamp), max(event_timestamp)), 0)"
            ),
            "total_quantity": "sum(quantity)",
            "latest_event": "max(event_timestamp)",
        },
    )


def inventory_view(inventory: DataFrame) -> MetricView:
    """Measures over stock events."""
    return MetricView(
        inventory, measures={"count": "count(*)", "avg_stock_level": "avg(stock_level)"}
    )


#: Revenue is summed in whole cents: exact, whatever the order of rows.
_SALES = {
    "total_store_revenue": "sum(cast(round(total_store_revenue * 100) as bigint)) / 100",
    "total_items_sold": "sum(total_items_sold)",
}


def regional_facts(mart: DataFrame) -> MetricView:
    """The regional mart, with the first day of the month for trend charts."""
    dated = mart.withColumn("month_date", F.make_date("transaction_year", "transaction_month", F.lit(1)))
    return MetricView(dated, measures=_SALES)


def sales_with_stores(mart: DataFrame, dim_store: DataFrame, dim_region: DataFrame) -> MetricView:
    """The regional mart with store and region details; rows without either are left out."""
    sales = mart.select(
        "transaction_year",
        "transaction_month",
        "region_id",
        "store_id",
        "store_name",
        "total_store_revenue",
        "total_items_sold",
    )
    store = dim_store.select(
        "store_id", "store_city", "store_state", "store_country", "store_type", "total_sqft"
    )
    region = dim_region.select("region_id", "sales_district", "sales_region")
    return MetricView(sales.join(store, "store_id").join(region, "region_id"), measures=_SALES)
