"""Whole refreshes, layer by layer: what arrived goes to bronze, on to silver, and gold is rebuilt.

Plain functions called in order of dependency. Each writes run events that ``operators.audit``
turns into the audit trail.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlake.operators.quality import RuleSet, apply_rules
from larderlake.plans import dims, facts, marts, partials, schemas, silver
from larderlake.plans.rules import RULES
from larderlake.sources import (
    append_table,
    layer_path,
    read_layer,
    read_table_stream,
    register_bronze,
    write_table,
)
from larderlake.streaming import (
    ChangeSpec,
    apply_changes_stream,
    checkpoint_dir,
    quality_metrics,
    read_accepted,
    read_history,
    run_available_now,
    run_checked,
    stream_static_join,
)

_EVENT_DDL = "timestamp timestamp, event_type string, update_id string, details string"


class RunLog:
    """Run events of one layer's refresh; a handful per table, written once at the end."""

    def __init__(self, spark: SparkSession, root: str, layer: str):
        self.spark, self.path = spark, layer_path(root, "events", layer)
        self.update_id = str(uuid.uuid4())
        self.events: list[tuple] = []

    def add(self, event_type: str, **details) -> None:
        text = json.dumps({event_type: details}, separators=(",", ":"))
        self.events.append((datetime.now(timezone.utc), event_type, self.update_id, text))

    def flow(self, table: str, counts: Mapping[str, int]) -> None:
        """A finished table: rows written, rows dropped, violations per rule."""
        counts = dict(counts)
        total, kept = counts.pop("total_rows", 0), counts.pop("kept_rows", 0)
        checks = [
            {"name": name, "passed_records": total - n, "failed_records": n}
            for name, n in counts.items()
        ]
        quality = {"dropped_records": total - kept}
        if checks:
            quality["expectations"] = checks
        self.add(
            "flow_progress",
            flow_name=table,
            status="COMPLETED",
            metrics={"num_output_rows": kept},
            data_quality=quality,
        )

    def __enter__(self) -> RunLog:
        self.add("create_update")
        return self

    def __exit__(self, kind, error, trace) -> None:
        if error is not None:
            self.add("update_progress", state="FAILED", error=str(error))
        else:
            self.add("update_progress", state="COMPLETED")
        rows = self.spark.createDataFrame(self.events, _EVENT_DDL)
        origin = F.struct("update_id").alias("origin")
        append_table(rows.select("timestamp", "event_type", origin, "details"), self.path)


def read_events(spark: SparkSession, root: str, layer: str) -> DataFrame:
    return spark.read.parquet(layer_path(root, "events", layer))


# --- bronze ---------------------------------------------------------------------------------------


def refresh_bronze(
    spark: SparkSession,
    root: str,
    env: str,
    paths: Mapping[str, str],
    messages: Mapping[str, DataFrame] | None = None,
    max_files: int | None = None,
) -> None:
    """Append new files of the datasets in ``paths`` and new rows of the decoded message streams
    in ``messages`` (table name to stream)."""
    pins = layer_path(root, "schemas", env)
    files = register_bronze(spark, dict(paths), max_files=max_files, pins=pins)
    streams = files | dict(messages or {})
    with RunLog(spark, root, "bronze") as log:
        for table, stream in streams.items():
            counted = stream.observe(table, F.count(F.lit(1)).alias("total_rows"))
            query = run_available_now(
                counted, layer_path(root, "bronze", table), checkpoint_dir(root, env, table)
            )
            rows = quality_metrics(query, table).get("total_rows", 0)
            log.flow(table, {"total_rows": rows, "kept_rows": rows})


# --- silver ---------------------------------------------------------------------------------------

#: Silver table -> (bronze table, cleansing). Lines and events are appended.
_APPENDED = {
    "transactions": ("bronze_transactions", silver.cleanse_transactions),
    "returns": ("bronze_return", silver.cleanse_returns),
    "calendar": ("bronze_calendar", silver.enrich_calendar),
    "inventory": ("bronze_inventory_kafka", silver.cleanse_inventory),
}
#: Master data goes through change application; regions keep no history.
_CHANGED = {
    "stores": ("bronze_stores", silver.cleanse_stores),
    "regions": ("bronze_regions", silver.cleanse_regions),
    "customers": ("bronze_customers", silver.parse_customers),
    "products": ("bronze_products", silver.parse_products),
}


def change_spec(table: str, **options) -> ChangeSpec:
    """How a master-data table applies its feed."""
    return ChangeSpec(
        schemas.KEYS[table], schemas.SEQUENCE, schemas.TRACKED.get(table), **options
    )


def refresh_silver(
    spark: SparkSession, root: str, env: str, tables: Sequence[str], strict: bool = True, **options
) -> None:
    """Bring the named silver tables up to date; ``options`` go to ``ChangeSpec``.

    Stores come before orders, which are enriched with them. Lines and events that break a drop rule
    stay in their table's quarantine (``streaming.read_quarantined``).
    """

    def bronze(name: str) -> DataFrame:
        return read_table_stream(spark, layer_path(root, "bronze", name))

    with RunLog(spark, root, "silver") as log:
        for table, (source, parse) in _CHANGED.items():
            if table in tables:
                rows, _ = apply_rules(parse(bronze(source), env, strict), RULES[table])
                target, check = layer_path(root, "silver", table), checkpoint_dir(root, env, table)
                spec = change_spec(table, **options)
                log.flow(table, _counts(apply_changes_stream(rows, target, check, spec), table))
        for table, (source, cleanse) in _APPENDED.items():
            if table in tables:
                rows = cleanse(bronze(source), env, strict)
                target, check = layer_path(root, "silver", table), checkpoint_dir(root, env, table)
                by = schemas.PARTITIONS.get(table, ())
                log.flow(table, run_checked(rows, RULES[table], target, check, by).counts)
        if "orders" in tables:
            orders = silver.normalise_orders(bronze("bronze_orders_kafka"), strict)
            kept, _ = apply_rules(orders, RULES["orders"])
            query = stream_static_join(
                kept,
                lambda: read_history(spark, layer_path(root, "silver", "stores")),
                lambda batch, stores: silver.enrich_orders(batch, stores, env),
                layer_path(root, "silver", "orders"),
                checkpoint_dir(root, env, "orders"),
            )
            log.flow("orders", _counts(query, "orders"))


def _counts(query, table: str) -> dict[str, int]:
    return quality_metrics(query, f"quality_{table}")


# --- gold -----------------------------------------------------------------------------------------


def refresh_gold(spark: SparkSession, root: str, years: Sequence[int] | None = None) -> None:
    """Rebuild dimensions and marts, and facts and their partial sums from silver.

    Each table is stored before the next reads it, so joins are planned on true sizes. With
    ``years`` only those partitions of the facts are read, recomputed and replaced; lines are never
    removed from silver, so no partition empties. Marts of sales come from partial sums by month, of
    which only the months of these years are summed anew.
    """

    def read(table: str) -> DataFrame:
        path = layer_path(root, "silver", table)
        return read_accepted(spark, path) if table in _APPENDED else read_layer(spark, root, "silver", table)

    def history(table: str) -> DataFrame:
        return read_history(spark, layer_path(root, "silver", table))

    def gold(table: str) -> DataFrame:
        return read_layer(spark, root, "gold", table)

    with RunLog(spark, root, "gold") as log:

        def store(table: str, df: DataFrame, only_touched: bool = False) -> None:
            df, seen = apply_rules(df, RULES.get(table, RuleSet(table, ())))
            write_table(
                df,
                layer_path(root, "gold", table),
                schemas.PARTITIONS.get(table, ()),
                schemas.CLUSTERING.get(table, ()),
                touched_partitions_only=only_touched,
                hashes=schemas.HASHES,
            )
            log.flow(table, seen.get)

        store("dim_date", dims.dim_date(read("calendar")))
        store("dim_region", dims.dim_region(history("regions")))
        store("dim_store", dims.dim_store(history("stores"), history("regions")))
        store("dim_customer", dims.dim_customer(history("customers")))
        store("dim_product", dims.dim_product(history("products")))
        keyed = {n: gold(f"dim_{n}") for n in ("product", "customer", "store", "date")}

        sold, returned = read("transactions"), read("returns")
        if years is not None:
            sold = sold.filter(F.col("transaction_year").isin(list(years)))
            returned = returned.filter(F.col("return_year").isin(list(years)))
        products = history("products")
        store("fact_sales", facts.fact_sales(sold, products, keyed), years is not None)
        store("fact_returns", facts.fact_returns(returned, products, keyed), years is not None)

        sums = layer_path(root, "gold", "partial_sums")
        months = None if years is None else partials.touched_months(sold)
        partials.refresh_partials(spark, gold("fact_sales"), sums, months)
        store("agg_executive_overview", partials.executive_overview(spark, sums))
        store("agg_regional_sales", partials.regional_sales(spark, sums, keyed["store"]))
        store("agg_customer_ltv", partials.customer_ltv(spark, sums, keyed["customer"]))
        store("agg_store_space_utilization", partials.store_space(spark, sums, keyed["store"]))
        alerts = marts.inventory_alerts(read("inventory"), keyed["store"], keyed["product"])
        store("agg_ops_inventory_alerts", alerts)
        store("agg_ops_orders_per_minute", marts.orders_per_minute(read("orders"), keyed["store"]))
