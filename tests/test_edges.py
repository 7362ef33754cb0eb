"""No rows in, no rows out; and streams that must stop."""

import pytest
from pyspark.sql import functions as F

from larderlake.operators import audit, scd
from larderlake.operators.dedup import dedup, latest
from larderlake.operators.quality import apply_rules, violations
from larderlake.plans import dashboards, dims, facts, marts, silver
from larderlake.plans.rules import RULES
from larderlake.sources import infer_csv_schema, read_csv_stream, with_lineage
from larderlake.streaming import run_available_now
from larderlake.workload import inputs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def none(spark):
    """Silver tables without rows."""
    names = ("transactions", "returns", "calendar", "regions", "stores", "customers", "products",
             "orders", "inventory")
    return {n: getattr(inputs, n)(spark, SF).filter("false") for n in names}


@pytest.fixture(scope="module")
def star(none):
    return {
        "date": dims.dim_date(none["calendar"]),
        "region": dims.dim_region(none["regions"]),
        "store": dims.dim_store(none["stores"], none["regions"]),
        "customer": dims.dim_customer(none["customers"]),
        "product": dims.dim_product(none["products"]),
    }


def test_empty_dimensions_and_facts(none, star):
    assert all(df.count() == 0 for df in star.values())
    assert facts.fact_sales(none["transactions"], none["products"], star).count() == 0
    assert facts.fact_returns(none["returns"], none["products"], star).count() == 0


def test_empty_marts(none, star):
    sales = facts.fact_sales(none["transactions"], none["products"], star)
    found = [
        marts.executive_overview(sales),
        marts.regional_sales(sales, star["store"]),
        marts.customer_ltv(sales, star["customer"]),
        marts.store_space(sales, star["store"]),
        marts.inventory_alerts(none["inventory"], star["store"], star["product"]),
        marts.orders_per_minute(none["orders"], star["store"]),
    ]
    assert [df.count() for df in found] == [0] * 6


def test_empty_dashboards(none, star):
    view = dashboards.orders_view(none["orders"])
    assert view.query([], ["count", "orders_per_minute", "latest_event"]).first() == (0, None, None)
    assert view.query(["event_minute"], ["count"]).count() == 0
    stock = dashboards.inventory_view(none["inventory"])
    assert stock.query([], ["avg_stock_level"]).first()[0] is None


def test_empty_change_feeds(none):
    rows = none["stores"].drop(scd.START, scd.END)
    args = ["store_id"], "bronze_ingestion_time"
    assert scd.scd1_latest(rows, *args).count() == 0
    assert scd.scd2_history(rows, *args, ["total_sqft"]).count() == 0
    history = scd.scd2_history(rows, *args, ["total_sqft"])
    assert scd.scd2_merge(history, rows, rows, *args, ["total_sqft"]).count() == 0
    assert dedup(rows, ["store_id"]).count() == latest(rows, ["store_id"], ["region_id"]).count() == 0


def test_empty_events_and_quarantine(spark, none):
    events = inputs.pipeline_events(spark, SF).filter("false")
    run = audit.AuditRun("r")
    assert audit.flow_metrics(events, run).count() == 0
    assert audit.timing_status(events).count() == 0
    assert violations(none["transactions"], RULES["transactions"]).count() == 0


def test_stream_stops_at_a_missing_key(spark, path):
    spark.createDataFrame([(None, "North", "West"), ("2", "South", "East")],
                          "region_id string, sales_district string, sales_region string") \
        .write.option("header", True).csv(f"{path}/in")
    stream = read_csv_stream(spark, f"{path}/in", infer_csv_schema(spark, f"{path}/in"))
    kept, _ = apply_rules(silver.cleanse_regions(with_lineage(stream, "regions"), "t"), RULES["regions"])
    with pytest.raises(Exception, match="valid_region_pk"):
        run_available_now(kept, f"{path}/out", f"{path}/check")
    # Nothing of the batch is visible, and the same run still fails.
    with pytest.raises(Exception, match="valid_region_pk"):
        run_available_now(kept, f"{path}/out", f"{path}/check")


def test_stream_stops_at_text_that_is_no_date(spark, path):
    spark.createDataFrame([("31/31/2024", "1", "1", "1")],
                          "return_date string, product_id string, store_id string, quantity string") \
        .write.option("header", True).csv(f"{path}/in")
    stream = with_lineage(read_csv_stream(spark, f"{path}/in", infer_csv_schema(spark, f"{path}/in")), "return")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        run_available_now(silver.cleanse_returns(stream, "t"), f"{path}/strict", f"{path}/check1")
    tolerant = silver.accepted(silver.cleanse_returns(stream, "t", strict=False), "returns")
    run_available_now(tolerant, f"{path}/out", f"{path}/check2")
    assert spark.read.schema("return_date date").parquet(f"{path}/out").count() == 0


def test_totals_do_not_depend_on_partitioning(spark):
    lines = facts.sales_measures(inputs.transactions(spark, SF), inputs.products(spark, SF))
    few, many = lines.repartition(2), lines.repartition(37, F.xxhash64("customer_id", "quantity"))
    mart = marts.executive_overview
    assert sorted(mart(few).collect()) == sorted(mart(many).collect())
