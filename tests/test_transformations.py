"""Column logic of the silver and gold plans."""

import pytest
from pyspark.sql import functions as F

from larderlake.functions import date_key, money, ratio, stock_status, surrogate_key, total
from larderlake.plans import facts, silver
from tests.conftest import day, rows, ts

ARRIVED = ts("2024-01-01 00:00:00")


def products(spark, *prices):
    data = [(i, p, c, 1, 0) for i, (p, c) in enumerate(prices)]
    df = spark.createDataFrame(
        data,
        "product_id int, product_retail_price double, product_cost double, recyclable int, low_fat int",
    )
    extra = {"product_brand": "b", "product_name": "n"}
    df = df.withColumns({k: F.lit(v) for k, v in extra.items()})
    return df.withColumns(
        {
            "product_sku": F.lit(1),
            "product_weight": F.lit(1.0),
            "ingestion_time": F.lit(ARRIVED),
        }
    )


def margins(spark, *prices):
    df = silver.parse_products(products(spark, *prices), "t")
    return [r.margin_pct for r in df.orderBy("product_id").collect()]


def test_margin(spark):
    assert margins(spark, (10.0, 4.0), (100.0, 75.0), (3.0, 2.0)) == [60.0, 25.0, 33.33]


def test_margin_zero_when_price_is_cost(spark):
    assert margins(spark, (5.0, 5.0)) == [0.0]


def test_margin_of_zero_price_is_null_and_row_is_dropped(spark):
    df = silver.parse_products(products(spark, (0.0, 1.0), (2.0, 1.0)), "t")
    assert [r.margin_pct for r in df.orderBy("product_id").collect()] == [None, 50.0]
    assert [r.product_id for r in silver.accepted(df, "products").collect()] == [1]


def test_booleans_from_numbers(spark):
    row = silver.parse_products(products(spark, (2.0, 1.0)), "t").first()
    assert (row.recyclable, row.low_fat) == (True, False)


@pytest.mark.parametrize(
    ("first", "last", "full"),
    [("Ada", "Example", "Ada Example"), ("Ada", None, "Ada"), (None, "Example", "Example"), (None, None, "")],
)
def test_full_name_skips_nulls(spark, first, last, full):
    text = ", ".join(f"{k} string" for k in ("first_name", "last_name"))
    df = spark.createDataFrame([(first, last)], text)
    assert df.select(F.concat_ws(" ", "first_name", "last_name")).first()[0] == full


def lines(spark, *data):
    return spark.createDataFrame(
        [(day("2024-03-09"), day("2024-03-01"), p, 1, 1, q, 2024, 3, 1) for p, q in data],
        "transaction_date date, stock_date date, product_id int, customer_id int, store_id int, "
        "quantity int, transaction_year int, transaction_month int, transaction_quarter int",
    )


def priced(spark, *data):
    return spark.createDataFrame(
        [(i, p, c, None) for i, p, c in data],
        "product_id int, product_retail_price double, product_cost double, `__END_AT` timestamp",
    )


def test_revenue_cost_profit(spark):
    df = facts.sales_measures(
        lines(spark, (1, 3), (2, 1), (3, 10)),
        priced(spark, (1, 9.99, 4.5), (2, 25.0, 10.0), (3, 1.25, 0.75)),
    )
    found = [(r["revenue"], r["cost"], r["gross_profit"]) for r in rows(df, "product_id")]
    assert found == [(29.97, 13.5, 16.47), (25.0, 10.0, 15.0), (12.5, 7.5, 5.0)]


def test_large_quantity(spark):
    row = facts.sales_measures(lines(spark, (1, 10000)), priced(spark, (1, 99.99, 49.99))).first()
    assert (row.revenue, row.cost, row.gross_profit) == (999900.0, 499900.0, 500000.0)


def test_stock_bands(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 9, 10, 49, 50, 100, None)], "n int")
    found = {r.n: r.s for r in df.select("n", stock_status(F.col("n")).alias("s")).collect()}
    assert found == {
        0: "OUT_OF_STOCK",
        1: "LOW",
        9: "LOW",
        10: "MEDIUM",
        49: "MEDIUM",
        50: "HEALTHY",
        100: "HEALTHY",
        None: "HEALTHY",
    }


def calendar(spark, *texts):
    df = spark.createDataFrame([(t, ARRIVED) for t in texts], "date string, ingestion_time timestamp")
    return rows(silver.enrich_calendar(df, "t"), "date")


def test_weekend_flag(spark):
    found = calendar(spark, "3/8/2024", "3/9/2024", "3/10/2024", "3/11/2024")
    assert [r["is_weekend"] for r in found] == [False, True, True, False]


def test_weekend_of_missing_date(spark):
    assert calendar(spark, None)[0]["is_weekend"] is False


def test_date_key(spark):
    df = spark.createDataFrame([(day("2024-01-05"),), (day("1997-12-31"),), (None,)], "d date")
    assert [r[0] for r in df.select(date_key("d")).collect()] == [20240105, 19971231, None]


def test_date_parts(spark):
    df = spark.createDataFrame(
        [("6/15/2023", "6/1/2023", "1", "2", "3", "4", ARRIVED, "f")],
        "transaction_date string, stock_date string, product_id string, customer_id string, "
        "store_id string, quantity string, ingestion_time timestamp, source_file string",
    )
    row = silver.cleanse_transactions(df, "t").first()
    parts = ("year", "month", "quarter", "day_of_week")
    assert [row[f"transaction_{p}"] for p in parts] == [2023, 6, 2, 5]
    assert (row.product_id, row.customer_id, row.store_id, row.quantity) == (1, 2, 3, 4)


def test_day_and_month_names(spark):
    (row,) = calendar(spark, "7/4/2024")
    assert (row["day_name"], row["month_name"]) == ("Thursday", "July")


def test_iso_week_at_year_end(spark):
    first, last = calendar(spark, "1/1/2024", "12/30/2024")
    assert (first["week_of_year"], last["week_of_year"]) == (1, 1)


def test_money_rounds_halves_up(spark):
    assert spark.range(1).select(money(F.lit(1.005)), money(F.lit(-2.675))).first() == (1.01, -2.68)


def test_ratio_by_zero_is_null(spark):
    assert spark.range(1).select(ratio(F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_total_is_exact_in_any_order(spark):
    df = spark.range(1000).select(F.lit(0.1).alias("a"))
    assert df.select(total("a")).first()[0] == 100.0
    assert df.filter("id < 0").select(total("a")).first()[0] is None


def test_surrogate_key_skips_nulls(spark):
    df = spark.createDataFrame([(None, "x"), ("x", None), ("x", "y")], "a string, b string")
    one, two, three = (r[0] for r in df.select(surrogate_key("t", "a", "b")).collect())
    assert one == two != three
    assert three == spark.range(1).select(F.md5(F.lit("t||x||y"))).first()[0]


def test_orders_without_store_stay(spark):
    orders = spark.createDataFrame(
        [(1, "2024-01-01 10:00:30", 1, 1, 1, 2), (2, "2024-01-01 10:01:00", 1, 9, 1, 2)],
        "order_id int, event_time string, product_id int, store_id int, customer_id int, quantity int",
    )
    stores = spark.createDataFrame(
        [(1, "Old", "S", 1, ts("2024-01-01 00:00:00")), (1, "New", "S", 1, None)],
        "store_id int, store_city string, store_state string, region_id int, `__END_AT` timestamp",
    )
    found = rows(silver.cleanse_orders(orders, stores, "t"), "order_id")
    assert [(r["order_id"], r["store_city"]) for r in found] == [(1, "New"), (2, None)]
    assert found[0]["order_date"] == day("2024-01-01") and found[0]["order_month"] == 1
