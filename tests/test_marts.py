"""The six marts, dimensions and dashboards on small tables."""

from larderlake.operators.metrics import MetricView, Widget
from larderlake.plans import dashboards, dims, marts
from tests.conftest import day, rows, ts

FACT = (
    "transaction_year int, transaction_month int, store_id int, store_sk string, customer_id int, "
    "customer_sk string, date_key int, quantity int, revenue double, gross_profit double"
)


def fact(spark, *data):
    """(month, store, customer, quantity, revenue, profit)"""
    full = [
        (2024, m, s, f"s{s}", c, f"c{c}", 20240100 + m, q, r, p) for m, s, c, q, r, p in data
    ]
    return spark.createDataFrame(full, FACT)


def stores(spark, *data):
    """(id, region, sqft)"""
    return spark.createDataFrame(
        [(f"s{i}", i, r, f"Store {i}", "Deluxe", a, a // 2, f"R{r}" if r else None) for i, r, a in data],
        "store_sk string, store_id int, region_id int, store_name string, store_type string, "
        "total_sqft int, grocery_sqft int, sales_region string",
    )


def test_executive_overview(spark):
    df = marts.executive_overview(
        fact(spark, (1, 1, 1, 1, 100.0, 40.0), (1, 1, 1, 1, 200.0, 80.0), (2, 1, 1, 1, 50.0, 10.0))
    )
    found = [(r["total_revenue"], r["total_profit"], r["profit_margin_pct"]) for r in rows(df, "transaction_month")]
    assert found == [(300.0, 120.0, 40.0), (50.0, 10.0, 20.0)]


def test_executive_overview_single_line(spark):
    (row,) = rows(marts.executive_overview(fact(spark, (5, 1, 1, 1, 99.99, 33.33))))
    assert (row["total_revenue"], row["profit_margin_pct"]) == (99.99, 33.33)


def test_executive_overview_without_revenue(spark):
    (row,) = rows(marts.executive_overview(fact(spark, (1, 1, 1, 1, 0.0, 0.0), (1, 1, 1, 1, None, None))))
    assert row["total_revenue"] == 0.0 and row["profit_margin_pct"] is None


def test_regional_sales(spark):
    lines = fact(spark, (1, 1, 1, 2, 100.0, 1.0), (1, 1, 2, 3, 50.0, 1.0), (1, 2, 1, 1, 75.0, 1.0), (1, 9, 1, 1, 7.0, 1.0))
    df = marts.regional_sales(lines, stores(spark, (1, 10, 100), (2, 20, 100)))
    found = {r["store_id"]: (r["total_store_revenue"], r["total_items_sold"], r["sales_region"]) for r in rows(df)}
    assert found == {1: (150.0, 5, "R10"), 2: (75.0, 1, "R20")}  # store 9 is in no dimension


def test_customer_ltv_counts_lines(spark):
    customers = spark.createDataFrame(
        [("c1", 1, "A", None, "X", "$10K", "Gold"), ("c2", 2, "B", "L", "Y", None, "Silver")],
        "customer_sk string, customer_id int, first_name string, last_name string, "
        "customer_country string, yearly_income string, member_card string",
    )
    df = marts.customer_ltv(
        fact(spark, (1, 1, 1, 9, 100.0, 40.0), (2, 1, 1, 9, 50.0, 20.0), (1, 1, 2, 9, 10.0, 1.0)), customers
    )
    one, two = rows(df, "customer_id")
    assert (one["lifetime_revenue"], one["lifetime_profit"], one["total_items_purchased"]) == (150.0, 60.0, 2)
    assert one["avg_item_value"] == 75.0 and one["last_name"] is None
    assert two["total_items_purchased"] == 1


def test_store_space(spark):
    lines = fact(spark, (1, 1, 1, 1, 1000.0, 300.0), (2, 1, 1, 1, 500.0, 100.0), (1, 2, 1, 1, 10.0, 5.0))
    one, two = rows(marts.store_space(lines, stores(spark, (1, 1, 500), (2, 1, 0))), "store_id")
    assert (one["revenue_per_sqft"], one["profit_per_sqft"]) == (3.0, 0.8)
    assert two["revenue_per_sqft"] is None  # no area


def test_store_space_high_density(spark):
    (row,) = rows(marts.store_space(fact(spark, (1, 1, 1, 1, 1e6, 4e5)), stores(spark, (1, 1, 100))))
    assert (row["revenue_per_sqft"], row["profit_per_sqft"]) == (10000.0, 4000.0)


def inventory(spark, *data):
    return spark.createDataFrame(
        [(s, p, st, lv, ts(t)) for s, p, st, lv, t in data],
        "store_id int, product_id int, stock_status string, stock_level int, event_timestamp timestamp",
    )


def keys(spark, name, *ids):
    return spark.createDataFrame([(f"{name[0]}{i}", i) for i in ids], f"{name}_sk string, {name}_id int")


def test_inventory_alerts(spark):
    df = inventory(
        spark,
        (1, 1, "LOW", 5, "2024-01-01 10:00:00"),
        (1, 1, "LOW", 3, "2024-01-01 11:00:00"),
        (1, 2, "OUT_OF_STOCK", 0, "2024-01-01 09:00:00"),
        (1, 3, "HEALTHY", 90, "2024-01-01 09:00:00"),
        (8, 1, "LOW", 7, "2024-01-01 08:00:00"),
        (9, 1, "LOW", 6, "2024-01-01 07:00:00"),
    )
    found = rows(marts.inventory_alerts(df, keys(spark, "store", 1), keys(spark, "product", 1, 2)))
    known = {(r["store_sk"], r["product_sk"]): r for r in found}
    assert len(found) == 3
    assert known["s1", "p1"]["lowest_stock_level"] == 3
    assert known["s1", "p1"]["last_alert_time"] == ts("2024-01-01 11:00:00")
    # Stores 8 and 9 are unknown and share the NULL key.
    assert (known[None, "p1"]["store_id"], known[None, "p1"]["lowest_stock_level"]) == (8, 6)


def test_no_alerts(spark):
    df = inventory(spark, (1, 1, "HEALTHY", 90, "2024-01-01 09:00:00"), (1, 2, "MEDIUM", 20, "2024-01-01 09:00:00"))
    assert marts.inventory_alerts(df, keys(spark, "store", 1), keys(spark, "product", 1)).count() == 0


def orders(spark, *data):
    return spark.createDataFrame(
        [(i, s, ts(t), q) for i, (s, t, q) in enumerate(data)],
        "order_id int, store_id int, event_timestamp timestamp, quantity int",
    )


def test_orders_per_minute(spark):
    df = orders(spark, (1, "2024-01-01 10:00:05", 2), (1, "2024-01-01 10:00:55", 3), (1, "2024-01-01 10:01:00", 1), (2, "2024-01-01 10:00:30", 4))
    found = {(r["store_id"], r["order_minute"].minute): (r["orders_per_minute"], r["total_quantity_per_minute"]) for r in rows(marts.orders_per_minute(df, keys(spark, "store", 1, 2)))}
    assert found == {(1, 0): (2, 5), (1, 1): (1, 1), (2, 0): (1, 4)}


def test_order_rate_needs_elapsed_minutes(spark):
    def rate(*times):
        view = dashboards.orders_view(orders(spark, *((1, t, 1) for t in times)))
        return view.query([], ["orders_per_minute"]).first()[0]

    assert rate("2024-01-01 10:00:00", "2024-01-01 10:02:59") == 1.0
    assert rate("2024-01-01 10:00:00", "2024-01-01 10:00:59") is None


def test_metric_view(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 5)], "k string, v int")
    view = MetricView(df, dims={"big": "v > 1"}, measures={"n": "count(*)", "s": "sum(v)"})
    assert view.query([], ["n", "s"]).first() == (3, 8)
    assert [tuple(r) for r in view.query(["k"], ["s"], order_by={"s": "desc"}).collect()] == [("b", 5), ("a", 3)]
    assert view.query(["k"], ["n"], where="v > 1").count() == 2
    assert {tuple(r) for r in view.query(["big"], ["n"]).collect()} == {(True, 2), (False, 1)}
    assert view.rows(["k", "big"], order_by={"k": "desc"}).first() == ("b", True)
    assert view.query([], ["n"], where="false").first()[0] == 0


def test_dim_date(spark):
    days = spark.createDataFrame(
        [(day("2024-02-29"), 2024, 2, 1, 9, 5, "Thursday", "February", False)] * 2,
        "date date, year int, month int, quarter int, week_of_year int, day_of_week int, "
        "day_name string, month_name string, is_weekend boolean",
    )
    (row,) = rows(dims.dim_date(days))
    assert (row["date_key"], row["fiscal_year"], row["fiscal_quarter"]) == (20240229, 2024, 1)
    assert len(row["date_sk"]) == 32 and len(row) == 14


def test_dim_region_is_unique(spark):
    regions = spark.createDataFrame(
        [(1, "N", "West"), (1, "N", "East"), (2, "S", "East")],
        "region_id int, sales_district string, sales_region string",
    )
    found = rows(dims.dim_region(regions), "region_id")
    assert [(r["region_id"], r["sales_region"]) for r in found] == [(1, "East"), (2, "East")]


def test_dashboard_sources_join_dimensions(spark):
    mart = marts.regional_sales(fact(spark, (1, 1, 1, 2, 100.0, 1.0), (1, 2, 1, 1, 9.0, 1.0)), stores(spark, (1, 10, 50), (2, None, 50)))
    store = spark.createDataFrame(
        [(1, "C", "S", "N", "Deluxe", 50), (2, "C", "S", "N", "Deluxe", 50)],
        "store_id int, store_city string, store_state string, store_country string, store_type string, total_sqft int",
    )
    region = spark.createDataFrame([(10, "D", "R10")], "region_id int, sales_district string, sales_region string")
    view = dashboards.sales_with_stores(mart, store, region)
    (row,) = rows(view.source)
    assert (row["store_id"], row["sales_district"], row["total_store_revenue"]) == (1, "D", 100.0)
    facts = dashboards.regional_facts(mart).query(["month_date"], ["total_items_sold"])
    assert rows(facts) == [{"month_date": day("2024-01-01"), "total_items_sold": 3}]


def test_all_widgets_of_a_view_in_one_pass(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("b", None, 5), (None, "x", None)], "k string, c string, v int"
    )
    view = MetricView(
        df,
        dims={"big": "v > 1"},
        measures={"n": "count(*)", "s": "sum(v)", "mean": "sum(coalesce(v, 0)) / nullif(count(v), 0)"},
    )
    widgets = {
        "all": Widget((), ("n", "s", "mean")),
        "by_k": Widget(("k",), ("s", "n")),
        "by_c_k": Widget(("c", "k"), ("n",)),
        "by_big": Widget(("big",), ("mean",)),
        "big_only": Widget(("k",), ("n", "mean"), "v > 1"),
        "none": Widget((), ("n", "s"), "v > 100"),
        "none_by_k": Widget(("k",), ("n",), "v > 100"),
    }
    found = view.queries(widgets)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    for name, w in widgets.items():
        assert rows(view.pick(found, name, w)) == rows(view.query(w.dims, w.measures, w.where)), name
    one = view.queries({"all": widgets["all"], "none": widgets["none"]})
    assert sorted(r.n for r in one.collect()) == [0, 4]
