"""Lookups, facts and their keys."""

from pyspark.sql import functions as F

from larderlake.operators.dedup import dedup, latest
from larderlake.operators.joins import lookup_join
from larderlake.plans import dims, facts
from tests.conftest import day, rows, ts

LINES = (
    "transaction_date date, stock_date date, product_id int, customer_id int, store_id int, "
    "quantity int, transaction_year int, transaction_month int, transaction_quarter int"
)


def lines(spark, *data):
    """(product, customer, store, quantity)"""
    when = (day("2024-03-09"), day("2024-03-01"))
    return spark.createDataFrame([(*when, p, c, s, q, 2024, 3, 1) for p, c, s, q in data], LINES)


def products(spark, *data):
    """(id, price, cost, end)"""
    return spark.createDataFrame(
        list(data),
        "product_id int, product_retail_price double, product_cost double, `__END_AT` timestamp",
    )


def dim(spark, name, *data):
    return spark.createDataFrame(list(data), f"{name}_id int, {name}_sk string")


OLD = ts("2024-01-01 00:00:00")


def test_sales_take_current_prices_and_keys(spark):
    found = facts.fact_sales(
        lines(spark, (1, 1, 1, 2), (2, 2, 2, 3)),
        products(spark, (1, 5.0, 2.0, OLD), (1, 10.0, 4.0, None), (2, 1.0, 0.5, None)),
        {
            "product": dim(spark, "product", (1, "p1"), (2, "p2")),
            "customer": dim(spark, "customer", (1, "c1"), (2, "c2")),
            "store": dim(spark, "store", (1, "s1")),
            "date": spark.createDataFrame([(20240309, "d")], "date_key int, date_sk string"),
        },
    )
    one, two = rows(found, "product_id")
    assert (one["revenue"], one["cost"], one["gross_profit"]) == (20.0, 8.0, 12.0)
    assert [one[f"{n}_sk"] for n in ("product", "customer", "store", "date")] == ["p1", "c1", "s1", "d"]
    assert two["store_sk"] is None and two["date_key"] == 20240309
    assert len(found.columns) == 19 and one["sale_sk"] != two["sale_sk"]


def test_unknown_product_keeps_the_line(spark):
    (row,) = rows(facts.sales_measures(lines(spark, (9, 1, 1, 2)), products(spark, (1, 1.0, 1.0, None))))
    assert row["quantity"] == 2 and row["revenue"] is None and row["gross_profit"] is None


def test_equal_lines_share_a_key_and_stay(spark):
    found = facts.fact_sales(lines(spark, (1, 1, 1, 2), (1, 1, 1, 2)), products(spark), {})
    assert found.count() == 2 and found.select("sale_sk").distinct().count() == 1


def test_returns(spark):
    df = spark.createDataFrame(
        [(day("2024-03-09"), 1, 1, 2, 2024), (day("2024-03-10"), 2, 1, 1, 2024)],
        "return_date date, product_id int, store_id int, quantity int, return_year int",
    )
    found = facts.fact_returns(
        df, products(spark, (1, 10.0, 4.0, None)), {"store": dim(spark, "store", (1, "s1"))}
    )
    one, two = rows(found, "product_id")
    assert (one["return_revenue"], one["return_cost"], one["store_sk"]) == (20.0, 8.0, "s1")
    assert two["return_revenue"] is None and two["date_key"] == 20240310


def stores(spark, *data):
    """(id, region, end)"""
    names = (
        "store_type string, store_name string, store_street_address string, store_city string, "
        "store_state string, store_country string, store_phone string, first_opened_date date, "
        "last_remodel_date date, total_sqft int, grocery_sqft int"
    )
    blank = (None,) * 11
    return spark.createDataFrame(
        [(i, r, *blank, OLD, e) for i, r, e in data],
        f"store_id int, region_id int, {names}, `__START_AT` timestamp, `__END_AT` timestamp",
    )


def test_stores_carry_their_region(spark):
    regions = spark.createDataFrame(
        [(1, "North", "West")], "region_id int, sales_district string, sales_region string"
    )
    found = rows(dims.dim_store(stores(spark, (1, 1, OLD), (1, 1, None), (2, 7, None)), regions), "store_id")
    assert [(r["store_id"], r["sales_region"]) for r in found] == [(1, "West"), (2, None)]
    assert found[0]["effective_from"] == OLD
    assert len(found[0]) == 18


def test_lookup_of_null_keys(spark):
    left = spark.createDataFrame([(None,), (1,)], "a int")
    right = spark.createDataFrame([(None, "n"), (1, "one")], "b int, v string")
    found = rows(lookup_join(left, right, "a", "b", ["v"]), "a")
    assert found == [{"a": None, "v": None}, {"a": 1, "v": "one"}]


def test_dedup_keeps_the_smallest(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "c")], "k int, v string")
    assert rows(dedup(df, ["k"])) == [{"k": 1, "v": "a"}, {"k": 2, "v": None}]
    assert dedup(df.select("k"), ["k"]).count() == 2


def test_latest_breaks_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z")], "k int, s int, v string")
    assert rows(latest(df, ["k"], ["s"])) == [{"k": 1, "s": 5, "v": "b"}]


def test_keys_travel_as_bytes_and_come_back_as_they_were(spark):
    from larderlake.functions import packed, unpacked

    texts = ["0" * 32, "deadbeef" * 4, "DEADBEEF" * 4, "x" * 32, "", "p1", "é" * 16, "abc", "0" * 16, None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", unpacked(packed(F.col("t"))).alias("back"), F.length(packed(F.col("t"))).alias("n")
    )
    for r in found.collect():
        assert r.back == r.t
        assert (r.n == 16) == (r.t in ("0" * 32, "deadbeef" * 4))


def test_no_key_is_shuffled_as_text(spark, path):
    """Where nothing is broadcast, and in the sink, keys of lookups go through exchanges packed."""
    from larderlake.plans import schemas
    from larderlake.sources import write_table
    from larderlake.workload.queries import sales

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = sales(spark, "/root/testdata/sf0.001", "product", "customer", "store", "date")
        text = fact._jdf.queryExecution().optimizedPlan().toString()
        above = text[: text.index("Join")]
        assert above.count("unhex") == 0 and above.lower().count("hex(") >= 2
        layout = schemas.PARTITIONS["fact_sales"], schemas.CLUSTERING["fact_sales"]
        write_table(fact, f"{path}/packed", *layout, hashes=schemas.HASHES)
        write_table(fact, f"{path}/plain", *layout)
        a, b = (spark.read.parquet(f"{path}/{p}").drop("gold_loaded_at") for p in ("packed", "plain"))
        assert a.columns == b.columns and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
