"""Marts from partial sums of the months that changed."""

import os
import time
from datetime import date

from pyspark.sql import functions as F

from larderlake.plans import marts, partials
from larderlake.sources import write_table
from larderlake.workload import queries
from larderlake.workload.queries import QUERIES, full_store, sales, star
from tests.conftest import rows
from tests.test_plans import plan

SF = "/root/testdata/sf0.001"


def files(folder):
    return {
        os.path.join(at, name): os.path.getmtime(os.path.join(at, name))
        for at, _, names in os.walk(folder)
        for name in names
        if name.endswith(".parquet")
    }


def test_late_lines_touch_their_months_only(spark, path):
    fact = sales(spark, SF, "store", "customer").drop("gold_loaded_at")
    months = [(1996, 11), (1998, 3)]
    late = partials.in_months(months) & (F.col("quantity") % 2 == 0)
    layout = partials.MONTH
    write_table(fact.filter(~late), f"{path}/fact", layout)
    partials.refresh_partials(spark, spark.read.parquet(f"{path}/fact"), f"{path}/sums")
    before = files(f"{path}/sums")

    touched = partials.touched_months(fact.filter(late))
    assert touched == months
    write_table(fact.filter(partials.in_months(touched)), f"{path}/fact", layout, touched_partitions_only=True)
    stored = spark.read.parquet(f"{path}/fact")
    partials.refresh_partials(spark, stored, f"{path}/sums", touched)
    after = files(f"{path}/sums")
    changed = {f for f in before.keys() ^ after.keys()} | {f for f in before.keys() & after.keys() if before[f] != after[f]}
    assert changed and all(any(f"year={y}/transaction_month={m}/" in f for y, m in months) for f in changed)

    store, customer = full_store(spark, SF), star(spark, SF, "customer")["customer"]
    sums = f"{path}/sums"
    assert rows(partials.executive_overview(spark, sums)) == rows(marts.executive_overview(fact))
    assert rows(partials.regional_sales(spark, sums, store)) == rows(marts.regional_sales(fact, store))
    assert rows(partials.store_space(spark, sums, store)) == rows(marts.store_space(fact, store))
    assert rows(partials.customer_ltv(spark, sums, customer)) == rows(marts.customer_ltv(fact, customer))

    # Of the facts, and of the sums behind a mart of some months, only those months are read.
    text = plan(partials.partial_sums(stored.filter(partials.in_months(touched)), "store_month"))
    assert "transaction_month" in text[text.index("PartitionFilters") :].split("PushedFilters")[0]
    one = partials.executive_overview(spark, sums, [(1998, 3)])
    assert "PartitionFilters: [(transaction_year" in plan(one).replace("isnotnull", "") or "1998" in plan(one)
    assert [(r["transaction_year"], r["transaction_month"]) for r in rows(one)] == [(1998, 3)]


def test_null_amounts_and_no_lines(spark, path):
    ddl = (
        "transaction_year int, transaction_month int, store_id int, store_sk string, customer_id int, "
        "customer_sk string, revenue double, gross_profit double, quantity int, date_key int"
    )
    fact = spark.createDataFrame([(2024, 1, 1, "s", 2, "c", None, None, 3, 20240101), (2024, 2, 1, "s", None, None, 0.1, 0.05, 1, None)], ddl)
    partials.refresh_partials(spark, fact, f"{path}/sums")
    assert rows(partials.executive_overview(spark, f"{path}/sums")) == rows(marts.executive_overview(fact))
    found = {r.transaction_month: r.lines for r in partials.read_partials(spark, f"{path}/sums", "customer_month").collect()}
    assert found == {1: 1, 2: 0}
    partials.refresh_partials(spark, fact.limit(0), f"{path}/sums", [])
    assert partials.read_partials(spark, f"{path}/sums", "store_month").count() == 2
    assert partials.touched_months(fact.limit(0)) == []


def left_on_disk(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    found = manager.getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_a_written_table_leaves_nothing_shuffled(spark, path):
    numbers = spark.range(0, 5000, 1, 4).selectExpr("id", "id % 3 month")
    before = left_on_disk(spark)
    write_table(numbers.groupBy("month", "id").count(), f"{path}/t", ["month"], ["id"])
    # Files are deleted in the background.
    until = time.time() + 20
    while (kept := left_on_disk(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not kept
    assert spark.read.parquet(f"{path}/t").count() == 5000


def test_facts_are_built_run_by_run(spark, path, monkeypatch):
    def table(name, ddl, *values):
        spark.createDataFrame(list(values), ddl).coalesce(1).write.parquet(f"{path}/{name}.parquet")

    table("region", "r_regionkey int, r_name string", (0, "EAST"))
    table("nation", "n_nationkey int, n_name string, n_regionkey int", (1, "A", 0))
    table("customer", "c_custkey int, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", *((i, "x", 1, 1.0, "S") for i in (1, 2, 3)))
    table("supplier", "s_suppkey int, s_name string, s_nationkey int, s_acctbal double", *((i, "s", 1, 1.0) for i in (4, 5)))
    table("part", "p_partkey int, p_name string, p_brand string, p_type string, p_size int, p_retailprice double", (7, "p", "b", "t", 2, 10.0))
    days = [(1, date(1995, 1, 9)), (2, date(1995, 2, 9)), (3, date(1995, 3, 9)), (4, date(1996, 1, 9)), (5, date(1996, 5, 9))]
    table("orders", "o_orderkey int, o_custkey int, o_orderdate date", *((i, 1 + i % 3, d) for i, d in days))
    lines = [(i, 7, 4 + n % 2, float(n + 1), date(1996, 6, 1)) for i, _ in days for n in range(i)]
    table("lineitem", "l_orderkey int, l_partkey int, l_suppkey int, l_quantity double, l_shipdate date", *lines, *lines[:3])

    monkeypatch.setattr(partials, "LINES_AT_ONCE", 5)
    written = []

    def recorded(df, to, *args, **kwargs):
        if to.endswith("/fact_sales"):
            counts = df.groupBy(*partials.MONTH).count().collect()
            written.append((len(counts), sum(r["count"] for r in counts)))
        write_table(df, to, *args, **kwargs)

    monkeypatch.setattr(queries, "write_table", recorded)
    for name, whole in (("g8_incremental", "g8_executive_overview"), ("g12_incremental", "g12_customer_ltv")):
        written.clear()
        found = rows(QUERIES[name](spark, path))
        assert found and found == rows(QUERIES[whole](spark, path))
        assert len(written) > 3 and all(n <= 5 or months == 1 for months, n in written)
