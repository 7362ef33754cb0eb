"""Physical plans: what is shuffled, what is read, what reaches the scan; and the same results when
nothing may be broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from larderlake.operators.governance import Viewer, apply_masks
from larderlake.operators.quality import enforce
from larderlake.plans import facts, marts, schemas
from larderlake.plans.policies import POLICIES
from larderlake.plans.rules import RULES
from larderlake.sources import write_table
from larderlake.workload import inputs
from larderlake.workload.queries import QUERIES, full_store, star
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Silver and dimensions as stored tables."""
    root = str(tmp_path_factory.mktemp("lake"))
    stored = {
        "transactions": inputs.transactions(spark, SF),
        "products": inputs.products(spark, SF),
        **{f"dim_{n}": df for n, df in star(spark, SF, "product", "customer", "date").items()},
        "dim_store": full_store(spark, SF),
    }
    for name, df in stored.items():
        write_table(df, f"{root}/{name}", (), schemas.CLUSTERING.get(name, ()))
    tables = {name: spark.read.parquet(f"{root}/{name}") for name in stored}
    keyed = {n: tables[f"dim_{n}"] for n in ("product", "customer", "store", "date")}
    fact = facts.fact_sales(tables["transactions"], tables["products"], keyed)
    layout = schemas.PARTITIONS["fact_sales"], schemas.CLUSTERING["fact_sales"]
    write_table(fact, f"{root}/fact_sales", *layout)
    return tables | {"keyed": keyed, "fact_sales": spark.read.parquet(f"{root}/fact_sales"), "root": root}


def test_facts_are_built_without_a_shuffle(lake):
    text = plan(facts.fact_sales(lake["transactions"], lake["products"], lake["keyed"]))
    assert "Exchange hashpartitioning" not in text
    assert text.count("BroadcastHashJoin") == 5


def test_lookups_read_two_columns(lake):
    text = plan(facts.fact_sales(lake["transactions"], lake["products"], lake["keyed"]))
    assert "ReadSchema: struct<customer_sk:string,customer_id:int>" in text


def test_rules_reach_the_scan(lake):
    text = plan(enforce(lake["transactions"], RULES["transactions"]))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThan(quantity,0)" in pushed and "IsNotNull(customer_id)" in pushed


def test_overview_reads_the_columns_and_months_it_needs(lake):
    fact = lake["fact_sales"].filter("transaction_year = 1998")
    text = plan(marts.executive_overview(fact))
    assert "ReadSchema: struct<revenue:double,gross_profit:double>" in text
    assert re.search(r"PartitionFilters: \[.*transaction_year#\d+ = 1998", text)
    assert text.count("Exchange hashpartitioning") == 1


def test_marts_join_after_aggregating(lake):
    text = plan(marts.regional_sales(lake["fact_sales"], lake["dim_store"]))
    join, scan = text.index("Join ["), text.index("fact_sales")
    between = text[join:scan]
    assert "HashAggregate" in between  # the join's input is already one row per group
    assert "partial_sum" in between


def test_masked_columns_are_not_read(lake):
    masked = apply_masks(lake["dim_customer"], POLICIES["dim_customer"], Viewer.of("u"))
    schema = re.search(r"ReadSchema: (struct<.*?>)", plan(masked)).group(1)
    assert "email_address" not in schema and "first_name" not in schema and "birthdate" not in schema


def test_written_partitions_are_sorted_and_few(spark, lake):
    files = lake["fact_sales"].inputFiles()
    months = lake["fact_sales"].select("transaction_year", "transaction_month").distinct().count()
    assert len(files) == months
    one = spark.read.parquet(files[0]).select("transaction_date", "store_id")
    found = [tuple(r) for r in one.collect()]
    assert found == sorted(found)


@pytest.mark.parametrize("name", ["v1_transactions", "g6_fact_sales", "d5c_store_performance", "a3_flow_metrics"])
def test_scans_are_not_shuffled_for_more_tasks(spark, name):
    assert "REPARTITION_BY_NUM" not in plan(QUERIES[name](spark, SF))


@pytest.fixture
def no_broadcast(spark):
    """Shuffle joins only, with every partition above a few bytes treated as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1024",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4096",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_shuffle_joins_give_the_same_facts(spark, lake, no_broadcast):
    # A third of the lines on one product and one store.
    hot = F.pmod(F.xxhash64("customer_id", "quantity", "stock_date"), F.lit(3)) == 0
    lines = lake["transactions"].repartition(4).withColumns(
        {
            "product_id": F.when(hot, 1).otherwise(F.col("product_id")),
            "store_id": F.when(hot, 1).otherwise(F.col("store_id")),
        }
    )
    built = facts.fact_sales(lines, lake["products"], lake["keyed"]).drop("gold_loaded_at")
    assert "BroadcastHashJoin" not in plan(built)
    found = built.collect()
    assert "skew=true" in plan(built)  # the hot product and store were split
    assert len(found) == lines.count()
    by_store = rows(marts.regional_sales(built, lake["dim_store"]))
    units = lines.join(lake["dim_store"], "store_id").agg(F.sum("quantity")).first()[0]
    assert sum(r["total_items_sold"] for r in by_store) == units


@pytest.mark.parametrize("name", ["g6_fact_sales", "g9_inventory_alerts", "r6_secure_regional"])
def test_queries_do_not_depend_on_broadcasting(spark, name):
    expected = rows(QUERIES[name](spark, SF))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(QUERIES[name](spark, SF)) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_products_are_looked_up_once(spark):
    text = plan(QUERIES["g6_fact_sales"](spark, SF))
    joins = [line for line in text.splitlines() if "HashJoin" in line or "SortMergeJoin" in line]
    lookups = [line for line in joins if "LeftOuter" in line]
    assert len(lookups) == 4
