"""Triggered runs: exactly once, current static sides, quality counts, and a whole refresh."""

import json

from larderlake.operators.audit import AuditRun, collect_entries, write_audit
from larderlake.operators.quality import apply_rules
from larderlake.plans import refresh, schemas, silver
from larderlake.plans.rules import RULES
from larderlake.sources import (
    decode_json_value,
    infer_csv_schema,
    layer_path,
    read_csv_stream,
    read_layer,
    read_table_stream,
    with_lineage,
)
from larderlake.streaming import (
    checkpoint_dir,
    quality_metrics,
    read_history,
    run_available_now,
    stream_static_join,
)
from tests.conftest import rows


def drop_file(folder, name, text):
    import os

    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text)


def test_each_file_is_read_once(spark, path):
    drop_file(f"{path}/in", "a.csv", "region_id,sales_region\n1,West\n2,East\n")

    def run():
        stream = read_csv_stream(spark, f"{path}/in", infer_csv_schema(spark, f"{path}/in"))
        check = checkpoint_dir(path, "test", "regions")
        run_available_now(with_lineage(stream, "regions"), f"{path}/out", check)
        return spark.read.parquet(f"{path}/out")

    assert run().count() == 2
    assert run().count() == 2  # nothing new
    drop_file(f"{path}/in", "b.csv", "region_id,sales_region\n3,North\n")
    again = run()
    assert sorted(r.region_id for r in again.collect()) == [1, 2, 3]
    assert {r.source_file.rsplit("/", 1)[1] for r in again.collect()} == {"a.csv", "b.csv"}


def test_environments_have_their_own_checkpoints():
    assert checkpoint_dir("/r/", "dev", "t") != checkpoint_dir("/r", "prod", "t")


def test_stream_counts_violations(spark, path):
    drop_file(
        f"{path}/in", "a.csv", "return_date,product_id,store_id,quantity\n1/2/2024,1,1,5\n1/3/2024,1,,5\n1/4/2024,2,1,0\n"
    )
    stream = with_lineage(
        read_csv_stream(spark, f"{path}/in", infer_csv_schema(spark, f"{path}/in")), "return"
    )
    kept, _ = apply_rules(silver.cleanse_returns(stream, "t"), RULES["returns"])
    query = run_available_now(kept, f"{path}/out", f"{path}/check")
    counts = quality_metrics(query, "quality_returns")
    assert counts["total_rows"] == 3 and counts["kept_rows"] == 1
    assert counts["valid_return_store"] == 1 and counts["valid_return_quantity"] == 1
    assert spark.read.parquet(f"{path}/out").count() == 1


def test_static_side_is_read_anew(spark, path):
    def orders(first, n):
        ids = range(first, first + n)
        df = spark.createDataFrame([(i, 1) for i in ids], "order_id int, store_id int")
        df.write.mode("append").parquet(f"{path}/orders")

    def stores(city):
        df = spark.createDataFrame([(1, city)], "store_id int, store_city string")
        df.write.mode("overwrite").parquet(f"{path}/stores")

    def run():
        stream_static_join(
            read_table_stream(spark, f"{path}/orders"),
            lambda: spark.read.parquet(f"{path}/stores"),
            lambda batch, static: batch.join(static, "store_id", "left"),
            f"{path}/out",
            f"{path}/check",
        )
        return {r.order_id: r.store_city for r in spark.read.parquet(f"{path}/out").collect()}

    orders(0, 2)
    stores("Old")
    assert run() == {0: "Old", 1: "Old"}
    stores("New")
    orders(2, 1)
    assert run() == {0: "Old", 1: "Old", 2: "New"}


def _landing(spark, root):
    drop_file(f"{root}/transactions", "1.csv",
              "transaction_date,stock_date,product_id,customer_id,store_id,quantity\n"
              "3/9/2024,3/1/2024,1,1,1,2\n3/10/2024,3/1/2024,2,1,2,1\n3/11/2023,3/1/2023,1,2,1,0\n")
    drop_file(f"{root}/return", "1.csv",
              "return_date,product_id,store_id,quantity\n3/20/2024,1,1,1\n")
    drop_file(f"{root}/calendar", "1.csv", "date\n3/9/2024\n3/10/2024\n3/20/2024\n")
    drop_file(f"{root}/regions", "1.csv", "region_id,sales_district,sales_region\n1,North,West\n")
    drop_file(f"{root}/stores", "1.csv",
              "store_id,region_id,store_type,store_name,store_street_address,store_city,store_state,"
              "store_country,store_phone,first_opened_date,last_remodel_date,total_sqft,grocery_sqft\n"
              "1,1,Deluxe,One,Street,City,State,Land,555,1/1/1990,1/1/2000,1000,500\n"
              "2,1,Deluxe,Two,Street,City,State,Land,,1/1/1990,1/1/2000,2000,500\n")
    docs = {
        "customers": [json.dumps({"customer_id": i, "first_name": "F", "gender": "F", "customer_country": "N",
                                  "birthdate": "1/1/1990", "acct_open_date": "1/1/2010"}) for i in (1, 2)],
        "products": [json.dumps({"product_id": i, "product_retail_price": 10.0 * i, "product_cost": 4.0 * i,
                                 "recyclable": 1, "low_fat": 0}) for i in (1, 2)],
    }
    for name, texts in docs.items():
        spark.createDataFrame([(t,) for t in texts], "data string").write.parquet(f"{root}/{name}")
    messages = {
        "orders": ['{"event_time":"2024-03-09 10:00:05","order_id":1,"product_id":1,"store_id":1,"customer_id":1,"quantity":2}',
                   '{"event_time":"2024-03-09 10:00:25","order_id":2,"product_id":1,"store_id":7,"customer_id":1,"quantity":2}'],
        "inventory": ['{"event_id":1,"event_time":"2024-03-09 10:00:00","product_id":1,"store_id":1,"stock_level":3,"event_type":"SALE"}',
                      '{"event_id":2,"event_time":"2024-03-09 10:00:00","product_id":1,"store_id":1,"stock_level":-3,"event_type":"SALE"}'],
    }
    for name, texts in messages.items():
        values = spark.createDataFrame([(bytearray(t.encode()),) for t in texts], "value binary")
        values.write.parquet(f"{root}/{name}")


SILVER = ("stores", "regions", "customers", "products", "transactions", "returns", "calendar", "inventory", "orders")


def test_whole_refresh(spark, path):
    land, root = f"{path}/landing", f"{path}/lake"
    _landing(spark, land)
    csv = ("transactions", "return", "calendar", "regions", "stores", "customers", "products")
    paths = {n: f"{land}/{n}" for n in csv}

    def run(years=None):
        messages = {
            f"bronze_{n}_kafka": decode_json_value(read_table_stream(spark, f"{land}/{n}"), ddl)
            for n, ddl in (("orders", schemas.ORDER_MESSAGE), ("inventory", schemas.INVENTORY_MESSAGE))
        }
        refresh.refresh_bronze(spark, root, "test", paths, messages)
        refresh.refresh_silver(spark, root, "test", SILVER, buckets=2, hot_rows=None)
        refresh.refresh_gold(spark, root, years)

    def gold(table):
        return read_layer(spark, root, "gold", table)

    run()
    (sales,) = rows(gold("agg_executive_overview"))
    assert (sales["total_revenue"], sales["total_profit"]) == (40.0, 24.0)
    assert gold("fact_sales").filter("store_sk IS NULL OR date_sk IS NULL").count() == 0
    assert gold("fact_returns").first().return_revenue == 10.0
    assert {r.sales_region for r in gold("agg_regional_sales").collect()} == {"West"}
    assert gold("agg_ops_inventory_alerts").first().lowest_stock_level == 3
    assert gold("agg_ops_orders_per_minute").count() == 2  # store 7 is unknown
    city = {r.order_id: r.store_city for r in read_layer(spark, root, "silver", "orders").collect()}
    assert city == {1: "City", 2: None}

    run_ = AuditRun("r1", "shop")
    sources = {n: (lambda n=n: refresh.read_events(spark, root, n)) for n in ("bronze", "silver", "gold")}
    entries = collect_entries(spark, sources, run_)
    flows = {(r.layer, r.stage): r.row_count for r in entries.filter("status = 'SUCCESS'").collect()}
    assert flows["bronze", "flow_bronze_transactions"] == 3
    assert flows["silver", "flow_transactions"] == 2 and flows["gold", "flow_fact_sales"] == 2
    drops = {r.stage: r.row_count for r in entries.filter("status = 'DQ_DROP'").collect()}
    assert drops == {"dq_drop_transactions": 1, "dq_drop_inventory": 1}
    counts = {r.layer: r["count"] for r in write_audit(entries, f"{path}/audit", run_, list(sources)).collect()}
    assert set(counts) == {"bronze", "silver", "gold", "orchestration"}
    closing = spark.read.parquet(f"{path}/audit").filter("stage = 'job_complete'").first()
    assert closing.status == "COMPLETED"

    # A second run with a changed store, a new line, and one year to recompute.
    drop_file(f"{land}/stores", "2.csv",
              "store_id,region_id,store_type,store_name,store_street_address,store_city,store_state,"
              "store_country,store_phone,first_opened_date,last_remodel_date,total_sqft,grocery_sqft\n"
              "1,1,Deluxe,One,Street,City,State,Land,555,1/1/1990,1/1/2000,4000,500\n")
    drop_file(f"{land}/transactions", "2.csv",
              "transaction_date,stock_date,product_id,customer_id,store_id,quantity\n3/9/2024,3/1/2024,1,1,1,1\n")
    run(years=[2024])
    versions = read_history(spark, layer_path(root, "silver", "stores"))
    assert sorted(r.total_sqft for r in versions.filter("store_id = 1").collect()) == [1000, 4000]
    assert gold("dim_store").count() == 2
    assert gold("fact_sales").count() == 3
    (space,) = [r for r in rows(gold("agg_store_space_utilization")) if r["store_id"] == 1]
    assert space["total_sqft"] == 4000 and space["total_revenue"] == 30.0
