"""Files, messages and documents into typed columns."""

import json
import os

import pytest
from pyspark.sql import functions as F

from larderlake.functions import conform
from larderlake.plans import schemas, silver
from larderlake.sources import (
    decode_json_value,
    infer_csv_schema,
    kafka_options,
    pinned_csv_schema,
    register_bronze,
    unwrap_json,
    with_lineage,
)
from tests.conftest import day, rows, ts

ARRIVED = ts("2024-01-01 00:00:00")


def documents(spark, *texts):
    return spark.createDataFrame([(t, ARRIVED) for t in texts], "data string, ingestion_time timestamp")


def parsed(spark, schema, key, *texts):
    return [r.asDict() for r in unwrap_json(documents(spark, *texts), key, schema).collect()]


def customers(spark, *texts):
    return parsed(spark, schemas.CUSTOMER_DOCUMENT, "customer_id", *texts)


FULL = {
    "customer_id": 7,
    "customer_acct_num": "A-7",
    "first_name": "Ada",
    "last_name": "Example",
    "email_address": "ada@example.test",
    "customer_address": "1 Test Way",
    "customer_city": "Testville",
    "customer_state_province": "TS",
    "customer_postal_code": "00007",
    "customer_country": "Nowhere",
    "birthdate": "3/15/1990",
    "marital_status": "S",
    "yearly_income": "$70K - $90K",
    "gender": "F",
    "total_children": 2,
    "num_children_at_home": 1,
    "education": "Bachelors",
    "acct_open_date": "1/10/2015",
    "member_card": "Gold",
    "occupation": "Professional",
    "homeowner": "Y",
}


def test_customer_document_with_three_fields(spark):
    (row,) = customers(spark, '{"customer_id": 1, "email_address": "t@example.test", "gender": "M"}')
    assert (row["customer_id"], row["email_address"], row["gender"]) == (1, "t@example.test", "M")


def test_customer_document_with_every_field(spark):
    (row,) = customers(spark, json.dumps(FULL))
    del row["ingestion_time"]
    assert row == FULL


def test_product_document_types(spark):
    doc = {
        "product_id": 5,
        "product_brand": "B",
        "product_name": "N",
        "product_sku": 90748583674,
        "product_retail_price": 3.49,
        "product_cost": 1.4,
        "product_weight": 12.5,
        "recyclable": 1,
        "low_fat": 0,
    }
    (row,) = parsed(spark, schemas.PRODUCT_DOCUMENT, "product_id", json.dumps(doc))
    del row["ingestion_time"]
    assert row == doc


def test_malformed_document_is_all_null(spark):
    (row,) = customers(spark, '{"customer_id": 1, "email_address": ')
    assert row["customer_id"] is None and row["email_address"] is None


def test_missing_fields_are_null(spark):
    (row,) = customers(spark, '{"customer_id": 42}')
    assert row["customer_id"] == 42
    assert {row[k] for k in ("first_name", "gender", "total_children")} == {None}


def test_empty_text_is_not_null(spark):
    with_text, without = customers(
        spark, '{"customer_id": 1, "email_address": ""}', '{"customer_id": 2}'
    )
    assert with_text["email_address"] == "" and without["email_address"] is None


def test_several_documents(spark):
    found = customers(spark, *(json.dumps({"customer_id": i, "gender": "F"}) for i in range(3)))
    assert sorted(r["customer_id"] for r in found) == [0, 1, 2]


def test_flat_delivery_is_left_alone(spark):
    flat = spark.createDataFrame([(1, "{}")], "customer_id int, data string")
    assert unwrap_json(flat, "customer_id", schemas.CUSTOMER_DOCUMENT) is flat


def test_dates_without_padding(spark):
    df = spark.createDataFrame([("1/5/1990",), ("12/25/2000",), ("3/15/1985",)], "d string")
    found = {r.d for r in conform(df, "d date").collect()}
    assert found == {day("1990-01-05"), day("2000-12-25"), day("1985-03-15")}


def test_leap_day(spark):
    df = spark.createDataFrame([("2/29/2024",)], "d string")
    assert conform(df, "d date").first().d == day("2024-02-29")


def test_strict_date_raises(spark):
    df = spark.createDataFrame([("not-a-date",)], "d string")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP|could not be parsed"):
        conform(df, "d date").collect()


def test_tolerant_date_is_null(spark):
    df = spark.createDataFrame([("not-a-date",), ("",), ("13/32/2020",)], "d string")
    assert [r.d for r in conform(df, "d date", strict=False).collect()] == [None] * 3


TYPED = "i int, d double, l bigint, b boolean"


def test_valid_casts(spark):
    df = spark.createDataFrame([("1", "2.5", "9999999999", "true")], "i string, d string, l string, b string")
    assert conform(df, TYPED).first() == (1, 2.5, 9999999999, True)


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("abc",)], "i string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        conform(df, "i int").collect()


def test_tolerant_cast_is_null(spark):
    df = spark.createDataFrame([("abc", "xyz", "no", "?")], "i string, d string, l string, b string")
    assert conform(df, TYPED, strict=False).first() == (None, None, None, None)


def test_message_bytes_to_columns(spark):
    text = '{"event_time":"2024-01-01 10:00:00","order_id":1,"product_id":2,"store_id":3,"quantity":4}'
    df = spark.createDataFrame([(bytearray(text.encode()),)], "value binary")
    row = decode_json_value(df, schemas.ORDER_MESSAGE).first()
    assert (row.order_id, row.quantity, row.customer_id) == (1, 4, None)
    assert row.ingestion_time is not None


def test_message_options():
    found = kafka_options("host:9092", "orders", 'us"er', "pa\\ss", max_offsets=10)
    assert found["subscribe"] == "orders" and found["startingOffsets"] == "earliest"
    assert found["kafka.security.protocol"] == "SASL_SSL"
    assert found["kafka.sasl.mechanism"] == "PLAIN"
    assert found["maxOffsetsPerTrigger"] == "10"
    assert 'username="us\\"er" password="pa\\\\ss";' in found["kafka.sasl.jaas.config"]


def test_csv_schema_and_lineage(spark, path):
    with open(f"{path}/a.csv", "w") as f:
        f.write("region_id,sales_district,sales_region\n1,North,West\n")
    schema = infer_csv_schema(spark, path)
    assert schema.simpleString() == "struct<region_id:int,sales_district:string,sales_region:string>"
    row = with_lineage(spark.read.schema(schema).option("header", True).csv(path), "regions").first()
    assert row.source_file.endswith("/a.csv") and row.source_name == "regions"


def test_schema_is_inferred_once(spark, path):
    def drop(name, text):
        with open(f"{path}/in/{name}.csv", "w") as f:
            f.write("a,b\n" + text)

    os.makedirs(f"{path}/in")
    drop("one", "1,x\n")
    first = pinned_csv_schema(spark, f"{path}/in", f"{path}/pin")
    assert first.simpleString() == "struct<a:int,b:string>"
    drop("two", "text,y\n")
    assert pinned_csv_schema(spark, f"{path}/in", f"{path}/pin") == first
    assert infer_csv_schema(spark, f"{path}/in").simpleString() == "struct<a:string,b:string>"


def test_one_stream_per_dataset(spark, path):
    for name in ("regions", "stores"):
        (spark.range(1).write.option("header", True).csv(f"{path}/{name}"))
    spark.range(1).write.parquet(f"{path}/products")
    paths = {n: f"{path}/{n}" for n in ("regions", "stores", "products")}
    streams = register_bronze(spark, paths)
    assert set(streams) == {"bronze_regions", "bronze_stores", "bronze_products"}
    assert all(s.isStreaming for s in streams.values())
    assert "source_name" in streams["bronze_regions"].columns
    assert streams["bronze_products"].columns[-2:] == ["ingestion_time", "source"]


def test_silver_customers_from_documents(spark):
    df = silver.parse_customers(documents(spark, json.dumps(FULL)), "test")
    row = df.first()
    assert row.full_name == "Ada Example"
    assert (row.birthdate, row.acct_open_date) == (day("1990-03-15"), day("2015-01-10"))
    assert (row.bronze_ingestion_time, row.environment) == (ARRIVED, "test")
    assert len(df.columns) == 24


def test_silver_takes_dates_already_typed(spark):
    lines = spark.createDataFrame(
        [(day("2024-01-05"), 3, 4, 2)],
        "return_date date, product_id int, store_id int, quantity int",
    ).withColumn("ingestion_time", F.lit(ARRIVED))
    assert rows(silver.cleanse_returns(lines, "t"))[0]["return_date"] == day("2024-01-05")


def test_csv_files_are_read_by_their_own_headers(spark, path):
    from pyspark.sql import types as T

    from larderlake.sources import drift

    files = {"a": "k,v\n1,x\n2,y\n", "b": "v,k\nz,3\nbad,n/a\n", "c": "k,more\n4,new\n", "d": "k,v\n"}
    for name, text in files.items():
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(text)
    schema = T.StructType.fromDDL("k int, v string")
    found = drift.read_csv_by_name(spark, [f"{path}/{n}.csv" for n in files], schema)
    assert found.columns == ["k", "v", drift.RESCUED, "more"]
    assert {tuple(r) for r in found.collect()} == {
        (1, "x", None, None), (2, "y", None, None), (3, "z", None, None), (4, None, None, "new"),
        (None, "bad", '{"k":"n/a"}', None),
    }
    assert drift.read_csv_by_name(spark, [], schema).count() == 0


def _drop(path, files):
    for name, text in files.items():
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(text)
    return [f"{path}/{name}.csv" for name in files]


def test_headers_of_a_batch_are_read_by_one_job(spark, path):
    from larderlake.sources import drift

    files = _drop(path, {f"with blank {i}": f'k,"a, b",,k\n{i},x,y,z\n' for i in range(7)} | {"none": ""})
    spark.sparkContext.setJobGroup("headers", "")
    headers = drift._headers(spark, files)
    ran = spark.sparkContext.statusTracker().getJobIdsForGroup("headers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(headers) == [("k0", "a, b", "_c2", "k3")] and len(headers["k0", "a, b", "_c2", "k3"]) == 7
    assert len(ran) == 1
    found = drift.read_csv_by_name(spark, files, drift.StructType())
    assert {r["k0"] for r in found.collect()} == {str(i) for i in range(7)}


def test_types_widen_and_nothing_else_does(spark, path):
    from larderlake.sources import drift

    first = _drop(path, {"a": "i,l,d,t,z,b,e\n1,2,3,2024-01-01,007,true,\n,4,,,,,\n"})
    then = _drop(path, {"b": "new,i,l,d,t,z,e\nx,5,3000000000,0.25,2024-01-01 10:00:00,8,2.5\n"})
    last = _drop(path, {"c": "i,l,t\n99999999999999999999,1,soon\n"})

    def types(schema):
        return {f.name: f.dataType.simpleString() for f in schema}

    one = drift.widened_schema(spark, first)
    assert types(one) == {
        "i": "int", "l": "int", "d": "int", "t": "date", "z": "string", "b": "boolean", "e": "string"
    }
    two = drift.widened_schema(spark, then, one)
    assert types(two) == types(one) | {"l": "bigint", "d": "double", "t": "timestamp", "e": "double", "new": "string"}
    assert drift.widened_schema(spark, first, two) == two
    assert types(drift.widened_schema(spark, first + then)) == types(two)
    assert types(drift.widened_schema(spark, last, two)) == types(two) | {"i": "string", "t": "string"}


def test_files_without_a_declared_schema_are_added_once_and_lose_no_text(spark, path):
    import os

    from larderlake.sources import drift

    os.makedirs(f"{path}/in")
    where = (f"{path}/in", f"{path}/t", f"{path}/check", f"{path}/pin")
    _drop(where[0], {"a": "k,v\n1,2\n2,3\n3,odd\n"})
    for _ in range(2):
        drift.ingest_csv_found(spark, *where, lines=2)
    found = drift.read_found(spark, where[1], where[3])
    assert dict(found.dtypes) == {"k": "int", "v": "int", drift.RESCUED: "string"}
    assert {tuple(r) for r in found.collect()} == {(1, 2, None), (2, 3, None), (3, None, '{"v":"odd"}')}
    _drop(where[0], {"b": "v,k\nx,0042\n"})
    drift.ingest_csv_found(spark, *where, lines=2)
    assert len(drift.pinned_versions(spark, where[3])) == 2
    found = drift.read_found(spark, where[1], where[3])
    assert {tuple(r) for r in found.collect()} == {
        ("1", "2", None), ("2", "3", None), ("3", "odd", None), ("0042", "x", None)
    }


def test_every_interleaved_column_skips_row_groups(spark, path):
    import glob

    import pyarrow.parquet as pq

    from larderlake.sources import write_table

    n = 40_000
    cols = ["day", "store", "product", "name"]
    spark.range(n).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.xxhash64("id") % 300).cast("int")).alias("day"),
        F.when(F.col("id") % 3 > 0, (F.xxhash64("id", F.lit(1)) % 200).cast("int")).alias("store"),
        F.pow(F.rand(5), F.lit(3)).alias("product"),
        F.concat(F.lit("p"), F.lpad(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(500)).cast("string"), 3, "0")).alias("name"),
        F.col("id"),
    ).write.option("parquet.block.size", 4096).parquet(f"{path}/raw")
    raw_table = spark.read.parquet(f"{path}/raw")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        write_table(raw_table, f"{path}/t", cluster_by=cols, interleave=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    stored = spark.read.parquet(f"{path}/t")
    assert stored.columns == raw_table.columns
    assert stored.exceptAll(raw_table).isEmpty() and stored.count() == n
    groups = []
    for file in glob.glob(f"{path}/t/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        groups += [meta.row_group(i) for i in range(meta.num_row_groups)]
    assert len(groups) >= 16
    for at, name in enumerate(cols):
        value = raw_table.filter(F.col(name).isNotNull()).orderBy("id").first()[name]
        stats = [g.column(at).statistics for g in groups]
        hit = [s for s in stats if s is not None and s.has_min_max and s.min <= value <= s.max]
        assert len(hit) < 0.75 * len(groups), name


def test_only_the_lines_asked_for_go_to_python(spark, path):
    from larderlake.sources.drift import sampled_cells

    spark.range(50_000).selectExpr("id", "id * 2 AS twice").coalesce(1).write.option("header", True).csv(f"{path}/in")
    files = spark.read.csv(f"{path}/in").inputFiles()
    cells = sampled_cells(spark, files, 3)
    steps = cells._jdf.queryExecution().executedPlan().toString().split("MapInArrow", 1)[1]
    assert "<= 3)" in steps and "Filter" in steps
    found = sorted((r.line, r.name, r.value) for r in cells.collect())
    assert found == [(0, "id", None), (0, "twice", None)] + [
        (i + 1, name, str(v)) for i in range(3) for name, v in (("id", i), ("twice", 2 * i))
    ]


def test_a_delivery_is_stored_without_a_shuffle(spark, path, monkeypatch):
    from pyspark.sql.types import StructType

    from larderlake.sources import drift

    plans, write = [], drift.write_own

    def watched(rows, *at):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write(rows, *at)

    monkeypatch.setattr(drift, "write_own", watched)
    schema = StructType.fromDDL("a int, b string")
    for i in range(2):
        spark.createDataFrame([(i, "x")], "a int, b string").write.option("header", True).csv(f"{path}/in/{i}")
        drift.ingest_csv_by_name(spark, f"{path}/in/*", f"{path}/t", f"{path}/c", schema)
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)
    assert sorted(r.a for r in drift.read_drifted(spark, f"{path}/t").collect()) == [0, 1]
