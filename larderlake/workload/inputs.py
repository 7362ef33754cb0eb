"""Retail-shaped inputs derived from the test tables.

The SQL texts run on Spark and on DuckDB, so a query and its check start from the same rows. Some
rows are bent on purpose: missing keys, zero quantities, orphans, NULL names, unknown values.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlake.operators.scd import END, START
from larderlake.plans import silver

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

ENV = "test"
#: Arrival of the first and second delivery of master data.
FIRST, SECOND = "2023-06-01 00:00:00", "2024-01-01 00:00:00"


def _text_date(col: str) -> str:
    return f"concat(month({col}), '/', day({col}), '/', year({col}))"


#: The json path expression differs by engine; everything else is common.
JSON_K = {"spark": "get_json_object(props, '$.k')", "duckdb": "json_extract_string(props, '$.k')"}

_ARRIVED = f"cast('{FIRST}' as timestamp) as ingestion_time"

SQL: dict[str, str] = {
    # Sales lines as text. Some lines have no customer, some a zero quantity.
    "r_transactions": f"""
        select {_text_date('o_orderdate')} as transaction_date,
               {_text_date('l_shipdate')} as stock_date,
               cast(l_partkey as string) as product_id,
               case when l_orderkey % 77 = 0 then null else cast(o_custkey as string) end
                   as customer_id,
               cast(l_suppkey as string) as store_id,
               case when l_orderkey % 50 = 0 then '0'
                    else cast(cast(l_quantity as int) as string) end as quantity,
               {_ARRIVED}, 'landing/transactions.csv' as source_file
        from {{lineitem}} join {{orders}} on l_orderkey = o_orderkey""",
    "r_returns": f"""
        select {_text_date('l_shipdate')} as return_date,
               cast(l_partkey as string) as product_id,
               case when l_orderkey % 61 = 0 then null else cast(l_suppkey as string) end
                   as store_id,
               cast(cast(l_quantity as int) as string) as quantity, {_ARRIVED}
        from {{lineitem}} where l_returnflag = 'R'""",
    "r_calendar": f"""
        select date, {_ARRIVED}
        from (select distinct {_text_date('o_orderdate')} as date from {{orders}}) days""",
    # Every 97th product is unknown to the catalogue, every 101st has no price yet.
    "r_products": f"""
        select cast(p_partkey as int) as product_id, p_brand as product_brand,
               p_name as product_name, 1000000000 + p_partkey as product_sku,
               case when p_partkey % 101 = 0 then 0.0 else p_retailprice end
                   as product_retail_price,
               round(p_retailprice * 0.6137, 2) as product_cost,
               cast(p_size as double) as product_weight, p_size % 2 as recyclable,
               case when p_size % 3 = 0 then 1 else 0 end as low_fat, {_ARRIVED}
        from {{part}} where p_partkey % 97 <> 0""",
    "r_stores": f"""
        select cast(s_suppkey as string) as store_id, cast(s_nationkey as string) as region_id,
               case s_suppkey % 4 when 0 then 'Supermarket' when 1 then 'Deluxe'
                    when 2 then 'Small' else 'Mid-Size' end as store_type,
               s_name as store_name, concat('Street ', s_suppkey) as store_street_address,
               concat('City ', s_nationkey % 7) as store_city,
               concat('State ', s_nationkey % 3) as store_state,
               concat('Country ', s_nationkey) as store_country,
               case when s_nationkey % 13 = 0 then null else concat('555-', s_suppkey) end
                   as store_phone,
               concat(1 + s_suppkey % 12, '/', 1 + s_suppkey % 28, '/', 1980 + s_suppkey % 20)
                   as first_opened_date,
               concat(1 + s_suppkey % 12, '/', 1 + s_suppkey % 28, '/', 2000 + s_suppkey % 20)
                   as last_remodel_date,
               cast(20000 + 100 * s_nationkey as string) as total_sqft,
               cast(12000 + 50 * s_nationkey as string) as grocery_sqft, {_ARRIVED}
        from {{supplier}}""",
    # The last nation has no region row, so its stores are orphans.
    "r_regions": f"""
        select cast(n_nationkey as string) as region_id, n_name as sales_district,
               r_name as sales_region, {_ARRIVED}
        from {{nation}} join {{region}} on n_regionkey = r_regionkey
        where n_nationkey < 24""",
    "r_customers": f"""
        select cast(c_custkey as int) as customer_id, concat('A-', c_custkey) as customer_acct_num,
               'Customer' as first_name,
               case when c_custkey % 11 = 0 then null else concat('No', c_custkey) end as last_name,
               case when c_custkey % 17 = 0 then null
                    else concat('c', c_custkey, '@example.test') end as email_address,
               concat('Road ', c_custkey) as customer_address,
               concat('City ', c_nationkey % 7) as customer_city,
               concat('State ', c_nationkey % 3) as customer_state_province,
               cast(10000 + c_custkey as string) as customer_postal_code,
               concat('Country ', c_nationkey) as customer_country,
               concat(1 + c_custkey % 12, '/', 1 + c_custkey % 28, '/', 1950 + c_custkey % 50)
                   as birthdate,
               case when c_custkey % 2 = 0 then 'S' else 'M' end as marital_status,
               concat('$', 10 * (c_custkey % 9), 'K') as yearly_income,
               case c_custkey % 5 when 0 then 'M' when 1 then 'F' when 2 then 'M' when 3 then 'F'
                    else 'X' end as gender,
               cast(c_custkey % 5 as int) as total_children,
               cast(c_custkey % 3 as int) as num_children_at_home,
               case when c_custkey % 3 = 0 then 'Bachelors' else 'High School' end as education,
               concat(1 + c_custkey % 12, '/', 1 + c_custkey % 28, '/', 2000 + c_custkey % 20)
                   as acct_open_date,
               c_mktsegment as member_card, 'Professional' as occupation,
               case when c_custkey % 2 = 0 then 'Y' else 'N' end as homeowner, {_ARRIVED}
        from {{customer}}""",
    "r_order_events": """
        select cast(ts as string) as event_time, cast(event_id as int) as order_id,
               cast(event_id % 200 as int) as product_id, cast(user_id as int) as store_id,
               cast(user_id as int) as customer_id, cast(event_id % 6 as int) as quantity
        from {events} where event_type = 'purchase'""",
    "r_inventory_events": """
        select cast(event_id as int) as event_id, cast(ts as string) as event_time,
               cast(event_id % 200 as int) as product_id, cast(user_id as int) as store_id,
               cast(@K as int) - 2 as stock_level,
               case event_type when 'purchase' then 'SALE' when 'signup' then 'RESTOCK'
                    when 'click' then 'ADJUSTMENT' when 'view' then 'RETURN'
                    else 'UNKNOWN' end as event_type
        from {events}""",
    # Change feeds: one row per order, in the order of day and order number.
    "r_customer_feed": """
        select cast(o_custkey as int) as customer_id,
               cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)
                    as bigint) * 1000000 + o_orderkey as seq,
               case when o_orderkey % 19 = 0 then null else o_orderstatus end as member_card,
               o_orderpriority as education
        from {orders}""",
    "r_region_feed": """
        select cast(o_custkey % 25 as int) as region_id,
               cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate)
                    as bigint) * 1000000 + o_orderkey as seq,
               o_orderpriority as sales_region, o_orderstatus as sales_district
        from {orders}""",
    # Run events of the layers: one update per day, as many events as the table has.
    "r_pipeline_events": """
        select case user_id % 4 when 0 then 'bronze' when 1 then 'silver' when 2 then 'gold'
                    else 'archive' end as layer,
               ts as timestamp,
               case event_type when 'signup' then 'create_update'
                    when 'purchase' then 'update_progress' else 'flow_progress' end as event_type,
               concat('u-', cast(cast(ts as date) as string)) as update_id,
               case event_type
                    when 'signup' then '{{"create_update":{{}}}}'
                    when 'purchase' then concat('{{"update_progress":{{"state":"',
                         case event_id % 4 when 0 then 'RUNNING' when 1 then 'COMPLETED'
                              when 2 then 'FAILED' else 'CANCELED' end, '"}}}}')
                    when 'view' then concat('{{"flow_progress":{{"flow_name":"table_',
                         event_id % 9, '","status":"RUNNING"}}}}')
                    when 'error' then concat('{{"flow_progress":{{"flow_name":"table_',
                         event_id % 9, '","status":"FAILED","error":"code ', event_id, '"}}}}')
                    else concat('{{"flow_progress":{{"flow_name":"table_', event_id % 9,
                         '","status":"COMPLETED","metrics":{{"num_output_rows":', @K,
                         '}},"data_quality":{{"dropped_records":', event_id % 3,
                         ',"expectations":[{{"name":"rule_', event_id % 5,
                         '","passed_records":', @K, '}}]}}}}}}')
               end as details
        from {events}""",
    # Grants, some of them given twice.
    "user_region_map": """
        select concat('user_', r_regionkey) as user_id, r_name as assigned_region from {region}
        union all
        select concat('user_', r_regionkey), r_name from {region} where r_regionkey % 2 = 0
        union all
        select 'user_0', r_name from {region} where r_regionkey = 3""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the inputs above as a DataFrame."""
    text = SQL[name].replace("@K", JSON_K["spark"])
    used = {t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text}
    return spark.sql(text, **used)


# --- silver tables as the gold layer finds them -------------------------------------------------


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.cleanse_transactions(raw(spark, sf_dir, "r_transactions"), ENV)
    return silver.accepted(rows, "transactions")


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.accepted(silver.cleanse_returns(raw(spark, sf_dir, "r_returns"), ENV), "returns")


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.enrich_calendar(raw(spark, sf_dir, "r_calendar"), ENV)
    return silver.accepted(rows, "calendar")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.accepted(silver.cleanse_regions(raw(spark, sf_dir, "r_regions"), ENV), "regions")


def _history(rows: DataFrame, key: str, earlier: dict) -> DataFrame:
    """Rows as a version history: every fifth key has an earlier version with other values."""
    first, second = F.lit(FIRST).cast("timestamp"), F.lit(SECOND).cast("timestamp")
    changed = F.col(key) % 5 == 0
    now = rows.withColumns(
        {START: F.when(changed, second).otherwise(first), END: F.lit(None).cast("timestamp")}
    )
    before = rows.filter(changed).withColumns({**earlier, START: first, END: second})
    return now.unionByName(before)


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Cleansed and accepted rows of stores, customers or products, one a key."""
    cleanse = {
        "stores": silver.cleanse_stores,
        "customers": silver.parse_customers,
        "products": silver.parse_products,
    }[name]
    return silver.accepted(cleanse(raw(spark, sf_dir, f"r_{name}"), ENV), name)


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = {"total_sqft": F.col("total_sqft") - 1000}
    return _history(feed(spark, sf_dir, "stores"), "store_id", earlier)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = {"member_card": F.lit("Starter")}
    return _history(feed(spark, sf_dir, "customers"), "customer_id", earlier)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier = {"product_retail_price": F.col("product_retail_price") * 0.9}
    return _history(feed(spark, sf_dir, "products"), "product_id", earlier)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.cleanse_orders(
        raw(spark, sf_dir, "r_order_events"), stores(spark, sf_dir), ENV
    )
    return silver.accepted(rows, "orders")


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = silver.cleanse_inventory(raw(spark, sf_dir, "r_inventory_events"), ENV)
    return silver.accepted(rows, "inventory")


def pipeline_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw(spark, sf_dir, "r_pipeline_events")
    return rows.select(
        "layer", "timestamp", "event_type", F.struct("update_id").alias("origin"), "details"
    )
