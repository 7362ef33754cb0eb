"""One query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderlake.functions import date_key, stock_status, surrogate_key
from larderlake.operators import audit, governance, scd
from larderlake.operators.dedup import dedup
from larderlake.operators.governance import Viewer
from larderlake.operators.metrics import Widget
from larderlake.operators.quality import (
    apply_rules,
    expect,
    expect_or_drop,
    expect_or_fail,
    scorecard,
    violations,
)
from larderlake.plans import dashboards, dims, facts, marts, partials, schemas, silver
from larderlake.plans.policies import POLICIES
from larderlake.plans.rules import RULES
from larderlake.plans.silver import accepted
from larderlake.session import configure
from larderlake.sources import (
    decode_json_value,
    infer_csv_schema,
    layer_path,
    read_csv_stream,
    read_layer,
    read_table_stream,
    register_bronze,
    replace_table,
    scratch_dir,
    unwrap_json,
    with_lineage,
    write_table,
)
from larderlake.sources import drift
from larderlake.streaming import (
    ChangeSpec,
    apply_changes_stream,
    checkpoint_dir,
    read_accepted,
    read_counts,
    read_history,
    read_late,
    read_minutes,
    read_quarantined,
    run_available_now,
    run_checked,
    run_minutes,
    stream_static_join,
    summed,
)
from larderlake.workload import inputs
from larderlake.workload.inputs import ENV, raw, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Columns stamped with the clock; they differ from run to run.
VOLATILE = ("silver_ingestion_time", "gold_loaded_at", "ingestion_time")


def result(df: DataFrame, *rounded: str) -> DataFrame:
    """Comparable output: no clock columns, timestamps without zone, sums of money in cents."""
    df = df.drop(*VOLATILE)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in rounded:
            c = F.round(c, 2).alias(f.name)
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def query(fn: Query) -> Query:
    """Register a query under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# --- the star schema over the inputs ------------------------------------------------------------


def star(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Dimensions by name. The store lookup for facts needs no region columns."""
    build = {
        "date": lambda: dims.dim_date(inputs.calendar(spark, sf_dir)),
        "region": lambda: dims.dim_region(inputs.regions(spark, sf_dir)),
        "store": lambda: dims.stores_keyed(inputs.stores(spark, sf_dir)),
        "customer": lambda: dims.dim_customer(inputs.customers(spark, sf_dir)),
        "product": lambda: dims.dim_product(inputs.products(spark, sf_dir)),
    }
    return {n: accepted(build[n](), f"dim_{n}") for n in names}


def full_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dims.dim_store(inputs.stores(spark, sf_dir), inputs.regions(spark, sf_dir))
    return accepted(rows, "dim_store")


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales lines with their amounts, no keys."""
    lines, products = inputs.transactions(spark, sf_dir), inputs.products(spark, sf_dir)
    return accepted(facts.sales_measures(lines, products), "fact_sales")


def sales(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """Sales facts with the keys of the named dimensions."""
    # The dimension comes straight from the products here, so where it is joined it gives the prices too.
    products = None if "product" in names else inputs.products(spark, sf_dir)
    rows = facts.fact_sales(inputs.transactions(spark, sf_dir), products, star(spark, sf_dir, *names))
    return accepted(rows, "fact_sales")


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = star(spark, sf_dir, "store", "product")
    return marts.inventory_alerts(inputs.inventory(spark, sf_dir), d["store"], d["product"])


def per_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = star(spark, sf_dir, "store")["store"]
    return marts.orders_per_minute(inputs.orders(spark, sf_dir), store)


def regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.regional_sales(sales(spark, sf_dir, "store"), full_store(spark, sf_dir))


# --- sources and sinks ---------------------------------------------------------------------------


def _csv_landing(spark: SparkSession, sf_dir: str, name: str, label: str) -> str:
    """An input written as headered CSV, as a feed would deliver it."""
    path = scratch_dir(spark, label)
    raw(spark, sf_dir, name).drop("ingestion_time", "source_file").write.option(
        "header", True
    ).csv(path)
    return path


@query
def s1_csv_stream(spark, sf_dir):
    """CSV files through an inferred, pinned schema into a bronze table, exactly once."""
    landing = _csv_landing(spark, sf_dir, "r_transactions", "landing")
    target = scratch_dir(spark, "bronze")
    stream = read_csv_stream(spark, landing, infer_csv_schema(spark, landing))
    bronze = with_lineage(stream, "transactions")
    run_available_now(bronze, f"{target}/t", checkpoint_dir(target, ENV, "bronze_transactions"))
    return result(spark.read.parquet(f"{target}/t").drop("source_file"))


@query
def s1_csv_drift(spark, sf_dir):
    """Deliveries whose columns are reordered, added, left out and misfit, read by name."""
    root = scratch_dir(spark, "drift")
    raw(spark, sf_dir, "r_transactions").drop("ingestion_time", "source_file").write.parquet(f"{root}/feed")
    feed = spark.read.parquet(f"{root}/feed")
    part = F.pmod(F.col("quantity").cast("int"), F.lit(3))
    odd = F.when(F.col("product_id") % 5 == 0, F.concat(F.lit("x"), "customer_id"))
    deliveries = [
        feed.filter(part == 0),
        feed.filter(part == 1).withColumn("customer_id", F.coalesce(odd, "customer_id")).select(*feed.columns[::-1]),
        feed.filter(part == 2).withColumn("promo", F.concat(F.lit("p"), "store_id")).drop("stock_date"),
    ]
    schema = T.StructType.fromDDL(
        "transaction_date string, stock_date string, product_id int, customer_id int, store_id int, quantity int"
    )
    for i, delivery in enumerate(deliveries):
        delivery.write.option("header", True).csv(f"{root}/landing/{i}")
        checkpoint = checkpoint_dir(root, ENV, "drift")
        drift.ingest_csv_by_name(spark, f"{root}/landing/*", f"{root}/t", checkpoint, schema)
    return drift.read_drifted(spark, f"{root}/t")


@query
def s2_found_types(spark, sf_dir):
    """Deliveries without a declared schema: columns turn long, double and text, a new one is a date."""
    root = scratch_dir(spark, "found")
    lines = raw(spark, sf_dir, "r_transactions").select("product_id", "customer_id", "store_id", "quantity")
    lines.write.parquet(f"{root}/feed")
    feed = spark.read.parquet(f"{root}/feed")
    part = F.pmod(F.col("product_id").cast("int"), F.lit(3))
    deliveries = [
        feed.filter(part == 0),
        feed.filter(part == 1)
        .withColumn("customer_id", (F.col("customer_id").cast("long") + 3_000_000_000).cast("string"))
        .withColumn("quantity", F.concat("quantity", F.lit(".5"))),
        feed.filter(part == 2)
        .withColumn("store_id", F.concat(F.lit("S"), "store_id"))
        .withColumn("arrived", F.concat(F.lit("2024-01-"), F.lpad((F.col("product_id") % 28 + 1).cast("int").cast("string"), 2, "0"))),
    ]
    for i, delivery in enumerate(deliveries):
        delivery.write.option("header", True).csv(f"{root}/landing/{i}")
        checkpoint = checkpoint_dir(root, ENV, "found")
        drift.ingest_csv_found(spark, f"{root}/landing/*", f"{root}/t", checkpoint, f"{root}/types")
    return drift.read_found(spark, f"{root}/t", f"{root}/types").drop(drift.RESCUED)


@query
def s3_lineage(spark, sf_dir):
    """Lineage columns of a file source: base name of the file and dataset, per file."""
    rows = with_lineage(table(spark, sf_dir, "lineitem"), "transactions")
    name = F.regexp_extract("source_file", "([^/]+)$", 1).alias("file_name")
    stamped = F.count_if(F.col("ingestion_time").isNotNull()).alias("stamped_rows")
    return rows.groupBy(name, "source_name").agg(stamped)


@query
def s6_json_value_decode(spark, sf_dir):
    """Message bytes back to typed columns."""
    events = raw(spark, sf_dir, "r_order_events")
    messages = events.select(F.to_json(F.struct(*events.columns)).cast("binary").alias("value"))
    return result(decode_json_value(messages, schemas.ORDER_MESSAGE))


@query
def s7_table_stream(spark, sf_dir):
    """A stored table streamed into the next layer."""
    target = scratch_dir(spark, "table")
    raw(spark, sf_dir, "r_products").drop("ingestion_time").write.parquet(f"{target}/export")
    stream = read_table_stream(spark, f"{target}/export")
    bronze = with_lineage(stream, "products", files=False)
    run_available_now(bronze, f"{target}/t", checkpoint_dir(target, ENV, "bronze_products"))
    return result(spark.read.parquet(f"{target}/t"))


@query
def s11_partitioned_sink(spark, sf_dir):
    """The sales table written partitioned and clustered, then read back by month."""
    path = scratch_dir(spark, "sink")
    layout = schemas.PARTITIONS["fact_sales"], schemas.CLUSTERING["fact_sales"]
    write_table(measures(spark, sf_dir), path, *layout)
    by_month = spark.read.parquet(path).groupBy("transaction_year", "transaction_month")
    return result(
        by_month.agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue")), "revenue"
    )


@query
def s12_interleaved_sink(spark, sf_dir):
    """The sales table sorted by interleaved ranks of its four cluster columns, filtered by two of them."""
    path, stored = scratch_dir(spark, "interleaved"), scratch_dir(spark, "sales")
    measures(spark, sf_dir).write.parquet(stored)
    write_table(spark.read.parquet(stored), path, cluster_by=schemas.CLUSTERING["fact_sales"], interleave=True)
    some = spark.read.parquet(path).filter((F.col("store_id") == 3) | (F.col("product_id") < 20))
    groups = some.groupBy("store_id", "product_id")
    return result(groups.agg(F.count(F.lit(1)).alias("lines"), F.sum("revenue").alias("revenue")), "revenue")


# --- silver ---------------------------------------------------------------------------------------


@query
def v1_transactions(spark, sf_dir):
    return result(inputs.transactions(spark, sf_dir))


@query
def v2_returns(spark, sf_dir):
    return result(inputs.returns(spark, sf_dir))


@query
def v3_stores(spark, sf_dir):
    rows = silver.cleanse_stores(raw(spark, sf_dir, "r_stores"), ENV)
    return result(accepted(rows, "stores"))


@query
def v4_regions(spark, sf_dir):
    return result(inputs.regions(spark, sf_dir))


@query
def v5_calendar(spark, sf_dir):
    return result(inputs.calendar(spark, sf_dir))


def _documents(rows: DataFrame) -> DataFrame:
    """Rows as exported documents: one JSON text and the arrival time."""
    payload = [c for c in rows.columns if c != "ingestion_time"]
    return rows.select(F.to_json(F.struct(*payload)).alias("data"), "ingestion_time")


@query
def v6_customers(spark, sf_dir):
    """Customer documents parsed from JSON text."""
    rows = silver.parse_customers(_documents(raw(spark, sf_dir, "r_customers")), ENV)
    return result(accepted(rows, "customers"))


@query
def v7_products(spark, sf_dir):
    """Product documents parsed from JSON text."""
    rows = silver.parse_products(_documents(raw(spark, sf_dir, "r_products")), ENV)
    return result(accepted(rows, "products"))


@query
def v8_unwrap_json(spark, sf_dir):
    """Nested and flat deliveries of the same documents end in the same columns."""
    flat = raw(spark, sf_dir, "r_products")
    schema = schemas.PRODUCT_DOCUMENT
    nested = unwrap_json(_documents(flat), "product_id", schema)
    same = unwrap_json(flat, "product_id", schema)
    cols = ["product_id", "product_sku", "product_cost", "low_fat"]
    tag = F.lit
    return nested.select(tag("nested").alias("delivery"), *cols).unionByName(
        same.select(tag("flat").alias("delivery"), *cols)
    )


@query
def v9_orders_enriched(spark, sf_dir):
    return result(inputs.orders(spark, sf_dir))


@query
def v10_inventory_status(spark, sf_dir):
    return result(inputs.inventory(spark, sf_dir))


# --- quality --------------------------------------------------------------------------------------

_LINE_RULES = RULES["transactions"]


def _lines(spark, sf_dir):
    return silver.cleanse_transactions(raw(spark, sf_dir, "r_transactions"), ENV).drop("source_file")


def _conditions(action: str) -> dict[str, str]:
    return {r.name: r.condition for r in _LINE_RULES.having(action)}


@query
def e1_expect_warn(spark, sf_dir):
    """Warned rows stay."""
    kept = expect(_lines(spark, sf_dir), _conditions("warn"))
    late = F.count_if(F.col("stock_date") > F.col("transaction_date"))
    return kept.groupBy("transaction_year").agg(
        F.count(F.lit(1)).alias("lines"), late.alias("late_stock")
    )


@query
def e2_expect_drop(spark, sf_dir):
    """Violating rows go."""
    kept = expect_or_drop(_lines(spark, sf_dir), _conditions("drop"))
    return kept.groupBy("transaction_year").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units")
    )


@query
def e3_expect_fail_pass(spark, sf_dir):
    """A fail rule that holds lets every row through."""
    rows = silver.cleanse_regions(raw(spark, sf_dir, "r_regions"), ENV)
    checked = {r.name: r.condition for r in RULES["regions"].having("fail")}
    return result(expect_or_fail(rows, checked))


@query
def e4_rule_scorecard(spark, sf_dir):
    """Passes and failures of each rule, and the number of rows that break each combination."""
    return scorecard(_lines(spark, sf_dir), _LINE_RULES)


@query
def e4_rules_applied(spark, sf_dir):
    """Enforced and counted in one pass."""
    kept, _ = apply_rules(_lines(spark, sf_dir), _LINE_RULES)
    return kept.groupBy("store_id").agg(F.count(F.lit(1)).alias("lines"))


@query
def e4_observed_counts(spark, sf_dir):
    """What a batch observes while its accepted rows are written: total, kept, violations per rule."""
    kept, seen = apply_rules(_lines(spark, sf_dir), _LINE_RULES)
    write_table(kept, f"{scratch_dir(spark, 'observed')}/lines", ["transaction_year"])
    return spark.createDataFrame(list(seen.get.items()), "metric string, value bigint")


@query
def e5_violations(spark, sf_dir):
    """Quarantined rows by the rules they break."""
    broken = violations(_lines(spark, sf_dir), _LINE_RULES)
    names = F.array_join("violated_rules", ",").alias("violated_rules")
    return broken.groupBy(names).agg(F.count(F.lit(1)).alias("lines"))


# --- change application ---------------------------------------------------------------------------

_FEED = {"keys": ["customer_id"], "sequence_by": "seq", "track": ["member_card"]}


@query
def scd2_history(spark, sf_dir):
    return scd.scd2_history(raw(spark, sf_dir, "r_customer_feed"), **_FEED)


@query
def scd2_hot_keys(spark, sf_dir):
    """The same history with every busy key's timeline cut into stretches."""
    return scd.scd2_history(raw(spark, sf_dir, "r_customer_feed"), **_FEED, hot_rows=5)


@query
def scd2_current(spark, sf_dir):
    history = scd.scd2_history(raw(spark, sf_dir, "r_customer_feed"), **_FEED)
    return scd.scd2_snapshot(history, "customer_id", "member_card", "education")


def _apply_twice(spark, sf_dir, name: str, spec: ChangeSpec) -> DataFrame:
    """A feed in two deliveries, the second holding rows older than some of the first."""
    root = scratch_dir(spark, "scd")
    feed = raw(spark, sf_dir, name)
    late = F.col("seq") % 4 == 0
    for delivery in (feed.filter(~late), feed.filter(late)):
        delivery.write.mode("append").parquet(f"{root}/landing")
        stream = read_table_stream(spark, f"{root}/landing", feed.schema)
        apply_changes_stream(stream, f"{root}/t", checkpoint_dir(root, ENV, "feed"), spec)
    return read_history(spark, f"{root}/t")


@query
def scd2_incremental(spark, sf_dir):
    """Late rows arriving in a second batch give the history of the whole feed."""
    return _apply_twice(spark, sf_dir, "r_customer_feed", ChangeSpec(**_FEED, buckets=4))


#: What the earlier delivery of a feed had in place of today's values.
_EARLIER = {
    "stores": {"total_sqft": "total_sqft - 1000"},
    "customers": {"member_card": "'Starter'"},
    "products": {"product_cost": "product_cost * 2"},
}


def _deliveries(spark, sf_dir, name: str) -> DataFrame:
    """Two deliveries of a cleansed feed, with ties and rows without sequence.

    The second changes every fifth key and sends every seventh again as it was. Every tenth comes
    twice at first, told apart by ``environment``; every eleventh also comes without sequence.
    """
    (key,), seq = schemas.KEYS[name], schemas.SEQUENCE
    rows = inputs.feed(spark, sf_dir, name).drop(*VOLATILE)
    at = lambda text: F.lit(text).cast("timestamp")
    changed = F.col(key) % 5 == 0
    earlier = {c: F.when(changed, F.expr(e)).otherwise(F.col(c)) for c, e in _EARLIER[name].items()}
    first = rows.withColumns(earlier).withColumn(seq, at(inputs.FIRST))
    ties = rows.filter(F.col(key) % 10 == 0).withColumn(seq, at(inputs.FIRST))
    second = rows.filter(changed | (F.col(key) % 7 == 0)).withColumn(seq, at(inputs.SECOND))
    unsequenced = rows.filter(F.col(key) % 11 == 0).withColumn(seq, F.lit(None).cast("timestamp"))
    return reduce(
        DataFrame.unionByName,
        [first, ties.withColumn("environment", F.lit("a tie")), second, unsequenced],
    )


def _real_history(spark, sf_dir, name: str) -> DataFrame:
    feed = _deliveries(spark, sf_dir, name)
    history = scd.scd2_history(
        feed, schemas.KEYS[name], schemas.SEQUENCE, schemas.TRACKED[name], order=["environment"], hot_rows=2
    )
    return result(history)


@query
def scd2_stores(spark, sf_dir):
    return _real_history(spark, sf_dir, "stores")


@query
def scd2_customers(spark, sf_dir):
    return _real_history(spark, sf_dir, "customers")


@query
def scd2_products(spark, sf_dir):
    return _real_history(spark, sf_dir, "products")


@query
def scd1_latest(spark, sf_dir):
    return scd.scd1_latest(raw(spark, sf_dir, "r_region_feed"), ["region_id"], "seq")


@query
def scd1_incremental(spark, sf_dir):
    spec = ChangeSpec(["region_id"], "seq", buckets=4)
    return _apply_twice(spark, sf_dir, "r_region_feed", spec)


# --- dimensions and facts -------------------------------------------------------------------------


@query
def g1_dim_date(spark, sf_dir):
    return result(star(spark, sf_dir, "date")["date"])


@query
def g2_dim_region(spark, sf_dir):
    return result(star(spark, sf_dir, "region")["region"])


@query
def g3_dim_store(spark, sf_dir):
    return result(full_store(spark, sf_dir))


@query
def g4_dim_customer(spark, sf_dir):
    return result(star(spark, sf_dir, "customer")["customer"])


@query
def g5_dim_product(spark, sf_dir):
    return result(star(spark, sf_dir, "product")["product"])


@query
def g6_fact_sales(spark, sf_dir):
    return result(sales(spark, sf_dir, "product", "customer", "store", "date"))


@query
def g7_fact_returns(spark, sf_dir):
    d = star(spark, sf_dir, "product", "store", "date")
    lines, products = inputs.returns(spark, sf_dir), inputs.products(spark, sf_dir)
    return result(accepted(facts.fact_returns(lines, products, d), "fact_returns"))


@query
def k1_surrogate_key(spark, sf_dir):
    """Keys over several columns, NULLs among them."""
    rows = raw(spark, sf_dir, "r_customers")
    key = surrogate_key("k", "customer_id", "last_name", "email_address")
    return rows.select("customer_id", key.alias("sk"))


@query
def k2_dedup(spark, sf_dir):
    """One row per key of a feed with many rows each; the smallest survives."""
    return dedup(raw(spark, sf_dir, "r_customer_feed"), ["customer_id"])


# --- marts ----------------------------------------------------------------------------------------


@query
def g8_executive_overview(spark, sf_dir):
    mart = marts.executive_overview(measures(spark, sf_dir))
    return result(mart, "total_revenue", "total_profit")


@query
def g9_inventory_alerts(spark, sf_dir):
    return result(alerts(spark, sf_dir))


@query
def g10_orders_per_minute(spark, sf_dir):
    return result(per_minute(spark, sf_dir))


@query
def g11_regional_sales(spark, sf_dir):
    return result(regional(spark, sf_dir), "total_store_revenue")


@query
def g12_customer_ltv(spark, sf_dir):
    customer = star(spark, sf_dir, "customer")["customer"]
    mart = marts.customer_ltv(sales(spark, sf_dir, "customer"), customer)
    return result(mart, "lifetime_revenue", "lifetime_profit")


@query
def g13_store_space(spark, sf_dir):
    mart = marts.store_space(sales(spark, sf_dir, "store"), full_store(spark, sf_dir))
    return result(mart, "total_revenue", "total_profit")


def _delivered_late(spark, sf_dir):
    """Partial sums of sales after a second delivery, of lines of one year for every fifth store."""
    root = scratch_dir(spark, "gold")
    late = (F.col("store_id") % 5 == 0) & (F.col("transaction_year") == 1995)

    def stored(table: str, rows: DataFrame, *by) -> DataFrame:
        write_table(rows, f"{root}/{table}", *by)
        return spark.read.parquet(f"{root}/{table}")

    lines = stored("transactions", inputs.transactions(spark, sf_dir), partials.MONTH)
    found = inputs.products(spark, sf_dir).select("product_id", "product_retail_price", "product_cost", scd.START, scd.END)
    products = stored("products", found)
    dimensions = star(spark, sf_dir, "store", "customer").items()
    keys = {name: stored(f"dim_{name}", d.select(f"{name}_id", f"{name}_sk")) for name, d in dimensions}
    layout = schemas.PARTITIONS["fact_sales"], schemas.CLUSTERING["fact_sales"]

    def store(rows: DataFrame) -> None:
        for months in partials.spans(rows):
            some = rows.filter(partials.in_months(months))
            built = accepted(facts.fact_sales(some, products, keys), "fact_sales")
            write_table(built, f"{root}/fact_sales", *layout, touched_partitions_only=True, hashes=schemas.HASHES)
            fact = spark.read.parquet(f"{root}/fact_sales")
            partials.refresh_partials(spark, fact, f"{root}/sums", months)

    store(lines.filter(~late))
    touched = partials.touched_months(lines.filter(late))
    store(lines.filter(partials.in_months(touched)))
    return f"{root}/sums"


@query
def g8_incremental(spark, sf_dir):
    """The overview after late lines, their months alone summed anew."""
    found = partials.executive_overview(spark, _delivered_late(spark, sf_dir))
    return result(found, "total_revenue", "total_profit", "profit_margin_pct")


@query
def g12_incremental(spark, sf_dir):
    """Lifetime values after late lines, merged from the partial sums of all months."""
    sums = _delivered_late(spark, sf_dir)
    customer = star(spark, sf_dir, "customer")["customer"]
    return result(partials.customer_ltv(spark, sums, customer))


# --- dashboards -----------------------------------------------------------------------------------


def _orders(spark, sf_dir):
    return dashboards.orders_view(inputs.orders(spark, sf_dir))


def _inventory(spark, sf_dir):
    return dashboards.inventory_view(inputs.inventory(spark, sf_dir))


def _regional(spark, sf_dir):
    return dashboards.regional_facts(regional(spark, sf_dir))


def _with_stores(spark, sf_dir):
    region = star(spark, sf_dir, "region")["region"]
    return dashboards.sales_with_stores(regional(spark, sf_dir), full_store(spark, sf_dir), region)


#: The widgets over order events.
_ORDER_WIDGETS = {
    "total": Widget((), ("count", "total_quantity")),
    "by_city": Widget(("store_state", "store_city"), ("count",)),
    "by_hour": Widget(("event_hour",), ("count", "total_quantity")),
    "large_by_city": Widget(("store_city",), ("count", "total_quantity"), "quantity >= 4"),
    "large": Widget((), ("count",), "quantity >= 4"),
}


@query
def d2_widgets(spark, sf_dir):
    """All widgets over order events in one pass."""
    return result(_orders(spark, sf_dir).queries(_ORDER_WIDGETS))


@query
def t3_ordered(spark, sf_dir):
    """The order that a view is asked for, as places."""
    by = {"count": "desc", "store_state": "asc", "store_city": "asc"}
    ordered = _orders(spark, sf_dir).query(["store_state", "store_city"], ["count"], order_by=by)
    # The number of a row tells its place in the result; the window only makes places of numbers.
    numbered = ordered.withColumn("at", F.monotonically_increasing_id())
    return numbered.withColumn("place", F.row_number().over(Window.orderBy("at"))).drop("at")


@query
def d1_alert_details(spark, sf_dir):
    d = star(spark, sf_dir, "store", "product")
    view = dashboards.alert_details(alerts(spark, sf_dir), d["product"], d["store"])
    return result(view.rows(dashboards.ALERT_FIELDS))


@query
def d1_alert_count(spark, sf_dir):
    d = star(spark, sf_dir, "store", "product")
    view = dashboards.alert_details(alerts(spark, sf_dir), d["product"], d["store"])
    return view.query([], ["count"])


@query
def d2_orders_source(spark, sf_dir):
    rows = dashboards.orders_source(inputs.orders(spark, sf_dir), per_minute(spark, sf_dir))
    return result(rows)


@query
def d2a_total_orders(spark, sf_dir):
    return _orders(spark, sf_dir).query([], ["count"])


@query
def d2b_orders_rate(spark, sf_dir):
    return result(_orders(spark, sf_dir).query([], ["orders_per_minute"]))


@query
def d2c_qty_latest(spark, sf_dir):
    return result(_orders(spark, sf_dir).query([], ["total_quantity", "latest_event"]))


@query
def d2d_orders_by_minute(spark, sf_dir):
    return result(_orders(spark, sf_dir).query(["event_minute"], ["count"]))


@query
def d2e_orders_by_city(spark, sf_dir):
    by = {"count": "desc"}
    return _orders(spark, sf_dir).query(["store_state", "store_city"], ["count"], order_by=by)


@query
def d2f_orders_by_hour(spark, sf_dir):
    return result(_orders(spark, sf_dir).query(["event_hour"], ["count", "total_quantity"]))


@query
def d3_inventory_measures(spark, sf_dir):
    return result(_inventory(spark, sf_dir).query([], ["count", "avg_stock_level"]))


@query
def d3a_low_stock(spark, sf_dir):
    where = "stock_status IN ('LOW', 'OUT_OF_STOCK')"
    return _inventory(spark, sf_dir).query([], ["count"], where=where)


@query
def d3b_out_of_stock(spark, sf_dir):
    return _inventory(spark, sf_dir).query([], ["count"], where="stock_status IN ('OUT_OF_STOCK')")


@query
def d3c_by_status(spark, sf_dir):
    view = _inventory(spark, sf_dir)
    return view.query(["stock_status"], ["count"], order_by={"count": "desc"})


@query
def d4_month_date(spark, sf_dir):
    fields = ["store_id", "month_date", "total_store_revenue", "total_items_sold"]
    return result(_regional(spark, sf_dir).rows(fields), "total_store_revenue")


@query
def d4a_totals(spark, sf_dir):
    view = _regional(spark, sf_dir)
    return result(
        view.query([], ["total_store_revenue", "total_items_sold"]), "total_store_revenue"
    )


@query
def d4b_monthly_trend(spark, sf_dir):
    trend = _regional(spark, sf_dir).query(["month_date"], ["total_store_revenue"])
    return result(trend, "total_store_revenue")


@query
def d5_sales_with_stores(spark, sf_dir):
    return result(_with_stores(spark, sf_dir).source, "total_store_revenue")


@query
def d5a_revenue_by_store(spark, sf_dir):
    by = {"total_store_revenue": "desc"}
    view = _with_stores(spark, sf_dir)
    return result(
        view.query(["store_name"], ["total_store_revenue"], order_by=by), "total_store_revenue"
    )


@query
def d5b_region_district(spark, sf_dir):
    view = _with_stores(spark, sf_dir)
    dims_ = ["sales_district", "sales_region"]
    return result(view.query(dims_, ["total_store_revenue"]), "total_store_revenue")


@query
def d5c_store_performance(spark, sf_dir):
    place = ["store_name", "store_city", "store_state", "sales_region", "sales_district"]
    measures = ["total_store_revenue", "total_items_sold"]
    return result(_with_stores(spark, sf_dir).query(place, measures), "total_store_revenue")


# --- governance -----------------------------------------------------------------------------------

_ANALYST, _ADMIN = Viewer.of("user_0", "analysts"), Viewer.of("root", "admins")


def _read(df, name, spark, sf_dir, viewer):
    grants = raw(spark, sf_dir, "user_region_map")
    return governance.secure_read(df, name, POLICIES, grants, viewer)


@query
def r1_row_filter(spark, sf_dir):
    """Stores by region as three viewers see them: one with grants, one without, an admin."""
    grants = raw(spark, sf_dir, "user_region_map")
    store = full_store(spark, sf_dir).select("store_id", "sales_region")
    parts = [
        governance.row_filter(store, "sales_region", grants, viewer).select(
            F.lit(viewer.user).alias("viewer"), "*"
        )
        for viewer in (_ANALYST, Viewer.of("user_none"), _ADMIN)
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def r3_mask_customer(spark, sf_dir):
    customer = star(spark, sf_dir, "customer")["customer"]
    return result(_read(customer, "dim_customer", spark, sf_dir, _ANALYST))


@query
def r5_mask_store(spark, sf_dir):
    return result(_read(full_store(spark, sf_dir), "dim_store", spark, sf_dir, _ANALYST))


@query
def r5_mask_ltv(spark, sf_dir):
    customer = star(spark, sf_dir, "customer")["customer"]
    mart = marts.customer_ltv(sales(spark, sf_dir, "customer"), customer)
    masked = _read(mart, "agg_customer_ltv", spark, sf_dir, _ANALYST)
    return result(masked, "lifetime_revenue", "lifetime_profit")


@query
def r6_secure_regional(spark, sf_dir):
    """What an analyst's dashboard shows of the regional mart."""
    mart = _read(regional(spark, sf_dir), "agg_regional_sales", spark, sf_dir, _ANALYST)
    by_region = dashboards.regional_facts(mart).query(
        ["sales_region", "month_date"], ["total_store_revenue", "total_items_sold"]
    )
    return result(by_region, "total_store_revenue")


@query
def r2_user_regions(spark, sf_dir):
    """Grants replaced by newer ones, read back from the store."""
    path = f"{scratch_dir(spark, 'grants')}/user_region_map"
    mapping = raw(spark, sf_dir, "user_region_map")
    replace_table(mapping.withColumn("assigned_region", F.lit("outdated")), path)
    replace_table(mapping, path)
    return spark.read.parquet(path)


@query
def udf_sql_functions(spark, sf_dir):
    """SQL functions of a viewer's session: a row filter that asks the grants, and two masks."""
    governance.register_functions(spark, raw(spark, sf_dir, "user_region_map"), _ANALYST)
    stores = full_store(spark, sf_dir).select("store_id", "sales_region", "store_name", "first_opened_date")
    return spark.sql(
        """SELECT store_id, sales_region, mask_pii_string(store_name) AS store_name,
                  mask_pii_date(first_opened_date) AS first_opened_date
           FROM {stores} WHERE region_filter(sales_region)""",
        stores=stores,
    )


@query
def s4_bronze_factory(spark, sf_dir):
    """A stream per dataset with its lineage, from one call; files and documents alike."""
    root = scratch_dir(spark, "factory")
    paths = {n: _csv_landing(spark, sf_dir, f"r_{f}", f"landing-{n}") for n, f in (("return", "returns"), ("regions", "regions"))}
    paths["products"] = f"{root}/documents"
    raw(spark, sf_dir, "r_products").drop("ingestion_time").write.parquet(paths["products"])
    parts = []
    for name, stream in register_bronze(spark, paths, pins=f"{root}/pins").items():
        run_available_now(stream, f"{root}/{name}", checkpoint_dir(root, ENV, name))
        stored = spark.read.parquet(f"{root}/{name}")
        origin = "source_name" if "source_name" in stored.columns else "source"
        parts.append(
            stored.groupBy(F.col(origin).alias("dataset")).agg(
                F.lit(name).alias("bronze_table"),
                F.count("*").alias("lines"),
                F.count("ingestion_time").alias("stamped"),
                F.lit(origin == "source_name").alias("from_files"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def s14_replace(spark, sf_dir):
    """A table replaced as a whole by fewer rows."""
    path = f"{scratch_dir(spark, 'replace')}/nations"
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    replace_table(nations, path)
    replace_table(nations.filter("n_regionkey <> 0"), path)
    return spark.read.parquet(path)


@query
def s9_layer_read(spark, sf_dir):
    """A table of another layer, as it stands, by layer and name."""
    root = scratch_dir(spark, "lake")
    write_table(inputs.transactions(spark, sf_dir), layer_path(root, "silver", "transactions"))
    stored = read_layer(spark, root, "silver", "transactions")
    units = F.sum("quantity").alias("units")
    return stored.groupBy("store_id").agg(F.count("*").alias("lines"), units)


@query
def x5_replay(spark, sf_dir):
    """A stream run again without new files adds nothing; new files are added once."""
    rows = raw(spark, sf_dir, "r_returns").drop("ingestion_time", "source_file")
    later = F.pmod(F.xxhash64("product_id", "store_id"), F.lit(3)) == 0
    landing, target = scratch_dir(spark, "landing"), scratch_dir(spark, "bronze")
    rows.filter(~later).write.option("header", True).csv(landing)
    schema = infer_csv_schema(spark, landing)
    checkpoint = checkpoint_dir(target, ENV, "bronze_return")
    for delivery in range(4):
        if delivery == 2:
            rows.filter(later).write.mode("append").option("header", True).csv(landing)
        run_available_now(read_csv_stream(spark, landing, schema), f"{target}/t", checkpoint)
    stored = spark.read.parquet(f"{target}/t")
    return stored.groupBy("store_id").agg(F.count("*").alias("lines"))


# --- audit ----------------------------------------------------------------------------------------

_RUN = audit.AuditRun("run-1")
_LAYERS = {"bronze": True, "silver": True, "gold": True, "quality": True, "export": False}


@query
def a1_latest_update(spark, sf_dir):
    newest = audit.latest_update(inputs.pipeline_events(spark, sf_dir))
    return newest.select("layer", "update_id", "created")


@query
def a2_timing_status(spark, sf_dir):
    timing = audit.timing_status(inputs.pipeline_events(spark, sf_dir))
    return timing.select("layer", "update_id", "start_ts", "end_ts", "duration_s", "status")


@query
def a3_flow_metrics(spark, sf_dir):
    return result(audit.flow_metrics(inputs.pipeline_events(spark, sf_dir), _RUN))


@query
def a4_dq_rows(spark, sf_dir):
    return result(audit.dq_rows(inputs.pipeline_events(spark, sf_dir), _RUN))


@query
def a5_errors(spark, sf_dir):
    return result(audit.error_rows(inputs.pipeline_events(spark, sf_dir), _RUN))


@query
def a6_summary(spark, sf_dir):
    """Closing entry, layer summaries and idle layers, without their times of writing."""
    path = scratch_dir(spark, "audit")
    entries = audit.extract(inputs.pipeline_events(spark, sf_dir), _LAYERS, _RUN)
    audit.write_audit(entries, f"{path}/audit_logs", _RUN, list(_LAYERS))
    stages = ["pipeline_summary", "pipeline_config", "pipeline_update", "job_complete"]
    stored = audit.read_run(spark, f"{path}/audit_logs", _RUN)
    return stored.filter(F.col("stage").isin(stages)).drop("timestamp")


@query
def a8_audit_errors(spark, sf_dir):
    """A layer whose events hold a number that is none: one error entry instead of wrong ones."""
    events = inputs.pipeline_events(spark, sf_dir)
    odd = F.replace("details", F.lit('"num_output_rows":'), F.lit('"num_output_rows":"many","was":'))
    bent = events.withColumn("details", F.when(F.col("layer") == "gold", odd).otherwise(F.col("details")))
    entries = audit.extract(bent, _LAYERS, _RUN).filter("layer = 'gold' OR status = 'AUDIT_ERROR'")
    return entries.select("layer", "stage", "level", "status", "error")


@query
def a7_audit_append(spark, sf_dir):
    """Entries stored, then counted per layer from the store."""
    path = scratch_dir(spark, "audit")
    entries = audit.extract(inputs.pipeline_events(spark, sf_dir), _LAYERS, _RUN)
    return audit.write_audit(entries, f"{path}/audit_logs", _RUN)


# --- scalar functions -----------------------------------------------------------------------------


@query
def f1_date_functions(spark, sf_dir):
    day, at = F.to_date("o_orderdate"), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        date_key(day).alias("date_key"),
        F.date_format(day, "yyyyMMdd").cast("int").alias("formatted_key"),
        F.quarter(day).alias("quarter"),
        F.dayofweek(day).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.make_date(F.year(day), F.month(day), F.lit(1)).alias("month_date"),
        F.date_trunc("hour", at).cast("timestamp_ntz").alias("hour"),
    )


@query
def f2_casts(spark, sf_dir):
    """Tolerant casts of text that is not always a number or a date."""
    text = F.when(F.col("l_linenumber") == 3, F.lit("x")).otherwise(
        F.col("l_quantity").cast("int").cast("string")
    )
    day = F.when(F.col("l_linenumber") == 2, F.lit("13/32/2020")).otherwise(F.lit("2/29/2024"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        text.try_cast("int").alias("as_int"),
        text.try_cast("double").alias("as_double"),
        F.try_to_date(day, "M/d/yyyy").alias("as_date"),
        (F.col("l_linenumber") % 2).cast("boolean").alias("as_flag"),
        F.col("l_linenumber").cast("string").alias("as_text"),
    )


@query
def f3_strings_hash(spark, sf_dir):
    rows = raw(spark, sf_dir, "r_customers")
    return rows.select(
        "customer_id",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        F.concat_ws(" ", "last_name", "email_address").alias("both_may_be_null"),
        F.md5("customer_address").alias("address_hash"),
        F.col("customer_acct_num").contains("7").alias("has_seven"),
        F.substring("customer_address", 1, 6).alias("cut"),
    )


@query
def f4_json(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    parsed = F.from_json("props", "k int, missing string")
    return rows.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("long").alias("by_path"),
        parsed["k"].alias("by_schema"),
        parsed["missing"].alias("missing"),
        F.from_json(F.concat(F.lit("{"), "props"), "k int")["k"].alias("malformed"),
    )


@query
def f5_conditionals(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    level = F.col("l_quantity").cast("int") - 1
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        stock_status(level).alias("band"),
        F.col("l_returnflag").isin("A", "R").alias("flagged"),
        F.nullif(F.col("l_linenumber"), F.lit(1)).alias("not_first"),
        F.try_divide(F.lit(10.0), level).alias("share"),
        F.coalesce(F.nullif(F.col("l_linestatus"), F.lit("O")), F.lit("open")).alias("state"),
    )


# --- streaming ------------------------------------------------------------------------------------


@query
def x1_stream_cleanse(spark, sf_dir):
    """CSV files to the accepted silver table, both steps as streams."""
    landing = _csv_landing(spark, sf_dir, "r_returns", "landing")
    root = scratch_dir(spark, "silver")
    bronze = with_lineage(read_csv_stream(spark, landing, infer_csv_schema(spark, landing)), "return")
    run_available_now(bronze, f"{root}/bronze", checkpoint_dir(root, ENV, "bronze_return"))
    rows = silver.cleanse_returns(read_table_stream(spark, f"{root}/bronze"), ENV)
    kept, _ = apply_rules(rows, RULES["returns"])
    run_available_now(
        kept, f"{root}/silver", checkpoint_dir(root, ENV, "returns"), ["return_year"]
    )
    return result(spark.read.parquet(f"{root}/silver").drop("bronze_ingestion_time"))


#: Batches of a stream whose counts are added up; Spark by itself remembers the last hundred reports.
MANY_BATCHES = 101
#: Lines of a file that a stream is fed with, about; one task writes such a file and one reads it.
FILE_LINES = 200_000


def _files_a_batch(spark, sf_dir, batches: int) -> int:
    """How many files a batch has where the sales lines come in so many batches."""
    return 1 + table(spark, sf_dir, "lineitem").count() // (batches * FILE_LINES)


@query
def x6_stream_counts(spark, sf_dir):
    """What rules found in a stream of many batches, from the counts stored with each batch."""
    root = scratch_dir(spark, "counted")
    files = _files_a_batch(spark, sf_dir, MANY_BATCHES)
    raw(spark, sf_dir, "r_transactions").repartition(MANY_BATCHES * files).write.parquet(f"{root}/bronze")
    stream = read_table_stream(spark, f"{root}/bronze", max_files=files)
    lines = silver.cleanse_transactions(stream, ENV).drop("source_file")
    run_checked(lines, _LINE_RULES, f"{root}/silver", checkpoint_dir(root, ENV, "transactions"))
    found = summed(read_counts(spark, f"{root}/silver/counts"))
    return found.select("label", "metric", "value", (F.col("batches") > 100).alias("over_100_batches"))


@query
def e6_stream_quarantine(spark, sf_dir):
    """A stream split by verdict in one pass: accepted and quarantined lines by the rules they break."""
    root = scratch_dir(spark, "checked")
    files = _files_a_batch(spark, sf_dir, 3)
    raw(spark, sf_dir, "r_transactions").repartition(3 * files, "product_id").write.parquet(f"{root}/bronze")
    stream = read_table_stream(spark, f"{root}/bronze", max_files=files)
    lines = silver.cleanse_transactions(stream, ENV).drop("source_file")
    target = f"{root}/silver"
    run_checked(lines, _LINE_RULES, target, checkpoint_dir(root, ENV, "transactions"), ["transaction_year"])
    kept = read_accepted(spark, target).select(F.lit("accepted").alias("verdict"), F.lit("").alias("rules"), "quantity")
    names = F.array_join(F.array_sort("violated_rules"), ",").alias("rules")
    out = read_quarantined(spark, target).select(F.lit("quarantined").alias("verdict"), names, "quantity")
    return kept.unionByName(out).groupBy("verdict", "rules").agg(
        F.count("*").alias("lines"), F.sum("quantity").alias("units")
    )


@query
def x7_minute_stream(spark, sf_dir):
    """Orders per store and minute from a stream in four deliveries, and the orders that came too late."""
    root = scratch_dir(spark, "minutes")
    orders = silver.normalise_orders(raw(spark, sf_dir, "r_order_events")).filter("quantity > 0")
    # Ten days a delivery; some orders come with the next one.
    day = F.dayofmonth("event_timestamp")
    due = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2) + (F.col("order_id") % 17 == 0).cast("int")
    for delivery in range(4):
        orders.filter(due == delivery).write.mode("append").parquet(f"{root}/bronze")
        run_minutes(read_table_stream(spark, f"{root}/bronze"), f"{root}/gold", f"{root}/checkpoints")
    late = read_late(spark, f"{root}/gold").groupBy("store_id").agg(
        F.lit(None).cast("timestamp").alias("order_minute"),
        F.count("order_id").alias("orders_per_minute"),
        F.sum("quantity").alias("total_quantity_per_minute"),
    )
    both = read_minutes(spark, f"{root}/gold").withColumn("late", F.lit(False))
    return result(both.unionByName(late.withColumn("late", F.lit(True))))


@query
def j2_stream_static(spark, sf_dir):
    """Order events joined to the store versions current when the batch runs."""
    root = scratch_dir(spark, "orders")
    raw(spark, sf_dir, "r_order_events").write.parquet(f"{root}/bronze")
    stores = inputs.stores(spark, sf_dir)
    stores.write.parquet(f"{root}/stores")
    stream_static_join(
        silver.normalise_orders(read_table_stream(spark, f"{root}/bronze")),
        lambda: spark.read.parquet(f"{root}/stores"),
        lambda batch, static: accepted(silver.enrich_orders(batch, static, ENV), "orders"),
        f"{root}/silver",
        checkpoint_dir(root, ENV, "orders"),
    )
    return result(spark.read.parquet(f"{root}/silver").drop("batch_id"))
