"""Orders per store and minute as a stream: late rows are set aside, minutes are counted once closed.

Two steps, each exactly once and each resuming from its own checkpoint:

``split``   a batch's rows are on time unless they lie further back than ``lateness`` behind the
            newest event of all earlier batches. Both kinds are stored, and the batch's newest event
            with them, in partitions that are the batch's own.
``count``   a stream over the rows on time: a watermark of the same lateness, tumbling minutes,
            sums in the state store. A minute is appended to its table when the watermark has passed
            its end, and its state goes.

The second step takes whole batches of the first, so its watermark is never ahead of the mark that
a row was judged by, and no row on time is lost to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larderlake.streaming.counts import BATCH, read_counts, write_counts, write_own
from larderlake.streaming.runs import run_available_now, run_batches

EVENT, LATE = "event_timestamp", "_late"
_MARK = "newest_event_us"


def split_late(orders: DataFrame, path: str, checkpoint: str, lateness: str = "10 minutes") -> StreamingQuery:
    """Store what has arrived under ``path``, late rows apart."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = read_counts(spark, f"{path}/marks").filter(F.col(BATCH) < batch_id)
        newest = marks.agg(F.max("value")).first()[0]
        # A row without a time belongs to no minute; it is late for all of them.
        late = F.col(EVENT).isNull()
        if newest is not None:
            late = late | (F.col(EVENT) < F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {lateness}"))
        write_own(batch.withColumn(LATE, late.cast("int")), f"{path}/rows", batch_id, LATE)
        stored = spark.read.parquet(f"{path}/rows").filter(F.col(BATCH) == batch_id)
        mark = stored.agg(F.unix_micros(F.max(EVENT))).first()[0]
        if mark is not None:
            write_counts(spark, f"{path}/marks", batch_id, "", _MARK, {_MARK: mark})

    return run_batches(orders, handle, checkpoint)


def count_minutes(spark: SparkSession, path: str, checkpoint: str, lateness: str = "10 minutes") -> StreamingQuery:
    """Append the minutes that have closed to ``path``/minutes; open ones wait in the state store."""
    stored = spark.read.parquet(f"{path}/rows")
    stream = spark.readStream.schema(stored.schema).parquet(f"{path}/rows").filter(F.col(LATE) == 0)
    minutes = (
        stream.withWatermark(EVENT, lateness)
        .groupBy("store_id", F.window(EVENT, "1 minute").alias("minute"))
        .agg(F.count("order_id").alias("orders_per_minute"), F.sum("quantity").alias("total_quantity_per_minute"))
    )
    closed = minutes.select(
        "store_id", F.col("minute.start").alias("order_minute"), "orders_per_minute", "total_quantity_per_minute"
    )
    return run_available_now(closed, f"{path}/minutes", checkpoint)


def run_minutes(orders: DataFrame, path: str, checkpoint: str, lateness: str = "10 minutes") -> None:
    """Both steps over what has arrived."""
    split_late(orders, path, f"{checkpoint}/split", lateness)
    count_minutes(orders.sparkSession, path, f"{checkpoint}/count", lateness)


def read_minutes(spark: SparkSession, path: str) -> DataFrame:
    """Closed minutes: store, minute, orders and units."""
    return spark.read.parquet(f"{path}/minutes")


def read_late(spark: SparkSession, path: str) -> DataFrame:
    """Rows that came too late to be counted."""
    return spark.read.parquet(f"{path}/rows").filter(F.col(LATE) == 1).drop(LATE, BATCH)
