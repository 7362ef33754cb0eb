"""Change application as a stream: type-1 and type-2 targets kept up to date batch by batch.

All tables of a target are split into buckets of the key, so that a batch touches only its buckets.
A type-1 target is ``history``, its latest rows, replaced bucket by bucket. A type-2 target is

``log``     the feed rows behind the versions, one partition per bucket and batch
``open``    the open version of every key, as of the last batch that touched the bucket
``closed``  versions that have ended, in a partition of the batch that ended them; never rewritten
``voided``  which closed versions a late row made wrong; their successors are in later partitions

Rows newer than what their key has meet its open version alone: neither log nor closed versions are
read. Only for late rows does a batch read them, in its buckets and from the late time on.

A batch reads what earlier batches left and writes partitions of its own (of the open versions, the
one of two slots that does not hold the state it reads), so a batch that runs again after a failure
ends in the same state. ``rebuild`` derives the history anew from the log.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larderlake.operators.scd import (
    END,
    HOT_ROWS,
    START,
    scd1_latest,
    scd1_merge,
    scd2_history,
    unique_sequence,
)
from larderlake.streaming.runs import run_batches

BUCKET, BATCH = "__bucket", "__batch"
SLOT, AS_OF, VERSION = "__slot", "__as_of", "__version"
_INTERNAL = (BUCKET, BATCH, SLOT, AS_OF, VERSION)
_ENDED_IN = "__ended_in"


@dataclass(frozen=True)
class ChangeSpec:
    """How a feed applies to its target; without ``track`` the target is type 1."""

    keys: Sequence[str]
    sequence_by: str
    track: Sequence[str] | None = None
    order: Sequence[str] | None = None
    buckets: int = 64
    hot_rows: int | None = HOT_ROWS

    def bucket(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """The target as users see it; columns that came later are NULL in older rows."""
    opened = _stored(spark, f"{path}/open")
    if opened is None:
        return spark.read.option("mergeSchema", True).parquet(f"{path}/history").drop(BUCKET)
    # What a batch has written before it replaces the open versions is not there yet for readers.
    done = opened.groupBy(BUCKET).agg(F.max(AS_OF).alias(AS_OF))
    found = opened.join(done, [BUCKET, AS_OF], "left_semi")
    closed = _valid_closed(spark, path, lambda t: t.join(done, BUCKET).filter(F.col(BATCH) <= F.col(AS_OF)).drop(AS_OF))
    if closed is not None:
        found = found.unionByName(closed, allowMissingColumns=True)
    return found.drop(*_INTERNAL)


def _valid_closed(spark: SparkSession, path: str, part: Callable[[DataFrame], DataFrame]) -> DataFrame | None:
    """Closed versions that are not voided, of the buckets and batches that ``part`` takes."""
    closed, voided = _stored(spark, f"{path}/closed"), _stored(spark, f"{path}/voided")
    if closed is None:
        return None
    closed = part(closed)
    if voided is None:
        return closed
    gone = part(voided).select(BUCKET, VERSION, F.col(_ENDED_IN).alias(BATCH))
    return closed.join(gone, [BUCKET, VERSION, BATCH], "left_anti")


def rebuild(spark: SparkSession, path: str, spec: ChangeSpec) -> DataFrame:
    """The target derived from the log alone."""
    log = spark.read.option("mergeSchema", True).parquet(f"{path}/log").drop(BUCKET, BATCH)
    if spec.track is None:
        return scd1_latest(log, spec.keys, spec.sequence_by, spec.order)
    return scd2_history(log, spec.keys, spec.sequence_by, spec.track, spec.order, spec.hot_rows)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """A stored table, or None before its first batch."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _with_columns_of(df: DataFrame, other: DataFrame) -> DataFrame:
    """Adds the columns that only the other table has, as NULL."""
    missing = [f for f in other.schema if f.name not in df.columns]
    return df.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing))


def _replace(df: DataFrame, path: str, *partitions: str, sort: str | None = None) -> None:
    """Replace the partitions that occur in ``df``; rebalanced, so hot buckets split over files."""
    df = df.hint("rebalance", *partitions)
    if sort:
        df = df.sortWithinPartitions(*partitions, sort)
    writer = df.write.mode("overwrite").partitionBy(*partitions)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def merge_batch(batch: DataFrame, batch_id: int, path: str, spec: ChangeSpec) -> None:
    """Apply one batch to the target at ``path``.

    The log takes the batch first; from it the target can be rebuilt whatever happens to a merge.
    Columns that the target does not have yet are added to it.
    """
    spark = batch.sparkSession
    keys = [BUCKET, *spec.keys]
    # One row per key and sequence is all a merge can use; the write is what the merge then reads.
    log_path = f"{path}/log"
    if spec.track is None:
        rows = scd1_latest(batch, spec.keys, spec.sequence_by, spec.order)
    else:
        rows = unique_sequence(batch, spec.keys, spec.sequence_by, spec.order)
    rows = rows.withColumn(BUCKET, spec.bucket())
    _replace(rows.withColumn(BATCH, F.lit(batch_id)), log_path, BUCKET, BATCH)
    log = spark.read.option("mergeSchema", True).parquet(log_path)
    fresh = log.filter(F.col(BATCH) == batch_id).drop(BATCH)

    # At most spec.buckets numbers; as literals they prune the partitions that are read.
    touched = [r[0] for r in fresh.select(BUCKET).distinct().collect()]
    if not touched:
        return
    if spec.track is not None:
        _merge_versions(fresh, log, batch_id, path, spec, touched)
        return
    merged, history = fresh, _stored(spark, f"{path}/history")
    if history is not None:
        history = _with_columns_of(history.filter(F.col(BUCKET).isin(touched)), fresh)
        merged = scd1_merge(history, fresh, keys, spec.sequence_by, spec.order)
    _replace(merged, f"{path}/history", BUCKET)


def _place(name: str) -> Column:
    """Structs order NULL too, before all others."""
    return F.struct(F.col(name).alias("at"))


def _merge_versions(
    fresh: DataFrame, log: DataFrame, batch_id: int, path: str, spec: ChangeSpec, touched: list[int]
) -> None:
    """Apply a batch's rows to open and closed versions; see the module for what is read when."""
    spark, keys, seq = fresh.sparkSession, [BUCKET, *spec.keys], spec.sequence_by

    def versions(feed: DataFrame) -> DataFrame:
        return scd2_history(feed, keys, seq, spec.track, spec.order, spec.hot_rows)

    opened = _stored(spark, f"{path}/open")
    if opened is None:
        opened = versions(fresh).limit(0).withColumns({SLOT: F.lit(0), AS_OF: F.lit(-1)})
    # What this batch wrote when it ran before is left out, here and below.
    before = opened.filter(F.col(BUCKET).isin(touched) & (F.col(AS_OF) < batch_id))
    done = before.groupBy(BUCKET).agg(F.max(AS_OF).alias(AS_OF))
    base = _with_columns_of(before.join(done, [BUCKET, AS_OF], "left_semi"), fresh)
    slots = {r[0]: 1 - r[1] for r in base.select(BUCKET, SLOT).distinct().collect()}
    base = base.drop(SLOT, AS_OF)

    # A version carries the sequence of its last row, so rows behind it are late.
    cut = fresh.groupBy(*keys).agg(F.min(_place(seq)).alias("__cut"))
    known = base.join(cut, keys).withColumn("__late", F.col("__cut") <= _place(seq))
    late = known.filter("__late").select(*keys, "__cut", _place(START).alias("__open_from"))
    buckets = [r[0] for r in late.select(BUCKET).distinct().collect()]

    prompt_open = known.filter(~F.col("__late"))
    began = prompt_open.select(*keys, F.col(START).alias("__began"), F.col(seq).alias("__at"))
    prompt = fresh.join(late.select(*keys), keys, "left_anti") if buckets else fresh
    # The open version joins the new rows as the last row it had, and keeps its start.
    redone = versions(prompt.unionByName(prompt_open.select(*fresh.columns))).join(began, keys, "left")
    goes_on = F.col("__at").isNotNull() & F.col(START).eqNullSafe(F.col("__at"))
    first = F.when(goes_on, F.col("__began")).otherwise(F.col(START))
    redone = redone.withColumn(START, first).drop("__began", "__at")

    if buckets:
        mine = F.col(BUCKET).isin(buckets) & (F.col(BATCH) < batch_id)
        earliest = late.agg(F.min("__cut")).first()[0]["at"]
        closed = _valid_closed(spark, path, lambda t: t.filter(mine))
        start = late.select(*keys, "__open_from")
        if closed is not None:
            if earliest is not None:
                closed = closed.filter(F.col(END) >= F.lit(earliest))  # skips row groups
            wrong = closed.join(late, keys).filter(_place(END) >= F.col("__cut"))
            gone = wrong.select(BUCKET, VERSION, F.col(BATCH).alias(_ENDED_IN))
            _replace(gone.withColumn(BATCH, F.lit(batch_id)), f"{path}/voided", BUCKET, BATCH)
            start = start.unionByName(wrong.select(*keys, _place(START).alias("__open_from")))
        start = start.groupBy(*keys).agg(F.min("__open_from").alias("__from"))
        feed = log.filter(F.col(BUCKET).isin(buckets) & (F.col(BATCH) <= batch_id)).drop(BATCH)
        # New rows may lie before all versions there are.
        again = feed.join(start.join(late.select(*keys, "__cut"), keys), keys)
        again = again.filter(_place(seq) >= F.least("__from", "__cut")).select(*fresh.columns)
        redone = redone.unionByName(versions(again))

    redone = redone.persist()
    try:
        ended = redone.filter(F.col(END).isNotNull())
        version = F.md5(F.to_json(F.struct(*spec.keys, START)))
        ended = ended.withColumns({VERSION: version, BATCH: F.lit(batch_id)})
        _replace(ended, f"{path}/closed", BUCKET, BATCH, sort=END)
        untouched = base.join(cut, keys, "left_anti").select(*redone.columns)
        in_one = [bucket for bucket, slot in slots.items() if slot]
        slot = F.col(BUCKET).isin(in_one).cast("int")
        current_now = untouched.unionByName(redone.filter(F.col(END).isNull()))
        _replace(current_now.withColumns({AS_OF: F.lit(batch_id), SLOT: slot}), f"{path}/open", BUCKET, SLOT)
    finally:
        redone.unpersist()


def apply_changes_stream(
    stream: DataFrame, path: str, checkpoint: str, spec: ChangeSpec, name: str | None = None
) -> StreamingQuery:
    """Keep the target at ``path`` up to date with a change feed."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, spec)

    return run_batches(stream, handle, checkpoint, name)
