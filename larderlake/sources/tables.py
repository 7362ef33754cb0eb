"""Stored tables: layer paths, reads, and the sinks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType, TimestampType

from larderlake.functions.keys import packed, unpacked

#: Bits of a column's rank in an interleaved key: 2 to this power ranges a column.
RANK_BITS = 8
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def layer_path(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}"


def read_layer(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    """Batch snapshot of a table of another layer."""
    return spark.read.parquet(layer_path(root, layer, table))


@contextmanager
def _shuffles_released(spark: SparkSession) -> Iterator[None]:
    """What an execution in here shuffles is deleted as soon as it ends, not when the driver collects garbage."""
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    touched_partitions_only: bool = False,
    interleave: bool = False,
    hashes: Sequence[str] = (),
) -> None:
    """Write a table laid out for pruning.

    Rows meet by partition value (without partitions, by the leading cluster column) and are sorted
    by the cluster columns, so that row-group statistics skip well and a partition gets as few
    files as its size allows. The exchange is a rebalance: it needs no pass for sampling, merges
    small pieces, and cuts an oversized one at block borders, so neither one hot month nor a mass
    of equal rows ends up in a single task. ``touched_partitions_only`` replaces only the
    partitions present in ``df``.

    In that order only the leading cluster column prunes. ``interleave`` sorts by ``interleaved``
    instead, so that a filter on any of them skips row groups. Files then hold ranges of the key, within
    a partition, and many rows with one key are divided by the hash of their other columns. It reads
    ``df`` three times (borders, ranges, rows), which should therefore be a stored table.

    ``hashes`` names text columns that hold MD5 keys, if any: they are packed while rows are rebalanced.
    Once the table is written, nothing shuffled for it is left on disk.
    """
    columns, order = df.columns, [*partition_by, *cluster_by]
    spread = [*partition_by] or [*cluster_by[:1]]
    if interleave and len(cluster_by) > 1:
        key = "__interleaved"
        rest = F.xxhash64(*(F.col(f"`{c}`") for c in columns))
        df = df.withColumn(key, interleaved(df, cluster_by)).repartitionByRange(*partition_by, key, rest)
        df = df.sortWithinPartitions(*partition_by, key).select(*columns)
    elif spread:
        hashes = [c for c in hashes if c in columns and c not in order]
        df = df.withColumns({c: packed(F.col(f"`{c}`")) for c in hashes}) if hashes else df
        df = df.hint("rebalance", *spread).sortWithinPartitions(*order)
        df = df.withColumns({c: unpacked(F.col(f"`{c}`")) for c in hashes}) if hashes else df
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if touched_partitions_only:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    with _shuffles_released(df.sparkSession):
        writer.parquet(path)


def interleaved(df: DataFrame, columns: Sequence[str]) -> Column:
    """A whole number that takes the bits of all columns' ranks in turns: close keys, close values in each.

    A rank is the number of the range that a value falls in; ranges hold about as many rows each, so
    skewed values take their share of the key and no more. Their borders come from one pass over
    ``df``, whose result is a list per column. NULL comes first. Seven columns at most.
    """
    if len(columns) * RANK_BITS > 62:
        raise ValueError(f"at most {62 // RANK_BITS} columns can be interleaved")
    shares = [i / 2**RANK_BITS for i in range(1, 2**RANK_BITS)]
    places = {c: _place(df, c) for c in columns}
    borders = df.agg(*(F.percentile_approx(p, shares, 20_000).alias(c) for c, p in places.items())).first()
    ranks = [_rank(place, borders[c]) for c, place in places.items()]
    # All ranks are made once; bits are taken from the array.
    bits = F.array(*(F.lit(1 << b) for b in reversed(range(RANK_BITS))))

    def taken(all_ranks: Column) -> Column:
        def add(key: Column, bit: Column) -> Column:
            return F.aggregate(
                all_ranks, key, lambda k, rank: k * 2 + F.when(rank.bitwiseAND(bit) != 0, 1).otherwise(0)
            )

        return F.aggregate(bits, F.lit(0).cast("long"), add)

    return F.get(F.transform(F.array(F.array(*ranks)), taken), F.lit(0))


def _place(df: DataFrame, name: str) -> Column:
    """A number in the order of the column's values; of texts the first six bytes count."""
    kind, column = df.schema[name].dataType, df[f"`{name}`"]
    if isinstance(kind, StringType):
        return F.conv(F.rpad(F.substring(F.hex(column), 1, 12), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(column).cast("double")
    return column.cast("int").cast("double") if isinstance(kind, BooleanType) else column.cast("double")


def _rank(place: Column, borders: Sequence[float] | None) -> Column:
    """How many borders a value has reached, by halving; 0 for NULL."""
    known = F.array(*(F.lit(b) for b in borders or [0.0] * (2**RANK_BITS - 1)))
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(RANK_BITS))))
    return F.aggregate(
        steps, F.lit(0), lambda at, step: at + F.when(F.get(known, at + step - 1) <= place, step).otherwise(0)
    )


def append_table(df: DataFrame, path: str) -> None:
    """Append rows. Later batches may bring new columns: read with ``mergeSchema`` to see them."""
    df.write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace a small table as a whole."""
    df.write.mode("overwrite").parquet(path)
