"""Slowly changing dimensions from change feeds.

Type 2 keeps a version per stretch of unchanged *tracked* columns; a change in the other columns
updates the open version in place. Feeds hold inserts and updates only. History rows carry
``__START_AT`` (sequence of the first row of the version) and ``__END_AT`` (start of the next one,
NULL while current).

A history needs each key's rows in sequence order. The timeline of a key is cut into stretches of
about ``hot_rows`` sequence values, each stretch is versioned on its own, and only its first and
last version meet in a window over the whole key. A key with few rows is one stretch, seldom two;
keys of any size take the same way. A NULL sequence comes before all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larderlake.operators.dedup import latest

START, END = "__START_AT", "__END_AT"

#: Sequence values of one key that a single task sorts, about.
HOT_ROWS = 1_000_000


def _tracked(track: Sequence[str]) -> Column:
    return F.struct(*track)


def unique_sequence(
    feed: DataFrame, keys: Sequence[str], sequence_by: str, order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key and sequence value.

    Rows delivered together share a sequence; among those the greatest by ``order`` (default: all
    other columns) counts. The shuffle is on key and sequence, so hot keys spread, and copies are
    combined before it.
    """
    return latest(feed, [*keys, sequence_by], [], order).select(*feed.columns)


def _stretches(
    rows: DataFrame, feed: DataFrame, keys: Sequence[str], sequence_by: str, hot_rows: int | None
) -> DataFrame:
    """Adds the number of the stretch that a row lies in.

    One in ``hot_rows`` sequence values of a key, by hash, begins a new stretch. So the cuts of a key
    are as many as its size asks for, need no count, and are the same in every run; they compare as
    structs, which order any type and NULL too.
    """
    if hot_rows is None:
        return rows.withColumn("__stretch", F.lit(0))
    place = F.struct(F.col(sequence_by).alias("at"))
    cuts = (
        feed.filter(F.pmod(F.xxhash64(*keys, sequence_by), F.lit(hot_rows)) == 0)
        .groupBy(*keys)
        .agg(F.collect_set(place).alias("__cuts"))
    )
    number = F.size(F.filter(F.coalesce("__cuts", F.array()), lambda cut: cut <= place))
    return rows.join(cuts, list(keys), "left").withColumn("__stretch", number).drop("__cuts")


def scd2_history(
    feed: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track: Sequence[str],
    order: Sequence[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Version history of a change feed.

    ``order`` breaks ties between rows of one key and sequence. ``hot_rows=None`` leaves timelines
    whole, for feeds known to have only small keys. The history is the same whatever the cuts are.
    """
    rows = unique_sequence(feed, keys, sequence_by, order)
    rows = _stretches(rows, feed, keys, sequence_by, hot_rows)
    return _stitch(_versions(rows, [*keys, "__stretch"], sequence_by, track), keys, track)


def _versions(
    rows: DataFrame, within: Sequence[str], sequence_by: str, track: Sequence[str]
) -> DataFrame:
    """Versions inside each ``within`` group, in one sort.

    ``__number`` counts a group's versions from 1, ``__last`` marks the last one.
    """
    timeline = Window.partitionBy(*within).orderBy(sequence_by)
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = _tracked(track)
    neighbours = {
        "__opens": ~now.eqNullSafe(F.lag(now).over(timeline)),
        "__closes": ~now.eqNullSafe(F.lead(now).over(timeline)),
        "__last": F.lead(F.lit(True)).over(timeline).isNull(),
        END: F.lead(sequence_by).over(timeline),
    }
    return (
        rows.withColumns(neighbours)
        .withColumn(START, F.max(F.when(F.col("__opens"), F.col(sequence_by))).over(so_far))
        .withColumn("__number", F.count_if("__opens").over(so_far))
        .filter("__closes")
        .drop("__opens", "__closes")
    )


def _stitch(versions: DataFrame, keys: Sequence[str], track: Sequence[str]) -> DataFrame:
    """Join versions that go on across stretch borders.

    Only the first and last version of each stretch go into the window over a whole key: two rows
    per stretch at most. One CASE for the test, so that no part of it is pushed below the window of
    the versions: both branches share its shuffle.
    """
    edge = F.when(F.col("__last"), True).otherwise(F.col("__number") == 1)
    inner, edges = versions.filter(~edge), versions.filter(edge)
    order = Window.partitionBy(*keys).orderBy("__stretch", "__number")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    now = _tracked(track)
    goes_on = (F.col("__number") == 1) & now.eqNullSafe(F.lag(now).over(order))
    stitched = (
        edges.withColumn("__goes_on", goes_on)
        .withColumn("__absorbed", F.coalesce(F.lead("__goes_on").over(order), F.lit(False)))
        .withColumn(END, F.when(F.col("__last"), F.lead(START).over(order)).otherwise(F.col(END)))
        .withColumn(START, F.max(F.when(~F.col("__goes_on"), F.col(START))).over(so_far))
        .filter(~F.col("__absorbed"))
        .drop("__goes_on", "__absorbed")
    )
    return inner.unionByName(stitched).drop("__stretch", "__number", "__last")


def current(history: DataFrame) -> DataFrame:
    """The open version of each key."""
    return history.filter(F.col(END).isNull())


def scd2_snapshot(history: DataFrame, *cols: str) -> DataFrame:
    """Open versions as ``cols`` (default: all attributes) plus ``effective_from``."""
    attrs = cols or tuple(c for c in history.columns if c not in (START, END))
    return current(history).select(*attrs, F.col(START).alias("effective_from"))


def scd2_merge(
    history: DataFrame,
    log: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    track: Sequence[str],
    order: Sequence[str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """History after ``batch``, given the history so far and the feed rows (``log``) behind it.

    A late row may split a closed version, which takes the rows inside it: hence the log. Only
    keys in the batch are touched, and of those only the timeline from the version the earliest
    new row falls into. Merging a batch twice changes nothing.
    """
    keys = list(keys)
    new = batch.select(*log.columns)
    # Structs order NULL too: a row without sequence reopens the whole timeline.
    place = lambda name: F.struct(F.col(name).alias("at"))
    cut = new.groupBy(*keys).agg(F.min(place(sequence_by)).alias("__cut"))
    known = history.join(cut, keys, "left")
    ended = F.col(END).isNotNull() & (place(END) < F.col("__cut"))
    closed_before = F.col("__cut").isNull() | F.coalesce(ended, F.lit(False))
    reopened = known.filter(~closed_before).groupBy(*keys).agg(F.min(place(START)).alias("__from"))
    replay = (
        log.join(reopened, keys)
        .filter(place(sequence_by) >= F.col("__from"))
        .select(*log.columns)
        .unionByName(new)
    )
    redone = scd2_history(replay, keys, sequence_by, track, order, hot_rows)
    kept = known.filter(closed_before).select(*history.columns)
    return kept.unionByName(redone.select(*history.columns))


def scd1_latest(
    feed: DataFrame, keys: Sequence[str], sequence_by: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Latest row per key; ties as in ``unique_sequence``."""
    return latest(feed, keys, [sequence_by], order).select(*feed.columns)


def scd1_merge(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert a batch: rows older than what the target holds lose."""
    return scd1_latest(target.unionByName(batch), keys, sequence_by, order)
