"""Change application: one pass, cut timelines, and batch by batch."""

import os
import random

import pytest
from pyspark.sql import functions as F

from larderlake.operators import scd
from larderlake.operators.scd import END, START
from larderlake.streaming import changes
from larderlake.streaming.changes import ChangeSpec, merge_batch, read_history, rebuild
from tests.conftest import rows

DDL = "k int, seq bigint, t string, u string"
SPEC = {"keys": ["k"], "sequence_by": "seq", "track": ["t"]}


def feed(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def versions(df):
    found = [(r["k"], r[START], r[END], r["t"], r["u"]) for r in df.collect()]
    return sorted(found, key=lambda v: (v[0], v[1] is not None, v[1]) if v[1] is not None else (v[0], False))


def expected(data):
    """Brute force: walk each key's rows in order."""
    out = []
    last = {}
    for k, seq, t, u in data:
        key = (k, seq)
        # Ties: the greatest of (t, u), NULLs least.
        rank = ((t is not None, t or ""), (u is not None, u or ""))
        if key not in last or rank > last[key][0]:
            last[key] = (rank, t, u)
    by_key = {}
    for (k, seq), (_, t, u) in last.items():
        by_key.setdefault(k, []).append((seq, t, u))
    for k, points in by_key.items():
        mine = []
        for seq, t, u in sorted(points):
            if mine and mine[-1][2] == t:
                mine[-1][3] = u
            else:
                mine.append([seq, None, t, u])
        for now, after in zip(mine, mine[1:]):
            now[1] = after[0]
        out += [(k, *v) for v in mine]
    return sorted(out, key=lambda v: v[:2])


EXAMPLE = [
    (1, 1, "a", "x"),
    (1, 2, "a", "y"),
    (1, 3, "b", "y"),
    (1, 4, None, "y"),
    (1, 5, None, "z"),
    (1, 6, "a", "z"),
]


def test_versions_by_hand(spark):
    found = versions(scd.scd2_history(feed(spark, *EXAMPLE), **SPEC))
    assert found == [
        (1, 1, 3, "a", "y"),
        (1, 3, 4, "b", "y"),
        (1, 4, 6, None, "z"),
        (1, 6, None, "a", "z"),
    ]
    assert found == expected(EXAMPLE)


def test_equal_sequence_is_decided_by_order(spark):
    df = feed(spark, (1, 1, "a", "x"), (1, 1, "b", "a"), (1, 2, "b", "c"))
    assert versions(scd.scd2_history(df, **SPEC)) == [(1, 1, None, "b", "c")]
    by_u = scd.scd2_history(df, **SPEC, order=["u"])
    assert versions(by_u) == [(1, 1, 2, "a", "x"), (1, 2, None, "b", "c")]


def test_copies_change_nothing(spark):
    df = feed(spark, *(EXAMPLE * 5))
    assert versions(scd.scd2_history(df, **SPEC)) == expected(EXAMPLE)


def test_empty_feed(spark):
    assert scd.scd2_history(feed(spark, (1, 1, "a", "x")).filter("false"), **SPEC).count() == 0


def random_feed(seed, keys=4, n=120, values="ab"):
    rng = random.Random(seed)
    pick = lambda: rng.choice([*values, None])
    # One key holds most rows.
    return [
        (rng.choice([0] * 5 + list(range(keys))), rng.randrange(60), pick(), rng.choice("xyz"))
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", range(4))
def test_cut_timelines_give_the_same_history(spark, seed):
    data = random_feed(seed, values="a" if seed == 3 else "ab")
    df = feed(spark, *data)
    for hot_rows in (1, 3, 20):
        found = versions(scd.scd2_history(df, **SPEC, hot_rows=hot_rows))
        assert found == expected(data), (seed, hot_rows)


def test_one_value_across_all_stretches_is_one_version(spark):
    data = [(1, i, "a", f"{i:03}") for i in range(50)]
    found = versions(scd.scd2_history(feed(spark, *data), **SPEC, hot_rows=2))
    assert found == [(1, 0, None, "a", "049")]


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "long"])
def test_any_sequence_type_and_null_give_the_same_history(spark, kind):
    def at(n):
        day = f"2024-01-{n:02}"
        return {"string": day, "date": day, "timestamp": f"{day} 00:00:00", "long": str(n)}[kind]

    rows = [(1, at(i), "ab"[i // 3 % 2], f"u{i}") for i in range(1, 20)]
    rows += [(1, None, "a", "u0"), (2, None, None, "x"), (2, at(3), None, "y"), (3, None, "a", "z"), (1, at(4), "b", "u0")]
    df = spark.createDataFrame(rows, "k int, seq string, t string, u string")
    df = df.withColumn("seq", F.col("seq").cast(kind))
    found = {h: versions(scd.scd2_history(df, **SPEC, hot_rows=h)) for h in (None, 1, 3, 20)}
    assert all(v == found[None] for v in found.values())
    # A version that begins without sequence ends where the next one begins, or is the current one.
    starts = {v[0]: v[2] for v in found[None] if v[1] is None}
    assert starts.keys() == {1, 2, 3} and starts[2] is None and starts[3] is None
    assert starts[1] == [v[1] for v in found[None] if v[0] == 1][1]


def test_a_plan_starts_no_job(spark):
    group = "history-plan"
    spark.sparkContext.setJobGroup(group, "plan")
    scd.scd2_history(feed(spark, *EXAMPLE), **SPEC, hot_rows=1)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)


@pytest.mark.parametrize("track", [["t"], None])
def test_a_batch_may_bring_a_new_column_and_null_sequences(spark, path, track):
    spec = ChangeSpec(["k"], "seq", track, buckets=2, hot_rows=2)
    first = [(1, 2, "a", "x"), (2, 5, "b", "y")]
    merge_batch(feed(spark, *first), 0, path, spec)
    wide = feed(spark, (1, None, "a", "n"), (1, 4, "b", "z"), (3, 1, None, "w")).withColumn("more", F.lit("new"))
    merge_batch(wide, 1, path, spec)
    whole = feed(spark, *first).withColumn("more", F.lit(None).cast("string")).unionByName(wide)
    if track:
        wanted = scd.scd2_history(whole, ["k"], "seq", track, hot_rows=None)
    else:
        wanted = scd.scd1_latest(whole, ["k"], "seq")
    rebuilt = rebuild(spark, path, spec).select(*wanted.columns)
    found = read_history(spark, path).select(*wanted.columns)
    assert rows(found) == rows(wanted) == rows(rebuilt)


@pytest.mark.parametrize("seed", range(3))
def test_merging_in_parts_gives_the_whole_history(spark, path, seed):
    data = random_feed(seed + 10, n=60)
    spec = ChangeSpec(**SPEC, buckets=3, hot_rows=15 if seed == 2 else None)
    parts = [data[i::3] for i in range(3)]
    for i, part in enumerate(parts):
        merge_batch(feed(spark, *part), i, path, spec)
        so_far = [r for p in parts[: i + 1] for r in p]
        assert versions(read_history(spark, path)) == expected(so_far)
    # The last batch again: nothing changes.
    merge_batch(feed(spark, *parts[-1]), 2, path, spec)
    assert versions(read_history(spark, path)) == expected(data)
    assert versions(rebuild(spark, path, spec)) == expected(data)


def test_late_row_splits_a_closed_version(spark):
    early = [(1, 10, "a", "x"), (1, 20, "a", "y"), (1, 30, "b", "y"), (2, 5, "q", "q")]
    late = [(1, 15, "c", "z")]
    history = scd.scd2_history(feed(spark, *early), **SPEC)
    merged = scd.scd2_merge(history, feed(spark, *early), feed(spark, *late), **SPEC)
    assert versions(merged) == [
        (1, 10, 15, "a", "x"),
        (1, 15, 20, "c", "z"),
        (1, 20, 30, "a", "y"),
        (1, 30, None, "b", "y"),
        (2, 5, None, "q", "q"),
    ]


def test_intervals_are_contiguous_with_one_open_end(spark):
    found = versions(scd.scd2_history(feed(spark, *random_feed(99)), **SPEC))
    for k in {v[0] for v in found}:
        mine = [v for v in found if v[0] == k]
        assert [v[2] for v in mine[:-1]] == [v[1] for v in mine[1:]]
        assert mine[-1][2] is None


def history(spark, *data):
    return spark.createDataFrame(list(data), f"k int, p double, `{START}` int, `{END}` int")


def test_snapshot_keeps_open_versions(spark):
    df = history(spark, (1, 1.0, 1, 5), (1, 2.0, 5, None), (2, 3.0, 2, 4), (2, 4.0, 4, None))
    found = rows(scd.scd2_snapshot(df), "k")
    assert found == [{"k": 1, "p": 2.0, "effective_from": 5}, {"k": 2, "p": 4.0, "effective_from": 4}]


def test_snapshot_of_expired_keys_is_empty(spark):
    assert scd.scd2_snapshot(history(spark, (1, 1.0, 1, 2), (2, 1.0, 1, 2))).count() == 0


def test_type_one_latest_and_merge(spark):
    df = feed(spark, (1, 3, "c", None), (1, 1, "a", "x"), (2, 1, None, "x"))
    latest = scd.scd1_latest(df, ["k"], "seq")
    assert rows(latest, "k") == [
        {"k": 1, "seq": 3, "t": "c", "u": None},
        {"k": 2, "seq": 1, "t": None, "u": "x"},
    ]
    late = feed(spark, (1, 2, "b", "b"), (2, 9, "n", "n"), (3, 1, "m", "m"))
    merged = rows(scd.scd1_merge(latest, late, ["k"], "seq"), "k")
    assert [(r["k"], r["t"]) for r in merged] == [(1, "c"), (2, "n"), (3, "m")]


def test_type_one_target_batch_by_batch(spark, path):
    spec = ChangeSpec(["k"], "seq", buckets=3)
    merge_batch(feed(spark, (1, 5, "a", "x"), (2, 1, "b", "x"), (2, 1, "c", "x")), 0, path, spec)
    merge_batch(feed(spark, (1, 4, "old", "x"), (3, 1, "d", "x")), 1, path, spec)
    merge_batch(feed(spark, (1, 4, "old", "x")).filter("false"), 2, path, spec)
    assert [(r["k"], r["t"]) for r in rows(read_history(spark, path), "k")] == [
        (1, "a"), (2, "c"), (3, "d"),
    ]


@pytest.mark.parametrize("table", ["voided", "closed", "open"])
def test_batch_that_failed_halfway_runs_again(spark, path, monkeypatch, table):
    spec = ChangeSpec(**SPEC, buckets=2, hot_rows=None)
    data = random_feed(5, n=60)
    merge_batch(feed(spark, *data[:20]), 0, path, spec)
    merge_batch(feed(spark, *data[20:30]), 1, path, spec)
    write = changes._replace

    def lost(df, target, *partitions, **options):
        write(df, target, *partitions, **options)
        if target.endswith(f"/{table}"):
            raise RuntimeError("lost")

    monkeypatch.setattr(changes, "_replace", lost)
    with pytest.raises(RuntimeError):
        merge_batch(feed(spark, *data[30:]), 2, path, spec)
    # Readers see a batch whole or not at all.
    seen = data if table == "open" else data[:30]
    assert versions(read_history(spark, path)) == expected(seen)
    monkeypatch.setattr(changes, "_replace", write)
    merge_batch(feed(spark, *data[30:]), 2, path, spec)
    assert versions(read_history(spark, path)) == expected(data)


def test_closed_versions_are_never_rewritten(spark, path, monkeypatch):
    spec = ChangeSpec(**SPEC, buckets=4, hot_rows=None)
    old = [(k, s, f"t{s}", "x") for k in range(12) for s in (10, 20, 30)]
    merge_batch(feed(spark, *old), 0, path, spec)

    def closed_files():
        return {
            os.path.join(at, name): os.path.getmtime(os.path.join(at, name))
            for at, _, names in os.walk(f"{path}/closed")
            for name in names
            if name.endswith(".parquet")
        }

    first = closed_files()
    assert first
    # Rows that are newer than all before read neither closed versions nor the log of other batches.
    read, asked = changes._valid_closed, []
    monkeypatch.setattr(changes, "_valid_closed", lambda *args: asked.append(args) or read(*args))
    new = [(k, 40, "t30" if k % 2 else "t40", "y") for k in range(0, 12, 3)]
    merge_batch(feed(spark, *new), 1, path, spec)
    assert not asked
    second = closed_files()
    assert first.items() < second.items()
    # A late row splits a closed version: its successors are new files, the old file stays.
    late = [(3, 15, "late", "z"), (50, 1, "n", "n")]
    merge_batch(feed(spark, *late), 2, path, spec)
    assert len(asked) == 1 and second.items() < closed_files().items()
    assert versions(read_history(spark, path)) == expected(old + new + late)


def test_what_a_merge_keeps_is_coalesced(spark):
    """A stage of a merge has dozens of sorts, so each needless partition of the kept rows costs their pages."""
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    kept = scd.scd2_history(feed(spark, *EXAMPLE), **SPEC).persist()
    try:
        kept.count()
        assert kept.rdd.getNumPartitions() < 20
    finally:
        kept.unpersist()
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_sort_gets_few_megabytes_of_a_shuffle(spark, path):
    """Partitions are merged up to 16 MB as shuffled, whatever the number of cores."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        wide = [F.xxhash64("id", F.lit(i)).alias(f"c{i}") for i in range(4)]
        rows_in = spark.range(3_000_000).select(F.xxhash64("id").alias("k"), F.xxhash64("id", F.lit(9)).alias("seq"), *wide)
        scd.unique_sequence(rows_in, ["k"], "seq").write.parquet(path + "/t")
        assert len(spark.read.parquet(path + "/t").inputFiles()) > 4
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
