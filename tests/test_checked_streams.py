"""Streams that are checked, counted and split batch by batch, and minutes with a rule for late orders."""

import os

import pytest
from pyspark.sql import functions as F

from larderlake.operators.quality import RuleSet
from larderlake.streaming import (
    quality_metrics,
    read_accepted,
    read_counts,
    read_late,
    read_minutes,
    read_quarantined,
    run_available_now,
    run_checked,
    run_minutes,
    summed,
)
from larderlake.streaming import checked
from larderlake.streaming.checked import judged
from larderlake.streaming.counts import run_totals, write_counts
from tests.conftest import rows, ts

RULES = RuleSet.of(
    "lines",
    drop={"has_id": "id IS NOT NULL", "positive": "n > 0"},
    warn={"small": "n < 100"},
)
DDL = "id int, n int, kind string"


def deliver(spark, path, *data):
    spark.createDataFrame(list(data), DDL).coalesce(1).write.mode("append").parquet(f"{path}/in")


def stream(spark, path):
    return spark.readStream.schema(DDL).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


def totals(spark, path):
    return {r.metric: (r.value, r.batches) for r in summed(read_counts(spark, f"{path}/out/counts")).collect()}


def test_rows_are_split_and_counts_add_up(spark, path):
    deliver(spark, path, (1, 5, "a"), (None, 5, "a"), (2, 500, "b"))
    deliver(spark, path, (3, None, "b"), (None, -1, None))
    first = run_checked(stream(spark, path), RULES, f"{path}/out", f"{path}/check", ["kind"])
    assert first.counts == {"total_rows": 5, "kept_rows": 2, "has_id": 2, "positive": 2, "small": 2}
    assert rows(read_accepted(spark, f"{path}/out"), "id") == [
        {"id": 1, "n": 5, "kind": "a"},
        {"id": 2, "n": 500, "kind": "b"},
    ]
    out = {(r.id, r.n): r.violated_rules for r in read_quarantined(spark, f"{path}/out").collect()}
    assert out == {(None, 5): ["has_id"], (3, None): ["positive", "small"], (None, -1): ["has_id", "positive"]}
    # A second run counts what is new; the table's totals go on.
    deliver(spark, path, (9, 9, "a"))
    second = run_checked(stream(spark, path), RULES, f"{path}/out", f"{path}/check", ["kind"])
    assert second.counts["total_rows"] == 1 and second.run != first.run
    assert totals(spark, path)["total_rows"] == (6, 3)
    assert run_checked(stream(spark, path), RULES, f"{path}/out", f"{path}/check", ["kind"]).counts == {}


def test_a_batch_that_runs_again_replaces_itself(spark, path, monkeypatch):
    deliver(spark, path, (1, 5, "a"), (None, 5, "a"))

    def lost(*args):
        write_counts(*args)
        raise RuntimeError("driver lost")

    # Rows and counts are stored, but the stream has not noted the batch.
    monkeypatch.setattr(checked, "write_counts", lost)
    with pytest.raises(Exception, match="driver lost"):
        run_checked(stream(spark, path), RULES, f"{path}/out", f"{path}/check")
    assert totals(spark, path)["total_rows"] == (2, 1)
    monkeypatch.undo()
    again = run_checked(stream(spark, path), RULES, f"{path}/out", f"{path}/check")
    assert again.counts["total_rows"] == 2
    assert totals(spark, path)["total_rows"] == (2, 1)
    assert read_accepted(spark, f"{path}/out").count() == 1
    assert read_quarantined(spark, f"{path}/out").count() == 1


def test_a_fail_rule_stops_the_stream(spark, path):
    strict = RuleSet.of("lines", fail={"has_id": "id IS NOT NULL"})
    deliver(spark, path, (None, 1, "a"))
    with pytest.raises(Exception, match="has_id violated"):
        run_checked(stream(spark, path), strict, f"{path}/out", f"{path}/check")
    assert read_counts(spark, f"{path}/out/counts").count() == 0


def test_no_rules_accept_all(spark):
    df = spark.createDataFrame([(1, None, None)], DDL)
    (row,) = judged(df, RuleSet("lines", ())).collect()
    assert row["_verdict"] == "accepted" and row.violated_rules == []


def test_counts_are_those_of_the_newest_try(spark, path):
    assert run_totals(spark, f"{path}/counts", "r") == {}
    write_counts(spark, f"{path}/counts", 0, "q", "t", {"x": 1})
    write_counts(spark, f"{path}/counts", 0, "r", "t", {"x": 4, "y": 2})
    write_counts(spark, f"{path}/counts", 1, "r", "t", {"x": 5})
    assert run_totals(spark, f"{path}/counts", "r") == {"x": 9, "y": 2}
    assert run_totals(spark, f"{path}/counts", "q") == {}


def test_counts_do_not_depend_on_kept_reports(spark, path):
    for i in range(4):
        deliver(spark, path, (i, i, "a"))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        counted = stream(spark, path).observe("seen", F.count("*").alias("rows"))
        query = run_available_now(counted, f"{path}/out", f"{path}/check")
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert len(query.recentProgress) < 4
    assert quality_metrics(query, "seen") == {"rows": 4}
    assert quality_metrics(query, "other") == {}


ORDER = "order_id int, store_id int, quantity int, event_timestamp timestamp"


def test_minutes_close_and_late_orders_are_set_aside(spark, path):
    def run(*orders):
        df = spark.createDataFrame([(i, s, q, at and ts(f"2024-01-01 {at}")) for i, s, q, at in orders], ORDER)
        df.coalesce(1).write.mode("append").parquet(f"{path}/in")
        orders = spark.readStream.schema(ORDER).parquet(f"{path}/in")
        run_minutes(orders, f"{path}/out", f"{path}/check")
        minutes = {
            (r.store_id, r.order_minute.strftime("%H:%M")): (r.orders_per_minute, r.total_quantity_per_minute)
            for r in read_minutes(spark, f"{path}/out").collect()
        }
        return minutes, sorted(r.order_id for r in read_late(spark, f"{path}/out").collect())

    minutes, late = run((1, 1, 2, "10:00:05"), (2, 1, 3, "10:00:59"), (3, None, 1, "10:00:00"), (4, 2, 1, "10:05:00"))
    assert late == [] and minutes == {}  # nothing is ten minutes old yet
    minutes, late = run((5, 1, 4, "10:00:30"), (6, 2, 1, "10:20:00"))
    assert minutes == {(1, "10:00"): (3, 9), (None, "10:00"): (1, 1), (2, "10:05"): (1, 1)}
    minutes, late = run((7, 1, 9, "10:09:59"), (8, 1, 1, "10:10:00"), (9, 1, 1, None), (10, 1, 1, "10:31:00"))
    assert late == [7, 9]
    assert minutes[(1, "10:10")] == (1, 1) and minutes[(1, "10:00")] == (3, 9)
    found, late = run((11, 1, 1, "10:31:30"))
    assert found == minutes and late == [7, 9]  # 10:31 is still open
    assert os.path.isdir(f"{path}/check/count/state")


def test_files_of_a_batch_follow_the_lines(spark, path, monkeypatch):
    """More lines make more files a batch, not longer ones; batches and counts stay as they are."""
    from larderlake.workload import queries

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(queries, "scratch_dir", lambda spark, label: f"{path}/{label}")
    monkeypatch.setattr(queries, "FILE_LINES", 500)
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    found = rows(queries.e6_stream_quarantine(spark, sf))
    assert sum(r["lines"] for r in found) == lines
    files = len(spark.read.parquet(f"{path}/checked/bronze").inputFiles())
    assert files == 3 * (1 + lines // 1500) > 6
    batches = read_counts(spark, f"{path}/checked/silver/counts").select("_batch").distinct().count()
    assert batches == 3
