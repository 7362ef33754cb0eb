"""Triggered stream runs: take what has arrived, stop, go on from the checkpoint next time."""

from __future__ import annotations

import threading
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

#: Seconds to wait for the last report of a run that has ended.
REPORT_WAIT = 60


def checkpoint_dir(root: str, env: str, table: str) -> str:
    """One checkpoint per environment and table."""
    return f"{root.rstrip('/')}/checkpoints/{env}/{table}"


def run_available_now(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: Sequence[str] = (),
    name: str | None = None,
) -> StreamingQuery:
    """Append the rows that have arrived to a table, exactly once, and return the finished query."""
    writer = stream.writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _finish(writer, name, stream.sparkSession)


def run_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    name: str | None = None,
) -> StreamingQuery:
    """Hand what has arrived to ``handle(batch, batch_id)``, batch by batch.

    A batch may come again after a failure; ``handle`` must make its repetition harmless.
    """
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _finish(writer, name, stream.sparkSession)


class _Reports(StreamingQueryListener):
    """Adds up what the batches of each run observed, report by report as they come."""

    def __init__(self):
        self.totals = defaultdict(lambda: defaultdict(lambda: defaultdict(int)))
        self.ended: set[str] = set()
        self.changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        found = self.totals[str(event.progress.runId)]
        for label, row in event.progress.observedMetrics.items():
            for metric, value in row.asDict().items():
                found[label][metric] += value

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()

    def of(self, run: str) -> dict[str, dict[str, int]]:
        """Totals of a run; its end is reported after all of its batches."""
        with self.changed:
            if not self.changed.wait_for(lambda: run in self.ended, REPORT_WAIT):
                raise TimeoutError(f"the reports of run {run} did not arrive")
        return {label: dict(counts) for label, counts in self.totals[run].items()}


def _finish(writer, name: str | None, spark) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    reports = _Reports()
    spark.streams.addListener(reports)
    try:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        query.observed = reports.of(str(query.runId))
    finally:
        spark.streams.removeListener(reports)
    return query


def quality_metrics(query: StreamingQuery, label: str) -> dict[str, int]:
    """Rule counts of a finished run, summed over all of its batches.

    They are gathered while the run goes on and do not depend on how many reports a session keeps.
    Counts that must outlive the driver are those of ``run_checked``, stored batch by batch.
    """
    return query.observed.get(label, {})
