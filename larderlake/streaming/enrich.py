"""Stream-static enrichment against a changing table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from larderlake.streaming.runs import run_batches


def stream_static_join(
    stream: DataFrame,
    read_static: Callable[[], DataFrame],
    join: Callable[[DataFrame, DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    name: str | None = None,
) -> StreamingQuery:
    """Enrich a stream with the table as it stands when each batch runs.

    A static side joined to the stream directly would be the one read at start. Each batch owns the
    partition ``batch_id`` of the output, so a repeated batch replaces itself.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = join(batch, read_static()).withColumn("batch_id", F.lit(batch_id))
        writer = rows.write.mode("overwrite").partitionBy("batch_id")
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)

    return run_batches(stream, handle, checkpoint, name)
