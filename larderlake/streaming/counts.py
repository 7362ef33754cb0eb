"""Counts of stream batches, stored batch by batch.

Every batch owns a partition of the counts table, so a batch that runs again replaces its counts,
and a run of any number of batches keeps all of them whatever reports the session remembers.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "_batch"
COUNTS_DDL = "label string, run string, metric string, value bigint"
_NAMES = ("label", "run", "metric", "value")


def write_own(rows: DataFrame, path: str, batch_id: int, *partition_by: str) -> None:
    """Write the rows of a batch as its partition, in place of what it wrote before."""
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{BATCH}={batch_id}")


def write_counts(
    spark: SparkSession, path: str, batch_id: int, run: str, label: str, counts: Mapping[str, int]
) -> None:
    """Store the counts of one batch in place of what it stored before."""
    rows = [F.struct(*(F.lit(x).alias(n) for n, x in zip(_NAMES, (label, run, metric, value)))) for metric, value in counts.items()]
    write_own(spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows))), path, batch_id)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """(label, run, metric, value, _batch) of all batches; no rows before the first one."""
    try:
        return spark.read.schema(f"{COUNTS_DDL}, {BATCH} bigint").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{COUNTS_DDL}, {BATCH} bigint")


def summed(counts: DataFrame) -> DataFrame:
    """(label, metric, value, batches): totals over batches."""
    return counts.groupBy("label", "metric").agg(
        F.sum("value").alias("value"), F.count_distinct(BATCH).alias("batches")
    )


def run_totals(spark: SparkSession, path: str, run: str) -> dict[str, int]:
    """Totals of the batches that a run finished, by metric."""
    rows = summed(read_counts(spark, path).filter(F.col("run") == run)).collect()
    return {r.metric: r.value for r in rows}
