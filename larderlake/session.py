"""Session settings the engine is designed around.

Nothing in the package needs these to be right; they decide how fast a plan is.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

#: Runtime settings, safe to change on a live session.
RUNTIME = {
    # Keys and texts hold timestamps as wall-clock strings.
    "spark.sql.session.timeZone": "UTC",
    # Strict parsing raises on text that does not fit.
    "spark.sql.ansi.enabled": "true",
    # Re-plan on measured sizes: shrink partitions, split hot ones, drop needless shuffles.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Split a hot key even where that costs a later shuffle: one endless task costs more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sorts hold some twenty times what a shuffle sent; the default of 64 MB made 1.7 GB of one task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # What is kept for two writes is merged into fewer partitions as well; each costs its sorts' first pages.
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    # Half of a fact row is hashes in hexadecimal, which the default does not compress.
    "spark.sql.parquet.compression.codec": "zstd",
    # A runtime filter from a small join side prunes the large scan.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


#: Megabytes of input that a shuffle partition should hold.
PARTITION_MB = 256


def build_session(
    app: str = "larderlake", master: str | None = None, input_gb: float | None = None, **conf: str
) -> SparkSession:
    """Build a session; keyword names use ``__`` for dots (``spark__sql__shuffle__partitions="8"``).

    ``input_gb`` is the size of the largest input: shuffles start with partitions enough for it, and
    small ones are merged at run time.
    """
    if input_gb is not None:
        initial = str(max(200, math.ceil(input_gb * 1024 / PARTITION_MB)))
        conf.setdefault("spark__sql__adaptive__coalescePartitions__initialPartitionNum", initial)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
