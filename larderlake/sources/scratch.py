"""Where intermediate tables and test streams may be written."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the one the cluster names in ``spark.checkpoint.dir``.

    A session without that setting writes below its warehouse, which executors see as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    shared = shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/larderlake/{label}-{uuid.uuid4().hex}"
