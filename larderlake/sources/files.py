"""File sources: CSV drops, exported documents, JSON payloads."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def infer_csv_schema(spark: SparkSession, path: str, sampling_ratio: float = 1.0) -> StructType:
    """Column names and types of headered CSV files, found once so that a stream can pin them.

    A full pass by default. On a large landing zone point ``path`` at one delivery, or lower the
    ratio and let the cleansing casts settle the types.
    """
    reader = spark.read.option("header", True).option("inferSchema", True)
    return reader.option("samplingRatio", sampling_ratio).csv(path).schema


def pinned_csv_schema(spark: SparkSession, path: str, pin: str) -> StructType:
    """The schema kept at ``pin``; inferred from ``path`` and kept there the first time.

    Later runs neither read the landing zone again nor change a column's type under the stream.
    """
    try:
        return StructType.fromJson(json.loads(spark.read.text(pin, wholetext=True).first()[0]))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    schema = infer_csv_schema(spark, path)
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.text(pin)
    return schema


def read_csv_stream(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Headered CSV files as a stream: each file is read once, new ones on the next run.

    All files must have the columns of the schema, in its order; another header is an error. Feeds
    whose columns move are read by ``drift.ingest_csv_by_name``.
    """
    reader = spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(path)


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    fmt: str = "parquet",
    max_files: int | None = None,
) -> DataFrame:
    """A stored table as a stream of its appended files.

    ``schema`` may be left out when the table already holds files.
    """
    if schema is None:
        schema = spark.read.format(fmt).load(path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def with_lineage(df: DataFrame, name: str, files: bool = True) -> DataFrame:
    """Stamp the arrival time and origin of each row.

    File drops carry their path and dataset (``source_file``, ``source_name``); exported
    documents carry the dataset only, as ``source``.
    """
    stamped = df.withColumn("ingestion_time", F.current_timestamp())
    if not files:
        return stamped.withColumn("source", F.lit(name))
    return stamped.withColumns(
        {"source_file": F.col("_metadata.file_path"), "source_name": F.lit(name)}
    )


#: The datasets of the bronze layer.
CSV_DATASETS = ("transactions", "regions", "stores", "return", "calendar")
DOCUMENT_DATASETS = ("customers", "products")


def register_bronze(
    spark: SparkSession,
    paths: dict[str, str],
    csv: Iterable[str] = CSV_DATASETS,
    documents: Iterable[str] = DOCUMENT_DATASETS,
    max_files: int | None = None,
    pins: str | None = None,
) -> dict[str, DataFrame]:
    """One lazy, lineage-stamped stream per dataset that ``paths`` locates, keyed ``bronze_<name>``.

    ``pins`` names a folder that keeps the inferred schemas between runs.
    """
    streams = {}
    for name in csv:
        if name in paths:
            if pins is None:
                schema = infer_csv_schema(spark, paths[name])
            else:
                schema = pinned_csv_schema(spark, paths[name], f"{pins}/{name}")
            stream = read_csv_stream(spark, paths[name], schema, max_files)
            streams[f"bronze_{name}"] = with_lineage(stream, name)
    for name in documents:
        if name in paths:
            stream = read_table_stream(spark, paths[name], max_files=max_files)
            streams[f"bronze_{name}"] = with_lineage(stream, name, files=False)
    return streams


def decode_json_value(df: DataFrame, schema: StructType | str, value_col: str = "value") -> DataFrame:
    """Message bytes to columns: binary, text, declared struct, flat; stamped with arrival time."""
    message = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(message.alias("m")).select("m.*", F.current_timestamp().alias("ingestion_time"))


def unwrap_json(
    df: DataFrame,
    key: str,
    schema: StructType | str,
    payload: str = "data",
    carry: tuple[str, ...] = ("ingestion_time",),
) -> DataFrame:
    """Flatten a JSON payload column, unless the rows already hold the flat ``key`` column.

    Text that is not JSON gives a row of NULLs; fields missing from it are NULL.
    """
    if payload not in df.columns or key in df.columns:
        return df
    return df.select(F.from_json(payload, schema).alias("doc"), *carry).select("doc.*", *carry)
