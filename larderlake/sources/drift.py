"""CSV drops whose columns move, come and go: every file is read by its own header.

Types may be declared, or found: then the table keeps the text as delivered, and a column's type is
the narrowest that holds all samples so far, pinned in versions.
"""

from __future__ import annotations

import csv
import json
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DataType, StringType, StructField, StructType

from larderlake.streaming.counts import BATCH, write_own
from larderlake.streaming.runs import run_batches

#: Values that do not fit their column, as JSON of column and text; NULL where all fit.
RESCUED = "_rescued"
#: Lines of a file that its types are found from.
SAMPLE = 1000

#: Which type holds both of two; where none is named, text does.
_WIDER = {
    frozenset({"int", "bigint"}): "bigint",
    frozenset({"int", "double"}): "double",
    frozenset({"bigint", "double"}): "double",
    frozenset({"date", "timestamp"}): "timestamp",
}
_CELL = "file string, line int, position int, name string, value string"


def sampled_cells(spark: SparkSession, files: Sequence[str], lines: int = 0) -> DataFrame:
    """(file, line, position, name, value): names of the columns of each file, and its first lines' cells.

    Names come as line 0 with a NULL value. One job for all files. A task has one block of one file, and
    no more than the lines asked for leave the scan; a file without any line gives nothing.
    """
    session = spark.newSession()
    # Files that cost a whole partition to open are not packed together.
    session.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", lines + 1)
    text = session.read.text(list(files))
    # Spark numbers the rows of a task in the lower 33 bits. What goes to Python is read there to its end.
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    at = F.col("_metadata.file_block_start").alias("at")
    rows = text.select("_metadata.file_path", at, "value", number.alias("number"))
    first = rows.filter((F.col("at") == 0) & (F.col("number") <= lines)).select("file_path", "value")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield _cells(batch.column(0)[0].as_py(), batch.column(1).to_pylist())

    return first.mapInArrow(cut, _CELL)


def _cells(file: str, lines: list[str]) -> pa.RecordBatch:
    header, *parsed = ([cell or None for cell in next(csv.reader([line], escapechar="\\"), [])] for line in lines)
    names = _unique(header)
    cells = [(file, 0, at, name, None) for at, name in enumerate(names)]
    for no, row in enumerate(parsed, 1):
        cells += [(file, no, at, name, value) for at, (name, value) in enumerate(zip(names, row))]
    columns = [list(c) for c in zip(*cells)] or [[]] * 5
    types = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[f.split()[0] for f in _CELL.split(", ")]
    )


def _unique(header: Sequence[str | None]) -> list[str]:
    """Names of columns: an empty one is named by its place, repeated ones get their place added."""
    names = [name.removeprefix("\ufeff") if name else f"_c{at}" for at, name in enumerate(header)]
    return [f"{name}{at}" if names.count(name) > 1 else name for at, name in enumerate(names)]


def _headers(spark: SparkSession, files: Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of each header."""
    names = defaultdict(list)
    if files:
        for cell in sorted(sampled_cells(spark, files).select("file", "position", "name").collect()):
            names[cell.file].append(cell.name)
    by_header = defaultdict(list)
    for file, header in names.items():
        by_header[tuple(header)].append(unquote(file))  # the file's place comes as a URI
    return by_header


def read_csv_by_name(spark: SparkSession, files: Sequence[str], schema: StructType) -> DataFrame:
    """Rows of headered CSV files with the declared columns, new ones as text, and RESCUED.

    Files with the same header are read together. A column that a file lacks is NULL. A value that
    its declared type cannot hold is NULL, and its text is kept in RESCUED.
    """
    parts = []
    for header, same in _headers(spark, files).items():
        rows = spark.read.schema(_text(header)).option("header", True).csv(same)
        parts.append(_typed(rows, schema))
    if not parts:
        return spark.createDataFrame([], schema).withColumn(RESCUED, F.lit(None).cast("string"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _text(names: Iterable[str]) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


def _typed(rows: DataFrame, schema: StructType) -> DataFrame:
    declared = {f.name: f.dataType for f in schema}
    cols, misfits = [], []
    for name, kind in declared.items():
        if name in rows.columns:
            raw = rows[f"`{name}`"]
            cols.append(raw.try_cast(kind).alias(name))
            misfits.append(F.when(raw.isNotNull() & raw.try_cast(kind).isNull(), raw).alias(name))
        else:
            cols.append(F.lit(None).cast(kind).alias(name))
    fresh = [rows[f"`{c}`"] for c in rows.columns if c not in declared]
    # JSON leaves NULL fields out, so a row without misfits gives an empty object.
    rescued = F.to_json(F.struct(*misfits)) if misfits else F.lit("{}")
    return rows.select(*cols, *fresh, F.when(rescued != "{}", rescued).alias(RESCUED))


def ingest_csv_by_name(
    spark: SparkSession, landing: str, path: str, checkpoint: str, schema: StructType, max_files: int = 100
) -> StreamingQuery:
    """Append the CSV files that have arrived to a table, each once, whatever order their columns have.

    A stream over the folder's listing hands on ``max_files`` names at a time; contents are not read
    to list them. A batch owns a partition of the table, so it may run again. Read the table with
    ``read_drifted``.
    """
    return _by_files(spark, landing, path, checkpoint, max_files, lambda files: schema)


def _by_files(spark, landing, path, checkpoint, max_files, schema_of) -> StreamingQuery:
    listing = "path string, modificationTime timestamp, length bigint, content binary"
    stream = spark.readStream.format("binaryFile").schema(listing).option("maxFilesPerTrigger", max_files)

    def handle(batch: DataFrame, batch_id: int) -> None:
        files = [r.path for r in batch.select("path").collect()]
        if files:
            # One partition of the table: the files' splits are its files, and nothing is shuffled.
            write_own(read_csv_by_name(spark, files, schema_of(files)), path, batch_id)

    return run_batches(stream.load(landing).select("path"), handle, checkpoint)


def read_drifted(spark: SparkSession, path: str) -> DataFrame:
    """The table with the columns of all batches."""
    return spark.read.option("mergeSchema", True).parquet(path).drop(BATCH)


# --- types found from what was delivered ----------------------------------------------------------


def _kind(value: Column) -> Column:
    """The narrowest type of a text; numbers that a type would change (leading zeros, too long) are text."""
    whole = value.rlike(r"^[+-]?(?:0|[1-9][0-9]*)$")
    number = value.rlike(r"^[+-]?(?:0|[1-9][0-9]*)?\.?[0-9]+(?:[eE][+-]?[0-9]+)?$") & ~value.rlike(r"^[+-]?[0-9]+$")
    day = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    return (
        F.when(whole & value.try_cast("int").isNotNull(), "int")
        .when(whole & value.try_cast("bigint").isNotNull(), "bigint")
        .when(number & value.try_cast("double").isNotNull(), "double")
        .when(value.rlike(f"{day}$") & value.try_cast("date").isNotNull(), "date")
        .when(value.rlike(f"{day}[ T][0-9]") & value.try_cast("timestamp").isNotNull(), "timestamp")
        .when(F.lower(value).isin("true", "false"), "boolean")
        .otherwise("string")
    )


def _join(kinds: Iterable[str]) -> str:
    return reduce(lambda a, b: a if a == b else _WIDER.get(frozenset({a, b}), "string"), sorted(kinds))


def widened_schema(
    spark: SparkSession, files: Sequence[str], known: StructType | None = None, lines: int = SAMPLE
) -> StructType:
    """The narrowest types that hold the first ``lines`` rows of every file, and what was ``known``.

    One distributed pass over the samples; the driver gets a row per column. Types only widen: whole
    numbers, long ones, doubles; dates, timestamps; everything meets in text. A column without any
    value is text until a value comes. Known columns stay first, new ones follow by place and name.
    """
    cells = sampled_cells(spark, files, lines)
    kinds = F.collect_set(F.when(F.col("value").isNotNull(), _kind(F.col("value")))).alias("kinds")
    found = {r.name: r for r in cells.groupBy("name").agg(kinds, F.min("position").alias("at")).collect()}
    types = {f.name: f.dataType.simpleString() for f in known or ()}
    unseen = {f.name for f in known or () if f.metadata.get("unseen")}
    for r in sorted(found.values(), key=lambda r: (r.at, r.name)):
        past = [types[r.name]] if r.name in types and r.name not in unseen else []
        if r.kinds or past:
            unseen.discard(r.name)
            types[r.name] = _join([*r.kinds, *past])
        else:
            unseen.add(r.name)
            types[r.name] = "string"
    return StructType(
        [
            StructField(name, DataType.fromDDL(kind), True, {"unseen": True} if name in unseen else None)
            for name, kind in types.items()
        ]
    )


def pinned_versions(spark: SparkSession, pin: str) -> list[StructType]:
    """All versions of the types kept at ``pin``, oldest first."""
    try:
        stored = spark.read.schema("version int, schema string").parquet(pin).distinct().orderBy("version").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [StructType.fromJson(json.loads(r.schema)) for r in stored]


def ingest_csv_found(
    spark: SparkSession, landing: str, path: str, checkpoint: str, pin: str, max_files: int = 100, lines: int = SAMPLE
) -> StreamingQuery:
    """Append the CSV files that have arrived, each once, without any declared schema.

    The table holds the text as it was delivered, so a wider type rewrites nothing. Where a batch's
    samples widen a type or bring a column, a new version of the types is kept at ``pin``; one that comes
    again finds its version there. One stream writes to a pin. Read the table with ``read_found``.
    """

    def no_types(files: Sequence[str]) -> StructType:
        versions = pinned_versions(spark, pin)
        wider = widened_schema(spark, files, versions[-1] if versions else None, lines)
        if not versions or wider != versions[-1]:
            row = [(len(versions), wider.json())]
            spark.createDataFrame(row, "version int, schema string").coalesce(1).write.mode("append").parquet(pin)
        return StructType()

    return _by_files(spark, landing, path, checkpoint, max_files, no_types)


def read_found(spark: SparkSession, path: str, pin: str, version: int = -1) -> DataFrame:
    """The table in the types of a version, the newest by default.

    A value that no sample held and its type cannot hold is NULL, and its text is in RESCUED.
    """
    schema = pinned_versions(spark, pin)[version]
    return _typed(spark.read.schema(_text(schema.names)).parquet(path).drop(BATCH), schema)
