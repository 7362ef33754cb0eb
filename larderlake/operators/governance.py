"""Row filters and column masks, applied when a viewer reads; marts are built unfiltered."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larderlake.sources.tables import replace_table

#: Groups that see everything where a deployment names no others.
PRIVILEGED = frozenset({"admins", "engineers"})

#: What replaces a masked text, and the names of the SQL functions below.
MASKED_TEXT = "### MASKED ###"


@dataclass(frozen=True)
class Viewer:
    user: str
    groups: frozenset[str] = frozenset()
    all_seeing: frozenset[str] = PRIVILEGED

    @classmethod
    def of(cls, user: str, *groups: str, all_seeing: Iterable[str] = PRIVILEGED) -> Viewer:
        return cls(user, frozenset(groups), frozenset(all_seeing))

    @property
    def privileged(self) -> bool:
        return bool(self.groups & self.all_seeing)


def load_user_regions(
    spark: SparkSession, pairs: Iterable[tuple[str, str]], path: str | None = None
) -> DataFrame:
    """The (user, region) grants; replaces the stored table when a path is given."""
    table = spark.createDataFrame(list(pairs), "user_id string, assigned_region string")
    if path is None:
        return table
    replace_table(table, path)
    return spark.read.parquet(path)


def row_filter(df: DataFrame, region_col: str, mapping: DataFrame, viewer: Viewer) -> DataFrame:
    """Rows of the regions a viewer is assigned.

    A semi join, so repeated grants do not repeat rows. Without a grant nothing is visible, and
    neither are rows without a region. Privileged viewers skip the join altogether.
    """
    if viewer.privileged:
        return df
    allowed = mapping.filter(F.col("user_id") == viewer.user).select(
        F.col("assigned_region").alias("__allowed")
    )
    return df.join(allowed, F.col(region_col) == F.col("__allowed"), "left_semi")


def mask_string(col: str, privileged: bool) -> Column:
    """The value, or the mask text. NULLs are masked too, so a mask does not tell them apart."""
    return (F.col(col) if privileged else F.lit(MASKED_TEXT)).alias(col)


def mask_date(col: str, privileged: bool) -> Column:
    """The date, or NULL."""
    return (F.col(col) if privileged else F.lit(None).cast("date")).alias(col)


@dataclass(frozen=True)
class TablePolicy:
    """Who may see what of one table."""

    region_col: str | None = None
    text_columns: Sequence[str] = ()
    date_columns: Sequence[str] = ()


def apply_masks(df: DataFrame, policy: TablePolicy, viewer: Viewer) -> DataFrame:
    """Mask a table's personal columns. Masked columns become constants, so scans skip them."""
    if viewer.privileged:
        return df
    masks = {c: mask_string(c, False) for c in policy.text_columns if c in df.columns}
    masks |= {c: mask_date(c, False) for c in policy.date_columns if c in df.columns}
    return df.withColumns(masks) if masks else df


def secure_read(
    df: DataFrame,
    table: str,
    policies: Mapping[str, TablePolicy],
    mapping: DataFrame,
    viewer: Viewer,
) -> DataFrame:
    """What ``viewer`` sees of ``table``: its row filter first, then its masks."""
    policy = policies.get(table)
    if policy is None:
        return df
    if policy.region_col:
        df = row_filter(df, policy.region_col, mapping, viewer)
    return apply_masks(df, policy, viewer)


def secure_views(
    tables: Mapping[str, DataFrame],
    policies: Mapping[str, TablePolicy],
    mapping: DataFrame,
    viewer: Viewer,
) -> None:
    """Register what ``viewer`` sees of each table under its name, for SQL in the viewer's session."""
    for name, df in tables.items():
        secure_read(df, name, policies, mapping, viewer).createOrReplaceTempView(name)


#: The grants as the SQL functions of a session see them.
GRANTS_VIEW = "user_region_grants"


def register_functions(spark: SparkSession, mapping: DataFrame, viewer: Viewer) -> None:
    """SQL functions of a viewer's session: ``region_filter``, ``mask_pii_string``, ``mask_pii_date``.

    The filter asks the grants in the moment it is used; in a WHERE clause it becomes a semi join,
    so no list of regions passes the driver, and grants stored later count.
    """
    everything = "true" if viewer.privileged else "false"
    mapping.select("user_id", "assigned_region").createOrReplaceTempView(GRANTS_VIEW)
    user = viewer.user.replace("\\", "\\\\").replace("'", "\\'")
    granted = f"EXISTS (SELECT 1 FROM {GRANTS_VIEW} g WHERE g.user_id = '{user}' AND g.assigned_region = region_name)"
    bodies = {
        "region_filter(region_name STRING) RETURNS BOOLEAN": "true" if viewer.privileged else granted,
        "mask_pii_string(value STRING) RETURNS STRING": (
            f"CASE WHEN {everything} THEN value ELSE '{MASKED_TEXT}' END"
        ),
        "mask_pii_date(value DATE) RETURNS DATE": f"CASE WHEN {everything} THEN value END",
    }
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
