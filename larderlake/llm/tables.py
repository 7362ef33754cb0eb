"""Intermediate tables, names that cannot clash, and connected components."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``, else one in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return (shared or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package where the driver does, also if it isn't installed."""
    import larderlake

    root = os.path.dirname(os.path.dirname(os.path.abspath(larderlake.__file__)))
    paths = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, *paths) if p)
    return spark


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def column(df: DataFrame, name: str, kind: str):
    """The named column cast to a type, found by its exact name even where names contain dots."""
    return df[f"`{name}`"].cast(kind)


def empty_or_null(text):
    return F.coalesce(text, F.lit(""))


def repeated(docs: DataFrame, id: str) -> bool:
    """Whether any two rows share an id or have none."""
    return not docs.groupBy(docs[f"`{id}`"].alias("id")).count().where("count > 1").isEmpty()


def checked(small: DataFrame, most: int = 1_000_000) -> DataFrame:
    """Marks a narrow table for broadcast if it has at most so many rows; else joins shuffle as usual."""
    return F.broadcast(small) if small.count() <= most else small


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the undirected links; a component is named by its least node.

    Alternates two steps until nothing moves: every node hands its larger neighbours to the least
    neighbour it sees, then the smaller ones. Each step is one aggregation and one join by node,
    combined before the shuffle, so a node with very many links is no task of its own; the number
    of rounds grows with the logarithm of the longest path. Loops and repeated links do no harm;
    null ends are ignored. Every round is a written table.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    stars = keep(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    mark = _fingerprint(stars)
    while mark[0]:
        stars = keep(_small_star(_large_star(stars)), "links")
        before, mark = mark, _fingerprint(stars)
        if before == mark:
            break
    roots = stars.groupBy(F.col("b").alias("node")).agg(F.first("b").alias("component"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def merge_components(components: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links (a, b) between components; a text alone is a component of its own."""
    moved = keep(connected_components(links), "moved")
    old = components.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    old = old.select("node", F.coalesce("to", "component").alias("component"))
    return old.unionByName(moved.join(old.select("node"), "node", "left_anti"))


def _fingerprint(stars: DataFrame):
    total = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return stars.agg(F.count("*"), total).first()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
