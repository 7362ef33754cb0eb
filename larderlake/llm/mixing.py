"""Mixing sources to target weights by balanced sampling: the cube method.

Every source has a target in words, at most twice its size. A document enters the mix a whole
number of times plus a fraction, its inclusion probability. The flight phase moves the
probabilities of a few documents at a time through the null space of the constraints (number of
documents, number of words): totals stay as they are, and each move fixes one document. Blocks of
documents fly on their own and leave a few undecided ones, which meet in larger rounds until a
source has one block. The last few documents of a source are landed together: of all choices the
one that misses the totals least.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larderlake.llm.tables import empty_or_null, free_name, keep, repeated
from larderlake.llm.words import VISIBLE, hashed_words

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Size of the mix as a share of all words, and of a source's part as a share of the source.
SHARE, MOST = 1.5, 2
#: Documents that fly together.
BLOCK = 4096
#: Documents of a source that are landed by trying all choices, besides the two that a flight leaves.
LANDING = 12
#: Chooses among the balanced mixes; the same seed gives the same mix.
SEED = 17
#: Probabilities this near to 0 or 1 are decided.
_EPS = 1e-9

_UNIT = "source string, id long, number int, size long, seed long, p double"
_UNIT_COLUMNS = ("source", "id", "number", "size", "seed", "p")


def sizes(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, source, size): words of each document, runs of what isn't ASCII white space; 0 for a null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.diff(w.bounds) for _, w in hashed_words(batch.column(2), VISIBLE)]
            size = pa.array(np.concatenate([*n, np.zeros(0, dtype=np.int64)]), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), size], names=["id", "source", "size"])

    rows = docs.select(
        docs[f"`{id}`"].cast("long").alias("id"),
        docs[f"`{source}`"].cast("string").alias("source"),
        empty_or_null(docs[f"`{text}`"]).alias("text"),
    )
    return rows.mapInArrow(count, "id long, source string, size long")


def targets(found: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target, docs) of (id, source, size).

    Sources in code point order, null last, share ``share`` of all words by weight. Those that would
    get more than ``most`` of their size stop there, and the others share what is left: in order of
    size by weight the full ones come first, so running sums find where they end.
    """
    rows = found.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place + 1).cast("int"))
    rows = rows.withColumn("weight", weight).withColumn("most", F.col("source_size") * float(most))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").isNull(), "source").rowsBetween(
        Window.unboundedPreceding, -1
    )
    budget = F.sum("source_size").over(every) * share
    left = budget - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    # What a weight of one would get if all earlier sources are full and no other.
    rows = rows.withColumn("rate", left / weights_left)
    rows = rows.withColumn("full", F.col("rate") * F.col("weight") >= F.col("most"))
    # The first that isn't full has the largest rate of these.
    rate = F.max(F.when(~F.col("full"), F.col("rate"))).over(every)
    target = F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * rate)
    return rows.select("source", "source_size", target.alias("target"), "docs")


def fly(sizes_: np.ndarray, p: np.ndarray, draws: np.ndarray, land: bool, hold: bool = False) -> np.ndarray:
    """Probabilities after the flight; all are 0 or 1 if it lands.

    Sums of ``p`` and of ``p * size`` stay while flying. ``draws`` decides the direction of the move
    after which a document is the next to enter. LANDING documents stay on the ground if ``hold`` is
    set, undecided; to land, they and the one or two that the flight leaves are decided together.
    """
    q = np.clip(p.astype(float), 0.0, 1.0).tolist()
    s, draws = sizes_.astype(float).tolist(), draws.tolist()
    waiting = [i for i in range(len(q)) if _EPS < q[i] < 1 - _EPS]
    ground = _grounded(waiting, s) if land or hold else []
    waiting = [i for i in waiting if i not in ground]
    active: list[int] = []
    for i in waiting:
        active.append(i)
        if len(active) < 3:
            continue
        u = _direction(*(s[i] for i in active))
        moves = [(i, v) for i, v in zip(active, u, strict=True) if v]
        up = min((1 - q[i]) / v if v > 0 else -q[i] / v for i, v in moves)
        down = min(q[i] / v if v > 0 else (q[i] - 1) / v for i, v in moves)
        step = up if draws[active[-1]] * (up + down) < down else -down
        for i, v in moves:
            q[i] += step * v
            if q[i] < _EPS or q[i] > 1 - _EPS:
                q[i] = float(q[i] > 0.5)
        active = [i for i in active if 0.0 < q[i] < 1.0]
    out = np.array(q)
    out[(out < _EPS) | (out > 1 - _EPS)] = np.round(out[(out < _EPS) | (out > 1 - _EPS)])
    if land:
        left = np.array(active + ground, dtype=int)
        out[left] = _landed(sizes_[left].astype(float), out[left])
    return out


def _grounded(waiting: list[int], s: list[float]) -> list[int]:
    """The longest documents, which shorter ones cannot make up for, and as many others."""
    longest = sorted(waiting, key=lambda i: -s[i])[: LANDING // 2]
    others = [i for i in waiting if i not in longest]
    return longest + others[max(0, len(others) - LANDING // 2) :]


def _direction(a: float, b: float, c: float) -> tuple[float, float, float]:
    """A move of three documents that changes neither their number nor their words."""
    return (c - b, a - c, b - a) if a != b or b != c else (1.0, -1.0, 0.0)


def _landed(s: np.ndarray, p: np.ndarray) -> np.ndarray:
    """The choice of a few documents that misses their totals of words and documents least."""
    choices = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
    off = choices - p
    return choices[np.argmin(np.abs(off @ s) + np.abs(off.sum(axis=1)))]


def _flight(units: DataFrame, land: bool) -> DataFrame:
    def block(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["seed", "id", "number", "size"], ignore_index=True)
        draws = (group["seed"].to_numpy() & 0xFFFFFFFF) / 2.0**32
        # One block of a source keeps documents for the landing.
        hold = int(group["block"].iloc[0]) == 0
        group["p"] = fly(group["size"].to_numpy(), group["p"].to_numpy(), draws, land, hold)
        return group[list(_UNIT_COLUMNS)]

    return units.groupBy("source", "block").applyInPandas(block, _UNIT)


def mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED, **plan) -> DataFrame:
    """(id, source, number, size, source_size, target, copies) for every row: how often the mix takes it.

    Sources are strata of their own, rows without source too. A source's taken words differ from its
    target by a few words where it has more than a few documents; no document is taken more often than its target's ratio rounded
    up. Repeated rows are units of their own, numbered from 1; rows without id are taken like others.
    Documents of size 0 count as documents and add no words. Other columns are not read.
    """
    found = sizes(docs, id, text, source).groupBy("source", "id", "size").agg(F.count("*").alias("rows"))
    found = keep(found, "sizes")
    every = found.select("source", "id", "size", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("number"))
    shares = keep(targets(every, **plan), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + _EPS)
    units = _with_source(every, shares).select(
        "source",
        "id",
        "number",
        "size",
        F.xxhash64(F.lit(seed), "id", "number", "size").alias("seed"),
        F.greatest(ratio - whole, F.lit(0.0)).alias("p"),
        "docs",
    )
    most = shares.agg(F.max("docs")).first()[0] or 0
    decided = []
    while True:
        last = most <= BLOCK
        block = F.pmod(F.xxhash64("seed", F.lit(int(most))), F.ceil(F.col("docs") / BLOCK)).cast("long").alias("block")
        flown = keep(_flight(units.select(*_UNIT_COLUMNS, block), land=last), "flown")
        decided.append(flown.where("p = 0 or p = 1"))
        if last:
            break
        # A block leaves at most two undecided documents, and the first those for the landing.
        most = 2 * -(-most // BLOCK) + LANDING
        left = flown.where("p > 0 and p < 1")
        units = _with_source(left, keep(left.groupBy("source").agg(F.count("*").alias("docs")), "left"))
    taken = _with_source(reduce(DataFrame.unionByName, decided), shares)
    copies = (whole + F.col("p")).cast("int").alias("copies")
    return taken.select(F.col("id").alias(id), "source", "number", "size", "source_size", "target", copies)


def _with_source(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    named = by_source.withColumnRenamed("source", "of")
    return rows.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def take(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", copy: str = "copy", **options) -> DataFrame:
    """The mix itself: documents as often as they are taken, numbered from 1 in a new column ``copy``."""
    found = mix(docs, id, text, source, **options).where("copies > 0")
    keys = [free_name(docs, k) for k in ("of_id", "of_source", "of_size", "of_number", "copies")]
    found = found.select(*(F.col(c).alias(k) for c, k in zip((id, "source", "size", "number", "copies"), keys, strict=True)))
    size, number = free_name(docs, "words"), free_name(docs, "number")
    rows = docs
    same = docs[f"`{id}`"].cast("long").eqNullSafe(F.col(keys[0]))
    if repeated(docs, id):
        words = F.regexp_count(empty_or_null(docs[f"`{text}`"]), F.lit(r"[^\x20\x09-\x0D]+"))
        rows = docs.withColumn(size, words.cast("long"))
        twins = Window.partitionBy(f"`{id}`", f"`{source}`", size).orderBy(F.xxhash64(f"`{text}`"))
        rows = rows.withColumn(number, F.row_number().over(twins))
        same = F.col(f"`{id}`").cast("long").eqNullSafe(F.col(keys[0]))
        same &= F.col(f"`{source}`").eqNullSafe(F.col(keys[1])) & (F.col(size) == F.col(keys[2]))
        same &= F.col(number) == F.col(keys[3])
    copies = F.explode(F.sequence(F.lit(1), F.col(keys[4]))).alias(copy)
    return rows.join(found, same).select(*(F.col(f"`{c}`") for c in docs.columns), copies)
