"""Matches of regular expressions with their places, in DataFrame functions only.

Spark gives all matches of a pattern but not where they are. The pieces between matches come from
``split`` with the same pattern, and both scan alike, so places are running sums of lengths. All
places are in code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A match: kind, place and text.
MATCH = "array<struct<kind:string,start:int,end:int,found:string>>"


def no_matches() -> Column:
    return F.array().cast(MATCH)


def matches(text: Column, pattern: str, kind: str, gate: Column | None = None) -> Column:
    """All leftmost non-overlapping matches in a text, in order; none where the gate is not true.

    A gate is a cheap test that holds wherever the pattern can match; without it the pattern itself
    is tested first, so that only texts with a match are cut in pieces.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    folded = F.aggregate(
        F.arrays_zip(found.alias("found"), gaps.alias("gap")),
        F.struct(F.lit(0).alias("at"), no_matches().alias("out")),
        lambda acc, x: F.when(x["found"].isNull(), acc).otherwise(
            F.struct(
                (acc["at"] + x["gap"] + F.length(x["found"])).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            F.lit(kind).alias("kind"),
                            (acc["at"] + x["gap"]).alias("start"),
                            (acc["at"] + x["gap"] + F.length(x["found"])).alias("end"),
                            x["found"].alias("found"),
                        )
                    ),
                ).cast(MATCH).alias("out"),
            )
        ),
        lambda acc: acc["out"],
    )
    test = text.rlike(pattern) if gate is None else gate & text.rlike(pattern)
    return F.when(test, folded).otherwise(no_matches())


def place(span: Column, *before: Column) -> Column:
    return F.struct(*before, span["start"].alias("start"), span["end"].alias("end"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kind(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def overlaps(span: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < span["end"]) & (span["start"] < o["end"]))


def splice(text: Column, spans: Column, replacement) -> Column:
    """The text with each span replaced; overlapping spans become one, named after the first.

    ``spans`` are sorted by start. ``replacement`` makes a string column of a span.
    """
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        more = F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), replacement(s))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"]).otherwise(more).alias("out"),
        )

    end = lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, end)).otherwise(text)
