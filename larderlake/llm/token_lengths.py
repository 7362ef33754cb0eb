"""Exact histogram of encoded lengths, and what it answers about context limits.

Texts are encoded once and aggregated by length. Sums from the longest down turn the histogram into
answers for every limit: how many texts reach it, how many tokens they hold, what is left of all
texts when each is cut there, and quantiles.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larderlake.llm.tables import empty_or_null, keep

# --- fixed value: how the vocabulary's own splitter cuts a text before the merges -----------------
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# --------------------------------------------------------------------------------------------------

#: White space in a row that the splitter's backtracking is spared; a fixed value of Unicode.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")
#: Bytes of a vocabulary file that is sent to the tasks at most.
MAX_VOCABULARY = 64 << 20
#: Lengths summed together first; the sums of these stretches are then run over.
STRETCH = 1024


def read_vocabulary(path: str) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a token in base 64 and its rank on each line."""
    with open(path, "rb") as file:
        data = file.read(MAX_VOCABULARY + 1)
    if len(data) > MAX_VOCABULARY:
        raise ValueError(f"{path} has more than {MAX_VOCABULARY} bytes")
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def encoded_length(encoding, text: str) -> int:
    """Tokens of a text of any length.

    The splitter takes white space before a word without its last character, and at the end of a text
    whole, as one piece. Long runs are cut off like that before it sees them: it would go back over
    each of their characters, and its stack has an end.
    """
    total = at = 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[at : run.start()]))
        total += len(encoding._encode_single_piece(text[run.start() : end].encode()))
        at = end
    return total + len(encoding.encode_ordinary(text[at:]))


def encoded_lengths(docs: DataFrame, vocabulary: dict[bytes, int], text: str = "text") -> DataFrame:
    """(length) of every row: tokens of its whole text, special tokens as plain text; 0 for a null."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        encoding = tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=shared.value, special_tokens={})
        for batch in batches:
            lengths = [encoded_length(encoding, x.as_py()) for x in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], names=["length"])

    return docs.select(empty_or_null(docs[f"`{text}`"]).alias("text")).mapInArrow(count, "length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """One row per length that occurs: length, docs, tokens, docs_from, tokens_from, truncated_total, share_to.

    ``docs_from`` and ``tokens_from`` count texts of this length and longer, ``truncated_total`` the
    tokens of all texts if each is cut to this length, ``share_to`` the share of texts that are not
    longer. No texts give no rows. Stretches of lengths are summed on their own before the running
    sum over stretches, so no task sees all lengths.
    """
    found = keep(lengths.groupBy("length").agg(F.count("*").alias("docs")), "lengths")
    found = found.withColumn("tokens", F.col("length") * F.col("docs"))
    found = found.withColumn("stretch", F.floor(F.col("length") / STRETCH))
    longer = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()

    def above(name: str, window) -> F.Column:
        return F.coalesce(F.sum(name).over(window), F.lit(0))

    stretches = found.groupBy("stretch").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    stretches = stretches.select(
        "stretch",
        above("docs", longer).alias("docs_above"),
        above("tokens", longer).alias("tokens_above"),
        F.sum("docs").over(every).alias("all_docs"),
        F.sum("tokens").over(every).alias("all_tokens"),
    )
    within = Window.partitionBy("stretch").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    rows = found.join(stretches, "stretch")
    rows = rows.withColumn("docs_from", F.sum("docs").over(within) + F.col("docs_above"))
    rows = rows.withColumn("tokens_from", F.sum("tokens").over(within) + F.col("tokens_above"))
    shorter = F.col("all_tokens") - F.col("tokens_from")
    return rows.select(
        "length",
        "docs",
        "tokens",
        "docs_from",
        "tokens_from",
        (shorter + F.col("length") * F.col("docs_from")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("docs")) / F.col("all_docs")).alias("share_to"),
    )


def at_limits(found: DataFrame, limits: list[int]) -> DataFrame:
    """(limit, docs_over, truncated_total) for any context limits, from a histogram; exact.

    A limit beyond the longest text cuts nothing.
    """
    spark: SparkSession = found.sparkSession
    wanted = spark.createDataFrame([(int(x),) for x in sorted(set(limits))], "limit long")
    # Each limit's rows of the histogram add up to its answers: one pass, one row per limit and task.
    cut = F.least("length", "limit") * F.col("docs")
    over = F.when(F.col("length") > F.col("limit"), F.col("docs")).otherwise(0)
    rows = found.select("length", "docs", F.explode(F.array(*(F.lit(int(x)) for x in sorted(set(limits))))).alias("limit"))
    sums = rows.groupBy("limit").agg(F.sum(over).alias("docs_over"), F.sum(cut).alias("truncated_total"))
    return wanted.join(sums.withColumn("limit", F.col("limit").cast("long")), "limit", "left").na.fill(0)


def quantile(found: DataFrame, share: float) -> int | None:
    """The least length that this share of texts does not exceed; null without texts."""
    return found.where(F.col("share_to") >= share).agg(F.min("length")).first()[0]
