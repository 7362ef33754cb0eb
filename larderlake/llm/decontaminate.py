"""Benchmark decontamination: n-gram windows of test items, found and verified in training texts.

The windows of the benchmark are hashed and broadcast as a set, in blocks of a bounded number of
windows, so a benchmark of any size fits; every block scans all documents. A document is tokenised
once per block, windows roll over its word hashes, and each hit of the hash set is verified on the
words themselves.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderlake.llm.spans import splice
from larderlake.llm.tables import free_name, keep
from larderlake.llm.words import LETTERS, code_points, hashed_words, windows

#: Consecutive words that make a window; a shorter item is one window as a whole.
WINDOW = 10
#: Windows broadcast at once; about 300 bytes each in a task's memory.
MAX_WINDOWS = 200_000
#: What takes the place of a removed span. It counts as a word, so that no window forms across it.
CUT = " … "

LEAKS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType([T.StructField(n, T.IntegerType()) for n in ("word", "word_end", "start", "end")])
            ),
        ),
    ]
)
_SPAN = pa.struct([(n, pa.int32()) for n in ("word", "word_end", "start", "end")])
_LEAKS = pa.struct(
    [("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(_SPAN))]
)


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct (item, n, hash, words) of a benchmark: ``words`` are the ``n`` words of a window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for first, w in hashed_words(batch.column(1), LETTERS):
                for row in range(len(w.bounds) - 1):
                    a, b = int(w.bounds[row]), int(w.bounds[row + 1])
                    n = min(size, b - a)
                    if n:
                        found = w.text(a, b)
                        name = batch.column(0)[first + row].as_py()
                        for i, h in enumerate(windows(w.hashes[a:b], n).view(np.int64)):
                            out.append((name, n, int(h), " ".join(found[i : i + n])))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            types = (pa.string(), pa.int32(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["item", "n", "hash", "words"]
            )

    rows = benchmark.select(benchmark[f"`{item}`"].cast("string").alias("item"), benchmark[f"`{text}`"].alias("text"))
    return rows.mapInArrow(cut, "item string, n int, hash long, words string").distinct()


class _Block(NamedTuple):
    """Windows of one block: sorted hashes by length, and the words and items behind each hash."""

    hashes: dict[int, np.ndarray]
    behind: dict[tuple[int, int], list[tuple[str, list[str]]]]

    @classmethod
    def of(cls, rows) -> _Block:
        by_length, behind = defaultdict(set), defaultdict(lambda: defaultdict(list))
        for r in rows:
            by_length[r["n"]].add(r["hash"])
            behind[r["n"], r["hash"]][r["words"]].append(r["item"])
        return cls(
            {n: np.sort(np.array(list(h), dtype=np.int64).view(np.uint64)) for n, h in by_length.items()},
            {k: list(v.items()) for k, v in behind.items()},
        )


class _Filter:
    """A bit per low end of a hash: most windows are dismissed by one look."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = hashes
        bits = max(16, int(len(hashes)).bit_length() + 6)
        self.mask = np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[hashes & self.mask] = True

    def hits(self, found: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.table[found & self.mask])
        at = np.searchsorted(self.hashes, found[maybe])
        at[at == len(self.hashes)] = 0
        return maybe[self.hashes[at] == found[maybe]]


def _union(spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Runs of hit words; runs that touch become one."""
    out: list[tuple[int, int, int, int]] = []
    for word, word_end, start, end in sorted(spans):
        if out and word <= out[-1][1]:
            if word_end > out[-1][1]:
                out[-1] = (out[-1][0], word_end, out[-1][2], end)
        else:
            out.append((word, word_end, start, end))
    return out


def _scan(docs: DataFrame, text: str, out: str, rows, again: bool) -> DataFrame:
    """Adds or extends the column of leaks by the windows of one block."""
    shared = docs.sparkSession.sparkContext.broadcast(_Block.of(rows))
    at, schema = docs.columns.index(text), docs.schema if again else T.StructType([*docs.schema, T.StructField(out, LEAKS)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        filters = {n: _Filter(h) for n, h in block.hashes.items()}
        for batch in batches:
            before = batch.column(batch.num_columns - 1).to_pylist() if again else None
            leaks: list[tuple] = []
            for _, w in hashed_words(batch.column(at), LETTERS):
                spans, items = defaultdict(list), defaultdict(set)
                words: dict[int, list[str]] = {}
                points: dict[int, np.ndarray] = {}
                for n, known in filters.items():
                    hashes = windows(w.hashes, n)
                    hits = known.hits(hashes)
                    rows = np.searchsorted(w.bounds, hits, side="right") - 1
                    inside = hits + n <= w.bounds[rows + 1]
                    for row, pos in zip(rows[inside].tolist(), hits[inside].tolist(), strict=True):
                        a, b = int(w.bounds[row]), int(w.bounds[row + 1])
                        if row not in words:
                            words[row] = w.text(a, b)
                            points[row] = code_points(w.data[w.offsets[row] : w.offsets[row + 1]])
                        seen = " ".join(words[row][pos - a : pos - a + n])
                        for found, of in block.behind[n, int(hashes[pos : pos + 1].view(np.int64)[0])]:
                            if found == seen:
                                start, end = w.starts[pos] - w.offsets[row], w.ends[pos + n - 1] - w.offsets[row]
                                spans[row].append((pos - a, pos - a + n, int(points[row][start]), int(points[row][end])))
                                items[row].update(of)
                for row, n in enumerate(np.diff(w.bounds).tolist()):
                    leaks.append((n, spans.get(row, []), items.get(row, set())))
            if before:
                leaks = [
                    (n, s + [tuple(x.values()) for x in old["spans"]], i | set(old["items"]))
                    for (n, s, i), old in zip(leaks, before, strict=True)
                ]
            found = [
                {"n_words": n, "n_hit": sum(x[1] - x[0] for x in s), "items": sorted(i), "spans": [_named(x) for x in s]}
                for n, s, i in ((n, _union(s), i) for n, s, i in leaks)
            ]
            columns = batch.columns[:-1] if again else batch.columns
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _LEAKS)], names=schema.names)

    return docs.mapInArrow(scan, schema)


def _named(x: tuple[int, int, int, int]) -> dict[str, int]:
    return dict(zip(("word", "word_end", "start", "end"), x, strict=True))


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    out: str = "leaks",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    size: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
) -> DataFrame:
    """All columns of the documents and ``out``: n_words, n_hit, items found, and spans hit.

    A word is hit if it lies in any occurrence of a window of any item. Spans name words and code
    points, ends exclusive. A null or empty text has no words; a null or empty item, or a benchmark
    without rows, has no windows. Repeated rows are scanned each on its own, repeated items count
    once. Other columns pass through; ``out`` must be a new name.
    """
    found = keep(benchmark_windows(benchmark, item, item_text, size), "windows")
    blocks = max(1, -(-found.count() // max_windows))
    found = found.withColumn("block", F.pmod(F.xxhash64("hash", "words", "item"), F.lit(blocks)))
    for block in range(blocks):
        rows = found.where(F.col("block") == block).select("item", "n", "hash", "words").collect()
        docs = _scan(docs, text, out, rows, again=block > 0)
        if blocks > 1:
            docs = keep(docs, "leaks")
    return docs


def drop_documents(docs: DataFrame, benchmark: DataFrame, min_hit: int = 1, **options) -> DataFrame:
    """The documents with fewer than ``min_hit`` hit words, columns as they were."""
    leaks = free_name(docs, "leaks")
    found = find_leaks(docs, benchmark, leaks, **options)
    return found.where(F.col(leaks)["n_hit"] < min_hit).drop(leaks)


def cut_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """All documents, with each hit span replaced by CUT; texts without a hit stay as they are."""
    leaks = free_name(docs, "leaks")
    found = find_leaks(docs, benchmark, leaks, text, **options)
    return found.withColumn(text, splice(F.col(f"`{text}`"), F.col(leaks)["spans"], lambda s: F.lit(CUT))).drop(leaks)
