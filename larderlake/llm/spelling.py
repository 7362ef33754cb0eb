"""Spelling variants: words one edit apart, each led to its most frequent form.

A pair of words one edit apart shares the first or the last half of the shorter one, so words meet
in groups by half and length. Inside a task a block of words is a bit-sliced index: for a position
and a letter, one bit for each word that has it there. A query walks along its letters and keeps two
sets of words as bits, those that agree so far and those one error away, with the index shifted by
a position for an inserted or deleted letter; a step does 64 words at a time, and many queries at
once. A group larger than a block is cut into blocks by hash, and its queries are sent to each.

Only counts and best neighbours leave a task, a row for each word and block, no pairs.

Defined results: null and empty texts have no words; a null id is written as nothing in the hash of
a run; repeated rows count again; other columns are ignored; no words give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larderlake.llm.tables import column, keep

# --- fixed values: letters of words, words worth a form, and how much more frequent a form is ----
RUN = r"[a-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, TIMES = 5, 3, 2
# --------------------------------------------------------------------------------------------------

#: Words whose bits stand side by side, and letters of them; longer words stand in smaller blocks.
BLOCK, BLOCK_LETTERS = 4096, 1 << 20
LEAST_BLOCK = 64
#: Queries that walk together.
STEP = 512


def runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, run): every run of letters of the whole texts, A-Z in lower case."""
    lower = F.translate(F.coalesce(column(docs, text, "string"), F.lit("")), UPPER, LOWER)
    return docs.select(
        F.coalesce(column(docs, id, "string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(lower, F.lit(RUN), F.lit(0))).alias("run"),
    )


def count_words(runs: DataFrame, word: Column) -> DataFrame:
    """(word, n) of words long and frequent enough."""
    counted = runs.select(word.alias("word")).where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def _capacity(length: Column) -> Column:
    return F.greatest(F.lit(LEAST_BLOCK), F.least(F.lit(BLOCK), F.floor(F.lit(BLOCK_LETTERS) / length).cast("int")))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): how many words are one edit apart, and the most frequent of them.

    ``words`` are different words of at least MIN_LENGTH code points up to U+00FF, with their counts.
    """
    n = F.length("word")
    sizes = F.when(n > MIN_LENGTH, F.array(n - 1, n)).otherwise(F.array(n))
    halves = words.withColumn("size", F.explode(sizes)).withColumn("half", F.floor(F.col("size") / 2).cast("int"))
    sides = F.array(
        F.struct(F.lit(0).alias("side"), F.substr("word", F.lit(1), F.col("half")).alias("key")),
        F.struct(F.lit(1).alias("side"), F.substr("word", F.length("word") - F.col("size") + F.col("half") + 1).alias("key")),
    )
    keyed = halves.select("word", "n", "size", F.inline(sides))
    large = keep(
        keyed.groupBy("size", "side", "key").agg(F.count("*").alias("members")).where(F.col("members") > _capacity(F.col("size"))),
        "large",
    )
    # A small group is one block of both words and queries. In a large one each word lies in one block, and asks in all.
    cut = F.ceil(F.col("members") / _capacity(F.col("size"))).cast("int")
    place = F.when(F.col("members").isNull(), F.array(F.struct(F.lit(0).alias("block"), F.lit(0).alias("use")))).otherwise(
        F.concat(
            F.array(F.struct(F.pmod(F.xxhash64("word"), cut).cast("int").alias("block"), F.lit(1).alias("use"))),
            F.transform(F.sequence(F.lit(0), cut - 1), lambda b: F.struct(b.alias("block"), F.lit(2).alias("use"))),
        )
    )
    placed = keyed.join(large, ["size", "side", "key"], "left").select("word", "n", "size", "side", "key", F.inline(place))
    group = ["size", "side", "key", "block"]
    found = placed.repartition(*group).sortWithinPartitions(*group, "use").mapInArrow(_meet, "word string, near long, form string, form_n long")
    best = F.struct((-F.col("form_n")).alias("less"), F.col("form"))
    merged = found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(best).alias("best")).withColumnRenamed("word", "w")
    return words.join(merged, words["word"] == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


class _Block:
    """Words of one length and the next as bits, for groups that end at the given places."""

    def __init__(self, size: int, side: int, words: list[bytes], counts: np.ndarray, groups: np.ndarray):
        self.size, self.side, self.counts, self.groups = size, side, counts, groups
        self.words, self.letters, self.lengths = words, _letters(words, size + 1), np.array([len(w) for w in words])
        self.bytes = -(-len(words) // 64) * 8
        # The best neighbour has the largest count, then the least word.
        order = sorted(range(len(words)), key=lambda i: (-counts[i], words[i]))
        self.rank = np.empty(len(words), dtype=np.int64)
        self.rank[order] = np.arange(len(words))
        self.order = order
        self.short, self.long = self._bits(self.lengths == size), self._bits(self.lengths == size + 1)
        # A bit for each word that has the letter at the position; row 0 of a position is no word.
        self.index, self.rows = [], []
        for i in range(size + 1):
            kinds = np.unique(self.letters[:, i])
            row = np.zeros(257, dtype=np.int64)
            row[kinds[kinds > 0]] = np.arange(1, (kinds > 0).sum() + 1)
            bits = self._bits(self.letters[:, i][None, :] == kinds[kinds > 0][:, None])
            self.index.append(np.concatenate([np.zeros((1, self.bytes // 8), dtype=np.uint64), bits]))
            self.rows.append(row)

    def _bits(self, mask: np.ndarray) -> np.ndarray:
        packed = np.packbits(mask, axis=-1, bitorder="little")
        wide = np.zeros((*packed.shape[:-1], self.bytes), dtype=np.uint8)
        wide[..., : packed.shape[-1]] = packed
        return wide.view(np.uint64)

    def _at(self, position: int, letters: np.ndarray) -> np.ndarray:
        return self.index[position][self.rows[position][letters]]

    def same_length(self, q: np.ndarray) -> np.ndarray:
        """Words of the queries' length and one more that are one edit away; queries have ``size`` letters."""
        none = np.tile(self.short | self.long, (len(q), 1))
        one, inserted = np.zeros_like(none), np.zeros_like(none)
        for i in range(self.size):
            here = self._at(i, q[:, i])
            inserted = (inserted | none) & self._at(i + 1, q[:, i])
            one = (one & here) | (none & ~here)
            none = none & here
        return (one & self.short) | ((inserted | none) & self.long)

    def shorter(self, q: np.ndarray) -> np.ndarray:
        """Words one letter shorter that are one deletion away; queries have ``size + 1`` letters."""
        none = np.tile(self.short, (len(q), 1))
        deleted = np.zeros_like(none)
        for i in range(self.size + 1):
            before = none
            if i:
                deleted = deleted & self._at(i - 1, q[:, i])
            none = none & self._at(i, q[:, i])
            deleted = deleted | before
        return deleted

    def answer(self, words: list[bytes], groups: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
        """(query, neighbours of its group found first on this side, place of the best) where there are any."""
        letters, lengths = _letters(words, self.size + 1), np.array([len(w) for w in words])
        half = self.size // 2
        for length, meet in ((self.size, self.same_length), (self.size + 1, self.shorter)):
            asked = np.flatnonzero(lengths == length)
            for first in range(0, len(asked), STEP):
                some = asked[first : first + STEP]
                bits = meet(letters[some]).view(np.uint8)
                at, word = np.nonzero(np.unpackbits(bits, axis=1, count=len(self.words), bitorder="little"))
                query = some[at]
                mine = groups[query] == self.groups[word]
                if self.side:
                    # Pairs that share the first half as well were found there.
                    mine &= (letters[query, :half] != self.letters[word, :half]).any(axis=1)
                query, word = query[mine], word[mine]
                if not len(query):
                    continue
                starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
                best = np.minimum.reduceat(self.rank[word], starts)
                sums = np.diff(np.r_[starts, len(query)])
                for i, near, rank in zip(query[starts].tolist(), sums.tolist(), best.tolist()):
                    yield words[i], near, self.order[rank]


def _letters(words: list[bytes], width: int) -> np.ndarray:
    """A row of letters for each word, 0 after its end."""
    return np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small groups share a block; a block of a large group answers its queries as they come."""
    words: list[bytes] = []
    counts: list[int] = []
    groups: list[int] = []
    shape = group = None
    number, limit = 0, BLOCK
    block: _Block | None = None
    asking: list[bytes] = []

    def answers(block: _Block, queries: list[bytes], of: np.ndarray) -> Iterator[pa.RecordBatch]:
        found = list(block.answer(queries, of))
        if found:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([w.decode("latin-1") for w, _, _ in found], pa.string()),
                    pa.array([near for _, near, _ in found], pa.int64()),
                    pa.array([block.words[i].decode("latin-1") for _, _, i in found], pa.string()),
                    pa.array([int(block.counts[i]) for _, _, i in found], pa.int64()),
                ],
                names=["word", "near", "form", "form_n"],
            )

    def build() -> _Block:
        return _Block(*shape, words, np.array(counts, dtype=np.int64), np.array(groups, dtype=np.int64))

    def finish() -> Iterator[pa.RecordBatch]:
        """Answer what waits: queries of a large group's block, else all groups of a shared block."""
        nonlocal block
        if block is not None:
            if asking:
                yield from answers(block, asking, np.full(len(asking), block.groups[0]))
            asking.clear()
        elif words:
            yield from answers(build(), words, np.array(groups, dtype=np.int64))
        block = None
        words.clear(), counts.clear(), groups.clear()

    for batch in batches:
        columns = [batch.column(name).to_pylist() for name in ("size", "side", "key", "block", "use", "word", "n")]
        for size, side, key, part, use, word, n in zip(*columns):
            if (size, side, key, part) != group:
                if use or block is not None or shape != (size, side) or len(words) >= limit:
                    yield from finish()
                if shape != (size, side):
                    limit = max(LEAST_BLOCK, min(BLOCK, BLOCK_LETTERS // size))
                shape, group, number = (size, side), (size, side, key, part), number + 1
            encoded = word.encode("latin-1")
            if use < 2:
                words.append(encoded), counts.append(n), groups.append(number)
                continue
            if not words:
                continue  # no word fell into this block
            if block is None:
                block = build()
            asking.append(encoded)
            if len(asking) >= STEP:
                yield from answers(block, asking, np.full(len(asking), block.groups[0]))
                asking.clear()
    yield from finish()


def forms(near: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a form is the most frequent near word if it is frequent enough.

    A form has at least TIMES the count of its word, so roads to the roots are as short as the
    logarithm of the largest count; each round doubles the part that is known.
    """
    enough = F.col("form_n") >= TIMES * F.col("n")
    words = keep(
        near.select("word", F.when(enough, F.col("form")).alias("form"), "n", "n_near", F.when(enough, F.col("form_n")).alias("form_n")),
        "forms",
    )
    roads = words.where("form is not null").select("word", F.col("form").alias("root"))
    moved = True
    while moved:
        ahead = roads.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roads = keep(roads.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roads")
        moved = not roads.where("moved").isEmpty()
        roads = roads.select("word", "root")
    roots = roads.withColumnRenamed("word", "w")
    return words.join(roots, words["word"] == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def group_variants(counted: DataFrame) -> DataFrame:
    """Forms and roots of counted words (word, n)."""
    return forms(near_words(keep(counted, "words")))
