"""Exact top-k search by BM25 over an inverted index in shards, with bounds by text.

Every shard (a segment of a few thousand texts) holds postings of its own. A query takes global
statistics into every shard. Two passes: the first looks through the short lists of every query's
rarest terms and scores the most promising texts in full. The k-th best of these, over all shards, is
a score that k texts reach, so the second pass begins with it everywhere. There a text's terms, from
common to rare, are added up: while their sum is below a share of that score, they alone cannot lift
the text there, and its postings are skipped. What the others bring near it is scored in full. The
tasks' best meet in an exact merge. Contributions are whole millionths, so sums, ties and merges don't
depend on any order.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larderlake.llm.tables import empty_or_null, keep
from larderlake.llm.words import LETTERS, hashed_words

K1, B = 1.2, 0.75
#: Texts of a segment, words of a segment, queries that are scored together.
SEGMENT, SEGMENT_WORDS, BLOCK = 4096, 1 << 22, 64
#: Postings that are added up together; a query with more is alone.
_POSTINGS = 1 << 17
#: Postings of a query's rarest terms that the first pass reads in a segment, besides one a term.
_PROBE = 1024
#: Classes of texts in a segment, of each of which the first pass tries one text for a query.
_CLASSES = 256
#: The share of the score to be reached that skipped postings of a text stay below; steps of such limits an octave.
_SKIPPED, _STEPS = 0.5, 4
#: Queries that are looked up, and whose best scores travel, together.
_GROUP = 256
#: Distinct words of all queries that are run at once; more queries run in further blocks.
BLOCK_TERMS = 1 << 21
#: Terms whose document frequencies travel together.
_STRETCH = 4096
_SEGMENT = "texts long, words long, ids binary, lengths binary, terms binary, offsets binary, docs binary, counts binary"


def index(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Segments of an inverted index, a row each. Rows without id are left out."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, hashes = [], [], []
        n_texts = n_words = 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            for first, w in hashed_words(batch.column(1), LETTERS):
                n = len(w.bounds) - 1
                at = 0
                while at < n:
                    # As many texts as fit; at least one.
                    room = min(SEGMENT - n_texts, n - at)
                    fits = int(np.searchsorted(w.bounds, w.bounds[at] + SEGMENT_WORDS - n_words, side="right")) - 1 - at
                    take = max(min(room, fits), 0 if n_texts else 1)
                    ids.append(keys[first + at : first + at + take])
                    lengths.append(np.diff(w.bounds[at : at + take + 1]))
                    hashes.append(w.hashes[w.bounds[at] : w.bounds[at + take]])
                    n_texts, n_words, at = n_texts + take, n_words + len(hashes[-1]), at + take
                    if at < n or n_texts >= SEGMENT or n_words >= SEGMENT_WORDS:
                        yield _segment(*(np.concatenate(x) for x in (ids, lengths, hashes)))
                        ids, lengths, hashes = [], [], []
                        n_texts = n_words = 0
        if n_texts:
            yield _segment(*(np.concatenate(x) for x in (ids, lengths, hashes)))

    rows = docs.select(docs[f"`{id}`"].cast("long").alias("id"), empty_or_null(docs[f"`{text}`"]).alias("text"))
    return rows.where("id is not null").mapInArrow(build, _SEGMENT)


def _segment(ids: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """Postings by term, from the terms that most texts of the segment have to the rarest."""
    doc = np.repeat(np.arange(len(ids)), lengths)
    codes, terms = pd.factorize(hashes)
    keys, counts = np.unique(codes * len(ids) + doc, return_counts=True)
    term, doc = np.divmod(keys, max(1, len(ids)))
    df = np.bincount(term, minlength=len(terms))
    by_df = np.lexsort((terms, -df))
    sort = _ranges((np.cumsum(df) - df)[by_df], df[by_df])
    offsets = np.concatenate(([0], np.cumsum(df[by_df])))
    blobs = (ids, lengths, terms[by_df], offsets, doc[sort], counts[sort])
    kinds = (np.int64, np.int32, np.uint64, np.int64, np.int32, np.int32)
    columns = [pa.array([x.astype(k).tobytes()], pa.binary()) for x, k in zip(blobs, kinds, strict=True)]
    sums = [pa.array([len(ids)], pa.int64()), pa.array([int(lengths.sum())], pa.int64())]
    return pa.RecordBatch.from_arrays([*sums, *columns], names=[c.split()[0] for c in _SEGMENT.split(", ")])


class _Asked(NamedTuple):
    """A block of queries: query i asks for ``terms[bounds[i]:bounds[i + 1]]``, places in the vocabulary, rarest first."""

    queries: np.ndarray
    terms: np.ndarray
    bounds: np.ndarray

    def parts(self) -> Iterator[tuple[int, _Asked]]:
        """A few hundred queries at a time, with the number of the first."""
        for first in range(0, len(self.queries), _GROUP):
            bounds = self.bounds[first : first + _GROUP + 1]
            yield first, _Asked(self.queries[first : first + _GROUP], self.terms[bounds[0] : bounds[-1]], bounds - bounds[0])


class _Segment:
    """A segment with the terms and weights of a block of queries."""

    def __init__(self, row: dict, vocabulary: np.ndarray, idf: np.ndarray | None, mean: float):
        self.ids = np.frombuffer(row["ids"], dtype=np.int64)
        terms = np.frombuffer(row["terms"], dtype=np.uint64)
        offsets = np.frombuffer(row["offsets"], dtype=np.int64)
        at = np.searchsorted(vocabulary, terms)
        at[at == len(vocabulary)] = 0
        known = np.flatnonzero(vocabulary[at] == terms) if len(vocabulary) else np.zeros(0, dtype=np.int64)
        self.term, self.df = at[known], np.diff(offsets)[known]
        if idf is None:
            return
        picked = _ranges(offsets[known], self.df)
        self.docs = np.frombuffer(row["docs"], dtype=np.int32)[picked].astype(np.int64)
        counts = np.frombuffer(row["counts"], dtype=np.int32)[picked].astype(float)
        lengths = np.frombuffer(row["lengths"], dtype=np.int32).astype(float)[self.docs]
        self.begin = np.cumsum(self.df) - self.df
        weight = np.repeat(idf[self.term], self.df)
        self.weight = np.rint(1e6 * weight * (counts * (K1 + 1)) / (counts + K1 * (1 - B + B * lengths / mean)))
        self.row_of = np.full(len(vocabulary), -1, dtype=np.int64)
        self.row_of[self.term] = np.arange(len(known))
        # The same by text, a text's terms from common to rare.
        self.by_text = np.argsort(self.docs.astype(np.uint16) if len(self.ids) <= 1 << 16 else self.docs, kind="stable")
        self.rows = np.repeat(np.arange(len(known)), self.df)
        self.text_rows, self.text_weight = self.rows[self.by_text], self.weight[self.by_text]
        self.text_terms = np.bincount(self.docs, minlength=len(self.ids))
        self.text_begin = np.cumsum(self.text_terms) - self.text_terms
        self.marked = np.zeros(BLOCK * len(known), dtype=bool)

    def probe(self, asked: _Asked, k: int) -> np.ndarray:
        """Scores of up to k texts that have rare terms of a query, 0 where there are fewer."""
        return np.concatenate([np.zeros((0, k)), *(self._probed(part, k) for _, part in asked.parts())])

    def _probed(self, asked: _Asked, k: int) -> np.ndarray:
        rows, owners, bounds = self._wanted(asked)
        length = self.df[rows]
        before = np.cumsum(length) - length
        most = _PROBE + np.diff(bounds)
        length = np.clip((most + np.append(before, 0)[bounds[:-1]])[owners] - before, 0, length)
        # The most promising text of every class of places, for the k best classes.
        classes = max(_CLASSES, k)
        width = -(-len(self.ids) // classes)
        out = np.zeros((len(asked.queries), k))
        for first, last, score in _scores(self.docs, self.weight, self.begin[rows], length, bounds, width * classes):
            score = score.reshape(last - first, width, classes)
            best = np.argpartition(score.max(axis=1), classes - k, axis=1)[:, classes - k :]
            inside = score[np.arange(last - first)[:, None], :, best]
            query, place = np.nonzero(inside.max(axis=2))
            docs = inside.argmax(axis=2)[query, place] * classes + best[query, place]
            part = slice(bounds[first], bounds[last])
            out[first + query, place] = self._sums(rows[part], owners[part] - first, query, docs, self.text_terms[docs])
        return out

    def best(self, asked: _Asked, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the query, id, score) of all texts that reach the floor of a query; floors are 1 at least."""
        limits = _level(_SKIPPED * floors)
        low = int(limits.min(initial=0))
        levels = int(limits.max(initial=0)) - low + 1
        limits = limits - low
        # What a text's terms sum up to, each with all more common ones.
        sums = np.concatenate(([0.0], np.cumsum(self.text_weight)))
        level = _level(sums[1:] - np.repeat(sums[self.text_begin], self.text_terms))
        level = np.clip(level - low, -1, levels - 1)
        skipped = _at_least(np.repeat(np.arange(len(self.ids)), self.text_terms), level, len(self.ids), levels)
        level_of = np.empty(len(level), dtype=np.int64)
        level_of[self.by_text] = level
        lengths = _at_least(self.rows, level_of, len(self.df), levels)
        # Lists begin with the texts that can be skipped last.
        order = np.argsort((self.rows + 1) * (levels + 1) - level_of)
        docs, weight = self.docs[order], self.weight[order]
        found = []
        n, near = len(self.ids), floors - _SKIPPED * floors - 0.5
        for start, part in asked.parts():
            rows, owners, bounds = self._wanted(part)
            length = lengths[limits[start + owners], rows]
            for first, last, score in _scores(docs, weight, self.begin[rows], length, bounds, n):
                query, place = np.nonzero(score.reshape(-1, n) >= near[start + first : start + last, None])
                if not len(query):
                    continue
                some = slice(bounds[first], bounds[last])
                number = start + first + query
                left = self.text_terms[place] - skipped[limits[number], place]
                rest = self._sums(rows[some], owners[some] - first, query, place, left)
                total = score[query * n + place] + rest
                good = total >= floors[number]
                found.append((number[good], self.ids[place[good]], total[good]))
        return tuple(np.concatenate(x) for x in zip(_NOTHING, *found, strict=True))

    def _wanted(self, asked: _Asked) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lists of the queries' terms, the query each is read for, and where each query's lists begin."""
        rows = self.row_of[asked.terms]
        here = rows >= 0
        owners = np.repeat(np.arange(len(asked.queries)), np.diff(asked.bounds))
        return rows[here], owners[here], np.concatenate(([0], np.cumsum(here)))[asked.bounds]

    def _sums(self, rows, owners, query, docs, length) -> np.ndarray:
        """What the ``length`` most common terms of texts give to a query each."""
        marks = owners * len(self.df) + rows
        self.marked[marks] = True
        picked = _ranges(self.text_begin[docs], length)
        hit = self.marked[np.repeat(query * len(self.df), length) + self.text_rows[picked]]
        self.marked[marks] = False
        pair = np.repeat(np.arange(len(docs)), length)
        return np.bincount(pair[hit], self.text_weight[picked[hit]], minlength=len(docs))


_NOTHING = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)


def _scores(docs, weight, begin, length, bounds, n: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Sums over ``length`` postings from ``begin`` on, by query and by text of n, for a few queries at a time."""
    ends = np.concatenate(([0], np.cumsum(length)))[bounds]
    first, queries = 0, len(bounds) - 1
    while first < queries:
        last = int(np.searchsorted(ends, ends[first] + _POSTINGS, side="right")) - 1
        last = min(max(last, first + 1), first + BLOCK, queries)
        if ends[last] > ends[first]:
            part = slice(bounds[first], bounds[last])
            picked = _ranges(begin[part], length[part])
            key = docs[picked]
            key += np.repeat(np.arange(last - first) * n, np.diff(ends[first : last + 1]))
            yield first, last, np.bincount(key, weight[picked], minlength=(last - first) * n)
        first = last


def _level(sums: np.ndarray) -> np.ndarray:
    """Sums on a scale of whole steps; never falls as a sum grows."""
    return np.floor(np.log2(np.maximum(sums, 0.25)) * _STEPS).astype(np.int64)


def _at_least(group: np.ndarray, level: np.ndarray, groups: int, levels: int) -> np.ndarray:
    """By level and group: how many of the group have that level or a higher one. Levels below 0 have none."""
    good = level >= 0
    place = (levels - 1 - level[good]) * groups + group[good]
    counts = np.bincount(place, minlength=levels * groups).astype(np.int32).reshape(levels, groups)
    return np.cumsum(counts, axis=0, dtype=np.int32, out=counts)[::-1]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: each is a whole segment."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers of all ranges one after the other."""
    before = np.cumsum(length) - length
    return np.repeat(begin - before, length) + np.arange(int(length.sum()))


def _best_k(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k largest scores of each query, of equal ones the least ids; in that order."""
    order = np.lexsort((ids, -scores, query))
    rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
    order = order[rank < k]
    return query[order], ids[order], scores[order]


def _frequencies(segments: DataFrame, vocabulary) -> np.ndarray:
    """Texts that each term of a broadcast vocabulary occurs in."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        total = np.zeros(len(known), dtype=np.int64)
        for row in _rows(batches):
            segment = _Segment(row, known, None, 1.0)
            total[segment.term] += segment.df
        parts = range(0, len(known), _STRETCH)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int64()), pa.array([total[i : i + _STRETCH].tobytes() for i in parts], pa.binary())],
            names=["at", "df"],
        )

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in group["df"])
        return pd.DataFrame({"at": group["at"].iloc[:1], "df": [total.tobytes()]})

    rows = segments.select("ids", "terms", "offsets").mapInArrow(count, "at long, df binary")
    found = rows.groupBy("at").applyInPandas(add, "at long, df binary").collect()
    out = np.zeros(len(vocabulary.value), dtype=np.int64)
    for r in found:
        part = np.frombuffer(r["df"], dtype=np.int64)
        out[r["at"] : r["at"] + len(part)] = part
    return out


def _queries(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(query, terms, size): distinct words of each query."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [
                np.unique(w.hashes[a:b])
                for _, w in hashed_words(batch.column(1), LETTERS)
                for a, b in zip(w.bounds[:-1], w.bounds[1:], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([t.tobytes() for t in terms], pa.binary()), pa.array([len(t) for t in terms], pa.int64())],
                names=["query", "terms", "size"],
            )

    rows = docs.select(docs[f"`{id}`"].cast("long").alias("id"), empty_or_null(docs[f"`{text}`"]).alias("text"))
    return rows.where("id is not null").mapInArrow(make, "query long, terms binary, size long")


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(query, rank, id, score): the k best texts for each query, by BM25, of equal scores the least ids.

    A query is a text; its distinct words count once each. Words are runs of letters, digits and
    anything outside ASCII, A-Z in lower case. Scores are sums of contributions rounded to
    millionths. Texts that share no word with a query are not among its results, so an empty or null
    query has none; empty and null texts count as texts of length 0. Rows without id neither ask nor
    are found. Of rows that share an id each is found on its own; a query id that repeats asks once
    for all its texts together.
    """
    segments = keep(index(docs, id, text), "index")
    asked = keep(_queries(queries, id, text), "queries")
    texts, words = segments.agg(F.sum("texts"), F.sum("words")).first()
    mean = max((words or 0) / max(texts or 0, 1), 1e-9)
    blocks = max(1, -(-(asked.agg(F.sum("size")).first()[0] or 0) // BLOCK_TERMS))
    found = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).select("query", "terms").collect()
        best = _run(segments, rows, texts or 0, mean, k)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query", "rank", F.col("id").alias(id), (F.col("score") / 1e6).alias("score"))


def _run(segments: DataFrame, rows: list, texts: int, mean: float, k: int) -> DataFrame:
    """(query, id, score) of the best k of every task, for one block of queries."""
    context = segments.sparkSession.sparkContext
    terms: dict[int, np.ndarray] = {}
    for r in rows:
        own = np.frombuffer(r["terms"], dtype=np.uint64)
        terms[r["query"]] = np.union1d(terms[r["query"]], own) if r["query"] in terms else own
    vocabulary = np.unique(np.concatenate([*terms.values(), np.zeros(0, dtype=np.uint64)]))
    df = _frequencies(segments, context.broadcast(vocabulary))
    idf = np.log(1 + (texts - df + 0.5) / (df + 0.5))
    places = [np.searchsorted(vocabulary, t) for t in terms.values() if len(t)]
    places = [at[np.argsort(-idf[at], kind="stable")].astype(np.int32) for at in places]
    asked = _Asked(
        np.array([q for q, t in terms.items() if len(t)], dtype=np.int64),
        np.concatenate([*places, np.zeros(0, dtype=np.int32)]),
        np.concatenate(([0], np.cumsum([len(at) for at in places]))).astype(np.int64),
    )
    shared = context.broadcast((vocabulary, idf, tuple(asked)))
    floors = context.broadcast(_floors(segments, shared, len(asked.queries), mean, k))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf, block = shared.value
        asked = _Asked(*block)
        least, best = floors.value.copy(), _NOTHING
        for row in _rows(batches):
            fresh = _Segment(row, vocabulary, idf, mean).best(asked, least)
            best = _best_k(*(np.concatenate(x) for x in zip(best, fresh, strict=True)), k)
            full = np.flatnonzero(np.bincount(best[0], minlength=len(least)) == k)
            last = np.searchsorted(best[0], full, side="right") - 1
            least[full] = np.maximum(least[full], best[2][last])
        columns = asked.queries[best[0]], best[1], best[2].astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["query", "id", "score"])

    return segments.mapInArrow(run, "query long, id long, score long")


def _floors(segments: DataFrame, shared, queries: int, mean: float, k: int) -> np.ndarray:
    """For each query a score that k texts reach or exceed; 1 where so many were not seen."""

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, idf, block = shared.value
        best = np.zeros((queries, k))
        for row in _rows(batches):
            fresh = _Segment(row, vocabulary, idf, mean).probe(_Asked(*block), k)
            best = np.partition(np.concatenate((best, fresh), axis=1), k, axis=1)[:, k:]
        parts = range(0, queries, _GROUP)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(parts), pa.int64()), pa.array([best[i : i + _GROUP].tobytes() for i in parts], pa.binary())],
            names=["at", "best"],
        )

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        best = np.concatenate([np.frombuffer(x).reshape(-1, k) for x in group["best"]], axis=1)
        least = np.partition(best, best.shape[1] - k, axis=1)[:, best.shape[1] - k]
        return pd.DataFrame({"at": group["at"].iloc[:1], "best": [least.tobytes()]})

    out = np.ones(queries)
    rows = segments.mapInArrow(probe, "at long, best binary")
    for r in rows.groupBy("at").applyInPandas(merge, "at long, best binary").collect():
        part = np.frombuffer(r["best"])
        out[r["at"] : r["at"] + len(part)] = np.maximum(part, 1.0)
    return out
