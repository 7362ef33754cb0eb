"""Language identification by interpolated Kneser-Ney character models.

A bounded sample of labelled texts gives n-gram counts per language. The models of all languages
share sorted hash arrays, one per order: a row holds an n-gram's interpolated probability in every
language. A text gets the language of least cross-entropy per character, and is rejected if even
that is far above what the language's own texts have.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larderlake.llm.tables import checked, empty_or_null, free_name, keep
from larderlake.llm.words import buffers, chunks, code_points, mix

#: Characters of the longest n-grams.
ORDER = 4
#: Labelled documents that a language's model is fitted on, about.
SAMPLE = 2000
#: One in so many of the sample is kept out of the counts, to calibrate rejection.
CALIBRATION = 10
#: A text is rejected from so many deviations above its language's usual cross-entropy, but not before
#: it is this far on the way from there to characters drawn at random.
REJECT, RANDOM = 6.0, 0.5
#: Characters that count as evidence at most when the score is formed.
EVIDENCE = 50
#: Bytes of probabilities; rarer n-grams are left out where a model would be larger.
MODEL_BYTES = 256 << 20
UNDETERMINED = "und"

_SPACE = 0x20
_STEP = np.uint64(0x2545F4914F6CDD1D)

LANGUAGE = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
        T.StructField("chars", T.LongType()),
        T.StructField("cross_entropy", T.ArrayType(T.DoubleType())),
    ]
)
_LANGUAGE = pa.struct(
    [
        ("lang", pa.string()),
        ("score", pa.float64()),
        ("rejected", pa.bool_()),
        ("chars", pa.int64()),
        ("cross_entropy", pa.list_(pa.float64())),
    ]
)


@cache
def _folded() -> np.ndarray:
    """Each code point's letter in lower case, or a space if it is no letter."""
    out = np.full(0x110000, _SPACE, dtype=np.uint32)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and (c := chr(code)).isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    return out


def letters(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Letters of many texts, other characters between them as one space, and bounds of each text."""
    data, offsets = buffers(texts)
    for first, last in chunks(offsets):
        part = offsets[first : last + 1]
        raw = data[part[0] : part[-1]]
        bounds = code_points(raw)[part - part[0]]
        codes = _folded()[np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)]
        space = codes == _SPACE
        before = np.ones(len(codes), dtype=bool)
        before[1:] = space[:-1]
        before[bounds[:-1][bounds[:-1] < len(codes)]] = True
        kept = ~(space & before)
        yield codes[kept], np.concatenate(([0], np.cumsum(kept)))[bounds]


def _shifted(codes: np.ndarray, bounds: np.ndarray, by: int) -> np.ndarray:
    """The character so many places before each; a space before a text begins."""
    out = np.full(len(codes), _SPACE, dtype=np.uint64)
    out[by:] = codes[: max(0, len(codes) - by)]
    place = np.arange(len(codes)) - np.repeat(bounds[:-1], np.diff(bounds))
    out[place < by] = _SPACE
    return out


def _hashes(columns: list[np.ndarray]) -> list[np.ndarray]:
    """Hash of the first character alone, of the first two, and so on; latest characters first."""
    out, h = [], np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        h = h * _STEP + c.astype(np.uint64) + np.uint64(1)
        out.append(mix(h))
    return out


@dataclass
class Model:
    """Probabilities of all languages.

    ``grams[m]`` are sorted hashes of n-grams of m + 1 characters and ``logp[m]`` their logarithms of
    probability, a column per language; ``contexts[m]`` and ``backoff[m]`` are the same for contexts
    of m characters and the weight that they leave to shorter ones.
    """

    languages: list[str]
    grams: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    unseen: float
    limits: dict[str, tuple[float, float, float]]

    def log_probability(self, columns: list[np.ndarray]) -> np.ndarray:
        """Of each character, in each language; ``columns`` are the characters and those before them."""
        return self._at(len(self.grams) - 1, _hashes(columns), _hashes(columns[1:]) if columns[1:] else [])

    def _at(self, m: int, grams: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        if m < 0:
            return np.full((len(grams[0]), len(self.languages)), self.unseen)
        at, known = _find(self.grams[m], grams[m])
        out = np.empty((len(at), len(self.languages)))
        out[known] = self.logp[m][at[known]]
        rest = np.flatnonzero(~known)
        if len(rest):
            lower = self._at(m - 1, [g[rest] for g in grams], [c[rest] for c in contexts])
            if m:
                at, known = _find(self.contexts[m], contexts[m - 1][rest])
                lower[known] += self.backoff[m][at[known]]
            else:
                lower += self.backoff[0][0]
            out[rest] = lower
        return out


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(table, wanted)
    at[at == len(table)] = 0
    return at, (table[at] == wanted) if len(table) else np.zeros(len(wanted), dtype=bool)


def kneser_ney(languages: list[str], grams: np.ndarray, counts: np.ndarray) -> Model:
    """Models from counts of the longest n-grams: code points (latest first) by row, a count per language.

    Shorter n-grams count the distinct characters seen before them. Each order takes an absolute
    discount from its counts, and gives what it took to the order below, by context.
    """
    order = grams.shape[1]
    tables = [(grams, counts)]
    for m in range(order - 1, 0, -1):
        above, seen = tables[-1]
        shorter, to = np.unique(above[:, :m], axis=0, return_inverse=True)
        continued = np.zeros((len(shorter), len(languages)))
        np.add.at(continued, to.ravel(), (seen > 0).astype(float))
        tables.append((shorter, continued))
    tables.reverse()
    unseen = 1.0 / (len(tables[0][0]) + 1)
    below = np.full((1, len(languages)), unseen)
    out = Model(languages, [], [], [], [], float(np.log(unseen)), {})
    for m, (rows, count) in enumerate(tables):
        ones, twos = (count == 1).sum(axis=0), (count == 2).sum(axis=0)
        discount = np.clip(ones / np.maximum(ones + 2 * twos, 1), 0.1, 0.9)
        contexts, of = np.unique(rows[:, 1:], axis=0, return_inverse=True)
        of = of.ravel()
        total, kinds = np.zeros((len(contexts), len(languages))), np.zeros((len(contexts), len(languages)))
        np.add.at(total, of, count)
        np.add.at(kinds, of, (count > 0).astype(float))
        weight = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
        if m:
            shorter = _hashes(list(rows[:, :m].T))[-1]
            lower = below[_find(out.grams[m - 1], shorter)[0]]
        else:
            lower = np.repeat(below, len(rows), axis=0)
        p = np.maximum(count - discount, 0) / np.maximum(total, 1)[of] + weight[of] * lower
        keys = _hashes(list(rows.T))[-1]
        order_of = np.argsort(keys)
        out.grams.append(keys[order_of])
        out.logp.append(np.log(p)[order_of].astype(np.float32))
        below = p[order_of]
        keys = _hashes(list(contexts.T))[-1] if m else np.zeros(1, dtype=np.uint64)
        order_of = np.argsort(keys)
        out.contexts.append(keys[order_of])
        out.backoff.append(np.log(weight)[order_of].astype(np.float32))
    return out


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each value, and where each number first occurs."""
    of, values = pd.factorize(hashes)
    first = np.zeros(len(values), dtype=np.int64)
    first[of[::-1]] = np.arange(len(of) - 1, -1, -1)
    return of, first


def _columns(codes: np.ndarray, bounds: np.ndarray, order: int) -> list[np.ndarray]:
    return [codes.astype(np.uint64), *(_shifted(codes, bounds, i) for i in range(1, order))]


def cross_entropy(model: Model, codes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Nats per character of each text in each language; 0 for an empty text."""
    columns = _columns(codes, bounds, len(model.grams))
    length = np.diff(bounds)
    out = np.zeros((len(length), len(model.languages)))
    if not len(codes):
        return out
    of, first = _distinct(_hashes(columns)[-1])
    logp = model.log_probability([c[first] for c in columns])
    full = np.flatnonzero(length)
    out[full] = -np.add.reduceat(logp[of], bounds[:-1][full], axis=0) / length[full, None]
    return out


def _counted(labelled: DataFrame) -> DataFrame:
    """(lang, gram, count) of (lang, text): counts of the longest n-grams, latest character first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, names = pd.factorize(np.array(batch.column(0).to_pylist(), dtype=object))
            row = 0
            for codes, bounds in letters(batch.column(1)):
                n = len(bounds) - 1
                label = np.repeat(labels[row : row + n], np.diff(bounds)).astype(np.uint64)
                row += n
                if not len(codes):
                    continue
                columns = [label, *_columns(codes, bounds, ORDER)]
                of, first = _distinct(_hashes(columns)[-1])
                found = np.stack([c[first] for c in columns]).astype(np.uint32)
                counts = np.bincount(of)
                grams = np.ascontiguousarray(found[1:].T).view(f"<U{ORDER}").ravel().tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.asarray(names, dtype=object)[found[0]].tolist(), pa.string()),
                        pa.array(grams, pa.string()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=["lang", "gram", "count"],
                )

    counted = labelled.select("lang", "text").mapInArrow(count, "lang string, gram string, count long")
    return counted.groupBy("lang", "gram").agg(F.sum("count").alias("count"))


def learn(labelled: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """Models of all languages that occur in ``lang``, from about ``sample`` texts of each.

    Rows without a label are left out, null texts teach nothing. Which rows are taken depends on
    their ids alone. What the driver gathers is bounded by the sample: its distinct n-grams.
    """
    rows = labelled.select(
        labelled[f"`{id}`"].cast("string").alias("id"),
        labelled[f"`{lang}`"].cast("string").alias("lang"),
        empty_or_null(labelled[f"`{text}`"]).alias("text"),
    ).where("lang is not null")
    counts = rows.groupBy("lang").count().select("lang", (F.lit(float(sample)) / F.col("count")).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "id"), F.lit(1 << 30)) / float(1 << 30)
    kept = F.pmod(F.xxhash64(F.lit("calibration"), "id"), F.lit(CALIBRATION))
    taken = rows.withColumn("draw", draw).join(checked(counts), "lang").where("draw < rate").select("lang", "text", kept.alias("part"))
    taken = keep(taken, "sample")
    grams = _counted(taken.where("part <> 0")).toPandas()
    languages = sorted(grams["lang"].unique())
    if not languages:
        return Model([], [], [], [], [], 0.0, {})
    names = np.unique(grams["gram"].to_numpy(dtype=f"<U{ORDER}"))
    column = np.searchsorted(np.array(languages), grams["lang"].to_numpy(dtype=str))
    table = np.zeros((len(names), len(languages)))
    table[np.searchsorted(names, grams["gram"].to_numpy(dtype=f"<U{ORDER}")), column] = grams["count"].to_numpy()
    least = 1
    while len(names) * len(languages) * 4 > MODEL_BYTES:
        least += 1
        good = table.sum(axis=1) >= least
        names, table = names[good], table[good]
    codes = names.view(np.uint32).reshape(-1, ORDER)
    model = kneser_ney(languages, codes.astype(np.uint64), table)
    model.limits = _calibrated(taken.where("part = 0"), model)
    return model


def _calibrated(texts: DataFrame, model: Model) -> dict[str, tuple[float, float, float]]:
    """By language: usual cross-entropy, its variance between texts, and variance times length."""
    found = identify(texts, model, "found")
    at = F.array_position(F.array(*(F.lit(x) for x in model.languages)), F.col("lang")).cast("int")
    rows = found.where("found.chars > 0").select(
        "lang", F.col("found.chars").alias("n"), F.element_at("found.cross_entropy", at).alias("h")
    )
    usual = (F.sum(F.col("n") * F.col("h")) / F.sum("n")).alias("usual")
    rows = rows.where("h is not null").join(rows.groupBy("lang").agg(usual).withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"))
    off = F.pow(F.col("h") - F.col("usual"), 2)
    stats = rows.groupBy("lang").agg(F.first("usual"), F.avg(off), F.avg(off * F.col("n"))).collect()
    return {r[0]: (r[1], r[2], r[3]) for r in stats}


def identify(docs: DataFrame, model: Model, out: str = "language", text: str = "text") -> DataFrame:
    """All columns of the table and ``out``: lang, score, rejected, chars, cross_entropy by language.

    A text that is null or has no letter is ``und`` with score 0, and rejected; so is every text if
    the model knows no language. Another text has the language of least cross-entropy, of equal ones
    the first by name; it is rejected if that is REJECT deviations above what is usual for texts of
    the language and length, and nearer to noise than to the language. The score is the share of the language's likelihood, over EVIDENCE
    characters at most. Only texts are looked at; other columns pass through.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema, T.StructField(out, LANGUAGE)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found: list[dict] = []
            for codes, bounds in letters(batch.column(at)):
                found.extend(_judged(known, codes, bounds))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _LANGUAGE)], names=schema.names)

    return docs.mapInArrow(scan, schema)


def _judged(model: Model, codes: np.ndarray, bounds: np.ndarray) -> Iterator[dict]:
    length = np.diff(bounds)
    if not model.languages:
        for n in length.tolist():
            yield {"lang": UNDETERMINED, "score": 0.0, "rejected": True, "chars": n, "cross_entropy": []}
        return
    # A text without letters has no character left but at most a space.
    h = cross_entropy(model, codes, bounds)
    best = h.argmin(axis=1)
    lowest = h[np.arange(len(h)), best]
    share = 1 / np.exp(-(h - lowest[:, None]) * np.minimum(length, EVIDENCE)[:, None]).sum(axis=1)
    limit = np.array([model.limits.get(x, (-model.unseen, 0.0, 0.0)) for x in model.languages])[best]
    far = REJECT * np.sqrt(limit[:, 1] + limit[:, 2] / np.maximum(length, 1))
    limit = limit[:, 0] + np.maximum(far, RANDOM * (-model.unseen - limit[:, 0]))
    for i, n in enumerate(length.tolist()):
        if n == 0:
            yield {"lang": UNDETERMINED, "score": 0.0, "rejected": True, "chars": 0, "cross_entropy": []}
        else:
            yield {
                "lang": model.languages[best[i]],
                "score": float(share[i]),
                "rejected": bool(lowest[i] > limit[i]),
                "chars": n,
                "cross_entropy": h[i].tolist(),
            }


def keep_known(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The documents whose language is known, columns as they were; rejected ones go."""
    name = free_name(docs, "language")
    return identify(docs, model, name, text).where(~F.col(name)["rejected"]).drop(name)
