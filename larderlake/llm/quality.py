"""Quality of documents by weak supervision: rules vote, and a latent class model weighs the votes.

A rule votes good, bad or not at all. Texts are good, or bad in one of the ways that rules look for.
How often each rule votes how on texts of each class is estimated by expectation-maximisation over
the counts of all documents' vote patterns, without any label; the posterior probability of a good
text then takes the place of "all rules must pass". At most 3 ** MAX_RULES patterns exist, so the
counts have a bound that no corpus exceeds.

Defined results: a null text is an empty one and has no words; nobody votes on a text without words.
Texts of any length are read whole. Repeated rows are rows; other columns are passed on, also ones
with clashing names. Without documents nothing is estimated and nothing comes out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from larderlake.llm.tables import column, empty_or_null, free_name, keep
from larderlake.llm.words import Alphabet, Words, buffers, chunks, mix, windows, words

# --- fixed values: what the base measures count -----------------------------------------------------
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS, MOST_REPEATED = 20, 30
# --------------------------------------------------------------------------------------------------

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",  # lines with a word
    "n_same",  # words equal to the one before
    "n_calls",  # words that end in ! or ?
    "n_stops",  # words that end a sentence
    "n_plain",  # code points that are letters, digits or beyond ASCII
    "n_letters",
    "n_capitals",
)


class Rule(NamedTuple):
    """Votes on a text with words, from its measures; where neither holds, it abstains.

    Rules that look for one kind of fault confirm each other, rules of different kinds need not.
    """

    name: str
    kind: str
    good: Callable
    bad: Callable


RULES = [
    Rule("length", "size", lambda m: m["n_words"] >= 50, lambda m: m["n_words"] < LEAST_WORDS),
    Rule(
        "word_length",
        "size",
        lambda m: (m["word_chars"] >= 3 * m["n_words"]) & (m["word_chars"] <= 10 * m["n_words"]),
        lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
    ),
    Rule("symbols", "markup", lambda m: 50 * m["n_symbols"] <= m["n_words"], lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule(
        "dup_lines",
        "repetition",
        lambda m: (m["n_lines"] >= 3) & (m["n_dup_lines"] == 0),
        lambda m: (m["n_dup_lines"] >= 3) & (10 * m["n_dup_lines"] > 3 * m["n_lines"]),
    ),
    Rule("repeats", "repetition", lambda m: 20 * m["n_repeat_words"] <= m["n_words"], lambda m: 100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"]),
    Rule("stutter", "repetition", lambda m: 50 * m["n_same"] <= m["n_words"], lambda m: 10 * m["n_same"] > m["n_words"]),
    Rule("capitals", "shouting", lambda m: 5 * m["n_capitals"] <= m["n_letters"], lambda m: 10 * m["n_capitals"] > 4 * m["n_letters"]),
    Rule("calls", "shouting", lambda m: 20 * m["n_calls"] <= m["n_words"], lambda m: 4 * m["n_calls"] > m["n_words"]),
    Rule("plain", "markup", lambda m: 100 * m["n_plain"] >= 92 * m["word_chars"], lambda m: 100 * m["n_plain"] < 85 * m["word_chars"]),
    Rule(
        "sentences",
        "markup",
        lambda m: (m["n_stops"] > 0) & (m["n_words"] <= 60 * m["n_stops"]),
        lambda m: m["n_words"] > 200 * (m["n_stops"] + 1),
    ),
]
#: Vote patterns are collected; so many rules give 531,441 of them at most.
MAX_RULES = 12

#: Texts are kept from this probability on.
KEEP = 0.5
#: The model before any text: share of good texts, a rule's votes (bad, good) where it votes on texts with
#: a fault of its kind and on others, and how much of the corpus this belief is worth.
PRIOR_GOOD = 0.8
PRIOR_FAULT, PRIOR_OTHER = (0.65, 0.35), (0.01, 0.99)
WORTH = 0.1
ROUNDS, CLOSE = 500, 1e-10


class _Exact(Alphabet):
    """Upper case and lower case are different."""

    def __init__(self, separators: set[int]):
        super().__init__(separators)
        self.values = np.where(self.is_word, mix(np.arange(256, dtype=np.uint64) + np.uint64(0x2545F491)), np.uint64(0))


VISIBLE = _Exact({0x20, *range(0x09, 0x0E)})
LINES = _Exact({0x0A})


def _flags(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), [ord(c) for c in characters])


_IS_SYMBOL, _IS_CALL, _IS_STOP = _flags(SYMBOLS), _flags("!?"), _flags(".!?")
_IS_CAPITAL = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_IS_LETTER = _IS_CAPITAL | _flags("abcdefghijklmnopqrstuvwxyz")
_IS_PLAIN = _IS_LETTER | _flags("0123456789") | (np.arange(256) >= 0x80)
_BEGINS = (np.arange(256) & 0xC0) != 0x80


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _between(flags: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """How many flags are set between each two borders."""
    return np.diff(_sums(flags)[borders])


def _again(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur more than once within their owner, and which of them are not the first."""
    order = np.lexsort((hashes, owner))
    same = (owner[order][1:] == owner[order][:-1]) & (hashes[order][1:] == hashes[order][:-1])
    more, later = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes), dtype=bool)
    later[order[1:][same]] = True
    more[order[1:][same]] = more[order[:-1][same]] = True
    return more, later


def _owners(found: Words) -> np.ndarray:
    return np.repeat(np.arange(len(found.bounds) - 1), np.diff(found.bounds))


def measures(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of consecutive texts, given as UTF-8."""
    found = words(data, offsets, VISIBLE)
    owner, n = _owners(found), len(found.hashes)
    last = data[found.ends - 1]
    same = np.zeros(n, dtype=bool)
    same[1:] = (found.hashes[1:] == found.hashes[:-1]) & (owner[1:] == owner[:-1])
    # Windows that lie within one text.
    hashes = windows(found.hashes, WINDOW)
    whole = np.flatnonzero(owner[: len(hashes)] == owner[WINDOW - 1 :][: len(hashes)])
    more, _ = _again(owner[whole], hashes[whole])
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, whole[more], 1)
    np.add.at(steps, whole[more] + WINDOW, -1)
    repeated = np.cumsum(steps[:n]) > 0
    lines = words(data, offsets, LINES)
    visible = _sums(VISIBLE.is_word[data])
    wordy = visible[lines.ends] > visible[lines.starts]
    line_owner = _owners(lines)[wordy]
    _, later = _again(line_owner, lines.hashes[wordy])
    texts = len(offsets) - 1
    return {
        "n_words": np.diff(found.bounds),
        "word_chars": _between(_BEGINS[data] & VISIBLE.is_word[data], offsets),
        "n_symbols": _between(_IS_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_owner[later], minlength=texts),
        "n_repeat_words": _between(repeated, found.bounds),
        "n_lines": np.bincount(line_owner, minlength=texts),
        "n_same": _between(same, found.bounds),
        "n_calls": _between(_IS_CALL[last], found.bounds),
        "n_stops": _between(_IS_STOP[last], found.bounds),
        "n_plain": _between(_IS_PLAIN[data] & _BEGINS[data], offsets),
        "n_letters": _between(_IS_LETTER[data], offsets),
        "n_capitals": _between(_IS_CAPITAL[data], offsets),
    }


def measure(docs: DataFrame, text: str = "text", carry: list[str] | None = None, into: str = "measures") -> DataFrame:
    """The carried columns (default: all) and a struct of the text's measures."""
    carried = docs.columns if carry is None else carry
    kept = [docs[f"`{name}`"] for name in carried]
    schema = StructType([docs.schema[name] for name in carried])
    struct = StructType([StructField(name, LongType()) for name in MEASURES])
    type = to_arrow_type(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column(batch.num_columns - 1))
            found = [
                measures(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
                for first, last in chunks(offsets)
            ]
            arrays = [pa.array(np.concatenate([f[name] for f in found]) if found else [], pa.int64()) for name in MEASURES]
            column = pa.StructArray.from_arrays(arrays, fields=list(type))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], column], names=[*carried, into])

    texts = empty_or_null(column(docs, text, "string")).alias(free_name(docs, "measured_text"))
    return docs.select(*kept, texts).mapInArrow(run, schema.add(into, struct))


def pattern(measured: Column, rules: list[Rule]) -> Column:
    """The votes of all rules as one number, in base 3: 0 bad, 1 none, 2 good; null without words."""
    votes = (F.when(rule.bad(measured), 0).when(rule.good(measured), 2).otherwise(1) * 3**i for i, rule in enumerate(rules))
    return F.when(measured["n_words"] > 0, sum(votes, F.lit(0))).cast("int")


class Model(NamedTuple):
    """Shares of the classes, good texts first; votes (rule, class, bad or good); the posterior of every pattern that occurs."""

    shares: np.ndarray
    votes: np.ndarray
    posterior: dict[int, float]

    def accuracies(self) -> list[float]:
        """How often each rule's votes are right, where it votes."""
        seen = self.votes * self.shares[:, None]
        return (seen[:, 0, 1] + seen[:, 1:, 0].sum(axis=1)).tolist()


def fit(counts: dict[int, int], kinds: list[str]) -> Model:
    """Expectation-maximisation over vote patterns and how many texts have each.

    ``kinds`` has the kind of each rule. Votes are independent given the class, and that a rule abstains
    says nothing. The prior keeps rules that hardly ever vote near the first belief, and the classes
    from changing places.
    """
    codes = np.array(sorted(counts), dtype=np.int64)
    weights = np.array([counts[code] for code in codes.tolist()], dtype=float)
    one_hot = (codes[:, None] // 3 ** np.arange(len(kinds)) % 3)[:, :, None] == np.array([0, 2])
    faults = sorted(set(kinds))
    belief = np.array([[PRIOR_OTHER, *(PRIOR_FAULT if kind == fault else PRIOR_OTHER for fault in faults)] for kind in kinds])
    first = np.array([PRIOR_GOOD, *[(1 - PRIOR_GOOD) / len(faults)] * len(faults)])
    worth = WORTH * max(weights.sum(), 1.0)
    shares, table, last = first, belief, -np.inf
    for _ in range(ROUNDS):
        logs = np.einsum("prv,rcv->pc", one_hot, np.log(table)) + np.log(shares)
        top = logs.max(axis=1, initial=-np.inf, keepdims=True)
        posterior = np.exp(logs - top)
        total = posterior.sum(axis=1, keepdims=True)
        posterior /= total
        # The belief is shared among the classes as the texts are.
        seen = np.einsum("p,pc,prv->rcv", weights, posterior, one_hot) + worth * first[:, None] * belief
        table = seen / seen.sum(axis=2, keepdims=True)
        shares = (weights @ posterior + worth * first) / (weights.sum() + worth)
        likelihood = float(weights @ (np.log(total) + top)[:, 0])
        if abs(likelihood - last) <= CLOSE * abs(likelihood):
            break
        last = likelihood
    return Model(shares, table, dict(zip(codes.tolist(), posterior[:, 0].tolist())))


def judge(docs: DataFrame, text: str = "text", carry: list[str] | None = None, rules: list[Rule] = RULES, into: str = "quality") -> DataFrame:
    """The carried columns (default: all) and a struct: the measures, base_failed, p_good and kept.

    ``base_failed`` are texts with fewer than LEAST_WORDS words or more than MOST_REPEATED percent of
    them in repeated windows; they are not kept, others if their probability reaches KEEP. Measures
    are written once with what is carried, so carry no texts that are not needed.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MAX_RULES} can be weighed")
    measured = measure(docs, text, carry, into)
    code = free_name(measured, "pattern")
    measured = keep(measured.withColumn(code, pattern(measured[into], rules)), "measures")
    voted = measured.where(F.col(code).isNotNull()).groupBy(code).agg(F.count("*").alias("texts"))
    model = fit({row[0]: row[1] for row in voted.collect()}, [rule.kind for rule in rules])
    known = docs.sparkSession.createDataFrame(list(model.posterior.items()), f"{code}_ int, p_good double")
    joined = measured.join(F.broadcast(known), measured[code] == known[f"{code}_"], "left")
    m = measured[into]
    failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > MOST_REPEATED * m["n_words"])
    p_good = F.coalesce(known["p_good"], F.lit(0.0))
    verdict = F.struct(
        *(m[name].alias(name) for name in MEASURES),
        failed.alias("base_failed"),
        p_good.alias("p_good"),
        (~failed & (p_good >= KEEP)).alias("kept"),
    )
    carried = [name for name in measured.columns if name not in (into, code)]
    return joined.select(*(measured[f"`{name}`"] for name in carried), verdict.alias(into))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents of good quality, with their own columns."""
    into = free_name(docs, "quality")
    return judge(docs, text, into=into).where(F.col(f"{into}.kept")).select(*(F.col(f"`{name}`") for name in docs.columns))
