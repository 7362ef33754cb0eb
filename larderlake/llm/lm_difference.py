"""Cross-entropy difference of two n-gram models: how much more a text resembles the target corpus.

Both models count words and pairs of words over one vocabulary, hashed to 32 bits, and mix them
alike, so that what neither has seen cancels out:

    P(w | h) = PAIR * count(h w) / count(h) + (1 - PAIR) * P(w)

The loss difference of a text is then a sum over its words and its known pairs of values that a
table holds by key. Values of the most frequent keys, so many at most whatever the corpus, go to all
tasks. The other keys of a chunk of texts travel to where the table has them, each once with the
texts it stands in, and come back as sums by text: one pass over the texts for a table of any size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larderlake.llm.tables import checked, empty_or_null, free_name, keep
from larderlake.llm.words import LETTERS, Words, hashed_words

#: Weight of pairs against single words.
PAIR = 0.7
#: Words that occur less often in the background are one unknown word; rarer pairs are not kept.
MIN_WORD, MIN_PAIR = 2, 3
#: A key goes to all tasks if it is at least this part of all words: so many words and as many pairs
#: can be, 16 bytes each.
HOT = 200_000
#: Words counted together before their counts leave a task, and words of a chunk of texts that asks at once.
FLUSH, ASK = 1 << 19, 1 << 18
#: Counts merged together, about; decides the number of groups.
GROUP = 1 << 20

#: Stands before the first word. Keys below 2**32 are single words, others pairs; key 0 stands for
#: all words that are unknown.
_UNKNOWN, _BEGIN = 0, np.uint64(1)
_LOW = np.uint64(0xFFFFFFFF)
_SPREAD = 31


def _keys(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each word and of the pair that it ends."""
    words = np.maximum(w.hashes >> np.uint64(32), np.uint64(2))
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[w.bounds[:-1][w.bounds[:-1] < len(words)]] = _BEGIN
    return words, (before << np.uint64(32)) | words


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, all first bytes together, then all second ones: equal bytes meet."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


def _planes(numbers: np.ndarray) -> bytes:
    """Small numbers, all first bytes together and so on: the empty ones compress away."""
    return np.ascontiguousarray(numbers.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes()


def _numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T
    return np.ascontiguousarray(planes).view(np.int32).ravel()


def _group(keys: np.ndarray, groups: int) -> np.ndarray:
    """Where a key is counted and looked up; ``_group_column`` is the same for a column."""
    return ((keys >> np.uint64(32)) * np.uint64(_SPREAD) + (keys & _LOW)).astype(np.int64) % groups


def _group_column(key: str, groups: int):
    low = F.col(key).bitwiseAND(int(_LOW))
    return (F.shiftrightunsigned(key, 32) * _SPREAD + low) % groups


def counts(texts: DataFrame, groups: int) -> DataFrame:
    """(key, background, target) of (target, text): counts of words and pairs over all texts.

    Pairs that occur less than MIN_PAIR times in the background are left out, and words less than
    MIN_WORD times added up as unknown, in one row a group. Key 1 counts texts with a word.

    A task combines what it counts, and sends it on as packed arrays by group of keys; a group merges
    arrays of many tasks. A key is one entry of a task's array however often it occurs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            keys = np.concatenate([k for k, _ in waiting] or [np.zeros(0, dtype=np.uint64)])
            target = np.concatenate([t for _, t in waiting] or [np.zeros(0, dtype=bool)])
            every, number = np.unique(keys, return_counts=True)
            own, own_number = np.unique(keys[target], return_counts=True)
            in_target = np.zeros(len(every), dtype=np.int64)
            in_target[np.searchsorted(every, own)] = own_number
            group = _group(every, groups)
            order = np.argsort(group, kind="stable")
            bounds = np.searchsorted(group[order], np.arange(groups + 1))
            rows = [(g, order[bounds[g] : bounds[g + 1]]) for g in range(groups) if bounds[g] < bounds[g + 1]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([g for g, _ in rows], pa.int64()),
                    pa.array([_packed(every[x]) for _, x in rows], pa.binary()),
                    pa.array([number[x].astype(np.int32).tobytes() for _, x in rows], pa.binary()),
                    pa.array([in_target[x].astype(np.int32).tobytes() for _, x in rows], pa.binary()),
                ],
                names=["group", "keys", "background", "target"],
            )

        for batch in batches:
            flags = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for first, w in hashed_words(batch.column(1), LETTERS):
                n = np.diff(w.bounds)
                flag = np.repeat(flags[first : first + len(n)], n)
                begins = flags[first : first + len(n)][n > 0]
                waiting.append((np.full(len(begins), _BEGIN), begins))
                for keys in _keys(w):
                    waiting.append((keys, flag))
                    size += len(keys)
                if size >= 2 * FLUSH:
                    yield flush()
                    waiting.clear()
                    size = 0
        yield flush()

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        keys = np.concatenate([_unpacked(x) for x in group["keys"]])
        order = np.argsort(keys, kind="stable")
        heads = np.flatnonzero(np.diff(keys[order], prepend=keys[order][:1] + np.uint64(1)))
        keys, sums = keys[order][heads], []
        for name in ("background", "target"):
            number = np.concatenate([np.frombuffer(x, dtype=np.int32) for x in group[name]]).astype(np.int64)
            sums.append(np.add.reduceat(number[order], heads))
        single = keys <= _LOW
        known = sums[0] >= np.where(single, MIN_WORD, MIN_PAIR)
        known |= keys == _BEGIN
        rare = single & ~known
        out = {"key": np.append(keys[known].view(np.int64), _UNKNOWN)}
        for name, number in zip(("background", "target"), sums, strict=True):
            out[name] = np.append(number[known], number[rare].sum())
        return pd.DataFrame(out)

    packed = texts.select("target", "text").mapInArrow(count, "group long, keys binary, background binary, target binary")
    return packed.groupBy("group").applyInPandas(merge, "key long, background long, target long")


def difference_table(found: DataFrame) -> DataFrame:
    """(key, gain, n) of counts: log P_target - log P_background of a word, or what a known pair adds to it.

    ``n`` is how often the key occurs in the background. The row with key 0 is the unknown word's,
    its ``n`` that of all words.
    """
    both = ("background", "target")
    known = found.where(F.col("key").between(2, (1 << 32) - 1))
    sums = known.agg(F.count("*"), *(F.sum(x) for x in both)).first()
    rest = found.where(F.col("key") == _UNKNOWN).agg(*(F.sum(x) for x in both)).first()
    size = sums[0] + 1
    n = {x: (sums[i + 1] or 0) + (rest[i] or 0) + size for i, x in enumerate(both)}
    unknown = {x: ((rest[i] or 0) + 1) / n[x] for i, x in enumerate(both)}
    p = {x: (F.col(x) + 1) / float(n[x]) for x in both}
    vocabulary = keep(known.select("key", *both, *(p[x].alias(f"p_{x}") for x in both)), "vocabulary")
    spark = found.sparkSession
    unigrams = vocabulary.select("key", (F.log("p_target") - F.log("p_background")).alias("gain"), F.col("background").alias("n"))
    words = n["background"] - size
    rest = spark.createDataFrame([(0, float(np.log(unknown["target"] / unknown["background"])), words)], "key long, gain double, n long")

    pairs = found.where(~F.col("key").between(0, (1 << 32) - 1))
    word = F.col("key").bitwiseAND((1 << 32) - 1)
    pairs = pairs.withColumn("word", word).withColumn("before", F.shiftrightunsigned("key", 32))
    left = vocabulary.select("key", *both).unionByName(found.where(F.col("key") == int(_BEGIN)))
    left = left.select(F.col("key").alias("before"), *(F.col(x).alias(f"before_{x}") for x in both))
    right = vocabulary.select(F.col("key").alias("word"), *(f"p_{x}" for x in both))
    rows = pairs.join(left, "before").join(right, "word")

    def log_p(x: str):
        seen = F.col(x) / F.greatest(F.col(f"before_{x}"), F.lit(1))
        return F.log(PAIR * seen / ((1 - PAIR) * F.col(f"p_{x}")) + 1)

    return unigrams.unionByName(rest).unionByName(
        rows.select("key", (log_p("target") - log_p("background")).alias("gain"), F.col("background").alias("n"))
    )


def learn(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The table of differences: the background is all documents, the target those whose id is in ``target``.

    Null and empty texts teach nothing; rows without id are background. Ids may repeat on either side.
    """
    ids = target.select(target[f"`{id}`"].alias("id"), F.lit(True).alias("target")).where("id is not null").distinct()
    rows = docs.select(docs[f"`{id}`"].alias("id"), empty_or_null(docs[f"`{text}`"]).alias("text"))
    flagged = rows.join(checked(keep(ids, "target")), "id", "left").select(
        F.coalesce("target", F.lit(False)).alias("target"), "text"
    )
    # About a word in six bytes of text, and each is counted once more in its pair.
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = keep(counts(flagged, max(1, size // 3 // GROUP)), "counts")
    return keep(difference_table(found), "differences")


def score(docs: DataFrame, table: DataFrame, out: str = "lm", text: str = "text") -> DataFrame:
    """All columns of the documents and ``out``: tokens and difference.

    ``difference`` is the target model's loss less the background model's, in nats a word: the lower,
    the more a text is like the target. A text without words has none: null. Repeated rows have equal
    values; other columns pass through.
    """
    spark = docs.sparkSession
    unknown, words = table.where("key = 0").select("gain", "n").first() or (0.0, 0)
    known = table.where("key <> 0")
    hot = F.col("n") >= max(1, words // HOT)
    rows = known.where(hot).toArrow()
    keys = rows.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    shared = spark.sparkContext.broadcast((keys[order], rows.column("gain").to_numpy()[order]))
    groups = max(1, -(-words // GROUP))

    digest = F.unhex(F.sha2(empty_or_null(docs[f"`{text}`"]), 256))
    texts = docs.select(digest.alias("digest"), empty_or_null(docs[f"`{text}`"]).alias("text"))
    asked = texts.mapInArrow(lambda batches: _ask(batches, shared.value, float(unknown), groups), _ASKED)
    held = known.where(~hot).select(_group_column("key", groups).alias("group"), F.lit(0).alias("asks"), "key", "gain")
    both = asked.withColumn("asks", F.lit(1)).unionByName(held, allowMissingColumns=True)
    met = both.repartition("group").sortWithinPartitions("group", "asks")
    met = met.select("group", "asks", "key", "gain", *_CHUNK)
    sums = met.mapInArrow(lambda batches: _answer(batches, float(unknown)), _SUMS)
    found = sums.groupBy("chunk").applyInArrow(_add_up, "digest binary, tokens long, total double")
    # Copies of a text have one digest and add up to so many times its values.
    found = found.groupBy("digest").agg(F.sum("tokens").alias("all_tokens"), F.sum("total").alias("total"), F.count("*").alias("copies"))
    lm = F.struct(
        (F.col("all_tokens") / F.col("copies")).cast("long").alias("tokens"),
        F.when(F.col("all_tokens") > 0, -F.col("total") / F.col("all_tokens")).alias("difference"),
    )
    marked = free_name(docs, "digest")
    found = found.select(F.col("digest").alias(marked), lm.alias(out))
    joined = docs.withColumn(marked, digest).join(found, marked)
    return joined.select(*(joined[f"`{name}`"] for name in [*docs.columns, out]))


#: A chunk of texts asks a group: its keys, in how many texts each stands, in which and how often. Rows of
#: a group below 0 go through: the texts' digests, their words, and what the hot keys give.
_CHUNK = ("chunk", "keys", "each", "rows", "times", "digests", "tokens", "sums")
_ASKED = "group long, chunk binary, keys binary, each binary, rows binary, times binary, digests binary, tokens binary, sums binary"
_SUMS = "chunk binary, rows binary, digests binary, tokens binary, sums binary"


def _looked_up(keys: np.ndarray, known: np.ndarray, gain: np.ndarray, unknown: float) -> tuple[np.ndarray, np.ndarray]:
    """Which keys are known, and what each adds: a word, instead of an unknown one; a pair, to its word."""
    if not len(known):
        return np.zeros(len(keys), dtype=bool), np.zeros(len(keys))
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[place] == keys
    return hit, np.where(hit, gain[place] - np.where(keys <= _LOW, unknown, 0.0), 0.0)


def _ask(batches: Iterator[pa.RecordBatch], hot: tuple, unknown: float, groups: int) -> Iterator[pa.RecordBatch]:
    """Keys of chunks of texts, by group; a chunk is named by its texts, so that it has one name in every try."""
    keys_of: list[np.ndarray] = []
    rows_of: list[np.ndarray] = []
    tokens: list[np.ndarray] = []
    digests: list[bytes] = []
    size = texts = 0

    def flush() -> pa.RecordBatch:
        keys = np.concatenate(keys_of) if keys_of else np.zeros(0, dtype=np.uint64)
        rows = np.concatenate(rows_of) if rows_of else np.zeros(0, dtype=np.int32)
        keys_of.clear(), rows_of.clear()
        n = np.concatenate(tokens)
        chunk = hashlib.blake2b(b"".join(digests), digest_size=16).digest()
        sums = unknown * n
        distinct, place = np.unique(keys, return_inverse=True)
        hit, gain = _looked_up(distinct, *hot, unknown)
        sums += np.bincount(rows, weights=gain[place], minlength=texts)
        cold = ~hit[place]
        # One entry for a key and a text.
        pair, times = np.unique(place[cold] * texts + rows[cold], return_counts=True)
        del keys, rows, place, cold
        key, row = np.divmod(pair, texts)
        group = _group(distinct, groups)[key]
        order = np.argsort(group, kind="stable")
        key, row, times, group = key[order], row[order], times[order], group[order]
        cuts = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else np.zeros(1, dtype=np.int64)
        out = []
        for first, last in zip(cuts[:-1], cuts[1:]):
            own = key[first:last]
            heads = np.flatnonzero(np.diff(own, prepend=-1))
            each = np.diff(np.append(heads, len(own)))
            asked = (_packed(distinct[own[heads]]), _planes(each), _planes(row[first:last]), _planes(times[first:last]))
            out.append((int(group[first]), chunk, *asked, None, None, None))
        through = -1 - int.from_bytes(chunk[:4], "little") % groups
        out.append((through, chunk, None, None, None, None, b"".join(digests), n.astype(np.int64).tobytes(), sums.tobytes()))
        kinds = [pa.int64(), *[pa.binary()] * 8]
        arrays = [pa.array(values, kind) for values, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(arrays, names=["group", *_CHUNK])

    for batch in batches:
        marks = batch.column(0)
        for first, w in hashed_words(batch.column(1), LETTERS):
            n = np.diff(w.bounds)
            rows = np.repeat(np.arange(texts, texts + len(n), dtype=np.int32), n)
            for keys in _keys(w):
                keys_of.append(keys), rows_of.append(rows)
                size += len(keys)
            tokens.append(n)
            digests += marks.slice(first, len(n)).to_pylist()
            texts += len(n)
            if size >= 2 * ASK:
                yield flush()
                tokens.clear(), digests.clear()
                size = texts = 0
    if texts:
        yield flush()


def _answer(batches: Iterator[pa.RecordBatch], unknown: float) -> Iterator[pa.RecordBatch]:
    """Sums by text of what a group knows of a chunk; a group's part of the table comes before its chunks."""
    here, known, gain = None, [], []
    sorted_part: tuple | None = None
    for batch in batches:
        group, asks = (batch.column(i).to_numpy() for i in (0, 1))
        borders = np.flatnonzero((np.diff(group) != 0) | (np.diff(asks) != 0)) + 1
        out = []
        for first, last in zip(np.r_[0, borders], np.r_[borders, len(group)]):
            part = batch.slice(first, last - first)
            if group[first] != here:
                here, known, gain, sorted_part = group[first], [], [], None
            if not asks[first]:
                known.append(part.column("key").to_numpy().view(np.uint64))
                gain.append(part.column("gain").to_numpy())
                continue
            if sorted_part is None:
                keys = np.concatenate(known) if known else np.zeros(0, dtype=np.uint64)
                order = np.argsort(keys)
                sorted_part = keys[order], (np.concatenate(gain) if gain else np.zeros(0))[order]
            for x in part.select(_CHUNK).to_pylist():
                if x["keys"] is None:
                    out.append((x["chunk"], None, x["digests"], x["tokens"], x["sums"]))
                    continue
                hit, own = _looked_up(_unpacked(x["keys"]), *sorted_part, unknown)
                if not hit.any():
                    continue
                each, rows, times = (_numbers(x[name]) for name in ("each", "rows", "times"))
                mine = np.repeat(hit, each)
                rows, place = np.unique(rows[mine], return_inverse=True)
                sums = np.bincount(place, weights=(np.repeat(own, each) * times)[mine])
                out.append((x["chunk"], _planes(rows), None, None, sums.tobytes()))
        if out:
            arrays = [pa.array(values, pa.binary()) for values in zip(*out)]
            yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "rows", "digests", "tokens", "sums"])


def _add_up(table: pa.Table) -> pa.Table:
    """Texts of a chunk with all their sums; chunks of equal texts have one name and add up as copies."""
    rows = table.to_pylist()
    base = [x for x in rows if x["digests"] is not None]
    total = sum(np.frombuffer(x["sums"]) for x in base)
    tokens = sum(np.frombuffer(x["tokens"], dtype=np.int64) for x in base)
    total = total.copy()
    for x in rows:
        if x["digests"] is None:
            total[_numbers(x["rows"])] += np.frombuffer(x["sums"])
    digests, n = base[0]["digests"], len(base)
    marks = [digests[i : i + 32] for i in range(0, len(digests), 32)]
    # As many rows a text as there are equal chunks, so that copies are counted right.
    found = {"digest": marks * n, "tokens": np.tile(tokens / n, n).astype(np.int64), "total": np.tile(total / n, n)}
    return pa.table({"digest": pa.array(found["digest"], pa.binary()), "tokens": found["tokens"], "total": found["total"]})
