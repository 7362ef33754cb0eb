import itertools
import random
import re
import zlib
from collections import Counter

import pytest

from larderlake.llm import spelling as s
from larderlake.llm.queries import QUERIES

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts):
    near = {w: [v for v in counts if is_near(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= s.TIMES * counts[w] else None
    out = set()
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def found(df):
    rows = [tuple(r[c] for c in COLUMNS) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def vocabulary(rng, n):
    """Words over few letters, with their variants, so that many are near."""
    words = set()
    while len(words) < n:
        w = "".join(rng.choices("abcé", k=rng.choice([5, 5, 6, 7, 9])))
        words.add(w)
        i = rng.randrange(len(w))
        words.add(w[:i] + rng.choice("abcÿ") + w[i + rng.choice([0, 1]) :])
    return {w: rng.choice([3, 4, 6, 7, 12, 50, 400]) for w in words if len(w) >= 5}


@pytest.mark.parametrize("block", [None, 64])
def test_near_words_and_forms(spark, monkeypatch, block):
    counts = vocabulary(random.Random(1), 700)
    if block:
        # Small blocks: groups are cut, and their queries go to each block.
        monkeypatch.setattr(s, "BLOCK", block)
        monkeypatch.setattr(s, "STEP", 50)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found(s.group_variants(words)) == brute(counts)


def test_forms_are_followed_to_the_last(spark):
    chain = ["aaaaa" + "b" * i for i in range(12)]
    counts = {w: 3 * 2**i for i, w in enumerate(chain)}
    rows = found(s.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert rows == brute(counts)
    assert {r[2] for r in rows} == {chain[-1]}


def test_long_words_and_ties(spark):
    long = "x" * 5_000
    counts = {long: 3, long + "y": 9, long[:-1] + "y": 9, "aabaa": 5, "aacaa": 10, "aadaa": 10, "zzzzzz": 3}
    rows = found(s.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert rows == brute(counts)
    assert next(r for r in rows if r[0] == "aabaa")[1] == "aacaa"


def brute_words(docs):
    counts = Counter()
    for id, text in docs:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return {w: n for w, n in counts.items() if len(w) >= s.MIN_LENGTH and n >= s.MIN_COUNT}


def query(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    return QUERIES["op12_spelling_variants"](spark, str(folder))


def test_query_on_awkward_tables(spark, awkward, nothing, tmp_path):
    docs = [(r.doc_id, r.text) for r in awkward.select("doc_id", "text").collect()]
    assert found(query(spark, tmp_path / "a", awkward)) == brute(brute_words(docs))
    assert found(query(spark, tmp_path / "b", nothing)) == set()


def test_query_damages_runs(spark, tmp_path):
    rng = random.Random(4)
    words = ["Straße", "garçon", "naïvely", "ABCDEFG", "kitten", "sitting", "sittin", "mitten"]
    docs = [(i, " ".join(rng.choices(words, k=60)) + "×Ā" + rng.choice(words)) for i in range(150)]
    rows = found(query(spark, tmp_path, spark.createDataFrame(docs, "doc_id long, text string")))
    assert rows == brute(brute_words(docs))
    assert any(r[1] for r in rows)


def test_all_short_strings(spark):
    words = ["".join(w) for w in itertools.product("ab", repeat=5)] + ["".join(w) for w in itertools.product("ab", repeat=6)]
    counts = {w: 3 + i % 11 for i, w in enumerate(words)}
    assert found(s.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute(counts)
