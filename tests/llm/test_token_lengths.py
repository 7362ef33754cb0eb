import random
import re

import pytest

from larderlake.llm import token_lengths as t
from larderlake.llm.queries import VOCABULARY


@pytest.fixture(scope="module")
def vocabulary():
    return t.read_vocabulary(VOCABULARY)


def test_lengths_are_those_of_the_encoder(spark, vocabulary):
    import tiktoken

    encoding = tiktoken.Encoding("x", pat_str=t.SPLIT, mergeable_ranks=vocabulary, special_tokens={})
    texts = ["Hello, world!", "", "é \U0001f600 x", "<|endoftext|>", "a" * 5000, None]
    docs = spark.createDataFrame([(x,) for x in texts], "text string")
    found = sorted(r.length for r in t.encoded_lengths(docs, vocabulary).collect())
    assert found == sorted(len(encoding.encode_ordinary(x or "")) for x in texts)
    # What is encoded is the whole text.
    assert all(encoding.decode(encoding.encode_ordinary(x)) == x for x in texts if x)


def test_white_space_of_any_length(spark, vocabulary, monkeypatch):
    import tiktoken

    encoding = tiktoken.Encoding("x", pat_str=t.SPLIT, mergeable_ranks=vocabulary, special_tokens={})
    # Texts that the splitter can do as well: the same lengths, however short the runs that are cut off.
    parts = [" ", "\n", "\t ", "\r\n", "\u2003", "\xa0", "\x1c", "a", "word", "1", "!", "'s", "\u00e9", " x"]
    rng = random.Random(2)
    texts = ["".join(p * rng.choice([1, 2, 9]) for p in rng.choices(parts, k=12)) for _ in range(400)]
    for least in (2, 3, 5):
        monkeypatch.setattr(t, "LONG_SPACE", re.compile(t.LONG_SPACE.pattern.replace("4096", str(least))))
        assert [t.encoded_length(encoding, x) for x in texts] == [len(encoding.encode_ordinary(x)) for x in texts]
    monkeypatch.undo()
    long = [" " * 300_000 + "x", "a" + "\n" * 300_000, "\t" * 5000 + "1" + " " * 5000]
    assert [t.encoded_length(encoding, x) for x in long] == [len(encoding.encode_ordinary(x)) for x in long]
    # And such as it can not.
    docs = spark.createDataFrame([(" " * 10_000_000 + "x",), ("\n" * 1_000_000,)], "text string")
    assert sorted(r.length for r in t.encoded_lengths(docs, vocabulary).collect()) == [1_000_000, 10_000_000]


def test_histogram_answers_every_limit(spark):
    lengths = [0, 0, 3, 3, 3, 5, 1023, 1024, 1025, 90_000]
    found = t.histogram(spark.createDataFrame([(x,) for x in lengths], "length long"))
    for r in found.collect():
        over = [x for x in lengths if x >= r.length]
        assert (r.docs, r.tokens) == (lengths.count(r.length), lengths.count(r.length) * r.length)
        assert (r.docs_from, r.tokens_from) == (len(over), sum(over))
        assert r.truncated_total == sum(min(x, r.length) for x in lengths)
        assert r.share_to == pytest.approx(sum(x <= r.length for x in lengths) / len(lengths))
    limits = [0, 1, 4, 1024, 2000, 10**6]
    for r in t.at_limits(found, limits).collect():
        assert r.docs_over == sum(x > r.limit for x in lengths)
        assert r.truncated_total == sum(min(x, r.limit) for x in lengths)
    assert t.quantile(found, 0.5) == 3 and t.quantile(found, 1.0) == 90_000


def test_awkward_tables(awkward, nothing, vocabulary):
    found = t.histogram(t.encoded_lengths(awkward, vocabulary))
    assert found.groupBy().sum("docs").first()[0] == awkward.count()
    empty = t.histogram(t.encoded_lengths(nothing, vocabulary))
    assert empty.count() == 0 and t.quantile(empty, 0.5) is None
    assert t.at_limits(empty, [5]).first().truncated_total == 0
