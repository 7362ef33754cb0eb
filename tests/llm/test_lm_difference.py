import math
import re
from collections import Counter

import numpy as np
import pytest

from larderlake.llm import lm_difference as lm


def brute(docs, target):
    words = {i: re.findall(r"[a-z0-9]+", (t or "").lower()) for i, t in docs}
    single, pair, begin = [Counter(), Counter()], [Counter(), Counter()], [0, 0]
    for i, ws in words.items():
        for x in range(1 + (i in target)):
            single[x].update(ws)
            pair[x].update(zip([None, *ws], ws, strict=False))
            begin[x] += bool(ws)
    known = {w for w, n in single[0].items() if n >= lm.MIN_WORD}
    size = len(known) + 1
    total = [sum(c.values()) for c in single]
    rest = [total[x] - sum(single[x][w] for w in known) for x in (0, 1)]

    def p(x, w):
        return ((single[x][w] if w in known else rest[x]) + 1) / (total[x] + size)

    def mixed(x, h, w):
        before = begin[x] if h is None else single[x][h]
        return lm.PAIR * pair[x][h, w] / max(before, 1) + (1 - lm.PAIR) * p(x, w)

    out = {}
    for i, ws in words.items():
        loss = 0.0
        for h, w in zip([None, *ws], ws, strict=False):
            kept = pair[0][h, w] >= lm.MIN_PAIR
            loss -= math.log(mixed(1, h, w) / mixed(0, h, w)) if kept else math.log(p(1, w) / p(0, w))
        out[i] = loss / len(ws) if ws else None
    return out


@pytest.mark.parametrize("hot, flush", [(200_000, 1 << 22), (200_000, 200), (20, 200), (1, 30)])
def test_equals_brute_force(spark, monkeypatch, hot, flush):
    monkeypatch.setattr(lm, "HOT", hot)
    monkeypatch.setattr(lm, "FLUSH", flush)
    monkeypatch.setattr(lm, "ASK", flush)
    monkeypatch.setattr(lm, "GROUP", 300)
    rnd = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{int(x)}" for x in rnd.zipf(1.5 + (i % 3) / 10, 40) if x < 500)) for i in range(120)]
    docs += [(200, None), (201, ""), (202, "never seen before"), (203, docs[0][1])]
    target = [i for i, _ in docs if i % 3 == 0]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    table = lm.learn(frame, spark.createDataFrame([(i,) for i in [*target, 0, 999]], "doc_id long"))
    wanted = brute(docs, set(target))
    found = {r.doc_id: r.lm.difference for r in lm.score(frame, table).collect()}
    assert found.keys() == wanted.keys()
    for i, x in wanted.items():
        assert found[i] is None if x is None else found[i] == pytest.approx(x, abs=1e-5)


def test_packing():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 1000).astype(np.uint64))
    assert (lm._unpacked(lm._packed(keys)) == keys).all()


def test_small_numbers():
    numbers = np.array([0, 1, 255, 256, 70_000, 2**31 - 1])
    assert (lm._numbers(lm._planes(numbers)) == numbers).all()


def test_columns_fall_into_the_same_groups(spark):
    keys = np.random.default_rng(1).integers(2, 1 << 63, 200).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    rows = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key long")
    found = [r[0] for r in rows.select(lm._group_column("key", 37)).collect()]
    assert found == lm._group(keys, 37).tolist()


def test_chunks_of_equal_texts(spark, monkeypatch):
    # A chunk a text: equal texts make equal chunks, in several tasks.
    monkeypatch.setattr(lm, "ASK", 1)
    docs = [(i, ["one two three", "two two four", "one two three", ""][i % 4]) for i in range(24)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    table = lm.learn(frame, spark.createDataFrame([(1,), (5,)], "doc_id long"))
    wanted = brute(docs, {1, 5})
    for r in lm.score(frame, table).collect():
        assert r.lm.tokens == len(dict(docs)[r.doc_id].split())
        assert r.lm.difference == (None if wanted[r.doc_id] is None else pytest.approx(wanted[r.doc_id], abs=1e-9))


def test_awkward_tables(awkward, nothing):
    table = lm.learn(awkward, awkward.where("doc_id = 1"))
    found = lm.score(awkward, table)
    assert found.columns == [*awkward.columns, "lm"] and found.count() == awkward.count()
    assert found.where("lm.tokens = 0 and lm.difference is not null").count() == 0
    empty = lm.learn(nothing, nothing)
    assert lm.score(nothing, empty).count() == 0
    assert lm.score(awkward, empty).count() == awkward.count()
