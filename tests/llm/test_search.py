import math
import random
import re
from collections import Counter

import pytest

from larderlake.llm import search


def brute(docs, queries, k):
    words = {i: re.findall(r"[a-z0-9]+", (t or "").lower()) for i, t in docs}
    df = Counter(w for ws in words.values() for w in set(ws))
    n, mean = len(words), sum(map(len, words.values())) / max(1, len(words))
    out = []
    for q, text in queries:
        scores = []
        for i, ws in words.items():
            total = 0
            for w in set(re.findall(r"[a-z0-9]+", (text or "").lower())) & set(ws):
                f, idf = ws.count(w), math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))
                total += round(1e6 * idf * (f * 2.2) / (f + 1.2 * (0.25 + 0.75 * len(ws) / mean)))
            if total:
                scores.append((-total, i))
        out += [(q, r, i, -s / 1e6) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("segment, block_terms", [(4096, 1 << 21), (40, 60)])
def test_equals_brute_force(spark, monkeypatch, segment, block_terms):
    monkeypatch.setattr(search, "SEGMENT", segment)
    monkeypatch.setattr(search, "BLOCK", 8)
    monkeypatch.setattr(search, "BLOCK_TERMS", block_terms)
    rnd = random.Random(4)
    zipf = [f"w{min(int(rnd.paretovariate(0.6)), 900)}" for _ in range(40_000)]
    docs = [(i, " ".join(rnd.sample(zipf, rnd.randrange(0, 60)))) for i in range(500)]
    docs += [(500 + i, docs[7][1]) for i in range(20)] + [(600, None), (601, "w1 " * 5000)]
    queries = [x for x in docs if x[0] % 50 == 7 or x[0] in (600, 601)]
    schema = "doc_id long, text string"
    found = search.top_k(spark.createDataFrame(docs, schema), spark.createDataFrame(queries, schema), 5)
    assert sorted((r["query"], r["rank"], r["doc_id"], r["score"]) for r in found.collect()) == brute(docs, queries, 5)


def test_awkward_tables(awkward, nothing):
    found = search.top_k(awkward, awkward, 3).collect()
    assert {r["query"] for r in found} == {1, 4, 5, 6, 7}
    assert [r.doc_id for r in sorted(found, key=lambda r: r["rank"]) if r["query"] == 1] == [1, 1, 7]
    assert search.top_k(nothing, awkward).count() == 0 and search.top_k(awkward, nothing).count() == 0


def test_tasks_begin_with_scores_that_others_found(spark):
    """Else each task returns the best k of its own segments for every query."""
    rnd = random.Random(5)
    docs = [(i, " ".join(f"w{rnd.randrange(3000)}" for _ in range(40))) for i in range(800)]
    schema, k, tasks = "doc_id long, text string", 5, 8
    segments = search.keep(search.index(spark.createDataFrame(docs, schema).repartition(tasks)), "index")
    asked = search._queries(spark.createDataFrame(docs[::20], schema), "doc_id", "text").collect()
    assert segments.count() == tasks
    found = search._run(segments, asked, len(docs), 40.0, k).count()
    assert len(asked) * k <= found < 2 * len(asked) * k
