import random

import numpy as np
import pytest

from larderlake.llm import near_dedup as nd


def brute(docs, percent=85):
    sets = {}
    for key, text in docs:
        w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
        sets[key] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((k, len(sets[k]), root(k), root(k) == k) for k in keys)


def corpus(copies, base_words, seed=1):
    """Near copies of one text, copies of copies, exact copies and others."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(5000)}"
    base = [word() for _ in range(base_words)]
    docs = [" ".join(base)]
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randrange(1, 4)):
            w[rnd.randrange(len(w))] = word()
        docs.append(" ".join(w))
    chain = list(base[::-1])
    for i in range(20):
        chain[i * 7] = word()
        docs.append(" ".join(chain))
    docs += [docs[3], docs[3], docs[-1]] + [" ".join(word() for _ in range(rnd.randrange(1, 60))) for _ in range(60)]
    docs += ["a b", "A  b", "a b c d e f", "a b c d e f g", "", " "]
    return list(enumerate(docs))


@pytest.mark.parametrize("region", [1024, 32])
def test_components_equal_brute_force(spark, monkeypatch, region):
    monkeypatch.setattr(nd, "REGION", region)
    docs = corpus(60, 150)
    found = nd.link_components(spark.createDataFrame(docs, "doc_id long, text string"))
    rows = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect())
    assert rows == brute(docs)


def test_pairs_in_a_mass_just_under_the_threshold(spark, monkeypatch):
    """Forms that are 0.83 alike fill regions that no prefix divides; some pairs of them are 0.86 alike."""
    monkeypatch.setattr(nd, "REGION", 16)
    monkeypatch.setattr(nd, "DEEPER", (8,))
    form = " ".join(f"form{i}" for i in range(184))
    own = lambda name, n: [f"{name}x{i}" for i in range(n)]
    docs = []
    for i in range(300):
        # Shingles in common: 180, and 3 more with the partner; 18 of each text are not in the form.
        words = own(f"p{i // 2}", 3) + own(f"t{i}", 15) if i < 120 else own(f"t{i}", 18)
        docs.append((i, f"{form} " + " ".join(words)))
    expected = brute(docs)
    assert sum(not stays for _, _, _, stays in expected) == 60
    found = nd.link_components(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found.collect()) == expected


@pytest.mark.parametrize("percent", [85, 80])
@pytest.mark.parametrize("depth", [5, 8, 11, 15])
def test_orders_of_a_depth_fail_independently(percent, depth):
    """Pairs at the threshold share as few prefixes as trees with values of their own let expect."""
    functions, n, p = nd._functions(depth, percent), nd.trees(depth, percent), (percent / 100) ** depth
    assert len(set(zip(*(x.tolist() for x in functions)))) == n * depth and (1 - p) ** n <= nd.MISS
    rnd, shared = np.random.default_rng(depth), []
    for _ in range(300):
        common, own = 4 * percent, 2 * (100 - percent)
        x = rnd.integers(0, 1 << 64, common + 2 * own, dtype=np.uint64)
        a, b = (nd._keys(y, depth, functions) for y in (x[: common + own], np.delete(x, slice(common, common + own))))
        shared.append(int((a == b).sum()))
    # Drawn from few values, orders share much: the spread was several times that of independent ones.
    assert min(shared) > 0 and np.var(shared) < 2 * n * p and abs(np.mean(shared) / (n * p) - 1) < 0.15


def test_pipeline_threshold(spark):
    docs = corpus(25, 150, seed=2)
    kept = nd.drop_near_copies(spark.createDataFrame(docs, "doc_id long, text string"), 80)
    assert sorted(r.doc_id for r in kept.collect()) == [k for k, _, _, stays in brute(docs, 80) if stays]


def test_awkward_tables(awkward, nothing):
    found = nd.link_components(awkward)
    rows = {(r.doc_id, r.component_id, r.kept) for r in found.collect()}
    assert {(1, 1, True), (2, 2, True), (3, 3, True), (None, None, True), (7, 1, False)} <= rows or (7, 7, True) in rows
    kept = nd.drop_near_copies(awkward)
    assert kept.columns == awkward.columns and kept.where("doc_id = 1").count() == 1
    assert kept.where("doc_id is null").count() == 3
    assert nd.link_components(nothing).count() == 0 and nd.drop_near_copies(nothing).count() == 0
