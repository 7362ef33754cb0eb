import collections
import math

import numpy as np
import pyarrow as pa
import pytest

from larderlake.llm import language as g

SF = "/root/testdata/sf0.001"


def brute_letters(text):
    out = []
    for c in text:
        if c.isalpha():
            out.append(c.lower() if len(c.lower()) == 1 else c)
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out)


@pytest.mark.parametrize("texts", [["Hé, llo 1 W!", "", None, "  ", "ßA\U0001f600b"], ["x" * 10, "y"]])
def test_letters(texts):
    found = []
    for codes, bounds in g.letters(pa.array(texts, pa.string())):
        found += ["".join(map(chr, codes[a:b])) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert found == [brute_letters(t or "") for t in texts]


class Brute:
    """Interpolated Kneser-Ney for one language, straight from the definition."""

    def __init__(self, texts, order, letters):
        self.order, self.letters = order, letters
        self.counts = [collections.Counter() for _ in range(order + 1)]
        for t in texts:
            for i in range(len(t)):
                self.counts[order][(" " * order + t)[i + 1 : i + 1 + order]] += 1
        for m in range(order - 1, 0, -1):
            for gram in self.counts[m + 1]:
                self.counts[m][gram[1:]] += 1
        self.discount = [0.0] * (order + 1)
        for m in range(1, order + 1):
            n = collections.Counter(self.counts[m].values())
            self.discount[m] = min(0.9, max(0.1, n[1] / max(1, n[1] + 2 * n[2])))

    def p(self, gram):
        m = len(gram)
        if m == 0:
            return 1 / (self.letters + 1)
        same = {k: v for k, v in self.counts[m].items() if k[:-1] == gram[:-1]}
        total = sum(same.values())
        if not total:
            return self.p(gram[1:])
        d = self.discount[m]
        return max(same.get(gram, 0) - d, 0) / total + d * len(same) / total * self.p(gram[1:])


def test_models_equal_the_definition():
    training = {"one": ["abab cab", "bac a"], "two": ["ccc abc", "zab"]}
    letters = len({c for ts in training.values() for t in ts for c in t})
    brute = {k: Brute(v, g.ORDER, letters) for k, v in training.items()}
    counts = collections.Counter()
    for k, ts in training.items():
        for t in ts:
            for i in range(len(t)):
                counts[(" " * g.ORDER + t)[i + 1 : i + 1 + g.ORDER][::-1], k] += 1
    grams = sorted({x for x, _ in counts})
    table = np.array([[counts[x, k] for k in training] for x in grams], dtype=float)
    codes = np.array([[ord(c) for c in x] for x in grams], dtype=np.uint64)
    model = g.kneser_ney(list(training), codes, table)
    tests = ["abc", "xq zz", "c", "bab cc"]
    stream = np.array([ord(c) for t in tests for c in t], dtype=np.uint32)
    bounds = np.cumsum([0] + [len(t) for t in tests])
    found = g.cross_entropy(model, stream, bounds)
    for row, t in zip(found, tests, strict=True):
        padded = " " * g.ORDER + t
        for h, k in zip(row, training, strict=True):
            grams = [padded[i + 1 : i + 1 + g.ORDER] for i in range(len(t))]
            assert h == pytest.approx(-sum(math.log(brute[k].p(x)) for x in grams) / len(t), rel=1e-5)


def test_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = g.learn(docs.where("doc_id % 4 <> 2"))
    found = g.identify(docs.where("doc_id % 4 = 2"), model).where("lang is not null").collect()
    assert sum(r.lang == r.language.lang for r in found) >= 0.98 * len(found)
    assert not any(r.language.rejected for r in found)
    noise = ["zqxj kvwq xzzk qqjx wvkz jxqv " * 5, "Ωμέγα ψηφίο λόγος και άλλα πολλά"]
    odd = g.identify(spark.createDataFrame([(t,) for t in noise], "text string"), model).collect()
    assert all(r.language.rejected for r in odd)


def test_awkward_tables(spark, awkward, nothing):
    model = g.learn(awkward)
    assert model.languages == ["en", "fr"]
    found = g.identify(awkward, model).collect()
    assert {r.language.lang for r in found if not any(c.isalpha() for c in r.text or "")} == {"und"}
    assert all(0 <= r.language.score <= 1 for r in found)
    kept = g.keep_known(awkward, model)
    assert kept.columns == awkward.columns
    unknown = g.learn(nothing)
    assert unknown.languages == [] and g.keep_known(awkward, unknown).count() == 0
    assert g.identify(nothing, model).count() == 0
