import random
import re
from collections import Counter
from math import exp, log

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from larderlake.llm import quality as q
from larderlake.llm.queries import QUERIES
from larderlake.llm.words import buffers

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    """All measures of a text, by the letter."""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {j for i in range(len(words) - 7) if seen[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "n_lines": len(lines),
        "n_same": sum(a == b for a, b in zip(words, words[1:])),
        "n_calls": sum(w[-1] in "!?" for w in words),
        "n_stops": sum(w[-1] in ".!?" for w in words),
        "n_plain": len(re.findall(r"[A-Za-z0-9]|[^\x00-\x7F]", text)),
        "n_letters": len(re.findall("[A-Za-z]", text)),
        "n_capitals": len(re.findall("[A-Z]", text)),
    }


def base_failed(m):
    return m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]


@given(texts=st.lists(st.none() | st.text(alphabet="aAb \n\t.!#*|é\U0001f600\r", max_size=120)))
def test_measures_are_those_of_plain_python(texts):
    texts = [*texts, "Do as you like and say it twice. " * 5, "x\ny\nx\n \n"]
    found = q.measures(*buffers(pa.array(texts, pa.string())))
    for i, text in enumerate(texts):
        assert {name: int(found[name][i]) for name in q.MEASURES} == brute(text)


def brute_fit(votes, kinds):
    """The same model, one text at a time: shares of classes, how often rules are bad on each, P(good) of each text."""
    faults = sorted(set(kinds))
    classes = range(len(faults) + 1)
    belief = [[(q.PRIOR_FAULT if c and faults[c - 1] == kind else q.PRIOR_OTHER)[0] for c in classes] for kind in kinds]
    first = [q.PRIOR_GOOD] + [(1 - q.PRIOR_GOOD) / len(faults)] * len(faults)
    shares, bad, worth = first, belief, q.WORTH * len(votes)
    for _ in range(q.ROUNDS):
        posterior = []
        for v in votes:
            logs = [log(shares[c]) + sum(log(bad[r][c] if x == 0 else 1 - bad[r][c]) for r, x in enumerate(v) if x != 1) for c in classes]
            scaled = [exp(x - max(logs)) for x in logs]
            posterior.append([x / sum(scaled) for x in scaled])
        bad = [
            [
                (sum(p[c] for v, p in zip(votes, posterior) if v[r] == 0) + worth * first[c] * belief[r][c])
                / (sum(p[c] for v, p in zip(votes, posterior) if v[r] != 1) + worth * first[c])
                for c in classes
            ]
            for r in range(len(kinds))
        ]
        new = [(sum(p[c] for p in posterior) + worth * first[c]) / (len(votes) + worth) for c in classes]
        if max(abs(a - b) for a, b in zip(new, shares)) < 1e-9:
            break
        shares = new
    return shares, bad, [p[0] for p in posterior]


def votes_of(m):
    return [0 if rule.bad(m) else 2 if rule.good(m) else 1 for rule in q.RULES]


def test_estimates_find_hidden_accuracies():
    rng, kinds = random.Random(1), ["x", "x", "y", "y", "y"]
    wrong, right = [0.02, 0.05, 0.01, 0.1, 0.03], [0.9, 0.7, 0.8, 0.6, 0.95]
    counts, truth = Counter(), {}
    for _ in range(60_000):
        kind = rng.choices(["", "x", "y"], [0.8, 0.1, 0.1])[0]
        votes = [
            1 if rng.random() < 0.2 else 2 * (rng.random() > (right[r] if kinds[r] == kind else wrong[r])) for r in range(5)
        ]
        code = sum(v * 3**i for i, v in enumerate(votes))
        counts[code] += 1
        truth.setdefault(code, []).append(kind == "")
    model = q.fit(counts, kinds)
    assert model.shares.tolist() == pytest.approx([0.8, 0.1, 0.1], abs=0.06)
    assert model.votes[:, 0, 0].tolist() == pytest.approx(wrong, abs=0.04)
    for code in sorted(truth, key=lambda code: -len(truth[code]))[:10]:
        assert model.posterior[code] == pytest.approx(sum(truth[code]) / len(truth[code]), abs=0.15)
    # A bad vote that its own kind's other rules contradict does not decide.
    assert model.posterior[2 + 2 * 3 + 2 * 9 + 0 * 27 + 2 * 81] > q.KEEP


def check(spark, folder, docs):
    docs.write.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op13_quality"](spark, str(folder)).collect()
    rows = [(r.doc_id, brute(r.text)) for r in docs.select("doc_id", "text").collect()]
    wanted = Counter((id, *(m[name] for name in BASE[:-1]), base_failed(m)) for id, m in rows)
    assert Counter((r.doc_id, *(r[name] for name in BASE)) for r in found) == wanted
    posterior = {}
    voted = [m for _, m in rows if m["n_words"]]
    if voted:
        for m, p in zip(voted, brute_fit([votes_of(m) for m in voted], [r.kind for r in q.RULES])[2]):
            posterior[tuple(m[name] for name in BASE[:-1])] = p
    for r in found:
        p = posterior.get(tuple(r[name] for name in BASE[:-1]), 0.0)
        assert r.p_good == pytest.approx(p, abs=1e-3)
        assert r.kept == (not r.base_failed and r.p_good >= q.KEEP)
    return found


def test_query_equals_brute_force(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    found = check(spark, tmp_path, spark.read.parquet(f"{folder}/documents.parquet"))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    good = [r.kept for r in found if labels.get(r.doc_id) == 1 and not r.base_failed]
    bad = [r.kept for r in found if labels.get(r.doc_id) == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1


def test_awkward_tables(spark, awkward, nothing, tmp_path):
    assert len(check(spark, tmp_path / "a", awkward)) == awkward.count()
    assert check(spark, tmp_path / "b", nothing) == []
    clashing = awkward.withColumn("quality", awkward["n"]).withColumn("pattern", awkward["n"])
    kept = q.keep_good(clashing)
    assert kept.columns == clashing.columns and kept.count() <= clashing.count()


def test_too_many_rules(nothing):
    with pytest.raises(ValueError):
        q.judge(nothing, rules=q.RULES * 2)
