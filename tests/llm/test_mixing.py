import numpy as np
import pytest

from larderlake.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Sizes by source name; the excess of full sources is shared again and again."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode()) + [n for n in sizes if n is None]
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left = budget - sum(most * sizes[n] for n in full)
        rest = sum(weight[n] for n in names if n not in full)
        target = {n: most * sizes[n] if n in full else left * weight[n] / rest for n in names}
        above = {n for n in names if n not in full and target[n] > most * sizes[n]}
        if not above:
            return target
        full |= above


def documents(spark, n=600):
    rnd = np.random.default_rng(5)
    names = ["a", "b", "é", "Z", None, "b"]
    return spark.createDataFrame(
        [(i, "w " * int(rnd.pareto(1.2) * 20), names[int(rnd.integers(6))] if i % 3 else "hot") for i in range(n)],
        "doc_id long, text string, source string",
    )


def test_targets_totals_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    docs = documents(spark)
    rows = mixing.mix(docs).toPandas()
    sizes = {s: int(x["size"].sum()) for s, x in rows.groupby(rows["source"].fillna("~"))}
    sizes = {None if s == "~" else s: n for s, n in sizes.items()}
    wanted = brute_targets(sizes)
    for name, part in rows.groupby(rows["source"].fillna("~")):
        target = wanted[None if name == "~" else name]
        assert part["target"].iloc[0] == pytest.approx(target)
        # Landing may miss by a few words, and the number of documents by a few.
        assert abs((part["size"] * part["copies"]).sum() - target) <= 10
        ratio = target / part["size"].sum()
        assert abs(part["copies"].sum() - ratio * len(part)) <= 8
        assert set(part["copies"]) <= {int(ratio), int(ratio) + 1}
    again = mixing.mix(docs.repartition(7)).toPandas()
    order = ["doc_id", "number"]
    assert rows.sort_values(order, ignore_index=True)["copies"].equals(again.sort_values(order, ignore_index=True)["copies"])


def test_flight_keeps_totals():
    rnd = np.random.default_rng(1)
    s, p = rnd.integers(1, 5000, 500), np.full(500, 0.37)
    q = mixing.fly(s, p, rnd.random(500), land=False)
    assert ((q > 0) & (q < 1)).sum() <= 2
    assert q.sum() == pytest.approx(p.sum()) and (q * s).sum() == pytest.approx((p * s).sum())


def test_each_document_has_its_probability():
    s = np.array([5, 5, 80, 200, 31, 7, 7, 900, 12, 64] * 3)
    p = np.full(len(s), 0.3)
    rnd = np.random.default_rng(2)
    mean = np.mean([mixing.fly(s, p, rnd.random(len(s)), land=False) for _ in range(3000)], axis=0)
    assert np.abs(mean - 0.3).max() < 0.05


def test_the_mix_repeats_documents(spark):
    docs = documents(spark, 90)
    copies = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    taken = mixing.take(docs)
    assert taken.columns == [*docs.columns, "copy"]
    counts = {r.doc_id: r["count"] for r in taken.groupBy("doc_id").count().collect()}
    assert counts == {k: n for k, n in copies.items() if n}


def test_awkward_tables(awkward, nothing):
    rows = mixing.mix(awkward)
    assert rows.count() == awkward.count()
    taken = mixing.take(awkward, copy="copy")
    assert taken.columns == [*awkward.columns, "copy"]
    assert taken.count() == rows.groupBy().sum("copies").first()[0]
    assert mixing.mix(nothing).count() == 0 and mixing.take(nothing).count() == 0
