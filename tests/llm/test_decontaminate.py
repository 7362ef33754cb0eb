import re

import pytest

from larderlake.llm import decontaminate as d


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, size=10):
    out = []
    for key, text in docs:
        w, hit, found = words(text), set(), set()
        for item, item_text in items:
            iw = words(item_text)
            n = min(size, len(iw))
            known = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
            for i in range(len(w) - n + 1):
                if n and tuple(w[i : i + n]) in known:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
        out.append((key, len(w), len(hit), sorted(found)))
    return sorted(out)


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Short one, here"), (3, None), (4, ""), (5, "w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (5, "twice"), (6, "twice")]
DOCS = [
    (1, "before " + LONG.upper() + " after"),
    (2, "a short one here, short ONE: here."),
    (3, None),
    (4, ""),
    (5, " ".join(f"w{i}" for i in range(2, 14))),
    (6, "w1 w2 w3 w4 w5 w6 w7 w8 w9 clean"),
    (7, "twice é twice"),
]


@pytest.mark.parametrize("max_windows", [1000, 5])
def test_equals_brute_force(spark, max_windows):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = d.find_leaks(docs, items, max_windows=max_windows).collect()
    assert sorted((r.doc_id, r.leaks.n_words, r.leaks.n_hit, r.leaks["items"]) for r in found) == brute(DOCS, ITEMS)


def test_spans_and_documents_are_removed(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    cut = {r.doc_id: r.text for r in d.cut_spans(docs, items).collect()}
    assert cut[1] == "before " + d.CUT + " after" and cut[6] == DOCS[5][1] and cut[3] is None
    assert [x for x in brute(list(cut.items()), ITEMS) if x[2]] == []
    assert {r.doc_id for r in d.drop_documents(docs, items).collect()} == {3, 4, 6}


def test_awkward_tables(spark, awkward, nothing):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs")], "item_id long, text string")
    kept = d.drop_documents(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == 7
    assert d.drop_documents(nothing, items).count() == 0
    assert d.drop_documents(awkward, items.where("false")).count() == awkward.count()
