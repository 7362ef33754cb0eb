import re

from larderlake.llm import credentials as c

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""


def brute(text):
    out = [("assign", *m.span()) for m in re.finditer(ASSIGN, text or "") if len(m[2]) >= 6]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return sorted(out)


KEY = "AKIA" + "Q" * 16
TEXTS = [
    'é Password = "hunter22" token:abc secret=token:abcdefgh API_KEY=x.y.z-1',
    f"{KEY} AKIASHORT {KEY}EXTRA AKIAAKIA{'Z' * 12}",
    "0123456789abcdef01234567 0123456789abcdef0123456 token=" + "ab" * 20,
    "",
    None,
    "a" * 100_000,
    f"user=alice {KEY}",
    f"user=alice {'.' * 300} password=longenough",
    "user=alice password=longenough https://db.example.com/x",
    "user=alice https://db.example.com/x wJalrXUtnFEMIK7MDENGbPxRfiCY",
    "user=alice https://db.example.com/x and no more",
    "https://db.example.com/x alone",
]


def spans(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    return {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in c.find_secrets(docs).collect()}


def test_base_and_linked_spans(spark):
    found = spans(spark)
    assert len(found) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        assert sorted(s for s in found[i] if s[0] in c.BASE) == brute(text)
        assert found[i] == sorted(found[i], key=lambda s: (s[1], (*c.BASE, *c.WEAK).index(s[0])))
    kinds = {i: [s[0] for s in found[i]] for i in found}
    # Both are identifiers: they complete nothing. Too far apart is no credential either.
    assert kinds[6] == ["access"] and kinds[7] == ["assign"]
    assert kinds[8] == ["user", "assign", "endpoint"]
    # Three weak parts of three roles make one; two don't.
    assert kinds[9] == ["user", "endpoint", "blob"] and kinds[10] == [] and kinds[11] == []


def test_awkward_tables(awkward, nothing):
    found = c.find_secrets(awkward)
    assert found.columns == ["doc_id", "spans"] and found.count() == awkward.count()
    assert c.find_secrets(nothing).count() == 0
