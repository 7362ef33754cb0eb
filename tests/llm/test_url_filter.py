import pytest

from larderlake.llm import url_filter as u

RULES = [
    u.Rule("block", "net", "/"),
    u.Rule("allow", "example.net", "/en/"),
    u.Rule("block", "example.com", "/de/"),
    u.Rule("allow", "org", "/fr/"),
]


def judged(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = u.judge(pages, u.rule_table(spark, RULES)).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}


def test_rules(spark):
    urls = {
        1: ("http://A.Example.NET/en/1?x#y", "a.example.net", "/en/1", "example.net/en/", "allow"),
        2: ("http://example.net/EN/", "example.net", "/EN/", "net/", "block"),
        3: ("https://example.com/de/x", "example.com", "/de/x", "example.com/de/", "block"),
        4: ("https://notexample.com/de/x", "notexample.com", "/de/x", None, "allow"),
        5: ("https://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
        6: ("https://x.net", "x.net", "", None, "allow"),
        7: ("no scheme example.net/de/", "", "", None, "allow"),
        8: (None, "", "", None, "allow"),
        9: ("://net/", "net", "/", "net/", "block"),
        10: ("http://h.org/a://b/fr/", "h.org", "/a://b/fr/", None, "allow"),
    }
    assert judged(spark, [(k, v[0], None) for k, v in urls.items()]) == {k: v[1:] for k, v in urls.items()}


def test_blocks_reach_aliases_and_allows_come_first(spark):
    canonical = '<LINK href="%s" rel="canonical">'
    refresh = "<meta http-equiv=refresh content='0; url=%s'>"
    pages = [
        (1, "http://a.org/1", canonical % "http://b.org/2"),
        (2, "http://b.org/2", refresh % "http://www.c.org/3/"),
        (3, "https://c.org/3?utm_source=x&utm_medium=y#top", refresh % "https://bad.net/x"),
        (4, "http://a.org/4", canonical % "/5"),
        (5, "http://a.org/5", canonical % "http://evil.net/"),
        (6, "http://a.org/fr/6", canonical % "http://evil.net/"),
        (7, "http://r.org/go?url=https%3A%2F%2Fother.net%2Fx", ""),
        (8, "http://example.com/de", None),
        (9, "http://www.example.com/de/", None),
        (10, "http://lone.org/", canonical % "http://lone.org/"),
    ]
    found = {k: v[3] for k, v in judged(spark, pages).items()}
    assert {k for k, v in found.items() if v == "block"} == {1, 2, 3, 7, 8, 9}
    # An explicit allow among its aliases keeps a page that no rule fits.
    assert found[4] == found[5] == found[6] == "allow"


@pytest.mark.parametrize("base", ["", "<BASE href='/c/d/'>", "<base href='//o.org/c/d/e?f'>"])
def test_relative_targets(spark, base):
    site, folder = {"": ("http://h.org", "/a/b/"), "<B": ("http://h.org", "/c/d/")}.get(base[:2], ("http://o.org", "/c/d/"))
    page, up = {"": "/a/b/p"}.get(base, "/c/d/e" if "o.org" in base else "/c/d/"), folder.split("/")[1]
    forms = {
        "x.html": f"{folder}x.html", "./x": f"{folder}x", "../x": f"/{up}/x", "../../../x": "/x", "..": f"/{up}/", "?id=2": f"{page}?id=2",
        "x?u=http://y/../z": f"{folder}x?u=http://y/../z", "/k/./l/../m": "/k/m", "mailto:x@y.z": None,
    }
    rows = [(f"http://h.org/a/b/p?n={i}", f"{base}<link rel=canonical href='{t}'>") for i, t in enumerate(forms)]
    rows += [(f"http://h.org/a/b/p?m={i}", f"{base}<meta http-equiv=refresh content='0; url={t}'>") for i, t in enumerate(forms)]
    found = u.links(spark.createDataFrame(rows, "url string, html string")).collect()
    expected = {(f"http://h.org/a/b/p?{k}={i}", site + x) for k in "nm" for i, x in enumerate(forms.values()) if x}
    assert {(r.url, r.target) for r in found} == expected


def test_blanks_in_quoted_links(spark):
    rows = [("http://h.org/a/b", "<link rel=canonical href=' my page.html '><link rel='canonical' href=x title='y'>")]
    found = u.links(spark.createDataFrame(rows, "url string, html string")).collect()
    assert {r.target for r in found} == {"http://h.org/a/my%20page.html", "http://h.org/a/x"}


def test_comments_and_scripts_hold_no_links(spark):
    link = "<link rel=canonical href='http://h.org/%s'>"
    rows = [
        ("http://h.org/1", f"<!-- {link % 'a'}\n{link % 'b'} -->{link % 'c'}<!-- x -->"),
        ("http://h.org/2", f"<SCRIPT type=x>document.write(\"{link % 'd'}\")</Script ><p>{link % 'e'}"),
        ("http://h.org/3", f"<!-- open {link % 'f'}"),
    ]
    found = u.links(spark.createDataFrame(rows, "url string, html string")).collect()
    assert {(r.url[-1], r.target[-1]) for r in found} == {("1", "c"), ("2", "e"), ("3", "f")}


def test_hosts_of_many_labels(spark):
    host = "a." * 200_000
    rows = [(1, f"http://{host}example.net/en/", None), (2, f"http://{host}net/de", None), (3, f"http://{host}", None)]
    found = {k: v[2:] for k, v in judged(spark, rows).items()}
    assert found == {1: ("example.net/en/", "allow"), 2: ("net/", "block"), 3: (None, "allow")}


def test_empty_and_repeated(spark):
    rules = u.rule_table(spark, RULES)
    none = spark.createDataFrame([], "page_id long, url string, html string, node string, rule string")
    assert u.judge(none, rules).count() == 0
    pages = spark.createDataFrame(
        [(1, "http://x.net/a", "", "n", "r")] * 3 + [(None, None, None, None, None)],
        "page_id long, url string, html string, node string, rule string",
    )
    found = u.judge(pages, rules)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(str(r.verdict) for r in found.collect()) == ["allow", "block", "block", "block"]
    assert u.judge(pages, rules.where("false")).where("verdict = 'block'").count() == 0


@pytest.mark.parametrize("a, b", [("http://www.A.org:80/x/", "https://a.org/x"), ("http://a.org/?utm_x=1&p=2", "http://a.org?p=2")])
def test_normal_forms(spark, a, b):
    rows = spark.createDataFrame([(a,), (b,)], "url string").select(u.normal_form(u.F.col("url")))
    assert len({r[0] for r in rows.collect()}) == 1
