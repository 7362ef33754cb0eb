import random

import pytest

from larderlake.llm.tables import connected_components, merge_components


def brute(links):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {(x, root(x)) for x in parent}


@pytest.mark.parametrize("kind", ["chain", "stars", "random"])
def test_components(spark, kind):
    rnd = random.Random(3)
    links = {
        "chain": [(i + 1, i) for i in range(200)] + [(500, 501), (7, 7)],
        "stars": [(1000, i) for i in range(300)] + [(i, 2000) for i in range(400, 700)] + [(1, 2)] * 50,
        "random": [(rnd.randrange(400), rnd.randrange(400)) for _ in range(180)],
    }[kind]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    wanted = brute([x for x in links if x[0] != x[1]])
    assert {(r.node, r.component) for r in found} == wanted and len(found) == len(wanted)


def test_nothing_to_link(spark):
    assert connected_components(spark.createDataFrame([(1, 1), (None, 2)], "a long, b long")).count() == 0


def test_merging(spark):
    first, more = [(1, 2), (5, 6), (8, 9)], [(2, 5), (8, 10), (20, 21)]
    components = connected_components(spark.createDataFrame(first, "a long, b long"))
    named = {2: 1, 5: 5, 8: 8}
    links = [(named.get(a, a), named.get(b, b)) for a, b in more]
    merged = merge_components(components, spark.createDataFrame(links, "a long, b long")).collect()
    assert {(r.node, r.component) for r in merged} == brute(first + more) and len(merged) == len(brute(first + more))
