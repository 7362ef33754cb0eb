"""Registered queries against their SQL, and the pipeline's stages against plain Python."""

import duckdb
import pytest

import corpus_pipeline
from larderlake.llm.queries import ORACLE, QUERIES
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_mixing import brute_targets
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_pii import brute as personal

SF = "/root/testdata/sf0.001"


def ordered(columns, data):
    places = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in places) for r in data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df, wanted = QUERIES[name](spark, SF), con.sql(ORACLE[name])
    assert ordered(df.columns, df.collect()) == ordered(list(wanted.columns), wanted.fetchall())


def test_every_operator_has_a_query():
    numbers = {name.split("_")[0] for name in QUERIES if name.startswith("op")}
    assert numbers == {f"op{i}" for i in range(1, 14)} and "pipeline" in QUERIES


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SF)
        docs.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/stage-{name}")
        docs = spark.read.parquet(path)
        after = docs.collect()
        texts = [(k, r.text) for k, r in before.items()]
        if name != "mix":
            assert set(docs.columns) == set(next(iter(before.values())).asDict())
        if name == "language_id":
            assert len(after) == len(before)
        elif name == "near_dedup":
            wanted = {k for k, _, _, kept in near(texts, corpus_pipeline.NEAR) if kept}
            assert {r.doc_id for r in after} == wanted < set(before)
        elif name == "decontaminate":
            assert {r.doc_id for r in after} == {k for k, _, hit, _ in leaks(texts, items) if not hit} < set(before)
        elif name == "pii":
            assert {r.doc_id for r in after} == set(before)
            assert all(not personal(r.text) for r in after)
            assert any(personal(r.text) for r in before.values())
            assert all(r.text == before[r.doc_id].text for r in after if not personal(before[r.doc_id].text))
        else:
            sizes = {}
            for r in before.values():
                sizes[r.source] = sizes.get(r.source, 0) + len(r.text.split())
            for source, target in brute_targets(sizes).items():
                assert sum(len(r.text.split()) for r in after if r.source == source) == pytest.approx(target, abs=30)
