from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from marketlens.llm import oracles, queries

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus_duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_queries_equal_their_sql(spark, corpus_duck, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    rel = corpus_duck.sql(oracles.ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(repr(tuple(r)) for r in df.collect()) == sorted(repr(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_one_query_for_each_operator():
    names = list(queries.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10
    assert {*names, "pipeline"} <= set(entry.queries())


def test_pipeline_equals_its_operators(spark):
    """Every stage against a brute-force reading of the stage's own input."""
    import corpus_pipeline
    from marketlens.llm.importance import classify
    from tests.llm.test_jaccard_join import brute as components
    from tests.llm.test_pii import brute as spans

    docs = spark.read.parquet(f"{SMOKE_DIR}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        before, after = kept, stage(spark, kept, SMOKE_DIR).cache()
        rows, left = {r["doc_id"]: r for r in before.collect()}, after.collect()
        if name != "pack":
            assert after.columns == columns
        if name == "quality":
            labels = spark.read.parquet(f"{SMOKE_DIR}/labels.parquet")
            want = {r["doc_id"] for r in classify(before, labels).filter("kept").collect()}
            assert {r["doc_id"] for r in left} == want
            good = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
            bad = {r["doc_id"] for r in labels.filter("quality = 0").collect()}
            assert good <= want and not bad & want
        elif name == "near_duplicates":
            found = components([(d, r["text"]) for d, r in rows.items()], 5, 80)
            assert sorted(r["doc_id"] for r in left) == sorted(d for d, (_, c) in found.items() if c == d)
        elif name == "personal_data":
            assert len(left) == len(rows) and not any(spans(r["text"]) for r in left)
            for r in left:
                assert r["n_chars"] == len(r["text"])
                if not spans(rows[r["doc_id"]]["text"]):
                    assert r["text"] == rows[r["doc_id"]]["text"]
        elif name == "mix_sources":
            assert all(r == rows[r["doc_id"]] for r in left)
        elif name == "pack":
            assert sum(r["size"] for r in left) == sum(len(r["text"].split()) for r in before.collect())
        kept = spark.createDataFrame(left, after.schema)
    assert corpus_pipeline.run(spark, SMOKE_DIR).count() == len(left)
