"""Term statistics and weights whose cost must not grow faster than the texts; equal ids are one document."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marketlens.operators import features

WORDS = "doc_id long, words array<string>"


def some_documents(seed=1, repeated=False):
    rng = random.Random(seed)
    rows = [(i // 2 if repeated else i, [f"w{rng.randint(0, 12)}" for _ in range(rng.randint(0, 9))]) for i in range(60)]
    return [*rows, (None, ["w1", "w1"]), *([(None, ["w2"])] if repeated else [])]


@pytest.mark.parametrize("repeated", [False, True])
def test_term_stats_group_by_term_alone(spark, repeated):
    rows = some_documents(repeated=repeated)
    df = spark.createDataFrame(rows, WORDS)
    stats = features.term_stats(df, "doc_id", "words")
    total, having = Counter(), Counter()
    for _, ws in rows:
        total.update(ws)
    for doc in {i for i, _ in rows}:
        having.update({w for i, ws in rows if i == doc for w in ws})
    assert {r["term"]: (r["total_count"], r["doc_freq"]) for r in stats.collect()} == {t: (total[t], having[t]) for t in total}
    if not repeated:  # no aggregation over (document, term), nothing dealt by document
        plan = stats._jdf.queryExecution().executedPlan().toString()
        assert "keys=[doc_id" not in plan and "hashpartitioning(doc_id" not in plan


def test_weights_move_documents_once(spark, monkeypatch):
    """Arrays are dealt out by id once; neither terms nor weights are shuffled by document again."""
    monkeypatch.setattr(features, "PART_DOCS", 10)
    df = spark.createDataFrame(some_documents(), WORDS)
    vocab = spark.createDataFrame([("w1", 0, 1.0), ("w2", 1, 2.0)], "term string, term_index int, idf double")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = features.transform_tfidf(df, "doc_id", "words", F.broadcast(vocab))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("hashpartitioning(doc_id") == 1
