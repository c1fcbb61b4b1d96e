from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm.importance import classify, kth_largest, resample, separating


def corpus(n=600):
    rng = random.Random(8)
    clean = ["river", "stone", "light", "house", "walk", "of", "the", "and"]
    rows, labels = [], []
    for i in range(n):
        good = i % 6 != 0
        words = [rng.choice(clean) for _ in range(rng.randint(3, 80))]
        rows.append((i, " ".join(words) + "." if good else " ".join(w + "$$$" for w in words)))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, int(good), 0))
    return rows, labels


@pytest.fixture
def labels_df(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(documents, labels_df):
    rows, labels = corpus()
    got = {r["doc_id"]: r["kept"] for r in classify(documents(rows), labels_df(labels)).collect()}
    known = {i for i, _, _ in labels}
    held_out = [(got[i], i % 6 != 0) for i, _ in rows if i not in known]
    assert held_out and np.mean([a == b for a, b in held_out]) >= 0.98
    assert all(got[i] for i, _ in rows if i % 6 != 0)  # clean documents stay


def test_resample_keeps_the_same_rows(documents, labels_df):
    rows, labels = corpus(200)
    df, lab = documents(rows), labels_df(labels)
    want = sorted(r["doc_id"] for r in classify(df, lab).filter("kept").collect())
    out = resample(df, lab)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == want
    assert sorted(r["doc_id"] for r in resample(df.repartition(6), lab).collect()) == want


def test_a_given_sample_size(documents, labels_df):
    rows, labels = corpus(200)
    assert classify(documents(rows), labels_df(labels), k=37).filter("kept").count() == 37


def test_edge_cases(documents, labels_df):
    assert classify(documents([]), labels_df([])).collect() == []
    got = classify(documents([(1, None), (2, ""), (None, "a b"), (4, "x"), (4, "x")]), labels_df([])).collect()
    assert len(got) == 5 and all(r["kept"] for r in got)
    assert {r["n_grams"] for r in got if r["doc_id"] in (1, 2)} == {0}
    nulls = [(1, None, None), (None, 1, 0), (2, 1, 0), (4, 0, 1)]
    assert classify(documents([(1, "a"), (2, "b c"), (4, "d $$")]), labels_df(nulls)).count() == 3


def test_kth_largest(spark):
    values = [random.Random(1).gauss(0, 3) for _ in range(3000)] + [5.0] * 500
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 10, 499, 501, 2500, 3499):
        assert kth_largest(df, "v", k, bins=16, exact_rows=50) == sorted(values)[-k]
    assert kth_largest(df, "v", len(values)) == -np.inf
    assert kth_largest(df.filter(F.lit(False)), "v", 3) == -np.inf


def test_separating_weight():
    assert separating(np.array([1.0, 2, 3, 4]), np.array([False, False, True, True])) == 2.5
    assert separating(np.array([1.0, 2]), np.array([True, True])) == -np.inf
