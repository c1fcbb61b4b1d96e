"""Order-free logistic regression, models kept as tables, exact splits."""

from __future__ import annotations

import hashlib
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.operators import exact_logit, features, model, model_store
from marketlens.operators.exact_split import exact_split, held_out

DOCS = "doc_id long, terms array<string>, label int, split string"


def corpus(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)]
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.3)
        pool = words[:20] if label else words[10:]
        rows.append((i, [rng.choice(pool) for _ in range(rng.randint(0, 12))], label, "train"))
    return rows


def fitted(spark, df, partitions, steps=exact_logit.STEPS, vocabulary=25):
    df = df.repartition(partitions)
    vocab = features.fit_tfidf(df, "doc_id", "terms", vocabulary)
    weights = features.transform_tfidf(df, "doc_id", "terms", vocab)
    rows = exact_logit.feature_rows(df.select("doc_id", "label"), weights, "doc_id")
    terms = [r["term"] for r in vocab.orderBy("term_index").collect()]
    return rows, exact_logit.fit(rows, terms, "label", steps=steps)


def test_the_model_is_the_same_for_any_partitioning(spark):
    df = spark.createDataFrame(corpus(200), DOCS)
    models = [fitted(spark, df, n, steps=4)[1] for n in (1, 8)]
    assert models[0] == models[1] and any(models[0].coefficients)


def test_the_model_is_near_the_optimum(spark):
    df = spark.createDataFrame(corpus(200, 2), DOCS)
    rows, found = fitted(spark, df, 2)
    data = rows.collect()
    x, y = np.zeros((len(data), len(found.terms))), np.array([r["label"] for r in data], float)
    for i, r in enumerate(data):
        x[i, list(r["at"])] = np.array(r["x"]) / exact_logit.UNIT
    n, weight = len(y), len(y) / (2 * np.bincount(y.astype(int))[y.astype(int)])

    def objective(b, b0):
        z = x @ b + b0
        return (weight * (np.maximum(z, 0) - z * y + np.log1p(np.exp(-abs(z))))).sum() / n + b @ b / (2 * n)
    best = model.fit_sentiment_model(df, "doc_id", "terms", "label", 25, max_iter=500, tol=1e-10).stages[-1]
    optimum = objective(np.array(best.coefficients), best.intercept)
    got = objective(np.array(found.coefficients) / exact_logit.UNIT, found.intercept / exact_logit.UNIT)
    assert optimum - 1e-9 <= got <= optimum + 5e-4


def test_scores_follow_the_model(spark):
    df = spark.createDataFrame(corpus(60, 3), DOCS)
    rows, found = fitted(spark, df, 2, steps=5)
    for r in exact_logit.scores(rows, found, "doc_id").join(rows.select("doc_id", "at", "x"), "doc_id").collect():
        z = sum(found.coefficients[i] * v for i, v in zip(r["at"], r["x"])) + found.intercept * exact_logit.UNIT
        assert abs(r["logit"] - z / exact_logit.UNIT ** 2) <= 1e-6 and r["predicted"] == int(r["logit"] > 0)


def test_no_rows_give_an_empty_model(spark):
    df = spark.createDataFrame([], "doc_id long, label int, at array<int>, x array<bigint>")
    found = exact_logit.fit(df, ["a"], "label")
    assert found.coefficients == [0] and found.intercept == 0


# ----------------------------------------------------------------- models as tables
def a_model(spark):
    terms = spark.createDataFrame([("good", 0, 1.5, 2.0), ("bad", 1, 1.25, -3.0)],
                                  "term string, term_index int, idf double, coefficient double")
    return model_store.LinearTextModel(terms, 0.25)


def test_a_saved_model_scores_like_the_one_that_was_saved(spark):
    docs = spark.createDataFrame([(1, ["good", "bad", "x"]), (2, []), (3, ["good"] * 3)], "id long, terms array<string>")
    folder, target = tempfile.mkdtemp(prefix="run-") + "/m", tempfile.mkdtemp(prefix="run-")
    model_store.save(a_model(spark), folder)
    done = model_store.publish(spark, {"a": folder, "bert": folder, "gone": "/nonexistent/m"}, target).collect()
    assert [r["status"].split(":")[0] for r in done] == ["published", "skipped", "error"]
    again = model_store.load(spark, f"{target}/a").score(docs, "id", "terms")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, a_model(spark).score(docs, "id", "terms").collect()))
    assert {r["id"]: r["predicted"] for r in again.collect()} == {1: 0, 2: 1, 3: 1}


def test_half_saved_and_foreign_models_are_refused(spark):
    folder = tempfile.mkdtemp(prefix="run-") + "/m"
    a_model(spark).terms.write.parquet(f"{folder}/terms")
    with pytest.raises(Exception):  # no about table: the save did not end
        model_store.load(spark, folder)
    spark.createDataFrame([("linear-tfidf", 1, 0.0, 3)], model_store.ABOUT).write.parquet(f"{folder}/about")
    with pytest.raises(ValueError, match="2 terms, 3 were saved"):
        model_store.load(spark, folder)
    spark.createDataFrame([("other", 1, 0.0, 2)], model_store.ABOUT).write.mode("overwrite").parquet(f"{folder}/about")
    with pytest.raises(ValueError, match="no linear-tfidf model"):
        model_store.load(spark, folder)


# ----------------------------------------------------------------- exact split
def split_by_hand(rows, percent=20, seed=42):
    counts = {}
    for _, label in rows:
        counts[label] = counts.get(label, 0) + 1
    out = {}
    for label, k in held_out(counts, percent).items():
        mine = sorted((int(hashlib.md5(f"{i}:{seed}".encode()).hexdigest()[:15], 16), i) for i, y in rows if y == label)
        out.update({i: "test" if place < k else "train" for place, (_, i) in enumerate(mine)})
    return out


@pytest.mark.parametrize("n", [0, 1, 4, 5, 6, 101, 997])
def test_sizes_are_exact(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([0, 0, 0, 0, 1, None])) for i in range(n)]
    got = exact_split(spark.createDataFrame(rows, "doc_id long, label int"), "doc_id", "label").collect()
    assert {r["doc_id"]: r["split"] for r in got} == split_by_hand(rows)
    assert sum(r["split"] == "test" for r in got) == -(-n * 20 // 100)


def test_rows_that_share_a_digest_are_told_apart(spark, monkeypatch):
    import marketlens.operators.exact_split as module

    monkeypatch.setattr(module, "digest", lambda id_col, seed: (F.col(id_col) % 3).cast("long"))
    rows = [(i, i % 2) for i in range(100)]
    got = {r["doc_id"]: r["split"] for r in
           exact_split(spark.createDataFrame(rows, "doc_id long, label int"), "doc_id", "label").collect()}
    assert {y: sum(s == "test" for i, s in got.items() if i % 2 == y) for y in (0, 1)} == {0: 10, 1: 10}
    assert all(got[i] == "train" for i in range(100) if i % 3)


def test_held_out_shares_are_whole_and_add_up():
    rng = random.Random(4)
    for _ in range(200):
        counts = {c: rng.randint(1, 50) for c in range(rng.randint(1, 6))}
        percent = rng.randint(0, 100)
        out, n = held_out(counts, percent), sum(counts.values())
        assert sum(out.values()) == -(-n * percent // 100)
        assert all(abs(out[c] - sum(out.values()) * k / n) < 1 and 0 <= out[c] <= k for c, k in counts.items())
