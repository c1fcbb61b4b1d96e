"""Text cleaning, TF-IDF, encoding, batching and the classifier against brute force."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from marketlens.functions.text import default_stopwords, normalise_text, tokens
from marketlens.operators import features, model, text

SAMPLES = {
    "Não está BOM!! <b>produto</b> chegou rápido": ["no", "est", "bom", "produto", "chegou", "rpido"],
    "linha1\nlinha2 x\x0by\x1cz  <a\nhref> tag aberto": ["linha1", "linha2", "x", "y", "z", "a", "href", "tag", "aberto"],
    "İstanbul Kelvin 10kg <<x>>": ["istanbul", "kelvin", "10kg"],
    "": [],
    None: [],
    "só números 123 456,78": ["s", "nmeros", "123", "45678"],
}


def test_cleaning_of_samples(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "id long, t string")
    got = {r["id"]: list(r["tk"]) for r in
           df.select("id", tokens(normalise_text(F.col("t"))).alias("tk")).collect()}
    assert [got[i] for i in range(len(SAMPLES))] == list(SAMPLES.values())


def test_stopwords_run_after_accents_are_stripped(spark):
    words = set(default_stopwords("portuguese"))
    assert "no" in words and "está" in words
    df = spark.createDataFrame([(1, "Não está bom")], "doc_id long, text string")
    out = text.clean_reviews(df, "text").collect()[0]
    # "não" -> "no" is a stop word and goes; "está" -> "est" is not and stays
    assert out["clean_text"] == "est bom"


def test_lemmas_keep_order_and_unknown_tokens(spark):
    df = spark.createDataFrame([(1, ["casas", "bonitas", "x"]), (2, [])],
                               "doc_id long, tokens array<string>")
    lemmas = spark.createDataFrame([("casas", "casa"), ("bonitas", "bonito")], "token string, lemma string")
    out = {r["doc_id"]: list(r["lemmas"]) for r in
           text.substitute_lemmas(df, "doc_id", "tokens", lemmas).collect()}
    assert out == {1: ["casa", "bonito", "x"], 2: []}


CORPUS = {1: ["aa", "bb", "aa", "cc"], 2: ["bb", "dd"], 3: ["aa", "ee", "ee"], 4: []}


def test_tfidf_matches_brute_force(spark):
    df = spark.createDataFrame(list(CORPUS.items()), "doc_id long, terms array<string>")
    vocab = features.fit_tfidf(df, "doc_id", "terms", max_features=3)
    v = {r["term"]: (r["term_index"], r["idf"]) for r in vocab.collect()}
    # corpus counts: aa 3, bb 2, ee 2, cc 1, dd 1 -> top 3 with ties by term: aa, bb, ee
    assert sorted(v) == ["aa", "bb", "ee"]
    assert [v[t][0] for t in ("aa", "bb", "ee")] == [0, 1, 2]
    n = len(CORPUS)
    df_counts = {"aa": 2, "bb": 2, "ee": 1}
    for t, d in df_counts.items():
        assert math.isclose(v[t][1], math.log((1 + n) / (1 + d)) + 1, rel_tol=1e-12)
    w = features.transform_tfidf(df, "doc_id", "terms", vocab)
    got = {(r["doc_id"], r["term"]): r["weight"] for r in w.collect()}
    for doc, terms in CORPUS.items():
        raw = {t: terms.count(t) * v[t][1] for t in set(terms) if t in v}
        norm = math.sqrt(sum(x * x for x in raw.values())) or 1.0
        for t, x in raw.items():
            assert math.isclose(got[(doc, t)], x / norm, rel_tol=1e-12)
    assert len(got) == sum(len(set(t) & set(v)) for t in CORPUS.values())


def test_vectorizer_stages_equal_long_format(spark):
    df = spark.createDataFrame(list(CORPUS.items()), "doc_id long, terms array<string>")
    vocab = features.fit_tfidf(df, "doc_id", "terms", max_features=3)
    vec = model.tfidf_vectorizer(vocab, "terms").transform(df)
    long = {(r["doc_id"], r["term_index"]): r["weight"]
            for r in features.transform_tfidf(df, "doc_id", "terms", vocab).collect()}
    for r in vec.collect():
        arr = r["features"].toArray()
        for j, x in enumerate(arr):
            assert math.isclose(x, long.get((r["doc_id"], j), 0.0), abs_tol=1e-12)


def _md5_bucket(i, seed=42):
    return int(hashlib.md5(f"{i}:{seed}".encode()).hexdigest()[:8], 16)


def test_split_is_stable_and_near_80_20(spark):
    df = spark.range(0, 2000).withColumnRenamed("id", "doc_id")
    a = {r["doc_id"]: r["split"] for r in features.train_test_split(df, "doc_id").collect()}
    b = {r["doc_id"]: r["split"] for r in features.train_test_split(df.repartition(7), "doc_id").collect()}
    assert a == b
    assert all(a[i] == ("test" if _md5_bucket(i) % 100 < 20 else "train") for i in range(2000))
    assert 0.15 < sum(1 for s in a.values() if s == "test") / 2000 < 0.25


def test_batches_are_a_seeded_permutation(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "doc_id")
    out = features.assign_batches(df, "doc_id", batch_size=32, seed=7, n_buckets=5).collect()
    pos = {r["doc_id"]: (r["position"], r["batch_id"]) for r in out}
    expected = sorted(range(1000), key=lambda i: (_md5_bucket(i, 7), i))
    assert [pos[i][0] for i in expected] == list(range(1000))
    assert all(pos[i][1] == pos[i][0] // 32 for i in pos)


def test_batches_are_numbered_within_groups(spark):
    df = spark.range(0, 500).withColumnRenamed("id", "doc_id").withColumn(
        "g", (F.col("doc_id") % 3).cast("string"))
    out = features.assign_batches(df, "doc_id", batch_size=10, seed=3, n_buckets=4, group_col="g").collect()
    for g in ("0", "1", "2"):
        ids = [i for i in range(500) if str(i % 3) == g]
        expected = sorted(ids, key=lambda i: (_md5_bucket(i, 3), i))
        pos = {r["doc_id"]: r["position"] for r in out if r["g"] == g}
        assert [pos[i] for i in expected] == list(range(len(ids)))


def test_encode_truncates_pads_and_masks(spark):
    df = spark.createDataFrame([(1, ["aa", "zz", "bb"]), (2, ["aa"] * 7), (3, [])],
                               "doc_id long, tokens array<string>")
    vocab = spark.createDataFrame([("aa", 0), ("bb", 1)], "term string, term_index int")
    out = {r["doc_id"]: r for r in text.encode_fixed_length(df, "doc_id", "tokens", vocab, 5).collect()}
    assert out[1]["input_ids"] == [2, 1, 3, 0, 0] and out[1]["attention_mask"] == [1, 1, 1, 0, 0]
    assert out[2]["input_ids"] == [2] * 5 and out[2]["attention_mask"] == [1] * 5
    assert out[2]["n_tokens"] == 7
    assert out[3]["input_ids"] == [0] * 5 and out[3]["attention_mask"] == [0] * 5


def test_binary_metrics_match_numpy(spark):
    rng = np.random.default_rng(0)
    z = rng.normal(size=100)
    y = (rng.random(100) < 0.5).astype(int)
    batch = np.arange(100) // 32
    df = spark.createDataFrame([(float(a), int(b), int(c)) for a, b, c in zip(z, y, batch)],
                               "z double, y int, b long")
    r = model.binary_metrics(df, "z", "y", batch_col="b").collect()[0]
    loss = np.maximum(z, 0) - z * y + np.log1p(np.exp(-np.abs(z)))
    assert r["n"] == 100
    assert math.isclose(r["accuracy"], float(np.mean((1 / (1 + np.exp(-z)) > 0.5) == y)))
    assert math.isclose(r["bce_loss"], float(loss.mean()), rel_tol=1e-9)
    batched = np.mean([loss[batch == k].mean() for k in range(4)])
    assert math.isclose(r["bce_loss_batched"], float(batched), rel_tol=1e-9)


def test_logistic_regression_penalty_matches_reference_objective(spark):
    """At Spark's optimum the gradient of C*sum(w*loss) + ||beta||^2/2 is ~0."""
    rng = np.random.default_rng(1)
    n, d = 200, 4
    X = rng.normal(size=(n, d))
    y = (X @ np.array([1.5, -2.0, 0.5, 0.0]) + rng.normal(scale=0.5, size=n) > 0.8).astype(int)
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame([(Vectors.dense(X[i]), float(y[i])) for i in range(n)],
                               ["features", "label"])
    w = features.with_class_weights(df, "label", "weight")
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(weightCol="weight", regParam=1.0 / n, elasticNetParam=0.0,
                            standardization=False, maxIter=200, tol=1e-10).fit(w)
    beta, b0 = lr.coefficients.toArray(), lr.intercept
    n1 = y.sum()
    wts = np.where(y == 1, n / (2 * n1), n / (2 * (n - n1)))
    p = 1 / (1 + np.exp(-(X @ beta + b0)))
    grad_beta = X.T @ (wts * (p - y)) + beta
    grad_b0 = np.sum(wts * (p - y))
    assert np.max(np.abs(grad_beta)) < 1e-3 and abs(grad_b0) < 1e-3
