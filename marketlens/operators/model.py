"""Sentiment model: TF-IDF features, weighted logistic regression, scoring and
metrics (J9-J13, I17, B6) as Spark ML stages.

The reference's classifier minimises  C * sum(w_i * loss_i) + ||beta||^2 / 2.
Spark's minimises  sum(w_i * loss_i) / sum(w_i) + regParam * ||beta||^2 / 2, so the
same optimum needs regParam = 1 / (C * sum(w_i)); with balanced class weights
sum(w_i) = n.  No feature standardisation, intercept unpenalised.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.operators.features import fit_tfidf


def tfidf_vectorizer(vocab: DataFrame, terms_col: str, features_col: str = "features") -> PipelineModel:
    """Fitted vocabulary -> ML stages: term counts, times idf, L2 normalisation.

    The vocabulary is a top-N table (N = max_features), so collecting its terms and
    idf values to build the stages is bounded.
    """
    rows = vocab.select("term", "term_index", "idf").orderBy("term_index").collect()
    counts = CountVectorizerModel.from_vocabulary([r["term"] for r in rows],
                                                  inputCol=terms_col, outputCol="_tf")
    weigh = ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]),
                               inputCol="_tf", outputCol="_tfidf")
    norm = Normalizer(p=2.0, inputCol="_tfidf", outputCol=features_col)
    return PipelineModel([counts, weigh, norm])


def fit_sentiment_model(train: DataFrame, id_col: str, terms_col: str, label_col: str,
                        max_features: int = 5000, C: float = 1.0, max_iter: int = 100,
                        tol: float = 1e-4, aggregation_depth: int = 2) -> PipelineModel:
    """J6 + J8 + J9: TF-IDF vocabulary and a class-balanced logistic regression fitted
    on ``train``; returns one PipelineModel (vectoriser + classifier) for scoring."""
    vocab = fit_tfidf(train, id_col, terms_col, max_features)
    vectorizer = tfidf_vectorizer(vocab, terms_col)
    counts = {r[label_col]: r["n"] for r in train.groupBy(label_col).agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())  # the sum of the balanced weights
    weight = F.lit(None).cast("double")
    for label, n_label in counts.items():  # one row a class
        weight = F.when(F.col(label_col).eqNullSafe(F.lit(label)), n / (len(counts) * n_label)).otherwise(weight)
    weighted = vectorizer.transform(train.withColumn("weight", weight)) \
        .withColumn("_label", F.col(label_col).cast("double"))
    lr = LogisticRegression(featuresCol="features", labelCol="_label", weightCol="weight",
                            regParam=1.0 / (C * max(n, 1)), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter, tol=tol,
                            aggregationDepth=aggregation_depth)
    return PipelineModel([*vectorizer.stages, lr.fit(weighted)])


def score(model: PipelineModel, df: DataFrame, logit_col: str = "logit") -> DataFrame:
    """Apply the fitted pipeline; adds the logit, the positive-class probability
    (sigmoid) and the 0/1 prediction (probability > 0.5)."""
    out = model.transform(df)
    z = vector_to_array("rawPrediction")[1]
    return (out.withColumn(logit_col, z)
            .withColumn("probability_positive", sigmoid(F.col(logit_col)))
            .withColumn("predicted", (F.col("probability_positive") > 0.5).cast("int"))
            .drop("_tf", "_tfidf", "features", "rawPrediction", "probability", "prediction"))


def linear_scores(weights: DataFrame, coefficients: DataFrame, ids: DataFrame, id_col: str,
                  intercept: float = 0.0, digits: int = 6) -> DataFrame:
    """J10 with a model that is a table: (term, coefficient) against (id, term, weight).
    Every row of ``ids`` gets a logit (the intercept alone, without known terms), its
    sigmoid and the 0/1 prediction, rounded to ``digits`` places."""
    z = (weights.join(coefficients, "term").groupBy(id_col)
         .agg(F.sum(F.col("weight") * F.col("coefficient")).alias("_z")))
    logit = F.round(F.coalesce("_z", F.lit(0.0)) + F.lit(float(intercept)), digits)
    return (ids.select(id_col).join(z, id_col, "left").withColumn("logit", logit)
            .select(id_col, "logit", F.round(sigmoid(F.col("logit")), digits).alias("probability_positive"),
                    (F.col("logit") > 0).cast("int").alias("predicted")))


def sigmoid(z: Column) -> Column:
    """I17."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def bce_with_logits(z: Column, y: Column) -> Column:
    """J13, numerically stable: max(z, 0) - z*y + log(1 + exp(-|z|))."""
    return F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))


def binary_metrics(df: DataFrame, logit_col: str, label_col: str,
                   batch_col: str | None = None, group_cols: list[str] | None = None) -> DataFrame:
    """Rows, accuracy of sigmoid(z) > 0.5, mean BCE-with-logits; with
    ``batch_col`` also the mean of per-batch mean losses (how the reference averages
    its test loss, where a short last batch weighs more)."""
    z, y = F.col(logit_col), F.col(label_col).cast("double")
    pred = F.when(sigmoid(z) > 0.5, 1.0).otherwise(0.0)
    base = df.select(*(group_cols or []), *( [batch_col] if batch_col else []),
                     (pred == y).cast("int").alias("_hit"), bce_with_logits(z, y).alias("_loss"))
    keys = list(group_cols or [])
    if not keys:  # one result row: join the two aggregates on a constant key
        base, keys = base.withColumn("_all", F.lit(0)), ["_all"]
    if not batch_col:
        return base.groupBy(*keys).agg(F.count("*").alias("n"), F.avg("_hit").alias("accuracy"),
                                       F.avg("_loss").alias("bce_loss")).drop("_all")
    # one pass over the rows: sums for each batch, rolled up to the group
    per_batch = base.groupBy(*keys, batch_col).agg(
        F.count("*").alias("_n"), F.sum("_hit").alias("_hits"), F.sum("_loss").alias("_sum"),
        F.count("_loss").alias("_losses"))
    return per_batch.groupBy(*keys).agg(
        F.sum("_n").alias("n"), (F.sum("_hits") / F.sum("_n")).alias("accuracy"),
        (F.sum("_sum") / F.sum("_losses")).alias("bce_loss"),
        F.avg(F.col("_sum") / F.col("_losses")).alias("bce_loss_batched")).drop("_all")


def save_model(model: PipelineModel, path: str) -> None:
    """Vectoriser and classifier are saved together, as one pipeline."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
