"""A linear text model kept as tables.

``path/terms`` holds a row a term (term, term_index, idf, coefficient), ``path/about`` one
row (kind, version, intercept, n_terms).  Any engine that reads Parquet can score with
them, and a loaded model scores by joins, whatever the vocabulary's size.  Spark ML's own
format (``operators.model.save_model``) stays for fitted pipelines.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.operators import features, model
from marketlens.operators.text import UNKNOWN_ID  # noqa: F401  (ids below the first term's are no terms)

KIND, VERSION = "linear-tfidf", 1
ABOUT = "kind string, version int, intercept double, n_terms long"


@dataclass(frozen=True)
class LinearTextModel:
    """``terms``: (term, term_index, idf, coefficient)."""

    terms: DataFrame
    intercept: float

    def score(self, df: DataFrame, id_col: str, terms_col: str, digits: int = 6) -> DataFrame:
        """Every document's logit, probability and prediction."""
        weights = features.transform_tfidf(df, id_col, terms_col, self.terms)
        return model.linear_scores(weights, self.terms.select("term", "coefficient"), df, id_col,
                                   self.intercept, digits)


def linear_text_model(vocabulary: DataFrame, coefficients: DataFrame, intercept: float = 0.0) -> LinearTextModel:
    """From a fitted vocabulary (term, term_index, idf) and (term, coefficient)."""
    terms = (vocabulary.select("term", "term_index", "idf")
             .join(coefficients.select("term", F.col("coefficient").cast("double").alias("coefficient")), "term"))
    return LinearTextModel(terms, float(intercept))


def save(m: LinearTextModel, path: str) -> None:
    """The terms first: a model without its ``about`` table was not saved to the end."""
    spark = m.terms.sparkSession
    m.terms.write.mode("overwrite").parquet(f"{path}/terms")
    n = spark.read.parquet(f"{path}/terms").count()
    about = spark.createDataFrame([(KIND, VERSION, m.intercept, n)], ABOUT)
    about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def load(spark: SparkSession, path: str) -> LinearTextModel:
    """The saved model; an error if it is another kind's, or its terms aren't whole."""
    about = spark.read.schema(ABOUT).parquet(f"{path}/about").first()
    if about is None or about["kind"] != KIND or about["version"] != VERSION:
        raise ValueError(f"{path}: no {KIND} model of version {VERSION}")
    terms = spark.read.schema("term string, term_index int, idf double, coefficient double").parquet(f"{path}/terms")
    n = terms.count()
    if n != about["n_terms"]:
        raise ValueError(f"{path}: {n} terms, {about['n_terms']} were saved")
    return LinearTextModel(terms, about["intercept"])


def publish(spark: SparkSession, models: Mapping[str, str], target_dir: str,
            exclude: Iterable[str] = ("bert",)) -> DataFrame:
    """Each saved model loaded, checked and saved under ``target_dir/name``, unless its
    name is on the deny-list; (name, status, terms, path).  One that can't be loaded is
    reported and the others go on."""
    denied, done = set(exclude), []
    for name, path in models.items():
        target = f"{target_dir.rstrip('/')}/{name}"
        if name in denied:
            done.append((name, "skipped", None, None))
            continue
        try:
            m = load(spark, path)
            save(m, target)
            done.append((name, "published", m.terms.count(), target))
        except Exception as exc:  # noqa: BLE001 - reported, as in a batch
            done.append((name, f"error: {type(exc).__name__}: {exc}", None, None))
    return spark.createDataFrame(done, "name string, status string, terms long, path string")
