"""Named queries: ``name -> (spark, sf_dir) -> DataFrame`` and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens import plans
from marketlens.plans import text_pipeline
from marketlens.operators import quality, repair
from marketlens.sources.standins import load_standins

# Parameters for the customer-value query on the stand-in data (its orders span
# 1995-2001; the reference's own dates are 2018-01-01 and 2018-07-01).
STANDIN_SNAPSHOT = "2000-01-01"
STANDIN_CONTROL = "2000-07-01"

Query = Callable[[SparkSession, str], DataFrame]


def _mart(fn, **params) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_standins(spark, sf_dir), **params)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def _marts() -> dict[str, tuple]:
    """The business queries with their parameters here."""
    names = ("best_sellers", "reviews", "customers_distribution", "delays_by_state", "sales_by_category_month",
             "delay_stats", "network_delay", "network_delay_pairs", "delay_review_correlation", "negative_reviews",
             "product_reviews", "rmf_per_client", "cohort", "first_order_analysis")
    params = {"rmf_per_client": {"snapshot": STANDIN_SNAPSHOT, "control": STANDIN_CONTROL}}
    return {n: (getattr(plans, n), params.get(n, {})) for n in names}


def mart_queries() -> dict[str, Query]:
    return {name: _mart(fn, **params) for name, (fn, params) in _marts().items()}


def _with_pos(df, col):
    return df.withColumn("input_pos", F.col(col))


def _repair(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = load_standins(spark, sf_dir)
        sellers = _with_pos(m.sellers, "seller_id")
        customers = _with_pos(m.customers, "customer_id")
        if kind == "geolocation_dedup_first":
            return repair.geolocation_first(m.geolocation_raw)
        if kind == "orphan_seller_zips":
            return repair.seller_zip_orphans(m.geolocation_raw, sellers).drop("input_pos")
        if kind == "orphan_customer_zips":
            return repair.customer_zip_orphans(m.geolocation_raw, sellers, customers).drop("input_pos")
        if kind == "orphan_categories":
            return repair.category_orphans(m.prodcategory_raw, m.products)
        if kind == "geolocation_repaired":
            return m.geolocation
        if kind == "category_repaired":
            return m.prodcategory
        raise KeyError(kind)
    run.__name__ = kind
    return run


def _quality(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rule(load_standins(spark, sf_dir).tables())
    run.__name__ = rule.__name__
    return run


def relational_queries() -> dict[str, Query]:
    out = {name: _repair(name) for name in (
        "geolocation_dedup_first", "orphan_seller_zips", "orphan_customer_zips",
        "orphan_categories", "geolocation_repaired", "category_repaired")}
    out.update({
        "pk_violations": _quality(quality.pk_violations),
        "fk_violations": _quality(quality.fk_violations),
        "length_violations": _quality(quality.length_violations),
        "load_report": _quality(quality.table_report),
        "month_spine": _mart(plans.cohort_spine),
        "stage_durations": _mart(plans.stage_durations),
    })
    return out


def text_queries() -> dict[str, Query]:
    names = ("review_clean_text", "lemma_substitution", "split_train_test", "vocabulary_top_n",
             "tfidf_fit", "tfidf_transform", "linear_scores", "class_weights", "encode_fixed_length",
             "attention_mask", "shuffle_batches", "logreg_scores", "logreg_metrics",
             "binary_metrics", "rule_lemmas", "lemmas_by_rules", "split_exact", "saved_model_scores", "exact_logit_model",
             "exact_logit_scores", "exact_logit_metrics")
    return {n: _mart(getattr(text_pipeline, n)) for n in names}


# The thirteen named results of a batch, all of which are published.
RESULTS = ("best_sellers", "reviews", "customers_distribution", "delays_by_state", "sales_by_category_month",
           "delay_stats", "network_delay", "delay_review_correlation", "negative_reviews", "product_reviews",
           "rmf_per_client", "cohort", "first_order_analysis")


def _batch(spark: SparkSession, sf_dir: str, names=RESULTS) -> DataFrame:
    from marketlens.plans.shared import shared_standins
    from marketlens.runner import run_batch, run_folder

    m, marts = shared_standins(spark, sf_dir), _marts()

    def build(name: str) -> DataFrame:
        fn, params = marts[name]
        return fn(m, **params)
    return run_batch(spark, {n: (lambda n=n: build(n)) for n in names}, run_folder(spark, "batch"), "csv",
                     compression="gzip")


def _batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run every named query as one batch into a fresh folder under the shared
    checkpoint folder; the report lists (name, status, rows, format)."""
    return _batch(spark, sf_dir).select("name", "status", "rows", "format")


def _publish_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch run, then publish every result; rows are those of the published copy."""
    from marketlens.runner import publish_results, run_folder

    return publish_results(spark, _batch(spark, sf_dir), run_folder(spark, "serving"), compression="gzip").select(
        "name", "status", "rows")


def _published_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review texts after batch (CSV), publish (CSV) and re-reading."""
    from marketlens.runner import publish_results, read_result, run_folder

    done = publish_results(spark, _batch(spark, sf_dir, ("reviews",)), run_folder(spark, "serving"), compression="gzip").first()
    return read_result(spark, done["path"], "csv", mart_queries()["reviews"](spark, sf_dir).schema)


def _csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A5: the reviews as a reference-format CSV folder, scanned with its schema."""
    from marketlens.runner import run_folder
    from marketlens.sources.csv_files import CSV_WRITE, read_csv_table
    from marketlens.sources.schemas import SCHEMAS

    df = load_standins(spark, sf_dir).order_reviews
    columns = [F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in SCHEMAS["order_reviews"].fields]
    path = run_folder(spark, "csv")
    df.select(*columns).write.options(**CSV_WRITE).csv(path)
    return read_csv_table(spark, path, "order_reviews").select(
        F.col("review_id").cast("long").alias("review_id"), F.col("order_id").cast("long").alias("order_id"),
        "review_score", "review_comment_message", "review_creation_date")


def _load_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine tables loaded into an empty target, parents first."""
    from marketlens.runner import load_tables, run_folder

    return load_tables(spark, load_standins(spark, sf_dir).tables(), run_folder(spark, "load")).select(
        "table_name", "status", "violations")


def _load_in_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1, C9-C11 against targets that are kept bucketed: a first load with two thirds of the
    orders; then the rest of them, all items, and the customers again; then orders that are
    all there."""
    from functools import reduce

    from marketlens.runner import load_tables, run_folder

    m, target = load_standins(spark, sf_dir), run_folder(spark, "steps")
    third, fifth = F.col("order_id") % 3 == 0, F.col("order_id") % 5 == 0
    customers = m.customers.withColumn("customer_state", F.substring("customer_state", 1, 2))  # so that they fit
    sellers = m.sellers.withColumn("seller_state", F.substring("seller_state", 1, 2))
    geolocation = m.geolocation.withColumn("geolocation_state", F.substring("geolocation_state", 1, 2))
    steps = [{"geolocation": geolocation, "customers": customers, "sellers": sellers,
              "prodcategory": m.prodcategory, "products": m.products, "orders": m.orders.filter(~third)},
             {"customers": customers, "orders": m.orders.filter(third), "order_items": m.order_items},
             {"orders": m.orders.filter(fifth)}]
    reports = [load_tables(spark, tables, target, buckets=8).select(
        F.lit(k + 1).alias("step"), "table_name", "status", "violations") for k, tables in enumerate(steps)]
    return reduce(DataFrame.unionByName, reports)


def _sql_rmf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: K11 from SQL text, its two dates as named parameters."""
    from marketlens.sources.sql_text import Catalogue

    return Catalogue(spark, load_standins(spark, sf_dir)).query(
        "SELECT * FROM rmf_per_client(CAST(:snapshot AS TIMESTAMP_NTZ), CAST(:control AS TIMESTAMP_NTZ))",
        {"snapshot": STANDIN_SNAPSHOT, "control": STANDIN_CONTROL})


def _sql_late_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: text that reads a result as a function, a table, and a parameter."""
    from marketlens.sources.sql_text import Catalogue

    return Catalogue(spark, load_standins(spark, sf_dir)).query(
        """SELECT s.seller_state, COUNT(*) AS n_sellers, COUNT(b.seller_id) AS n_late, MAX(b.n_orders) AS most_rows
           FROM sellers s LEFT JOIN (SELECT * FROM best_sellers() WHERE average_delay_days > :days) b
             ON b.seller_id = s.seller_id
           GROUP BY s.seller_state""", {"days": 8})


def _input_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: a data folder that lacks one of its nine files."""
    from marketlens.runner import run_folder
    from marketlens.sources.csv_files import CSV_WRITE, input_report
    from marketlens.sources.schemas import SCHEMAS

    folder = run_folder(spark, "inputs")
    for name, df in load_standins(spark, sf_dir).tables().items():
        if name != "products":
            columns = [F.col(f.name).cast(f.dataType) if f.name in df.columns
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields]
            df.select(*columns).write.options(**CSV_WRITE).csv(f"{folder}/{name}")
    return input_report(spark, folder, {name: name for name in SCHEMAS}).select("table_name", "status", "rows")


def runner_queries() -> dict[str, Query]:
    return {"batch_report": _batch_report, "publish_results": _publish_results,
            "published_reviews": _published_reviews, "csv_scan": _csv_scan, "load_gate": _load_gate, "load_in_steps": _load_in_steps,
            "sql_rmf": _sql_rmf, "sql_late_sellers": _sql_late_sellers, "input_report": _input_report}


def queries() -> dict[str, Query]:
    out = dict(mart_queries())
    out.update(relational_queries())
    out.update(text_queries())
    out.update(runner_queries())
    return out


def oracle_sql() -> dict[str, str]:
    from marketlens.oracle import ORACLE, runner_oracle, text_oracle

    return {**ORACLE, **text_oracle(), **runner_oracle()}
