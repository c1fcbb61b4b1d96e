from __future__ import annotations

import os
import tempfile

import pytest

from marketlens.sources.csv_files import MissingInput, read_csv_table


def test_csv_reader_keeps_multiline_quoted_text_and_input_order(spark):
    d = tempfile.mkdtemp(prefix="ml-csv-")
    path = os.path.join(d, "reviews.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("review_id,order_id,review_score,review_comment_title,review_comment_message,"
                "review_creation_date,review_answer_timestamp\n")
        f.write('r1,o1,5,,"linha um\nlinha ""dois""",2018-01-02 00:00:00,2018-01-03 10:11:12\n')
        f.write("r2,o2,,,,2018-01-04 00:00:00,\n")
    df = read_csv_table(spark, path, "order_reviews", with_position=True)
    rows = sorted(df.collect(), key=lambda r: r["input_pos"])
    assert [r["review_id"] for r in rows] == ["r1", "r2"]
    assert rows[0]["review_comment_message"] == 'linha um\nlinha "dois"'
    assert rows[1]["review_score"] is None and rows[1]["review_comment_message"] is None
    assert str(rows[0]["review_answer_timestamp"]) == "2018-01-03 10:11:12"


def test_missing_input_is_reported(spark):
    with pytest.raises(MissingInput):
        read_csv_table(spark, "/nonexistent/marketlens/input.csv", "orders")


def test_model_round_trip(spark):
    from marketlens.operators import features, model

    df = spark.createDataFrame([(i, ["good", "fine"] if i % 2 else ["bad", "awful"], i % 2)
                                for i in range(40)], "doc_id long, terms array<string>, label int")
    fitted = model.fit_sentiment_model(df, "doc_id", "terms", "label", max_features=10)
    path = tempfile.mkdtemp(prefix="ml-model-") + "/m"
    model.save_model(fitted, path)
    again = model.load_model(path)
    a = {r["doc_id"]: r["predicted"] for r in model.score(fitted, df).collect()}
    b = {r["doc_id"]: r["predicted"] for r in model.score(again, df).collect()}
    assert a == b and a == {i: i % 2 for i in range(40)}
    assert features.class_weights(df, "label").count() == 2


def test_reference_csv_folder_gives_the_same_answers(spark):
    """Stand-in tables written as reference-format CSV files (string ids) load through
    the CSV source, are repaired on load, and answer K4/K5 like the parquet stand-ins."""
    from pyspark.sql import functions as F

    from marketlens import plans
    from marketlens.sources.csv_files import read_marketplace_csv
    from marketlens.sources.schemas import SCHEMAS, csv_file_names
    from marketlens.sources.standins import load_standins
    from tests.conftest import SMOKE_DIR, rows_of

    m = load_standins(spark, SMOKE_DIR)
    raw = {"geolocation": m.geolocation_raw.orderBy("input_pos").drop("input_pos"),
           "prodcategory": m.prodcategory_raw.drop("input_pos"),
           **{k: v for k, v in m.tables().items() if k not in ("geolocation", "prodcategory")}}
    folder = tempfile.mkdtemp(prefix="ml-csvdb-")
    for table, df in raw.items():
        cols = [F.col(f.name).cast(f.dataType) if f.name in df.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields]
        (df.select(*cols).coalesce(1).write.option("header", True).option("escape", '"')
         .csv(f"{folder}/{csv_file_names('raw_')[table]}"))
    csv_market = read_marketplace_csv(spark, folder, prefix="raw_")
    assert rows_of(plans.delays_by_state(csv_market)) == rows_of(plans.delays_by_state(m))
    assert rows_of(plans.sales_by_category_month(csv_market)) == rows_of(plans.sales_by_category_month(m))
    assert csv_market.geolocation.count() == m.geolocation.count()


def test_tables_answer_plain_sql_through_views(spark):
    """The loaded tables are usable from Spark SQL under their usual names."""
    from marketlens import plans
    from marketlens.sources import register_views
    from marketlens.sources.standins import load_standins
    from tests.conftest import SMOKE_DIR, rows_of

    m = load_standins(spark, SMOKE_DIR)
    assert "orders" in register_views(m, prefix="")
    sql = spark.sql("""
        SELECT s.seller_state,
               COUNT(*) FILTER (WHERE o.order_estimated_delivery_date < o.order_delivered_customer_date) AS number_of_delays,
               COUNT(*) AS number_of_orders
        FROM order_items i
        JOIN sellers s ON s.seller_id = i.seller_id
        JOIN orders o ON o.order_id = i.order_id
        GROUP BY s.seller_state""")
    df = plans.delays_by_state(m).select("seller_state", "number_of_delays", "number_of_orders")
    assert rows_of(sql) == rows_of(df)


def test_keep_first_follows_file_order_over_several_files(spark):
    """The smaller file comes first in name order, whatever order Spark plans them in."""
    from marketlens.operators.repair import geolocation_first

    d = tempfile.mkdtemp(prefix="ml-order-")
    head = "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
    for name, city, n in (("a.csv", "first", 1), ("b.csv", "second", 5000)):
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(head + f"z,1.0,1.0,{city},s\n" + "".join(f"{name}{i},0.0,0.0,c,s\n" for i in range(n)))
    raw = read_csv_table(spark, d, "geolocation", with_position=True)
    kept = geolocation_first(raw).filter("geolocation_zip_code_prefix = 'z'").collect()
    assert [r["geolocation_city"] for r in kept] == ["first"]


def test_bad_values_and_headers_are_reported(spark):
    from marketlens.sources.csv_files import type_violations

    d = tempfile.mkdtemp(prefix="ml-bad-")
    path = os.path.join(d, "p.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                "o1,1,card,1,9.5\no2,x,card,1,9.5\no3,1,card,1\n")
    report = type_violations(spark, path, "order_payments").first()
    assert (report["n_bad_rows"], report["first_bad_row"]) == (2, "o2,x,card,1,9.5")
    with open(path, "w", encoding="utf-8") as f:
        f.write("order_id,payment_type,payment_sequential,payment_installments,payment_value\no1,card,1,1,9.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, path, "order_payments").collect()


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from marketlens import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Cluster:
        conf = Conf()

        @property
        def sparkContext(self):
            raise RuntimeError

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())
