from __future__ import annotations

import tempfile

from pyspark.sql import functions as F

from marketlens.runner import load_tables, publish_results, read_loaded, read_result, run_batch


def test_batch_isolates_failures_and_counts_rows(spark):
    out = tempfile.mkdtemp(prefix="ml-batch-")
    qs = {"ok": lambda: spark.range(5), "bad": lambda: spark.range(3).select(F.col("nope")),
          "csv": lambda: spark.range(2)}
    report = {r["name"]: r for r in run_batch(spark, qs, out).collect()}
    assert report["ok"]["status"] == "ok" and report["ok"]["rows"] == 5
    assert report["bad"]["status"] == "error" and "nope" in report["bad"]["error"]
    assert report["csv"]["rows"] == 2
    pub = tempfile.mkdtemp(prefix="ml-pub-")
    done = {r["name"]: r["status"] for r in
            publish_results(spark, run_batch(spark, qs, out), pub, exclude=("csv",)).collect()}
    assert done == {"ok": "published", "csv": "skipped"}
    assert spark.read.parquet(f"{pub}/ok").count() == 5


def test_load_gate_rejects_only_the_violating_table(spark):
    out = tempfile.mkdtemp(prefix="ml-load-")
    sellers = spark.createDataFrame([("s1", "z", "c", "st"), ("s1", "z", "c", "st")],
                                    "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    geo = spark.createDataFrame([("z", 0.0, 0.0, "c", "st")],
                                "geolocation_zip_code_prefix string, geolocation_lat double, "
                                "geolocation_lng double, geolocation_city string, geolocation_state string")
    report = {r["table_name"]: r["status"] for r in
              load_tables(spark, {"sellers": sellers, "geolocation": geo}, out).collect()}
    assert report == {"geolocation": "loaded", "sellers": "rejected"}
    assert read_loaded(spark, out, "geolocation").count() == 1
    assert read_loaded(spark, out, "sellers") is None


def test_load_can_partition_orders_by_month_for_pruning(spark):
    import datetime as dt

    from marketlens.functions.timecols import month_floor

    out = tempfile.mkdtemp(prefix="ml-part-")
    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", dt.datetime(2018, 1, 5), None, None, None, None),
         ("o2", "c2", "delivered", dt.datetime(2018, 2, 7), None, None, None, None)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz, "
        "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
        "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz")
    report = load_tables(spark, {"orders": orders}, out, partition_by={
        "orders": {"purchase_month": month_floor(F.col("order_purchase_timestamp"))}}).collect()
    assert report[0]["status"] == "loaded"
    loaded = read_loaded(spark, out, "orders")
    feb = loaded.filter(F.col("purchase_month") == F.lit("2018-02-01").cast("date"))
    assert [r["order_id"] for r in feb.collect()] == ["o2"]
    plan = feb._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(purchase_month" in plan


GEO = ("geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
       "geolocation_city string, geolocation_state string")
CUSTOMERS = ("customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
             "customer_city string, customer_state string")


def _status(report):
    return {r["table_name"]: (r["status"], r["violations"]) for r in report.collect()}


def test_children_of_a_rejected_parent_are_rejected(spark):
    out = tempfile.mkdtemp(prefix="ml-cascade-")
    geo = spark.createDataFrame([("z", 0.0, 0.0, "c", "st")] * 2, GEO)
    customers = spark.createDataFrame([("c1", "u1", "z", "c", "st"), ("c2", "u2", None, "c", "st")], CUSTOMERS)
    assert _status(load_tables(spark, {"geolocation": geo, "customers": customers}, out)) == {
        "geolocation": ("rejected", 2), "customers": ("rejected", 1)}


def test_a_repeated_load_is_rejected_and_new_rows_append(spark):
    out = tempfile.mkdtemp(prefix="ml-twice-")
    geo = spark.createDataFrame([("z", 0.0, 0.0, "c", "st")], GEO)
    customers = spark.createDataFrame([("c1", "u1", "z", "c", "st")], CUSTOMERS)
    both = {"geolocation": geo, "customers": customers}
    assert _status(load_tables(spark, both, out)) == {"geolocation": ("loaded", 0), "customers": ("loaded", 0)}
    assert _status(load_tables(spark, both, out)) == {"geolocation": ("rejected", 1), "customers": ("rejected", 1)}
    more = spark.createDataFrame([("c2", "u1", "z", "c", "st")], CUSTOMERS)  # its parent is in the target
    assert _status(load_tables(spark, {"customers": more}, out)) == {"customers": ("loaded", 0)}
    assert sorted(r["customer_id"] for r in read_loaded(spark, out, "customers").collect()) == ["c1", "c2"]


def test_amounts_that_do_not_fit_are_reported(spark):
    out = tempfile.mkdtemp(prefix="ml-money-")
    rows = [("o1", 1, "card", 1, float("nan")), ("o2", 1, "card", 1, float("inf")), ("o3", 1, "card", 1, 1e30),
            ("o4", 1, "card", 1, 0.00004)]
    payments = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_type string, "
                                           "payment_installments int, payment_value double")
    assert _status(load_tables(spark, {"order_payments": payments}, out)) == {"order_payments": ("rejected", 3)}


def test_small_amounts_keep_their_digits(spark, make_market):
    from marketlens import plans
    from tests.conftest import ts

    m = make_market(
        geolocation=[("z", 0.0, 0.0, "c", "st")], customers=[(1, 1, "z", "c", "st")],
        orders=[(1, 1, "x", ts("2017-01-01"), None, None, None, None)],
        order_items=[(1, k, 1, 1, None, 0.00004, 0.0) for k in range(10)])
    assert [r["spesa_totale"] for r in plans.customers_distribution(m).collect()] == [0.0004]


def test_csv_results_survive_batch_and_publish(spark):
    texts = ["two\nlines", "quote \" and, comma", "", None, " blanks ", "\r\n", "back\\slash\\", '""', "é\u2028x", "\t"]
    df = spark.createDataFrame([(t, i if i % 3 else None) for i, t in enumerate(texts)], "text string, score int")
    report = run_batch(spark, {"reviews": lambda: df}, tempfile.mkdtemp(prefix="ml-b-"), "csv")
    done = publish_results(spark, report, tempfile.mkdtemp(prefix="ml-p-")).first()
    assert done["rows"] == len(texts)
    again = read_result(spark, done["path"], "csv", df.schema)
    assert sorted(map(repr, again.collect())) == sorted(map(repr, df.collect()))


def test_errors_are_reported_whole(spark):
    def fail():
        raise ValueError("first line\n" + "x" * 2000)

    report = run_batch(spark, {"bad": fail}, tempfile.mkdtemp(prefix="ml-e-")).first()
    assert report["error"].endswith("x" * 2000) and "first line\n" in report["error"]


def test_models_are_published_by_loading_and_saving(spark):
    from marketlens.operators import model
    from marketlens.runner import publish_models

    df = spark.createDataFrame([(i, ["good"] if i % 2 else ["bad"], i % 2) for i in range(20)],
                               "doc_id long, terms array<string>, label int")
    fitted = model.fit_sentiment_model(df, "doc_id", "terms", "label", max_features=10)
    folder, target = tempfile.mkdtemp(prefix="ml-m-") + "/m", tempfile.mkdtemp(prefix="ml-t-")
    model.save_model(fitted, folder)
    assert publish_models({"tfidf": folder, "bert": folder}, target) == [("tfidf", "published"), ("bert", "skipped")]
    again = {r["doc_id"]: r["predicted"] for r in model.score(model.load_model(f"{target}/tfidf"), df).collect()}
    assert again == {i: i % 2 for i in range(20)}


def test_one_query_is_cancelled_while_twelve_end(spark):
    import threading
    import time

    from marketlens.runner import BatchControl

    def slow():
        return spark.range(4).repartition(4).select(F.expr("java_method('java.lang.Thread', 'sleep', 600000L)"))

    out, control = tempfile.mkdtemp(prefix="run-"), BatchControl()
    queries = {"stuck": slow, **{f"q{k}": (lambda k=k: spark.range(k + 1)) for k in range(12)}}
    stop = threading.Timer(6, control.cancel, ["stuck"])
    stop.start()
    began = time.time()
    report = run_batch(spark, queries, out, control=control, workers=4).collect()
    assert time.time() - began < 120
    assert [r["name"] for r in report] == list(queries)
    assert report[0]["status"] == "cancelled" and report[0]["error"]
    assert [(r["status"], r["rows"]) for r in report[1:]] == [("ok", k + 1) for k in range(12)]


def test_a_time_limit_stops_one_query(spark):
    def slow():
        return spark.range(2).select(F.expr("java_method('java.lang.Thread', 'sleep', 600000L)"))

    report = {r["name"]: r["status"] for r in run_batch(
        spark, {"stuck": slow, "ok": lambda: spark.range(3)}, tempfile.mkdtemp(prefix="run-"), time_limit=8).collect()}
    assert report == {"stuck": "timed out", "ok": "ok"}


def test_a_result_is_counted_by_the_job_that_writes_it(spark):
    from marketlens.runner import write_result

    sc, out = spark.sparkContext, tempfile.mkdtemp(prefix="run-")
    sc.addJobTag("counted-write")
    try:
        assert write_result(spark.range(100, numPartitions=3), out + "/x", "csv") == 100
        assert write_result(spark.range(0), out + "/y") == 0
    finally:
        sc.removeJobTag("counted-write")
    assert len(sc.statusTracker().getJobIdsForTag("counted-write")) == 2 if hasattr(
        sc.statusTracker(), "getJobIdsForTag") else True
    assert spark.catalog.listTables("global_temp") == [] or all(
        not t.name.startswith("counted_") for t in spark.catalog.listTables("global_temp"))


def test_models_can_be_trained_after_counted_writes(spark):
    from marketlens.operators import model
    from marketlens.runner import write_result

    assert write_result(spark.range(5), tempfile.mkdtemp(prefix="run-") + "/x") == 5
    df = spark.createDataFrame([(i, ["good"] if i % 2 else ["bad"], i % 2) for i in range(20)],
                               "doc_id long, terms array<string>, label int")
    fitted = model.fit_sentiment_model(df, "doc_id", "terms", "label", max_features=10)
    assert {r["doc_id"]: r["predicted"] for r in model.score(fitted, df).collect()} == {i: i % 2 for i in range(20)}


def test_bucketed_targets_take_several_loads(spark):
    out = tempfile.mkdtemp(prefix="run-")
    geo = spark.createDataFrame([("z", 0.0, 0.0, "c", "st"), ("y", 0.0, 0.0, "c", "st")], GEO)
    customers = spark.createDataFrame([(f"c{k}", "u1", "z", "c", "st") for k in range(20)], CUSTOMERS)
    both = {"geolocation": geo, "customers": customers}
    assert _status(load_tables(spark, both, out, buckets=4)) == {"geolocation": ("loaded", 0), "customers": ("loaded", 0)}
    assert _status(load_tables(spark, both, out, buckets=4)) == {"geolocation": ("rejected", 2), "customers": ("rejected", 20)}
    more = spark.createDataFrame([("c20", "u1", "y", "c", "st"), ("c21", "u1", "x", "c", "st")], CUSTOMERS)
    assert _status(load_tables(spark, {"customers": more}, out, buckets=4)) == {"customers": ("rejected", 1)}
    fits = more.filter("customer_id = 'c20'")
    assert _status(load_tables(spark, {"customers": fits}, out, buckets=4)) == {"customers": ("loaded", 0)}
    assert sorted(r["customer_id"] for r in read_loaded(spark, out, "customers").collect()) == sorted(f"c{k}" for k in range(21))
    assert _status(load_tables(spark, {"customers": fits}, out, buckets=8))["customers"][0].startswith("error: ValueError")
