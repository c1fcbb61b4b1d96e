"""Results of one batch from shared tables: the same rows, without shuffling items by order."""

from __future__ import annotations

import glob
import re
import tempfile

import pytest
from pyspark.sql import functions as F

from marketlens import plans, registry
from tests.conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def shared(spark):
    from marketlens.plans.shared import shared_standins

    return shared_standins(spark, SMOKE_DIR)


@pytest.mark.parametrize("name", [n for n in registry.RESULTS if n not in ("reviews", "negative_reviews")])
def test_shared_tables_give_the_same_rows(spark, shared, name):
    fn, params = registry._marts()[name]
    assert sorted(map(repr, fn(shared, **params).collect())) == sorted(
        map(repr, registry.queries()[name](spark, SMOKE_DIR).collect()))


def test_items_and_orders_are_not_shuffled_for_each_result(spark, shared):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for fn in (plans.best_sellers, plans.delays_by_state, plans.delay_stats, plans.sales_by_category_month,
                   plans.product_reviews, plans.network_delay_pairs):
            plan = fn(shared)._jdf.queryExecution().executedPlan().toString()
            assert not re.search(r"Exchange hashpartitioning\(order_id", plan), plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_table_is_made_once_and_again_after_a_failure(spark):
    from marketlens.plans.shared import _Once

    calls = []

    def make():
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("cancelled")
        return spark.range(3)

    once = _Once(make)
    with pytest.raises(RuntimeError):
        once()
    assert once() is once() and len(calls) == 2


def test_items_of_a_very_large_order_are_counted_first(spark):
    from marketlens.plans.shared import item_counts

    rows = [(7, k % 2, 1) for k in range(3000)] + [(100 + k, k % 5, k % 3) for k in range(600)] + [(None, 1, 1)]
    items = spark.createDataFrame(rows, "order_id long, seller_id long, product_id long").repartition(3)
    got = item_counts(items)
    assert got.filter("order_id = 7").count() == 2
    total = got.groupBy("order_id", "seller_id", "product_id").agg(F.sum("k").alias("k"))
    want = items.filter("order_id IS NOT NULL").groupBy("order_id", "seller_id", "product_id").agg(F.count("*").alias("k"))
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, want.collect()))


def test_few_copies_are_made_where_the_row_lies(spark):
    from marketlens.operators.expand import repeat_most_in_place

    df = spark.createDataFrame([(k, k % 4) for k in range(40)], "k long, n long").repartition(3)
    out = repeat_most_in_place(df, "n", spread_keys=["k"])
    assert out.count() == sum((k % 4) ** 2 for k in range(40))
    large = repeat_most_in_place(spark.createDataFrame([(1, 10), (2, 8), (3, -1), (4, None)], "k long, n long"), "n", ["k"])
    assert {r["k"]: r["count"] for r in large.groupBy("k").count().collect()} == {1: 100, 2: 64}
    parts = df.select("k", F.spark_partition_id().alias("p")).filter("k % 4 > 0").groupBy("p").count().count()
    assert out.groupBy(F.spark_partition_id().alias("p")).count().count() <= parts


def test_compressed_results_are_read_back(spark):
    from marketlens.runner import publish_results, read_result, run_batch

    df = spark.createDataFrame([("two\nlines", 1), ("", None), (None, 3)], "text string, score int")
    report = run_batch(spark, {"x": lambda: df}, tempfile.mkdtemp(prefix="run-"), "csv", compression="gzip")
    assert glob.glob(f"{report.first()['path']}/*.csv.gz")
    done = publish_results(spark, report, tempfile.mkdtemp(prefix="run-"), compression="gzip").first()
    assert done["rows"] == 3
    assert sorted(map(repr, read_result(spark, done["path"], "csv", df.schema).collect())) == sorted(map(repr, df.collect()))
