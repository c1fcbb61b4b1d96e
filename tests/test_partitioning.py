"""Results must not depend on the number of shuffle partitions (ties, keep-first,
hash split and batches are all defined by data, not by arrival order)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketlens import registry
from marketlens.operators.expand import repeat_squared
from tests.conftest import SMOKE_DIR, rows_of

NAMES = ["first_order_analysis", "best_sellers", "geolocation_repaired", "shuffle_batches",
         "tfidf_transform", "customers_distribution", "rmf_per_client", "network_delay"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_with_1_and_8_partitions(spark, name):
    q = registry.queries()[name]
    results = []
    for n in (1, 8):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            results.append(rows_of(q(spark, SMOKE_DIR)))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]


def test_repeat_squared_emits_n_squared_rows(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 0)], "k long, n long")
    out = repeat_squared(df, "n", spread_keys=["k"])
    assert sorted(r["k"] for r in out.collect()) == [1] + [2] * 9


def test_a_large_group_is_emitted_by_many_tasks(spark):
    df = spark.createDataFrame([(1, 3000), (2, 3)], "k long, n long")
    out = repeat_squared(df.repartition(16), "n", spread_keys=["k"])
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["c"] for r in repeat_squared(df, "n", ["k"]).groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count("*").alias("c")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 3000 ** 2 + 9 == out.count()
    assert len(sizes) == 16 and max(sizes) <= 0.2 * sum(sizes)


def test_units_of_units(spark, monkeypatch):
    import marketlens.operators.expand as expand

    monkeypatch.setattr(expand, "EMIT", 4)
    df = spark.createDataFrame([(1, 10), (2, 3), (3, -1), (4, None)], "k long, n long")
    out = expand.repeat_squared(df, "n", spread_keys=["k"])
    assert {r["k"]: r["count"] for r in out.groupBy("k").count().collect()} == {1: 100, 2: 9}
