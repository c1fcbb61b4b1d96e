"""Loads into bucketed targets: a table is made once, and its own rules read it once."""

from __future__ import annotations

import os
import tempfile

from tests.test_runner import CUSTOMERS, GEO, _status


def test_rows_are_made_once_and_rejected_ones_removed(spark):
    from marketlens.runner import load_tables, read_loaded

    made = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            made.add(1)
            yield row

    geo = spark.createDataFrame([("z", 0.0, 0.0, "c", "st")], GEO)
    rows = [(f"c{k}", "u", "z", "c", "st") for k in range(10)]
    customers = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2).mapPartitions(count), CUSTOMERS)
    out = tempfile.mkdtemp(prefix="run-")
    tables = {"geolocation": geo, "customers": customers}
    assert _status(load_tables(spark, tables, out, buckets=2)) == {"geolocation": ("loaded", 0), "customers": ("loaded", 0)}
    assert made.value == len(rows)
    assert _status(load_tables(spark, tables, out, buckets=2)) == {
        "geolocation": ("rejected", 1), "customers": ("rejected", 10)}
    assert made.value == 2 * len(rows)
    assert os.listdir(f"{out}/_staging") == []
    assert read_loaded(spark, out, "customers").count() == len(rows)


def test_own_rules_count_as_the_reports_do(spark):
    from marketlens.operators import quality

    rows = [("o1", 1, "card", 1, 1.0), ("o1", 1, "card", 1, float("nan")), (None, 1, "x", 1, 2.0), (None, None, "x" * 300, 1, 1e30),
            ("o2", 1, "card", 1, None)]
    df = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_type string, "
                                     "payment_installments int, payment_value double")
    n = 0
    for report in (quality.pk_violations, quality.length_violations, quality.value_violations):
        for r in report({"order_payments": df}).collect():
            n += sum(r[c] or 0 for c in report({"order_payments": df}).columns
                     if c in ("n_duplicate_rows", "n_null_key_rows", "n_violations"))
    assert quality.own_violations("order_payments", df) == n >= 6
    assert quality.own_violations("order_payments", df.limit(0)) == 0
