"""Physical-plan properties behind the scale claims (static plans, AQE off)."""

from __future__ import annotations

import re

import pytest

from marketlens import registry
from tests.conftest import SMOKE_DIR

RUNS_JOBS = {"batch_report", "publish_results", "published_reviews", "csv_scan", "load_gate",
             "logreg_scores", "logreg_metrics", "exact_logit_model", "exact_logit_scores", "exact_logit_metrics",
             "saved_model_scores", "input_report", "load_in_steps", "lemma_substitution", "lemmas_by_rules"}


@pytest.fixture
def static_plan(spark):
    def plan(name: str) -> str:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            df = registry.queries()[name](spark, SMOKE_DIR)
            return df._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", "true")
    return plan


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - RUNS_JOBS))
def test_no_cartesian_join_and_no_python(static_plan, name):
    plan = static_plan(name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan)


def test_k1_counts_items_per_order_and_seller_before_any_join(static_plan):
    plan = static_plan("best_sellers")
    assert re.search(r"HashAggregate\(keys=\[order_id#\d+L, seller_id#\d+L\], "
                     r"functions=\[partial_count\(1\)\]", plan)


def test_k13_limits_each_person_to_two_orders_before_the_shuffle(static_plan):
    plan = static_plan("first_order_analysis")
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) and final


@pytest.fixture
def shuffled_plan(spark, static_plan):
    """The plan without broadcasts, as at scale."""
    def plan(name: str) -> str:
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            return static_plan(name)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    return plan


def _count(plan: str, what: str) -> int:
    return len(re.findall(what, plan))


def test_cohort_reads_each_table_once(shuffled_plan):
    plan = shuffled_plan("cohort")
    assert _count(plan, "FileScan") == 5  # orders; and orders, customer, nation, region for the customers


def test_length_rule_reads_each_table_once(shuffled_plan):
    from marketlens.sources.standins import load_standins  # noqa: F401

    plan = shuffled_plan("length_violations")
    assert _count(plan, "FileScan") <= 30


def test_binary_metrics_aggregates_its_rows_once(shuffled_plan):
    plan = shuffled_plan("binary_metrics")
    assert _count(plan, "FileScan") <= 4


@pytest.mark.parametrize("name", ["delays_by_state", "sales_by_category_month", "delay_stats",
                                  "network_delay_pairs", "product_reviews"])
def test_items_are_counted_before_any_join(shuffled_plan, name):
    assert re.search(r"HashAggregate\(keys=\[order_id#\d+L, (seller|product)_id#\d+L\], functions=\[partial_count\(1\)\]",
                     shuffled_plan(name))


def test_checks_of_a_load_do_not_shuffle_what_is_loaded(spark, monkeypatch):
    """Key and parent checks against bucketed targets: exchanges on the new rows' side only."""
    import tempfile

    from pyspark.sql import functions as F

    from marketlens.operators import quality
    from marketlens.runner import load_tables, read_loaded
    from marketlens.sources.standins import load_standins

    m, target = load_standins(spark, SMOKE_DIR), tempfile.mkdtemp(prefix="run-")
    odd = F.col("order_id") % 2 == 1
    customers = m.customers.withColumn("customer_state", F.lit("st"))
    first = {"geolocation": m.geolocation, "customers": customers, "orders": m.orders.filter(odd)}
    assert {r["status"] for r in load_tables(spark, first, target, buckets=4).collect()} == {"loaded"}
    plans = []
    real = type(m.orders).join

    def joined(self, other, on=None, how=None):
        out = real(self, other, on, how)
        if how in ("left_semi", "left_anti"):
            plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out
    monkeypatch.setattr(type(m.orders), "join", joined)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bad = quality.load_violations("orders", m.orders.filter(~odd), {"customers": read_loaded(spark, target, "customers")},
                                      read_loaded(spark, target, "orders"), buckets=4)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert bad == 0 and len(plans) == 2
    for plan in plans:
        lines = plan.splitlines()
        bucketed = [line for line in lines if "Bucketed: true" in line]
        assert len(bucketed) == 1, plan
        depth = lines.index(bucketed[0])
        above = []
        indent = len(bucketed[0]) - len(bucketed[0].lstrip(" :+-"))
        for line in reversed(lines[:depth]):  # the way up to the join
            here = len(line) - len(line.lstrip(" :+-"))
            if here < indent:
                above.append(line)
                indent = here
                if "Join" in line:
                    break
        assert above and not any("Exchange" in line for line in above), plan
