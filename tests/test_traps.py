"""One test per semantic trap of the reference queries, on hand-made frames with the
expected value worked out by hand."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlens import plans
from marketlens.functions.exact import percent_rounded
from marketlens.operators.repair import keep_first, repair_geolocation
from tests.conftest import rows_of, ts


def _order(oid, cust, purchase, delivered=None, estimated=None, approved=None, carrier=None):
    return (oid, cust, "delivered", ts(purchase), ts(approved) if approved else None,
            ts(carrier) if carrier else None, ts(delivered) if delivered else None,
            ts(estimated) if estimated else None)


def _item(oid, item_id, seller, price=10.0, freight=1.0, product=1):
    return (oid, item_id, product, seller, ts("2000-01-01"), price, freight)


def test_t1_day_of_month_not_dates(make_market):
    # order 1: delivered 2 May, due 28 April -> late by date, excluded by day-of-month
    # order 2: delivered 28 April, due 2 May -> early by date, included
    m = make_market(
        orders=[_order(1, 1, "2000-04-01", "2000-05-02 10:00", "2000-04-28"),
                _order(2, 2, "2000-04-01", "2000-04-28 10:00", "2000-05-02")],
        order_items=[_item(1, 1, 7), _item(2, 1, 7)])
    out = rows_of(plans.delay_stats(m).select("seller_id", "number_of_delays", "total_orders"))
    assert out == [(7, 0, 1)]
    calendar = rows_of(plans.delay_stats(m, late_rule="calendar")
                       .select("seller_id", "number_of_delays", "total_orders"))
    assert calendar == [(7, 1, 1)]


def test_whole_days_truncate_towards_zero(make_market):
    m = make_market(
        orders=[_order(1, 1, "2000-01-01", "2000-01-10 05:00", "2000-01-12 10:00"),   # -2d 5h
                _order(2, 2, "2000-01-01", "2000-01-15 23:00", "2000-01-12 00:00")],  # +3d 23h
        order_reviews=[(1, 1, 4, "a", None), (2, 2, 5, "b", None)])
    out = rows_of(plans.delay_review_correlation(m))
    assert out == [(1, -2, 4), (2, 3, 5)]


def test_t2_t3_churn_is_inverted(make_market):
    # person 10: one order before the snapshot and nothing later -> churned 0
    # person 20: an order before the snapshot and a later one before control -> 1
    m = make_market(
        customers=[(1, 10, "z", "c", "s"), (2, 20, "z", "c", "s"), (3, 20, "z", "c", "s")],
        orders=[_order(1, 1, "2017-06-01"), _order(2, 2, "2017-06-01"),
                _order(3, 3, "2018-03-01")],
        order_payments=[(1, 1, "card", 1, 10.0), (2, 1, "card", 1, 5.5)],
        order_reviews=[(1, 1, 5, None, None), (2, 2, 1, None, None)])
    out = {r["customer_unique_id"]: r["churned"] for r in plans.rmf_per_client(m).collect()}
    assert out == {10: 0, 20: 1}


def test_t4_fan_out_counts_and_delay_rate_over_100(make_market):
    # one late order with two items and two reviews: 4 rows, 1 distinct order
    m = make_market(
        sellers=[(7, "z1", "city", "st")],
        geolocation=[("z1", 1.0, 2.0, "city", "st")],
        orders=[_order(1, 1, "2000-01-01", "2000-01-20", "2000-01-10")],
        order_items=[_item(1, 1, 7), _item(1, 2, 7)],
        order_reviews=[(1, 1, 5, None, None), (2, 1, 2, None, None)])
    r = plans.best_sellers(m).collect()[0]
    assert r["n_orders"] == 4
    assert r["perc_delays"] == 400.0
    assert r["perc_negative_reviews"] == 50.0
    assert r["average_score"] == 3.5
    assert r["average_delay_days"] == 10.0


def test_t6_sellers_without_late_orders_are_dropped(make_market):
    m = make_market(
        sellers=[(7, "z1", "c", "s"), (8, "z1", "c", "s")],
        geolocation=[("z1", 1.0, 2.0, "c", "s")],
        orders=[_order(1, 1, "2000-01-01", "2000-01-20", "2000-01-10"),
                _order(2, 2, "2000-01-01", "2000-01-05", "2000-01-10")],
        order_items=[_item(1, 1, 7), _item(2, 1, 8)],
        order_reviews=[(1, 1, 5, None, None), (2, 2, 5, None, None)])
    assert [r["seller_id"] for r in plans.best_sellers(m).collect()] == [7]
    assert plans.best_sellers(m, drop_incomplete=False).count() == 2


def test_t5_first_order_with_two_rows_counts_as_return(make_market):
    m = make_market(
        customers=[(1, 10, "z", "c", "SP"), (2, 20, "z", "c", "SP"), (3, 20, "z", "c", "SP")],
        sellers=[(7, "z", "c", "RJ")],
        products=[(1, "toys")],
        orders=[_order(1, 1, "2000-01-01"), _order(2, 2, "2000-01-01"),
                _order(3, 3, "2000-02-01")],
        order_items=[_item(1, 1, 7, price=0.0), _item(1, 2, 7), _item(2, 1, 7, price=20.0, freight=5.0)],
        order_payments=[(2, 1, "card", 3, 25.0)])
    out = {r["customer_unique_id"]: r for r in plans.first_order_analysis(m).collect()}
    # person 10: two item rows in the first order -> LEAD sees the same timestamp
    assert out[10]["came_back_in_3_months"] == 1
    assert out[10]["delivery_cost_percentage"] is None  # first item has price 0
    assert out[10]["interstate_shipping"] == 1
    # person 20: one row for the first order, next order 31 days later
    assert out[20]["came_back_in_3_months"] == 1
    assert out[20]["delivery_cost_percentage"] == 0.25
    assert out[20]["payment_installments"] == 3
    assert out[20]["product_category_name"] == "toys"


def test_t9_exact_half_up_rounding(spark):
    df = spark.createDataFrame([(1, 32), (1, 800), (1005, 100000), (6698, 80342), (0, 5)], "a long, b long")
    got = [r[0] for r in df.select(percent_rounded(F.col("a"), F.col("b"))).collect()]
    assert got == [3.13, 0.13, 1.01, 8.34, 0.0]


def test_t11_person_with_two_places_gives_two_rows(make_market):
    m = make_market(
        customers=[(1, 10, "z1", "a", "s"), (2, 10, "z2", "b", "s")],
        geolocation=[("z1", 1.0, 1.0, "a", "s"), ("z2", 2.0, 2.0, "b", "s")],
        orders=[_order(1, 1, "2000-01-01"), _order(2, 2, "2000-01-01")],
        order_items=[_item(1, 1, 7, 10.0, 0.5), _item(2, 1, 7, 1.25, 0.0)])
    out = rows_of(plans.customers_distribution(m).select("customer_zip_code_prefix", "spesa_totale"))
    assert out == [("z1", 10.5), ("z2", 1.25)]


def test_t13_null_score(make_market):
    m = make_market(order_reviews=[(1, 1, None, "txt", None), (2, 2, 2, "bad", None),
                                   (3, 3, 3, None, None)])
    assert rows_of(plans.reviews(m)) == [("bad", 2, 0), ("txt", None, 0)]
    assert rows_of(plans.negative_reviews(m)) == [("bad", 2)]


def test_c1_keep_first_follows_input_order(spark):
    df = spark.createDataFrame([("z", 3, "late"), ("z", 1, "first"), ("y", 2, "only")],
                               "k string, input_pos long, v string")
    assert rows_of(keep_first(df, ["k"], ["input_pos"])) == [("y", "only"), ("z", "first")]


def test_t8_t12_repair_priority_and_zero_coordinates(spark):
    geo = spark.createDataFrame([(1, "z1", 5.0, 6.0, "geo", "S")],
                                "input_pos long, geolocation_zip_code_prefix string, geolocation_lat double, "
                                "geolocation_lng double, geolocation_city string, geolocation_state string")
    sellers = spark.createDataFrame([("z2", "seller-city", "S", 1)],
                                    "seller_zip_code_prefix string, seller_city string, seller_state string, input_pos long")
    customers = spark.createDataFrame([("z2", "customer-city", "S", 1), ("z3", "c3", "S", 2),
                                       ("z3", "c3-later", "S", 5), (None, "x", "S", 3)],
                                      "customer_zip_code_prefix string, customer_city string, "
                                      "customer_state string, input_pos long")
    out = rows_of(repair_geolocation(geo, sellers, customers))
    assert out == [("z1", 5.0, 6.0, "geo", "S"), ("z2", 0.0, 0.0, "seller-city", "S"),
                   ("z3", 0.0, 0.0, "c3", "S")]


def test_k5_months_add_up_and_unknown_category(spark):
    import __spark_entry__ as entry

    df = entry.queries()["sales_by_category_month"](spark, "/root/testdata/sf0.001")
    months = [c for c in df.columns if c.startswith("sold_in_")]
    assert len(months) == 12
    for r in df.collect():
        assert sum(r[c] for c in months) == r["total_sold"]
    assert "Unknown" in {r["category"] for r in df.collect()}


def test_k12_spine_has_no_gaps(spark):
    import __spark_entry__ as entry

    rows = entry.queries()["cohort"](spark, "/root/testdata/sf0.001").collect()
    months = [r["purchase_month"] for r in rows]
    for a, b in zip(months, months[1:]):
        assert (b.year * 12 + b.month) - (a.year * 12 + a.month) == 1
    assert any(r["new_clients"] == 0 for r in rows)


def test_golden_headers(spark):
    import __spark_entry__ as entry

    q = entry.queries()
    # Result headers of the three stored reference outputs (fixed values).
    assert q["cohort"](spark, "/root/testdata/sf0.001").columns == (
        ["purchase_month", "new_clients"] + [f"still_active_{k}m" for k in range(1, 13)])
    assert q["delays_by_state"](spark, "/root/testdata/sf0.001").columns == [
        "seller_state", "number_of_delays", "number_of_orders", "percentage_of_delays"]
    assert q["sales_by_category_month"](spark, "/root/testdata/sf0.001").columns == (
        ["category"] + [f"sold_in_{m}" for m in ("jan", "feb", "mar", "apr", "may", "jun", "jul",
                                                 "aug", "sep", "oct", "nov", "dec")] + ["total_sold"])


def test_hot_order_skew_is_exact(make_market):
    """One order holds most items: the pre-aggregated plans give the fan-out counts."""
    items = [_item(1, i, 7) for i in range(300)] + [_item(1, 300 + i, 8) for i in range(200)]
    items += [_item(2, 1, 8)]
    m = make_market(
        sellers=[(7, "z1", "c", "s"), (8, "z1", "c", "s")],
        geolocation=[("z1", 1.0, 2.0, "c", "s")],
        orders=[_order(1, 1, "2000-01-01", "2000-01-15 06:00", "2000-01-10"),
                _order(2, 2, "2000-01-01", "2000-01-09", "2000-01-10")],
        order_items=items,
        order_reviews=[(1, 1, 5, None, None), (2, 1, 1, None, None), (3, 1, 4, None, None),
                       (4, 2, 2, None, None)])
    out = {r["seller_id"]: r for r in plans.best_sellers(m, drop_incomplete=False).collect()}
    assert out[7]["n_orders"] == 900 and out[8]["n_orders"] == 601
    assert out[7]["perc_delays"] == 90000.0 and out[8]["perc_delays"] == 30000.0
    assert out[7]["average_delay_days"] == 5.0
    assert abs(out[8]["average_score"] - (200 * 10 + 2) / 601) < 1e-12


def test_durations_ignore_the_session_time_zone(spark):
    """timestamp_ntz arithmetic must not see daylight-saving gaps of the session zone."""
    from marketlens.functions.timecols import micros_between, whole_days

    df = spark.createDataFrame([(ts("1999-10-03 00:00"), ts("1999-10-03 05:00")),
                                (ts("1999-10-02 23:00"), ts("1999-10-03 00:30"))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        got = [(r[0], r[1]) for r in df.select(micros_between(F.col("a"), F.col("b")),
                                               whole_days(F.col("b"), F.col("a"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [(5 * 3600 * 10 ** 6, 0), (90 * 60 * 10 ** 6, 0)]


def test_output_invariants(spark):
    """Invariants the reference's stored outputs satisfy, asserted on ours."""
    from decimal import ROUND_HALF_UP, Decimal

    import __spark_entry__ as entry
    from marketlens.sources.standins import load_standins

    q = entry.queries()
    m = load_standins(spark, "/root/testdata/sf0.001")
    people = m.customers.join(m.orders, "customer_id").select("customer_unique_id").distinct().count()
    cohort = q["cohort"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r["new_clients"] for r in cohort) == people
    states = q["delays_by_state"](spark, "/root/testdata/sf0.001").collect()
    assert [r["number_of_delays"] for r in states] == sorted((r["number_of_delays"] for r in states), reverse=True)
    for r in states:
        exact = Decimal(r["number_of_delays"]) * 100 / Decimal(r["number_of_orders"])
        assert r["percentage_of_delays"] == float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
    assert sum(r["number_of_orders"] for r in states) == m.order_items.join(m.sellers, "seller_id").count()


def test_k12_cohort_counts_and_gap_months(make_market):
    # person 10: Jan, Feb (twice), Apr -> cohort Jan; active +1 and +3 months
    # person 20: Mar only -> cohort Mar; Feb has no new people but stays on the spine
    m = make_market(
        customers=[(1, 10, "z", "c", "s"), (2, 10, "z", "c", "s"), (3, 10, "z", "c", "s"),
                   (4, 10, "z", "c", "s"), (5, 20, "z", "c", "s")],
        orders=[_order(1, 1, "2000-01-15"), _order(2, 2, "2000-02-01"), _order(3, 3, "2000-02-20"),
                _order(4, 4, "2000-04-30 23:59"), _order(5, 5, "2000-03-03")])
    rows = {str(r["purchase_month"]): r for r in plans.cohort(m).collect()}
    assert list(rows) == ["2000-01-01", "2000-02-01", "2000-03-01"]
    jan, feb, mar = rows["2000-01-01"], rows["2000-02-01"], rows["2000-03-01"]
    assert (jan["new_clients"], jan["still_active_1m"], jan["still_active_2m"], jan["still_active_3m"]) == (1, 1, 0, 1)
    assert (feb["new_clients"], feb["still_active_1m"]) == (0, 0)
    assert (mar["new_clients"], mar["still_active_1m"]) == (1, 0)


def test_k6_mean_durations_skip_missing_dates(make_market):
    m = make_market(
        orders=[_order(1, 1, "2000-01-01", "2000-01-20", "2000-01-10", approved="2000-01-01 02:00",
                       carrier="2000-01-03"),
                _order(2, 2, "2000-01-01", "2000-01-21", "2000-01-10", approved=None,
                       carrier="2000-01-05")],
        order_items=[_item(1, 1, 7), _item(2, 1, 7)])
    r = plans.delay_stats(m).collect()[0]
    assert r["avg_seller_response_time_seconds"] == 7200.0            # order 2 has no approval
    assert r["carrier_delivery_time_seconds"] == 46 * 3600.0
    assert r["customer_delivery_time_seconds"] == (17 * 86400 + 16 * 86400) / 2
