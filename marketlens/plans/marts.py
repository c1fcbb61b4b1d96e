"""The thirteen named business queries over a :class:`Marketplace`.

Each function returns a lazy DataFrame whose values equal the reference's query,
including its quirks (day-of-month comparisons, fan-out counts, inverted churn flag),
which are documented where they occur.  Output columns are lower case.

Where several results are made in one run, ``item_counts`` and ``reviews_by_order`` of the
marketplace hold what they share, see ``shared.py``.

Plan shape, common to all: fact tables are aggregated per order *before* they meet
another fan-out table, so an order with many items, reviews or payments never
materialises the product of those rows; joins on ``order_id`` share one hash
partitioning, and the per-seller / per-person aggregates run map-side first.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.exact import (
    MONEY_TYPE, money, money_out, percent, percent_rounded, ratio_mean, weighted_mean,
)
from marketlens.functions.timecols import micros_between, month_floor, whole_days
from marketlens.operators.expand import repeat_most_in_place
from marketlens.operators.spine import month_spine
from marketlens.sources.marketplace import Marketplace


def PURCHASE() -> Column:
    return F.col("order_purchase_timestamp")


def APPROVED() -> Column:
    return F.col("order_approved_at")


def CARRIER() -> Column:
    return F.col("order_delivered_carrier_date")


def DELIVERED() -> Column:
    return F.col("order_delivered_customer_date")


def ESTIMATED() -> Column:
    return F.col("order_estimated_delivery_date")


def SCORE() -> Column:
    return F.col("review_score")


# Month column names of the sales pivot (fixed values).
MONTH_ABBREVIATIONS = ("jan", "feb", "mar", "apr", "may", "jun",
                       "jul", "aug", "sep", "oct", "nov", "dec")


def _is_late() -> Column:
    """Delivered after the estimate; NULL dates count as not late."""
    return F.coalesce(ESTIMATED() < DELIVERED(), F.lit(False))


def _day_of_month_late() -> Column:
    """The reference's lateness test in K6/K7 compares *day of month* only: delivered
    2 May vs due 28 April fails it, 28 April vs 2 May passes (kept on purpose)."""
    return F.dayofmonth(DELIVERED()) > F.dayofmonth(ESTIMATED())


def _calendar_late() -> Column:
    return DELIVERED() > ESTIMATED()


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def _items_per(m: Marketplace, column: str) -> DataFrame:
    """Items of each (order, ``column``): counted map-side before any join, so an order
    with a third of all items is one row for each of its sellers or products."""
    if m.item_counts is not None:
        return m.item_counts.groupBy("order_id", column).agg(F.sum("k").alias("k"))
    return m.order_items.groupBy("order_id", column).agg(F.count("*").alias("k"))


def reviews_by_order(m: Marketplace) -> DataFrame:
    """Per order: number of reviews, sum and number of scores, negative ones, and the first
    review (FIRST_REVIEW_ORDER), aggregated map-side.  Unused columns are pruned."""
    if m.reviews_by_order is not None:
        return m.reviews_by_order
    return m.order_reviews.groupBy("order_id").agg(
        F.count("*").alias("n_reviews"), F.sum(SCORE()).alias("score_sum"),
        F.count(SCORE()).alias("score_n"), F.count_if(SCORE() < 3).alias("negative_n"),
        F.min(F.struct(*FIRST_REVIEW_ORDER)).alias("review"))


# --------------------------------------------------------------------------- K1
def best_sellers(m: Marketplace, drop_incomplete: bool = True) -> DataFrame:
    """K1: per seller and place, item x review rows, review averages and delays.

    Fan-out kept as in the reference: ``n_orders`` counts item x review rows, and
    ``perc_delays`` divides late *rows* by distinct orders (it can pass 100).  With
    ``drop_incomplete`` rows holding any NULL are removed afterwards, which drops
    every seller without a late order or without a review.
    """
    late = _calendar_late()
    orders = m.orders.select(
        "order_id", F.coalesce(late, F.lit(False)).alias("is_late"),
        F.when(late, whole_days(DELIVERED(), ESTIMATED())).alias("late_days"))
    reviews_per_order = reviews_by_order(m).select("order_id", "n_reviews", "score_sum", "score_n", "negative_n")
    # Items are counted per (order, seller) before the join: partial aggregation runs
    # map-side, so an order holding a third of all items arrives as one row per
    # seller, and both join sides then hold at most one row per order (and seller).
    items_per_order = _items_per(m, "seller_id").withColumnRenamed("k", "n_items")
    per_order = (items_per_order.join(orders, "order_id")
                 .join(reviews_per_order, "order_id", "left"))
    n_items = F.col("n_items")
    rows = n_items * F.greatest(F.coalesce(F.col("n_reviews"), F.lit(0)), F.lit(1))
    per_seller = per_order.groupBy("seller_id").agg(
        F.sum(rows).alias("n_orders"),
        F.sum(n_items * F.col("score_sum")).alias("score_sum"),
        F.sum(n_items * F.col("score_n")).alias("score_n"),
        F.sum(n_items * F.coalesce(F.col("negative_n"), F.lit(0))).alias("negative_rows"),
        F.sum(F.when(F.col("is_late"), rows).otherwise(0)).alias("late_rows"),
        F.sum(F.when(F.col("is_late"), rows * F.col("late_days"))).alias("late_days_sum"),
        F.count("*").alias("distinct_orders"))
    sellers, geo = m.sellers, m.geolocation
    out = (per_seller.join(sellers, "seller_id")
           .join(geo, sellers.seller_zip_code_prefix == geo.geolocation_zip_code_prefix, "left")
           .select("seller_id",
                   F.col("seller_zip_code_prefix").alias("zip_code"),
                   F.col("seller_state").alias("state"),
                   F.col("seller_city").alias("city"),
                   "geolocation_lat", "geolocation_lng", "n_orders",
                   ratio_mean(F.col("score_sum"), F.col("score_n")).alias("average_score"),
                   percent(F.col("negative_rows"), F.col("n_orders")).alias("perc_negative_reviews"),
                   percent(F.col("late_rows"), F.col("distinct_orders")).alias("perc_delays"),
                   ratio_mean(F.col("late_days_sum"), F.col("late_rows")).alias("average_delay_days")))
    if drop_incomplete:
        out = out.na.drop("any")
    return out.orderBy(F.desc_nulls_first("n_orders"), F.desc_nulls_first("average_score"))


# --------------------------------------------------------------------------- K2
def reviews(m: Marketplace) -> DataFrame:
    """K2: review texts with a positive flag (score >= 3; a NULL score counts as 0)."""
    return (m.order_reviews.filter(F.col("review_comment_message").isNotNull())
            .select("review_comment_message", "review_score",
                    F.when(SCORE() >= 3, 1).otherwise(0).alias("is_positive")))


# --------------------------------------------------------------------------- K3
def customers_distribution(m: Marketplace) -> DataFrame:
    """K3: spend (price + freight) per person and place; one row per place of a person."""
    spend_per_order = m.order_items.groupBy("order_id").agg(
        F.sum(money(F.col("price") + F.col("freight_value"))).alias("spent"))
    spend_per_customer_id = (m.orders.select("order_id", "customer_id")
                             .join(spend_per_order, "order_id")
                             .groupBy("customer_id").agg(F.sum("spent").alias("spent")))
    c, geo = m.customers, m.geolocation
    return (c.join(geo, c.customer_zip_code_prefix == geo.geolocation_zip_code_prefix)
            .join(spend_per_customer_id, "customer_id")
            .groupBy("customer_unique_id", "customer_zip_code_prefix", "customer_city",
                     "customer_state", F.col("geolocation_lat").alias("lat"),
                     F.col("geolocation_lng").alias("lng"))
            .agg(money_out(F.sum("spent")).alias("spesa_totale"))
            .orderBy(F.desc_nulls_first("spesa_totale")))


# --------------------------------------------------------------------------- K4
def delays_by_state(m: Marketplace) -> DataFrame:
    """K4: late items / all items per seller state, percentage rounded half-up to 2
    places on exact numbers.  Counts are items, not orders."""
    per_seller = (_items_per(m, "seller_id")
                  .join(m.orders.select("order_id", _is_late().alias("is_late")), "order_id")
                  .groupBy("seller_id")
                  .agg(F.sum(F.when(F.col("is_late"), F.col("k")).otherwise(0)).alias("n_late"),
                       F.sum("k").alias("n_items")))
    by_state = (per_seller.join(m.sellers.select("seller_id", "seller_state"), "seller_id")
                .groupBy("seller_state")
                .agg(F.sum("n_late").alias("number_of_delays"),
                     F.sum("n_items").alias("number_of_orders")))
    return (by_state.select(
                "seller_state", "number_of_delays", "number_of_orders",
                percent_rounded(F.col("number_of_delays"), F.col("number_of_orders"))
                .alias("percentage_of_delays"))
            .orderBy(F.desc_nulls_first("number_of_delays")))


# --------------------------------------------------------------------------- K5
def sales_by_category_month(m: Marketplace) -> DataFrame:
    """K5: items sold per English category and calendar month (all years pooled).
    Products without a (translated) category fall out of the inner join."""
    per_product = (_items_per(m, "product_id")
                   .join(m.orders.select("order_id", F.month(PURCHASE()).alias("order_month")),
                         "order_id")
                   .groupBy("product_id", "order_month").agg(F.sum("k").alias("n")))
    per_category = (per_product
                    .join(m.products.select("product_id", "product_category_name"), "product_id")
                    .join(m.prodcategory, "product_category_name"))
    month, n = F.col("order_month"), F.col("n")
    return per_category.groupBy(F.col("product_category_name_english").alias("category")).agg(
        *[F.sum(F.when(month == i + 1, n).otherwise(0)).alias(f"sold_in_{abbr}")
          for i, abbr in enumerate(MONTH_ABBREVIATIONS)],
        F.sum(n).alias("total_sold"))


# --------------------------------------------------------------------------- K6
def delay_stats(m: Marketplace, late_rule: str = "day_of_month") -> DataFrame:
    """K6: per seller, late items and mean stage durations in seconds.

    Rows are restricted by the reference's day-of-month test (``late_rule`` =
    ``"calendar"`` uses true lateness instead).  Means skip NULL durations.
    """
    keep = _day_of_month_late() if late_rule == "day_of_month" else _calendar_late()
    orders = m.orders.filter(keep).select(
        "order_id", (ESTIMATED() < DELIVERED()).alias("is_late"),
        micros_between(PURCHASE(), APPROVED()).alias("response_us"),
        micros_between(APPROVED(), CARRIER()).alias("carrier_us"),
        micros_between(CARRIER(), DELIVERED()).alias("customer_us"))
    k = F.col("k")
    per_seller = (_items_per(m, "seller_id").join(orders, "order_id")
                  .groupBy("seller_id").agg(
                      F.sum(F.when(F.col("is_late"), k).otherwise(0)).alias("number_of_delays"),
                      F.sum(k).alias("total_orders"),
                      (weighted_mean(F.col("response_us"), k) / F.lit(1e6))
                      .alias("avg_seller_response_time_seconds"),
                      (weighted_mean(F.col("carrier_us"), k) / F.lit(1e6))
                      .alias("carrier_delivery_time_seconds"),
                      (weighted_mean(F.col("customer_us"), k) / F.lit(1e6))
                      .alias("customer_delivery_time_seconds")))
    return per_seller.orderBy(F.desc_nulls_first("number_of_delays"))


# --------------------------------------------------------------------------- K7
_NETWORK_COLUMNS = ("seller_id", "seller_city", "seller_state", "seller_lat", "seller_lng",
                    "customer_id", "customer_city", "customer_state", "customer_lat",
                    "customer_lng")


def network_delay_pairs(m: Marketplace, late_rule: str = "day_of_month") -> DataFrame:
    """K7, compact: one row per (seller, customer) pair with both coordinates,
    ``n_items`` passing the test and ``n_rows`` = n_items^2, the number of times the
    reference's self-join repeats the pair.  Use this form at scale."""
    keep = _day_of_month_late() if late_rule == "day_of_month" else _calendar_late()
    pairs = (_items_per(m, "seller_id")
             .join(m.orders.filter(keep).select("order_id", "customer_id"), "order_id")
             .groupBy("seller_id", "customer_id").agg(F.sum("k").alias("n_items")))
    geo = m.geolocation
    seller_side = m.sellers.join(
        geo, m.sellers.seller_zip_code_prefix == geo.geolocation_zip_code_prefix).select(
        "seller_id", "seller_city", "seller_state",
        F.col("geolocation_lat").alias("seller_lat"), F.col("geolocation_lng").alias("seller_lng"))
    customer_side = m.customers.join(
        geo, m.customers.customer_zip_code_prefix == geo.geolocation_zip_code_prefix).select(
        "customer_id", "customer_city", "customer_state",
        F.col("geolocation_lat").alias("customer_lat"),
        F.col("geolocation_lng").alias("customer_lng"))
    return (pairs.join(seller_side, "seller_id").join(customer_side, "customer_id")
            .select(*_NETWORK_COLUMNS, "n_items",
                    (F.col("n_items") * F.col("n_items")).alias("n_rows")))


def network_delay(m: Marketplace, late_rule: str = "day_of_month") -> DataFrame:
    """K7: the reference's result, where a pair with n matching items appears n^2
    times (seller-side rows x customer-side rows of its self-join)."""
    pairs = network_delay_pairs(m, late_rule)
    return repeat_most_in_place(pairs, "n_items", spread_keys=["seller_id", "customer_id"]).select(
        *_NETWORK_COLUMNS)


# --------------------------------------------------------------------------- K8
def delay_review_correlation(m: Marketplace) -> DataFrame:
    """K8: whole days delivered - estimated (negative = early) against review score."""
    orders = (m.orders.filter(DELIVERED().isNotNull() & ESTIMATED().isNotNull())
              .select("order_id", whole_days(DELIVERED(), ESTIMATED()).alias("delivery_delay")))
    scored = m.order_reviews.filter(SCORE().isNotNull()).select("order_id", "review_score")
    return (orders.join(scored, "order_id")
            .select("order_id", "delivery_delay", "review_score")
            .orderBy(F.desc_nulls_first("delivery_delay"), F.desc_nulls_first("review_score")))


# --------------------------------------------------------------------------- K9
def negative_reviews(m: Marketplace) -> DataFrame:
    """K9: texts of reviews scored 1 or 2."""
    return (m.order_reviews
            .filter(SCORE().isNotNull() & F.col("review_comment_message").isNotNull() & (SCORE() <= 2))
            .select("review_comment_message", "review_score"))


# --------------------------------------------------------------------------- K10
def product_reviews(m: Marketplace) -> DataFrame:
    """Mean review score per product (each review weighted by the items of its
    order), with the English category; products without one are dropped."""
    per_order = (reviews_by_order(m).select("order_id", F.col("score_sum").alias("s"), F.col("score_n").alias("c"))
                 .filter("c > 0"))
    k = F.col("k")
    per_product = (_items_per(m, "product_id").join(per_order, "order_id")
                   .groupBy("product_id").agg(F.sum(k * F.col("s")).alias("s"), F.sum(k * F.col("c")).alias("c")))
    return (per_product
            .join(m.products.select("product_id", "product_category_name"), "product_id")
            .join(m.prodcategory, "product_category_name")
            .select("product_id", "product_category_name_english",
                    ratio_mean(F.col("s"), F.col("c")).alias("avg_score"))
            .orderBy(F.desc_nulls_first("avg_score")))


# --------------------------------------------------------------------------- K11
def rmf_per_client(m: Marketplace, snapshot="2018-01-01", control="2018-07-01") -> DataFrame:
    """Recency, frequency, monetary value and churn per person.

    Main side: orders up to ``snapshot`` that have a payment *and* a review, counted
    per payment x review row (frequency and monetary are fan-out sums).  Control side:
    last order before ``control`` over all orders.  ``churned`` is 0 when the last
    main order equals the last control order -- i.e. when the person did *not* come
    back -- and 1 otherwise, inverted as in the reference.
    """
    snap, ctrl = _ts(snapshot), _ts(control)
    payments = m.order_payments.groupBy("order_id").agg(
        F.count("*").alias("n_pay"), F.sum(money(F.col("payment_value"))).alias("paid"))
    reviews_per_order = reviews_by_order(m).select("order_id", F.col("n_reviews").alias("n_rev"), "score_sum", "score_n")
    delay = F.when(DELIVERED() > ESTIMATED(), whole_days(DELIVERED(), ESTIMATED())).otherwise(0)
    orders = (m.orders.filter((PURCHASE() < ctrl) | (PURCHASE() <= snap))
              .select("order_id", "customer_id", PURCHASE().alias("ts"), delay.alias("delay_days")))
    facts = (orders.join(payments, "order_id", "left").join(reviews_per_order, "order_id", "left")
             .join(m.customers.select("customer_id", "customer_unique_id"), "customer_id"))
    ts = F.col("ts")
    main = (ts <= snap) & F.col("n_pay").isNotNull() & F.col("n_rev").isNotNull()
    rows = F.col("n_pay") * F.col("n_rev")
    per_person = facts.groupBy("customer_unique_id").agg(
        F.max(F.when(ts < ctrl, ts)).alias("last_before_control"),
        F.max(F.when(main, ts)).alias("last_main"),
        F.sum(F.when(main, rows)).alias("frequency"),
        F.sum(F.when(main, F.col("paid") * F.col("n_rev").cast("decimal(20,0)")).cast(MONEY_TYPE)).alias("money"),
        F.sum(F.when(main, F.col("score_sum") * F.col("n_pay"))).alias("score_sum"),
        F.sum(F.when(main, F.col("score_n") * F.col("n_pay"))).alias("score_n"),
        F.sum(F.when(main, F.col("delay_days") * rows)).alias("delay_sum"))
    return (per_person
            .filter(F.col("last_main").isNotNull() & F.col("last_before_control").isNotNull())
            .select("customer_unique_id",
                    whole_days(snap, F.col("last_main")).alias("recency"),
                    "frequency",
                    money_out(F.col("money")).alias("monetary"),
                    ratio_mean(F.col("score_sum"), F.col("score_n")).alias("average_score"),
                    ratio_mean(F.col("delay_sum"), F.col("frequency")).alias("average_delay_days"),
                    F.when(F.col("last_main") == F.col("last_before_control"), 0)
                    .otherwise(1).alias("churned"))
            .orderBy(F.desc_nulls_first("churned")))


# --------------------------------------------------------------------------- K12
def person_months(m: Marketplace) -> DataFrame:
    """Per person: first purchase month (``cohort``) and the set of months with a
    purchase.  A person's distinct months are bounded by the calendar span and
    ``collect_set`` is merged map-side, so a person with a third of all orders costs
    one small set per task."""
    return (m.orders.select("customer_id", month_floor(PURCHASE()).alias("month"))
            .join(m.customers.select("customer_id", "customer_unique_id"), "customer_id")
            .groupBy("customer_unique_id")
            .agg(F.min("month").alias("cohort"), F.collect_set("month").alias("months"))
            .filter(F.col("cohort").isNotNull()))


def cohort_spine(m: Marketplace) -> DataFrame:
    """Every month from the first to the last cohort month."""
    return month_spine(person_months(m), "cohort", "calendar_month")


def cohort(m: Marketplace, horizon: int = 12) -> DataFrame:
    """Monthly cohorts: new people per first-purchase month and how many of them
    buy again exactly k months later (k = 1..horizon), on a gap-free month spine.

    Equal to the reference's COUNT(DISTINCT ...) FILTER form: activity is distinct per
    (person, month) and each person has one cohort, so plain counts per offset are
    distinct counts.
    """
    pm = person_months(m)
    offsets = F.filter(
        F.transform("months", lambda x: F.months_between(x, F.col("cohort")).cast("int")),
        lambda k: k <= horizon)
    k = F.col("k")
    counts = pm.select("cohort", F.explode(offsets).alias("k")).groupBy("cohort").agg(
        F.count_if(k == 0).alias("new_clients"),
        *[F.count_if(k == i).alias(f"still_active_{i}m") for i in range(1, horizon + 1)])
    value_cols = ["new_clients"] + [f"still_active_{i}m" for i in range(1, horizon + 1)]
    # One row a cohort month, so they fit one row; the spine comes from the same pass.
    whole = counts.agg(F.min("cohort").alias("lo"), F.max("cohort").alias("hi"),
                       F.map_from_entries(F.collect_list(F.struct("cohort", F.struct(*value_cols)))).alias("by_month"))
    months = whole.select("by_month", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("purchase_month"))
    found = F.try_element_at("by_month", F.col("purchase_month"))
    return (months.select("purchase_month",
                          *[F.coalesce(found[c], F.lit(0).cast("long")).alias(c) for c in value_cols])
            .orderBy(F.asc_nulls_last("purchase_month")))


def stage_durations(m: Marketplace) -> DataFrame:
    """F8/I5 per order: seconds between purchase, approval, hand-over to the carrier and
    delivery, and whole days delivered - estimated.  NULL where a date is missing."""
    return m.orders.select(
        "order_id",
        (micros_between(PURCHASE(), APPROVED()) / F.lit(1e6)).alias("seller_response_seconds"),
        (micros_between(APPROVED(), CARRIER()) / F.lit(1e6)).alias("carrier_seconds"),
        (micros_between(CARRIER(), DELIVERED()) / F.lit(1e6)).alias("customer_delivery_seconds"),
        whole_days(DELIVERED(), ESTIMATED()).alias("delivery_delay_days"))


# --------------------------------------------------------------------------- K13
FIRST_ITEM_ORDER = ("order_item_id", "product_id", "seller_id", "price", "freight_value")
FIRST_REVIEW_ORDER = ("review_id", "review_score")
FIRST_PAYMENT_ORDER = ("payment_sequential", "payment_installments", "payment_type",
                       "payment_value")


def first_order_analysis(m: Marketplace, window_days: int = 90) -> DataFrame:
    """Facts of each person's first order and whether they came back.

    The reference ranks the rows of a five-way left-join star per person by purchase
    time only; ties make the first row arbitrary and LEAD then returns the *same*
    order's timestamp, so any first order with several item / review / payment rows
    counts as a return.  Here the order is made total -- purchase time, order id,
    then item (FIRST_ITEM_ORDER), review (FIRST_REVIEW_ORDER) and payment
    (FIRST_PAYMENT_ORDER) columns -- which is one of the reference's legal outcomes.

    The star is never materialised: per person only the two first orders are kept
    (a top-2 window that Spark limits map-side), and the first item, review and
    payment of an order are minima per order, aggregated map-side before any shuffle.
    """
    # whole days late, mostly 0, go through the shuffles instead of two timestamps
    delay = F.when(ESTIMATED() < DELIVERED(), whole_days(DELIVERED(), ESTIMATED())).otherwise(0)
    person_orders = (m.orders.select("order_id", "customer_id", PURCHASE().alias("ts"), delay.alias("delay"))
                     .join(m.customers.select("customer_id", "customer_unique_id",
                                              "customer_state"), "customer_id"))
    w = Window.partitionBy("customer_unique_id").orderBy(F.asc_nulls_last("ts"), F.asc("order_id"))
    top2 = person_orders.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= 2)
    first = F.col("rn") == 1
    firsts = top2.groupBy("customer_unique_id").agg(
        *[F.max(F.when(first, F.col(c))).alias(c)
          for c in ("order_id", "ts", "delay", "customer_state")],
        F.max(F.when(F.col("rn") == 2, F.col("ts"))).alias("next_order_ts"))

    def first_row(df: DataFrame, order_cols, name: str, count_name: str) -> DataFrame:
        # Per order: row count and first row, aggregated map-side before the shuffle
        # (a hot order is one row per task).  The left joins below keep first orders.
        return df.groupBy("order_id").agg(F.count("*").alias(count_name),
                                          F.min(F.struct(*order_cols)).alias(name))

    items = first_row(m.order_items, FIRST_ITEM_ORDER, "item", "n_items")
    revs = reviews_by_order(m).select("order_id", "n_reviews", "review")
    pays = first_row(m.order_payments, FIRST_PAYMENT_ORDER, "payment", "n_payments")
    products = m.products.select(F.col("product_id").alias("_pid"), "product_category_name")
    sellers = m.sellers.select(F.col("seller_id").alias("_sid"), "seller_state")

    star = (firsts.join(items, "order_id", "left").join(revs, "order_id", "left")
            .join(pays, "order_id", "left")
            .join(products, F.col("item.product_id") == F.col("_pid"), "left")
            .join(sellers, F.col("item.seller_id") == F.col("_sid"), "left"))

    def at_least_one(c: str) -> Column:
        return F.greatest(F.coalesce(F.col(c), F.lit(0)), F.lit(1))

    copies = at_least_one("n_items") * at_least_one("n_reviews") * at_least_one("n_payments")
    ts = F.col("ts")
    next_ts = F.when(copies >= 2, ts).otherwise(F.col("next_order_ts"))
    return (star.select(
                "customer_unique_id",
                "delay",
                F.col("review.review_score").alias("review_score"),
                "product_category_name",
                (F.col("item.freight_value") / F.nullif(F.col("item.price"), F.lit(0.0)))
                .alias("delivery_cost_percentage"),
                F.col("payment.payment_installments").alias("payment_installments"),
                F.when(F.col("customer_state") != F.col("seller_state"), 1)
                .otherwise(0).alias("interstate_shipping"),
                F.when(next_ts < ts + F.make_dt_interval(days=F.lit(window_days)), 1)
                .otherwise(0).alias("came_back_in_3_months"))
            .orderBy(F.asc_nulls_last("customer_unique_id")))
