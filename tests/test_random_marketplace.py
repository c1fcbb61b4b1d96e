"""Differential test on random, hostile marketplace data.

The stand-in tables are well behaved.  Here every table is random: NULL dates,
prices, scores, texts and zips; duplicate item rows; zero prices; a hot order; a
hot person and a hot seller; orders without items and reviews without scores; texts with accents
and tags.  The raw tables go through the Spark load (repair) and the plans, and
through the same oracle SQL in DuckDB, reading the raw tables as views in place of
the stand-in definitions.
"""

from __future__ import annotations

import datetime as dt
import os
import random
import tempfile

import duckdb
import pytest

from marketlens import plans, registry
from marketlens.operators import quality
from marketlens.operators.repair import repair_categories, repair_geolocation
from marketlens.oracle import rmf_sql, without_base_tables
from marketlens.plans import text_pipeline
from marketlens.sources.marketplace import Marketplace
from tools.oracle_check import digest

ORACLE = registry.oracle_sql()

DDL = {
    "geolocation_raw": "input_pos long, geolocation_zip_code_prefix string, geolocation_lat double, "
                       "geolocation_lng double, geolocation_city string, geolocation_state string",
    "customers": "customer_id long, customer_unique_id long, customer_zip_code_prefix string, "
                 "customer_city string, customer_state string",
    "orders": "order_id long, customer_id long, order_status string, order_purchase_timestamp timestamp_ntz, "
              "order_approved_at timestamp_ntz, order_delivered_carrier_date timestamp_ntz, "
              "order_delivered_customer_date timestamp_ntz, order_estimated_delivery_date timestamp_ntz",
    "sellers": "seller_id long, seller_zip_code_prefix string, seller_city string, seller_state string",
    "products": "product_id long, product_category_name string, product_photos_qty int, product_weight_g double",
    "prodcategory_raw": "product_category_name string, product_category_name_english string, input_pos long",
    "order_items": "order_id long, order_item_id int, product_id long, seller_id long, "
                   "shipping_limit_date timestamp_ntz, price double, freight_value double",
    "order_payments": "order_id long, payment_sequential int, payment_type string, "
                      "payment_installments int, payment_value double",
    "order_reviews": "review_id long, order_id long, review_score int, review_comment_message string, "
                     "review_creation_date timestamp_ntz",
}
WORDS = ["produto", "não", "chegou", "ótimo", "ruim", "<b>bom</b>", "entrega", "atrasou", "de", "a",
         "muito", "recomendo", "péssimo", "ok!", "10kg", "İstanbul", "caixas", "caixa", "línea\ncorta"]
STATES = ["SP", "RJ", "MG", "PR", None]


def _maybe(rng, value, p_null):
    return None if rng.random() < p_null else value


def _money(rng):
    return round(rng.uniform(0, 500), 2)


def make_raw(seed: int) -> dict[str, list[tuple]]:
    rng = random.Random(seed)
    t0 = dt.datetime(2017, 1, 1)
    zips = [str(z) for z in range(25)]
    geo = [(pos, rng.choice(zips[:18]), round(rng.uniform(-30, 0), 2), round(rng.uniform(-60, -30), 2),
            f"geo{rng.randint(0, 3)}", rng.choice(STATES[:4])) for pos in range(60)]
    n_orders, n_people = 300, 80
    customers = [(cid, 1 if rng.random() < 0.3 else rng.randint(2, n_people),
                  _maybe(rng, rng.choice(zips), 0.05), f"city{rng.randint(0, 5)}", rng.choice(STATES))
                 for cid in range(1, n_orders + 1)]
    orders = []
    for oid in range(1, n_orders + 1):
        purchase = _maybe(rng, t0 + dt.timedelta(seconds=rng.randint(0, 700 * 86400)), 0.03)
        base = purchase or t0
        approved = _maybe(rng, base + dt.timedelta(seconds=rng.randint(0, 3 * 86400)), 0.1)
        carrier = _maybe(rng, base + dt.timedelta(seconds=rng.randint(86400, 10 * 86400)), 0.1)
        delivered = _maybe(rng, base + dt.timedelta(seconds=rng.randint(2 * 86400, 60 * 86400)), 0.1)
        estimated = _maybe(rng, base + dt.timedelta(days=rng.randint(10, 40)), 0.05)
        orders.append((oid, oid, rng.choice(["delivered", "shipped"]), purchase, approved, carrier,
                       delivered, estimated))
    sellers = [(sid, _maybe(rng, rng.choice(zips), 0.05), f"scity{rng.randint(0, 4)}", rng.choice(STATES))
               for sid in range(1, 31)]
    cats = ["toys", "tools", "books", "garden", "music", "bed"]
    products = [(pid, _maybe(rng, rng.choice(cats), 0.1), rng.randint(1, 5), _money(rng))
                for pid in range(1, 61)]
    prodcat = [(c, c.upper(), 0) for c in cats[:4]]
    items = []
    for i in range(900):
        oid = 7 if rng.random() < 0.2 else rng.randint(1, n_orders - 20)   # a hot order; some orders have none
        seller = 1 if rng.random() < 0.3 else rng.randint(2, 30)             # a hot seller
        row = (oid, rng.randint(1, 4), rng.randint(1, 60), seller,
               t0 + dt.timedelta(days=rng.randint(0, 700)),
               _maybe(rng, rng.choice([0.0, _money(rng)]), 0.05), round(rng.uniform(0, 50), 2))
        items.append(row)
        if rng.random() < 0.05:
            items.append(row)  # exact duplicate row
    payments = [(rng.randint(1, n_orders), rng.randint(1, 3), rng.choice(["card", "boleto"]),
                 rng.randint(1, 10), _money(rng)) for _ in range(400)]
    reviews = []
    for rid in range(1, 351):
        text = " ".join(rng.choice(WORDS) for _ in range(rng.randint(0, 120)))
        reviews.append((rid, 7 if rng.random() < 0.1 else rng.randint(1, n_orders),
                        _maybe(rng, rng.randint(1, 5), 0.1), _maybe(rng, text, 0.15),
                        t0 + dt.timedelta(days=rng.randint(0, 700))))
    return {"geolocation_raw": geo, "customers": customers, "orders": orders, "sellers": sellers,
            "products": products, "prodcategory_raw": prodcat, "order_items": items,
            "order_payments": payments, "order_reviews": reviews}


def _queries():
    q = {name: getattr(plans, name) for name in (
        "best_sellers", "reviews", "customers_distribution", "delays_by_state",
        "sales_by_category_month", "delay_stats", "network_delay", "network_delay_pairs",
        "delay_review_correlation", "negative_reviews", "product_reviews", "cohort",
        "first_order_analysis", "stage_durations")}
    q["rmf_per_client"] = lambda m: plans.rmf_per_client(m, "2018-01-01", "2018-07-01")
    q["month_spine"] = plans.cohort_spine
    q["geolocation_repaired"] = lambda m: m.geolocation
    q["category_repaired"] = lambda m: m.prodcategory
    for rule in ("pk_violations", "fk_violations", "length_violations"):
        q[rule] = (lambda r: lambda m: getattr(quality, r)(m.tables()))(rule)
    q["load_report"] = lambda m: quality.table_report(m.tables())
    for name in ("review_clean_text", "lemma_substitution", "split_train_test", "vocabulary_top_n",
                 "tfidf_fit", "tfidf_transform", "class_weights", "encode_fixed_length",
                 "attention_mask", "shuffle_batches", "binary_metrics"):
        q[name] = getattr(text_pipeline, name)
    return q


@pytest.fixture(scope="module", params=[1, 2])
def random_world(request, spark):
    raw = make_raw(request.param)
    folder = tempfile.mkdtemp(prefix="ml-random-")
    con = duckdb.connect()
    frames = {}
    for name, rows in raw.items():
        df = spark.createDataFrame(rows, DDL[name])
        path = os.path.join(folder, name)
        df.write.parquet(path)
        frames[name] = spark.read.schema(DDL[name]).parquet(path)
        cols = "* EXCLUDE (input_pos)" if name == "prodcategory_raw" else "*"  # as the stand-in
        con.execute(f"CREATE VIEW st_{name} AS SELECT {cols} FROM read_parquet('{path}/*.parquet')")
    sellers = frames["sellers"].withColumn("input_pos", frames["sellers"]["seller_id"])
    customers = frames["customers"].withColumn("input_pos", frames["customers"]["customer_id"])
    market = Marketplace(
        geolocation=repair_geolocation(frames["geolocation_raw"], sellers, customers),
        customers=frames["customers"], orders=frames["orders"], sellers=frames["sellers"],
        prodcategory=repair_categories(frames["prodcategory_raw"], frames["products"]),
        products=frames["products"], order_items=frames["order_items"],
        order_payments=frames["order_payments"], order_reviews=frames["order_reviews"],
        geolocation_raw=frames["geolocation_raw"], prodcategory_raw=frames["prodcategory_raw"])
    return market, con


@pytest.mark.parametrize("name", sorted(_queries()))
def test_random_data_matches_sql(random_world, name):
    market, con = random_world
    df = _queries()[name](market)
    sql = rmf_sql("2018-01-01", "2018-07-01") if name == "rmf_per_client" else ORACLE[name]
    cur = con.execute(without_base_tables(sql))
    want_cols = [c[0] for c in cur.description]
    want = cur.fetchall()
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(want_cols)
    assert len(got) == len(want)
    assert digest(got, df.columns)[1] == digest(want, want_cols)[1]
