"""The nine marketplace tables derived from the driver's TPC-H-like parquet tables.

The driver data has no delivery milestones, reviews or payments; these are derived
by integer arithmetic on keys (definitions in FIXTURES.md section 4).  Every column
is a plain projection, so Catalyst prunes each scan to the columns a query uses.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.functions.timecols import add_days, add_hours
from marketlens.operators.repair import repair_categories, repair_geolocation
from marketlens.sources.marketplace import Marketplace

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


# Schemas of the driver tables this module reads (fixed values).  Declaring them
# keeps Spark from launching a footer-reading job for every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation -> (city, state) names: nation and region are fixed 25- and 5-row
    dimensions, so broadcasting them is size-safe."""
    nation = driver_table(spark, sf_dir, "nation")
    region = driver_table(spark, sf_dir, "region")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", "n_name", "r_name"))


def st_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders")
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    undelivered = (k % 25) == 4
    return o.select(
        k.alias("order_id"),
        k.alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        d.alias("order_purchase_timestamp"),
        F.when((k % 40) != 3, add_hours(d, k % 72)).alias("order_approved_at"),
        F.when(~undelivered, add_hours(d, 72 + (k * 7) % 240)).alias("order_delivered_carrier_date"),
        F.when(~undelivered, add_hours(d, 312 + (k * 13) % 480)).alias("order_delivered_customer_date"),
        add_days(d, 20 + k % 9).alias("order_estimated_delivery_date"),
    )


def st_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = driver_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = driver_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    place = _place(spark, sf_dir)
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(F.broadcast(place), F.col("c_nationkey") == place.n_nationkey)
            .select(F.col("o_orderkey").alias("customer_id"),
                    F.col("o_custkey").alias("customer_unique_id"),
                    # some customers live in a zip that no other table knows
                    F.concat(F.col("c_nationkey").cast("string"),
                             F.when(F.col("o_custkey") % 50 == 7, "F").otherwise(""))
                    .alias("customer_zip_code_prefix"),
                    F.col("n_name").alias("customer_city"),
                    F.col("r_name").alias("customer_state")))


def st_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = driver_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    place = _place(spark, sf_dir)
    return (s.join(F.broadcast(place), s.s_nationkey == place.n_nationkey)
            .select(F.col("s_suppkey").alias("seller_id"),
                    F.col("s_nationkey").cast("string").alias("seller_zip_code_prefix"),
                    F.col("n_name").alias("seller_city"),
                    F.col("r_name").alias("seller_state")))


def st_geolocation_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = driver_table(spark, sf_dir, "customer")
    key, nat = F.col("c_custkey"), F.col("c_nationkey")
    return (c.filter((nat % 5) != 0)
            .select(key.alias("input_pos"),
                    nat.cast("string").alias("geolocation_zip_code_prefix"),
                    (key % 180 - 90).cast("double").alias("geolocation_lat"),
                    (key % 360 - 180).cast("double").alias("geolocation_lng"),
                    F.concat(F.lit("CITY_"), nat.cast("string")).alias("geolocation_city"),
                    F.col("c_mktsegment").alias("geolocation_state")))


def st_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = driver_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.when(F.col("l_quantity") == 1, F.lit(0.0))
         .otherwise(F.col("l_extendedprice")).alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )


def st_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_brand") != "Brand#7", F.col("p_type")).alias("product_category_name"),
        F.col("p_size").alias("product_photos_qty"),
        F.col("p_retailprice").alias("product_weight_g"),
    )


def st_prodcategory_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = driver_table(spark, sf_dir, "part")
    return (p.filter(F.col("p_type") != "PROMO")
            .select(F.col("p_type").alias("product_category_name"),
                    F.lower("p_type").alias("product_category_name_english"))
            .distinct()
            .withColumn("input_pos", F.lit(0).cast("long")))


def st_order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = driver_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        F.floor(eid / 2).cast("long").alias("order_id"),
        (eid % 2 + 1).cast("int").alias("payment_sequential"),
        F.col("event_type").alias("payment_type"),
        (eid % 10 + 1).cast("int").alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


def st_order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = driver_table(spark, sf_dir, "events").select("event_id", "ts")
    d = driver_table(spark, sf_dir, "documents").select("doc_id", "text")
    eid = F.col("event_id")
    return (e.join(d, eid == d.doc_id, "left")
            .select(eid.alias("review_id"),
                    F.when(eid % 20 == 0, eid + 1).otherwise(eid).alias("order_id"),
                    F.when(eid % 50 != 7, ((eid * 7) % 5 + 1).cast("int")).alias("review_score"),
                    F.col("text").alias("review_comment_message"),
                    F.col("ts").alias("review_creation_date")))


def load_standins(spark: SparkSession, sf_dir: str,
                  customers: Callable[[], DataFrame] | None = None) -> Marketplace:
    """All nine tables, geolocation and categories repaired as on load.  Nothing runs and
    nothing is remembered here: each table is made when a query first reads it.
    ``customers`` gives a copy of that table to use, here and in the repair."""
    def made(table, position: str | None = None):
        df = customers() if table is st_customers and customers else table(spark, sf_dir)
        return df.withColumn("input_pos", F.col(position)) if position else df

    return Marketplace(
        geolocation=lambda: repair_geolocation(made(st_geolocation_raw), made(st_sellers, "seller_id"),
                                               made(st_customers, "customer_id")),
        customers=lambda: made(st_customers),
        orders=lambda: made(st_orders),
        sellers=lambda: made(st_sellers),
        prodcategory=lambda: repair_categories(made(st_prodcategory_raw), made(st_products)),
        products=lambda: made(st_products),
        order_items=lambda: made(st_order_items),
        order_payments=lambda: made(st_order_payments),
        order_reviews=lambda: made(st_order_reviews),
        geolocation_raw=lambda: made(st_geolocation_raw),
        prodcategory_raw=lambda: made(st_prodcategory_raw),
    )
