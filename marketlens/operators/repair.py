"""Cleaning and missing-parent repair.

All operators are aggregations or joins: a key held by a third of all rows is
reduced map-side by partial aggregation before any shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GEO_COLUMNS = ("geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng",
               "geolocation_city", "geolocation_state")
CATEGORY_COLUMNS = ("product_category_name", "product_category_name_english")
UNKNOWN_CATEGORY = "Unknown"  # English name given to categories missing a translation


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str],
               payload: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the first in ``order_by`` order (ascending).

    Unlike ``dropDuplicates`` the surviving row is defined: the minimum of
    ``struct(order_by..., payload...)``.  ``min`` is partially aggregated before the
    shuffle, so a hot key costs one row per map task.
    """
    keys, order_by = list(keys), list(order_by)
    if payload is None:
        payload = [c for c in df.columns if c not in keys and c not in order_by]
    payload = list(payload)
    best = F.min(F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by)],
                          *[F.col(c) for c in payload]))
    return (df.groupBy(*keys).agg(best.alias("_first"))
            .select(*keys, *[F.col(f"_first.{c}").alias(c) for c in payload]))


def _pos_type(df: DataFrame, column: str):
    """Positions are numbers or, over several files, sortable strings."""
    return df.schema[column].dataType


def missing_parents(child: DataFrame, child_key: str, parent: DataFrame,
                    parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent (anti-join)."""
    return (child.filter(F.col(child_key).isNotNull())
            .join(parent.select(F.col(parent_key).alias("_pk")),
                  F.col(child_key) == F.col("_pk"), "left_anti"))


def _geo_additions(rows: DataFrame, zip_col: str, city_col: str, state_col: str,
                   pos_col: str, known: DataFrame) -> DataFrame:
    """Distinct (zip, city, state) of rows whose zip is missing from ``known``, each
    with the input position of its first occurrence, and coordinates 0.0.

    The rows (a whole customer table, say) are first reduced to distinct triples by
    a partial aggregation, so only a few rows per task are shuffled; the anti-join
    then runs on that small set."""
    triples = (rows.filter(F.col(zip_col).isNotNull())
               .groupBy(F.col(zip_col).alias("geolocation_zip_code_prefix"),
                        F.col(city_col).alias("geolocation_city"),
                        F.col(state_col).alias("geolocation_state"))
               .agg(F.min(pos_col).alias("input_pos")))
    first_pos = missing_parents(triples, "geolocation_zip_code_prefix", known,
                                "geolocation_zip_code_prefix")
    return first_pos.select(
        "geolocation_zip_code_prefix",
        F.lit(0.0).alias("geolocation_lat"), F.lit(0.0).alias("geolocation_lng"),
        "geolocation_city", "geolocation_state", "input_pos")


def geolocation_first(geo_raw: DataFrame) -> DataFrame:
    """C1 on geolocation: first row per zip prefix in input order."""
    return keep_first(geo_raw, ["geolocation_zip_code_prefix"], ["input_pos"],
                      list(GEO_COLUMNS[1:]))


def seller_zip_orphans(geo_raw: DataFrame, sellers: DataFrame,
                       seller_pos: str = "input_pos") -> DataFrame:
    """C2+C3: (zip, city, state) of sellers whose zip is not in the deduplicated
    geolocation."""
    first = geolocation_first(geo_raw)
    return _geo_additions(sellers, "seller_zip_code_prefix", "seller_city", "seller_state",
                          seller_pos, first).drop("geolocation_lat", "geolocation_lng")


def customer_zip_orphans(geo_raw: DataFrame, sellers: DataFrame, customers: DataFrame,
                         seller_pos: str = "input_pos",
                         customer_pos: str = "input_pos") -> DataFrame:
    """C2+C3: customer (zip, city, state) missing from geolocation *as already extended
    by the sellers' additions*."""
    first = geolocation_first(geo_raw)
    seller_add = _geo_additions(sellers, "seller_zip_code_prefix", "seller_city",
                                "seller_state", seller_pos, first)
    known = first.select("geolocation_zip_code_prefix").unionByName(
        seller_add.select("geolocation_zip_code_prefix"))
    return _geo_additions(customers, "customer_zip_code_prefix", "customer_city",
                          "customer_state", customer_pos, known).drop(
        "geolocation_lat", "geolocation_lng")


def repair_geolocation(geo_raw: DataFrame, sellers: DataFrame, customers: DataFrame,
                       seller_pos: str = "input_pos",
                       customer_pos: str = "input_pos") -> DataFrame:
    """Deduplicate geolocation, then add every seller zip and then every customer
    zip that is missing, with coordinates (0.0, 0.0); one row per zip.

    Priority when a zip appears more than once: the original file, then sellers,
    then customers; within each, the first occurrence in input order.  A zip present
    for both sellers and customers therefore takes the seller's city.
    NULL zips are never added (a NULL key cannot be a parent).
    """
    first = geolocation_first(geo_raw)
    seller_add = _geo_additions(sellers, "seller_zip_code_prefix", "seller_city",
                                "seller_state", seller_pos, first)
    known = first.select("geolocation_zip_code_prefix").unionByName(
        seller_add.select("geolocation_zip_code_prefix"))
    customer_add = _geo_additions(customers, "customer_zip_code_prefix", "customer_city",
                                  "customer_state", customer_pos, known)
    ranked = (first.withColumn("_prio", F.lit(0)).withColumn("input_pos", F.lit(None).cast(_pos_type(sellers, seller_pos)))
              .unionByName(seller_add.withColumn("_prio", F.lit(1)))
              .unionByName(customer_add.withColumn("_prio", F.lit(2))))
    return keep_first(ranked, ["geolocation_zip_code_prefix"], ["_prio", "input_pos"],
                      list(GEO_COLUMNS[1:]))


def category_orphans(cat_raw: DataFrame, products: DataFrame) -> DataFrame:
    """C2+C4: distinct non-null product categories that have no translation (the
    products are reduced to distinct categories before the anti-join)."""
    names = (products.filter(F.col("product_category_name").isNotNull())
             .select("product_category_name").distinct())
    return missing_parents(names, "product_category_name", cat_raw, "product_category_name")


def repair_categories(cat_raw: DataFrame, products: DataFrame) -> DataFrame:
    """C5 on categories: add untranslated categories as ``Unknown``, keep the first row
    per name, then drop rows with any NULL (in that order, as the reference does)."""
    added = category_orphans(cat_raw, products).select(
        "product_category_name", F.lit(UNKNOWN_CATEGORY).alias("product_category_name_english"),
        F.lit(1).alias("_prio"), F.lit(None).cast(_pos_type(cat_raw, "input_pos")).alias("input_pos"))
    ranked = (cat_raw.select(*CATEGORY_COLUMNS, F.lit(0).alias("_prio"),
                             "input_pos")
              .unionByName(added))
    deduped = keep_first(ranked.filter(F.col("product_category_name").isNotNull()),
                         ["product_category_name"], ["_prio", "input_pos"],
                         ["product_category_name_english"])
    return deduped.na.drop("any")
