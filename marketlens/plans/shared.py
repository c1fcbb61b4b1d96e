"""What the results of one batch share, made once for all of them.

Six results count items by order, four read reviews by order, nine the orders and five the
customers; each alone would shuffle them anew.  Here they are tables in the shared
checkpoint folder, bucketed by the key that the results join and group by, so those reads
need no exchange.  A table is made when a result first asks for it; the others wait, and
try it themselves should that one fail or be cancelled.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.plans.marts import reviews_by_order
from marketlens.session import bucketed_copy, cut_lineage
from marketlens.sources.marketplace import TABLES, Marketplace
from marketlens.sources.standins import load_standins

HOT_SHARE = 0.01  # of all items: larger orders are counted before they are dealt out
ITEM = ("order_id", "seller_id", "product_id")


class _Once:
    """Calls ``make`` once, whatever thread asks first; a call that fails is not kept."""

    def __init__(self, make: Callable[[], DataFrame]):
        self._make, self._made, self._lock = make, None, threading.Lock()

    def __call__(self) -> DataFrame:
        with self._lock:
            if self._made is None:
                self._made = self._make()
            return self._made


def item_counts(items: DataFrame) -> DataFrame:
    """Rows (order, seller, product, k) whose k add up to the items of each; items of no
    order are left out, as no result joins them.  Only the items of very large orders are
    counted before they are dealt out by order, the others are too few to."""
    rows = items.filter(F.col("order_id").isNotNull()).select(*ITEM)
    often = rows.stat.freqItems(["order_id"], HOT_SHARE).first()[0]  # holds all such orders, at most 100
    one = F.lit(1).cast("long").alias("k")
    if not often:
        return rows.select(*ITEM, one)
    hot = F.col("order_id").isin(list(often))
    return rows.filter(~hot).select(*ITEM, one).unionByName(
        rows.filter(hot).groupBy(*ITEM).agg(F.count("*").alias("k")))


def shared_tables(m: Marketplace) -> dict[str, Callable[[], DataFrame]]:
    return {
        "orders": _Once(lambda: bucketed_copy(m.orders, "order_id")),
        "geolocation": _Once(lambda: cut_lineage(m.geolocation)),
        "item_counts": _Once(lambda: bucketed_copy(item_counts(m.order_items), "order_id")),
        "reviews_by_order": _Once(lambda: bucketed_copy(reviews_by_order(m), "order_id", dealt=True)),
    }


def shared_standins(spark: SparkSession, sf_dir: str) -> Marketplace:
    """The stand-in tables for several results of one run."""
    customers = _Once(lambda: bucketed_copy(load_standins(spark, sf_dir).customers, "customer_id"))
    m = load_standins(spark, sf_dir, customers)
    return Marketplace(**{name: (lambda name=name: getattr(m, name)) for name in TABLES}
                       | {"customers": customers} | shared_tables(m))
