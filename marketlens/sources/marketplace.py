"""The container the business queries read from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

# The nine loaded tables, in the order they are listed, and the inputs of the repair.
TABLES = ("geolocation", "customers", "orders", "sellers", "prodcategory", "products", "order_items",
          "order_payments", "order_reviews")
RAW = ("geolocation_raw", "prodcategory_raw")
# What several results compute from a table, given where it was computed once for all of them.
DERIVED = ("item_counts", "reviews_by_order")


class Marketplace:
    """The nine marketplace tables as lazy DataFrames.

    ``geolocation`` and ``prodcategory`` are the repaired tables (deduplicated, missing
    parents filled in); the ``*_raw`` fields keep the inputs of that repair, with an
    ``input_pos`` column recording input order.

    A table is given as a DataFrame or as a function that makes one; functions are called
    when the table is first read, so a query plans only the tables it uses.
    """

    def __init__(self, **tables: DataFrame | Callable[[], DataFrame] | None):
        unknown = set(tables) - set(TABLES) - set(RAW) - set(DERIVED)
        missing = set(TABLES) - set(tables)
        if unknown or missing:
            raise TypeError(f"unknown tables {sorted(unknown)}, missing tables {sorted(missing)}")
        self._given = {**dict.fromkeys(RAW + DERIVED), **tables}

    def __getattr__(self, name: str) -> DataFrame | None:
        given = self.__dict__.get("_given", {})
        if name not in given:
            raise AttributeError(name)
        table = given[name]
        if callable(table) and not isinstance(table, DataFrame):
            table = given[name] = table()
        return table

    def tables(self) -> dict[str, DataFrame]:
        """The nine loaded tables by name (raw inputs excluded)."""
        return {name: getattr(self, name) for name in TABLES}


def register_views(m: Marketplace, prefix: str = "") -> list[str]:
    """Register the nine tables as temporary views under their usual names
    (``orders``, ``order_items``, ...), so existing SQL can run through
    ``spark.sql``.  Returns the view names."""
    names = []
    for name, df in m.tables().items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
