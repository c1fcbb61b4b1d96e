"""Calendar spines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def month_spine(df: DataFrame, month_col: str, out_col: str = "calendar_month") -> DataFrame:
    """Every first-of-month DATE from min(month_col) to max(month_col), gap-free.

    The bounds are one global aggregate (partial per task, one row merged); the spine
    has one row per calendar month, so it is small whatever the data size.
    """
    bounds = df.agg(F.min(month_col).alias("_lo"), F.max(month_col).alias("_hi"))
    return bounds.select(
        F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias(out_col))
