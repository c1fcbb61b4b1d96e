"""Row expansion for queries whose reference result repeats rows (K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows that one unit of work emits; also the longest array a generator builds.
EMIT = 65536
# A row of up to so many copies may be repeated where it lies.
IN_PLACE = 64


def _numbers(upto) -> object:
    """The array 0 .. upto - 1 (empty for 0)."""
    whole = F.sequence(F.lit(0).cast("long"), F.greatest(upto - 1, F.lit(0)).cast("long"))
    return F.when(upto > 0, whole).otherwise(F.array().cast("array<bigint>"))


def repeat_squared(df: DataFrame, n_col: str, spread_keys: list[str]) -> DataFrame:
    """Emit every row ``n * n`` times, where n = ``df[n_col]`` (rows with n < 1 emit
    nothing).

    A row is first cut into units that emit EMIT copies each (the last one fewer), units
    are dealt over the cluster by ``spread_keys`` and their number, and each then emits
    its copies.  So the copies of one very large group come from as many tasks as it
    has units, whatever n is, and no array is longer than EMIT.
    """
    n = F.greatest(F.col(n_col), F.lit(0)).cast("long")
    total = n * n
    units = F.ceil(total / F.lit(EMIT)).cast("long")
    blocks = df.withColumn("_block", F.explode(_numbers(F.ceil(units / F.lit(EMIT)).cast("long"))))
    in_block = F.least(units - F.col("_block") * EMIT, F.lit(EMIT).cast("long"))
    cut = (blocks.withColumn("_unit", F.explode(_numbers(in_block)))
           .withColumn("_unit", F.col("_block") * EMIT + F.col("_unit"))
           .repartition(*spread_keys, "_unit"))
    copies = F.least(total - F.col("_unit") * EMIT, F.lit(EMIT).cast("long"))
    return cut.withColumn("_copy", F.explode(_numbers(copies))).drop("_block", "_unit", "_copy")


def repeat_most_in_place(df: DataFrame, n_col: str, spread_keys: list[str]) -> DataFrame:
    """As ``repeat_squared``, but a row of few copies (``IN_PLACE``) is repeated where it lies,
    so the many rows of small groups are not shuffled again."""
    n = F.greatest(F.col(n_col), F.lit(0)).cast("long")
    few = df.filter((n * n).between(1, IN_PLACE)).withColumn("_copy", F.explode(_numbers(n * n))).drop("_copy")
    return few.unionByName(repeat_squared(df.filter(n * n > IN_PLACE), n_col, spread_keys))
