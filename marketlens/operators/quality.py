"""Key, length and value rules as data-quality reports over DataFrames.

A database enforces these on INSERT; here each rule is a distributed aggregate that
reports violations, and ``runner.load_tables`` loads a table only when its report is
clean.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.exact import MONEY_TYPE
from marketlens.sources.schemas import FOREIGN_KEYS, MAX_LENGTHS, MONEY_COLUMNS, PRIMARY_KEYS


_EMPTY = {
    "pk": "table_name string, n_duplicate_keys bigint, n_duplicate_rows bigint, n_null_key_rows bigint",
    "fk": "child_table string, child_column string, parent_table string, n_orphan_rows bigint, "
          "n_orphan_keys bigint",
    "len": "table_name string, column_name string, max_length int, n_violations bigint, longest int",
    "value": "table_name string, n_violations bigint",
}


def _union(frames: Sequence[DataFrame], tables: Mapping[str, DataFrame], kind: str) -> DataFrame:
    """Union of per-table reports; an empty report when no rule applies."""
    if frames:
        return reduce(DataFrame.unionByName, frames)
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame([], _EMPTY[kind])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values held by more than one row, with their row count."""
    return (df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
            .groupBy(*keys).agg(F.count("*").alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def pk_violations(tables: Mapping[str, DataFrame],
                  keys: Mapping[str, Sequence[str]] = PRIMARY_KEYS) -> DataFrame:
    """Per table, duplicated keys, rows sharing them, and rows with a NULL key part."""
    reports = []
    for name, df in tables.items():
        if name not in keys:
            continue
        key = list(keys[name])
        any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
        per_key = df.groupBy(*key).agg(F.count("*").alias("n")).select("n", any_null.alias("null_key"))
        dup = (F.col("n") > 1) & ~F.col("null_key")
        reports.append(per_key.agg(
            F.count_if(dup).alias("n_duplicate_keys"),
            F.coalesce(F.sum(F.when(dup, F.col("n"))), F.lit(0)).cast("long").alias("n_duplicate_rows"),
            F.coalesce(F.sum(F.when(F.col("null_key"), F.col("n"))), F.lit(0)).cast("long")
            .alias("n_null_key_rows"))
            .select(F.lit(name).alias("table_name"), "*"))
    return _union(reports, tables, "pk")


def fk_violations(tables: Mapping[str, DataFrame],
                  fks: Sequence[tuple[str, str, str, str]] = FOREIGN_KEYS) -> DataFrame:
    """Per reference, non-NULL child keys without a parent (rows and distinct keys)."""
    reports = []
    for child, col, parent, pcol in fks:
        if child not in tables or parent not in tables:
            continue
        parents = tables[parent].select(F.col(pcol).alias("_pk"))
        # Child rows are counted per key first (partial aggregation), so the anti-join
        # sees one row per key, not every child row.
        per_key = (tables[child].select(F.col(col).alias("_ck")).filter(F.col("_ck").isNotNull())
                   .groupBy("_ck").agg(F.count("*").alias("n"))
                   .join(parents, F.col("_ck") == F.col("_pk"), "left_anti"))
        reports.append(per_key.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_orphan_rows"),
            F.count("*").alias("n_orphan_keys"))
            .select(F.lit(child).alias("child_table"), F.lit(col).alias("child_column"),
                    F.lit(parent).alias("parent_table"), "*"))
    return _union(reports, tables, "fk")


def length_violations(tables: Mapping[str, DataFrame],
                      limits: Mapping[str, Mapping[str, int]] = MAX_LENGTHS) -> DataFrame:
    """Per text column with a VARCHAR(n) limit, values longer than n characters.
    Columns that are not strings in the given table are skipped.  One pass a table."""
    reports = []
    for name, df in tables.items():
        types = dict(df.dtypes)
        checks = [(c, n) for c, n in limits.get(name, {}).items() if types.get(c) == "string"]
        if not checks:
            continue
        rows = F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.lit(n).alias("max_length"),
            F.count_if(F.char_length(c) > n).alias("n_violations"),
            F.max(F.char_length(c)).alias("longest")) for c, n in checks])
        reports.append(df.agg(rows.alias("rows")).select(F.explode("rows").alias("r"))
                       .select(F.lit(name).alias("table_name"), "r.*"))
    return _union(reports, tables, "len")


def value_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Amounts that are no finite decimal of 26 digits before the point, so that money
    sums would have to skip them: (table_name, n_violations)."""
    reports = []
    for name, df in tables.items():
        amounts = [c for c, t in df.dtypes if t in ("double", "float") and c in MONEY_COLUMNS]
        if amounts:
            bad = reduce(lambda a, b: a | b, [F.col(c).isNotNull() & F.col(c).try_cast(MONEY_TYPE).isNull()
                                              for c in amounts])
            reports.append(df.agg(F.count_if(bad).alias("n_violations"))
                           .select(F.lit(name).alias("table_name"), "n_violations"))
    return _union(reports, tables, "value")


def own_violations(name: str, df: DataFrame) -> int:
    """Violations of the key, length and value rules of one table, in one pass over it."""
    key, types = list(PRIMARY_KEYS[name]), dict(df.dtypes)
    broken = [F.char_length(c) > n for c, n in MAX_LENGTHS.get(name, {}).items() if types.get(c) == "string"]
    amounts = [F.col(c).isNotNull() & F.col(c).try_cast(MONEY_TYPE).isNull()
               for c, t in df.dtypes if t in ("double", "float") and c in MONEY_COLUMNS]
    if amounts:  # a row counts once, see ``value_violations``
        broken.append(reduce(lambda a, b: a | b, amounts))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    rules = [F.count_if(b).alias(f"_rule{i}") for i, b in enumerate(broken)]
    n = F.col("_n")
    total = [F.coalesce(F.sum(F.when((n > 1) | any_null, n)), F.lit(0))]
    total += [F.coalesce(F.sum(f"_rule{i}"), F.lit(0)) for i in range(len(broken))]
    return int(df.groupBy(*key).agg(F.count("*").alias("_n"), *rules)
               .agg(reduce(lambda a, b: a + b, total)).first()[0])


def table_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table with a primary key: violations of the three rules (0 = loadable)."""
    def long(df: DataFrame, table: str, rule: str, n) -> DataFrame:
        return df.select(F.col(table).alias("table_name"), F.lit(rule).alias("rule"), n.cast("long").alias("n"))

    every = (long(pk_violations(tables), "table_name", "pk", F.col("n_duplicate_rows") + F.col("n_null_key_rows"))
             .unionByName(long(fk_violations(tables), "child_table", "fk", F.col("n_orphan_rows")))
             .unionByName(long(length_violations(tables), "table_name", "len", F.col("n_violations"))))
    report = every.groupBy("table_name").agg(*[
        F.coalesce(F.sum(F.when(F.col("rule") == r, F.col("n"))), F.lit(0).cast("long")).alias(r)
        for r in ("pk", "fk", "len")], F.max((F.col("rule") == "pk")).alias("keyed"))
    return report.filter("keyed").select(
        "table_name", "pk", "fk", "len", ((F.col("pk") + F.col("fk") + F.col("len")) == 0).alias("loadable"))


def load_violations(name: str, df: DataFrame, parents: Mapping[str, DataFrame | None],
                    target: DataFrame | None, buckets: int | None = None) -> int:
    """C8-C11 for one table against what it is loaded into: rows with repeated or NULL
    keys, rows whose key the target already holds, rows without a parent among
    ``parents`` (None: there is none), texts that are too long, amounts that don't fit.

    ``buckets``: targets and parents are bucketed by their keys into so many.  The new rows
    are then dealt out the same way, so only they move."""
    key = list(PRIMARY_KEYS[name])
    n = own_violations(name, df)

    def beside_target(rows: DataFrame, *columns: str) -> DataFrame:
        return rows.repartition(buckets, *columns) if buckets else rows
    if target is not None:
        here = beside_target(df.select(*[F.col(k).alias(f"_{k}") for k in key]), *[f"_{k}" for k in key])
        there = target.select(*key)
        same = reduce(lambda a, b: a & b, [F.col(f"_{k}") == F.col(k) for k in key])
        n += here.join(there, same, "left_semi").count()
    for child, column, parent, parent_key in FOREIGN_KEYS:
        if child == name and parent in parents:
            rows = df.select(F.col(column).alias("_ck")).filter("_ck IS NOT NULL")
            known = parents[parent]
            if known is not None:
                known = known.select(F.col(parent_key).alias("_pk"))
                # one row a key, counted in the tasks first, before it is dealt out
                rows = (beside_target(rows.groupBy("_ck").agg(F.count("*").alias("_n")), "_ck")
                        .join(known, F.col("_ck") == F.col("_pk"), "left_anti"))
                n += int(rows.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0])
            else:
                n += rows.count()
    return n
