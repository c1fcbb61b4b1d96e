"""Every registered query equals its DuckDB oracle at sf0.001: row count, column
names and types, and the exact values (order-insensitive)."""

from __future__ import annotations

import datetime
import math

import pytest

import __spark_entry__ as entry
from marketlens import registry
from tests.conftest import SMOKE_DIR

ORACLE = registry.oracle_sql()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return repr(v)


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle_or_is_declared_iterative():
    rows_only = {"logreg_scores", "logreg_metrics"}
    assert set(registry.queries()) - set(ORACLE) == rows_only


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    df = registry.queries()[name](spark, SMOKE_DIR)
    rel = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {c: TYPES.get(t, t) for c, t in df.dtypes}
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert spark_types == duck_types
    srows = [tuple(r) for r in df.collect()]
    drows = rel.fetchall()
    assert len(srows) == len(drows)
    assert _canon(srows, df.columns) == _canon(drows, rel.columns)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["seller_state", "number_of_delays", "number_of_orders",
                          "percentage_of_delays"]
    assert df.count() >= 0
