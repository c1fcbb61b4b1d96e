"""Class-balanced logistic regression whose result doesn't depend on the order of sums.

The objective is that of ``operators.model``: the weighted mean of the losses plus a ridge
of ``1 / (C * sum of weights)`` on the coefficients, intercept free.  It is minimised by a
fixed number of accelerated gradient steps, scaled for each coefficient by a bound of its
curvature.  Everything that is summed over rows is an integer:

- feature values, coefficients and residuals are fixed-point numbers of eight places;
- a document's logit is an integer inner product, computed where the document lies;
- the gradient is a sum of integer products by feature, combined in each task first.

So 1 or 1 000 partitions, lost executors and repeated tasks give the same model to the
last digit, and the same chain can be written in SQL.  Documents are packed once, their
features as bytes of whole numbers; a step is one job that reads them batch by batch in
Arrow, with one small shuffle (a row a feature and task); the driver holds the model, which
the vocabulary's size bounds, and sees one number a feature and step.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.session import cut_lineage

UNIT = 10 ** 8        # fixed-point places of features, coefficients and residuals
CURVE_UNIT = 10 ** 4  # of the rows' share in the curvature bounds
STEPS = 40
LOW_BITS = 26         # products are summed as a high and a low part, each exact
SUM_ROWS = 1 << 16    # documents whose parts are summed as doubles: 2^16 * 2^37 is exact


def fixed(value: Column, unit: int = UNIT) -> Column:
    """Half-up to an integer number of ``1 / unit``."""
    return F.floor(value * F.lit(float(unit)) + F.lit(0.5)).cast("long")


def _held(value: float, unit: int = UNIT) -> int:
    return math.floor(value * float(unit) + 0.5)


def momenta(steps: int) -> list[float]:
    """How far each step goes on in the direction of the last one."""
    out, t = [], 1.0
    for _ in range(steps):
        after = (1.0 + math.sqrt(1.0 + 4.0 * t * t)) / 2.0
        out.append((t - 1.0) / after)
        t = after
    return out


@dataclass(frozen=True)
class LinearModel:
    """Terms with their coefficients, and an intercept, as fixed-point integers."""

    terms: list[str]
    coefficients: list[int]
    intercept: int
    steps: int

    def table(self, spark, digits: int = 8) -> DataFrame:
        """(term, coefficient), the intercept under the empty term; rounded half-up on the
        integers."""
        part = UNIT // 10 ** digits
        rows = [(t, (c + part // 2) // part / 10 ** digits)
                for t, c in zip([*self.terms, ""], [*self.coefficients, self.intercept], strict=True)]
        return spark.createDataFrame(rows, "term string, coefficient double")


def feature_rows(docs: DataFrame, weights: DataFrame, id_col: str) -> DataFrame:
    """``docs`` with its documents' features as two arrays, ``at`` (term index, ascending)
    and ``x`` (fixed-point weight); documents without known terms have empty ones."""
    per_doc = (weights.select(id_col, "term_index", fixed(F.col("weight")).alias("x"))
               .groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("term_index", "x"))).alias("_f")))
    empty = F.array().cast("array<struct<term_index:int,x:bigint>>")
    return (docs.join(per_doc, id_col, "left").withColumn("_f", F.coalesce("_f", empty))
            .withColumns({"at": F.col("_f.term_index"), "x": F.col("_f.x")}).drop("_f"))


def _constant(values: list[int]) -> Column:
    """An array of whole numbers as one literal of the plan."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _with_intercept(rows: DataFrame, n_terms: int) -> DataFrame:
    """The intercept as one more feature, of value one."""
    return rows.withColumns({"at": F.concat("at", F.array(F.lit(n_terms))),
                             "x": F.concat("x", F.array(F.lit(UNIT).cast("long")))})


def _logit(model: list[int]) -> Column:
    """The logit of a row with its intercept: an exact integer sum, divided once.  The
    model is a literal array, no number in it becomes code: steps share what is compiled."""
    coefficient = _constant(model)
    products = F.zip_with("at", "x", lambda i, x: F.element_at(coefficient, i + 1) * x)
    z = F.aggregate(products, F.lit(0).cast("long"), lambda total, p: total + p)
    return z.cast("double") / F.lit(float(UNIT)) / F.lit(float(UNIT))


PACKED = "label double, balance double, at binary, x binary"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, balance, at, x) with the two arrays as bytes of 32-bit and 64-bit integers."""
    for batch in batches:
        arrays = []
        for column, kind in (("at", np.int32), ("x", np.int64)):
            lists = batch.column(column)
            start, end = lists.offsets[0].as_py(), lists.offsets[-1].as_py()
            values = lists.values.slice(start, end - start).to_numpy(zero_copy_only=False).astype(kind)
            offsets = (lists.offsets.to_numpy().astype(np.int64) - start) * values.itemsize
            arrays.append(pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(batch), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).cast(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("balance"), *arrays],
                                         ["label", "balance", "at", "x"])


def _numbers(binary: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows of a packed column, and where each row's begin and end."""
    offsets = np.frombuffer(binary.buffers()[1], np.int32)[binary.offset:binary.offset + len(binary) + 1].astype(np.int64)
    data = binary.buffers()[2]
    flat = (np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)).view(kind)
    return flat, (offsets - offsets[0]) // np.dtype(kind).itemsize


def _inner(at: np.ndarray, x: np.ndarray, ends: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Each row's inner product with the model, an exact integer; an error if one is too long for 64 bits."""
    coefficients = model[at]
    top = int(np.abs(coefficients).max(initial=0)) * int(np.abs(x).max(initial=0)) * int(np.diff(ends).max(initial=0))
    total = np.zeros(len(x) + 1, np.int64)  # running sums wrap around, their differences are right all the same
    np.cumsum(coefficients * x, out=total[1:])
    if top >= 1 << 63:
        size = np.zeros(len(x) + 1)
        np.cumsum(np.abs(coefficients.astype(float) * x), out=size[1:])
        if np.diff(size[ends]).max(initial=0.0) >= 9e18:
            raise OverflowError("a logit of a document is beyond 64 bits")
    return total[ends[1:]] - total[ends[:-1]]


def _gradient(model: list[int] | None, n: int):
    """Sums over rows of a share of the row times each of its features, by feature and batch:
    (i, high, low) with the total ``high * 2^LOW_BITS + low``.  The share is the residual
    of ``model``; without one, the row's part in the curvature bounds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coefficients = None if model is None else np.array(model, np.int64)
        high, low = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for whole in batches:
            for first in range(0, len(whole), SUM_ROWS):
                batch = whole.slice(first, SUM_ROWS)
                at, ends = _numbers(batch.column("at"), np.int32)
                x, _ = _numbers(batch.column("x"), np.int64)
                balance = batch.column("balance").to_numpy(zero_copy_only=False)
                if coefficients is None:
                    size = _inner(np.zeros(len(x), np.int32), x, ends, np.ones(1, np.int64))
                    share = np.floor(balance * size.astype(float) / float(UNIT // CURVE_UNIT) + 0.5)
                else:
                    z = _inner(at, x, ends, coefficients).astype(float) / float(UNIT) / float(UNIT)
                    label = batch.column("label").to_numpy(zero_copy_only=False)
                    with np.errstate(over="ignore"):
                        share = np.floor(balance * (1.0 / (1.0 + np.exp(-z)) - label) * float(UNIT) + 0.5)
                share = np.nan_to_num(share).astype(np.int64)  # a row without a label has no part
                products = x * np.repeat(share, np.diff(ends))
                high += np.bincount(at, (products >> LOW_BITS).astype(float), n).astype(np.int64)
                low += np.bincount(at, (products & ((1 << LOW_BITS) - 1)).astype(float), n).astype(np.int64)
        some = np.flatnonzero((high != 0) | (low != 0))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(high[some]), pa.array(low[some])],
                                         ["i", "high", "low"])
    return run


def _by_feature(packed: DataFrame, model: list[int] | None, n: int) -> list[int]:
    """``_gradient`` summed over all rows; exact, as the driver's integers."""
    sums = (packed.mapInArrow(_gradient(model, n), "i int, high bigint, low bigint").groupBy("i")
            .agg(F.sum("high").alias("high"), F.sum("low").alias("low")))
    found = {r["i"]: (r["high"] << LOW_BITS) + r["low"] for r in sums.collect()}  # a row a feature
    return [found.get(i, 0) for i in range(n)]


def fit(rows: DataFrame, terms: list[str], label_col: str, C: float = 1.0, steps: int = STEPS) -> LinearModel:
    """The model after ``steps`` steps, from ``feature_rows`` with 0/1 labels."""
    counts = {r[0]: r[1] for r in rows.groupBy(label_col).count().collect()}  # a row a class
    n, n_terms = sum(counts.values()), len(terms)
    if not n:
        return LinearModel(terms, [0] * n_terms, 0, steps)
    balance = F.lit(0.0)
    for label, n_label in counts.items():
        balance = F.when(F.col(label_col) == label, F.lit(n / (len(counts) * n_label))).otherwise(balance)
    ridge = 1.0 / (C * n)
    packed = cut_lineage(_with_intercept(rows, n_terms)
                         .select(F.col(label_col).cast("double").alias("label"), balance.alias("balance"), "at", "x")
                         .mapInArrow(_packed, PACKED))

    curve = _by_feature(packed, None, n_terms + 1)
    scale = [0.25 * (float(c) / float(UNIT) / float(CURVE_UNIT) / float(n)) + (ridge if place < n_terms else 0.0)
             for place, c in enumerate(curve)]
    now = [0] * (n_terms + 1)
    ahead = list(now)  # where the gradient is taken: beyond ``now`` in the last direction
    for momentum in momenta(steps):
        after = []
        for place, total in enumerate(_by_feature(packed, ahead, n_terms + 1)):
            at = ahead[place] / float(UNIT)
            down = float(total) / float(UNIT) / float(UNIT) / float(n) + (ridge * at if place < n_terms else 0.0)
            after.append(_held(at - down / scale[place]) if scale[place] > 0.0 else ahead[place])
        ahead = [a + _held(momentum * ((a - b) / float(UNIT))) for a, b in zip(after, now, strict=True)]
        now = after
    return LinearModel(terms, now[:-1], now[-1], steps)


def scores(rows: DataFrame, model: LinearModel, id_col: str, digits: int = 6) -> DataFrame:
    """Every row's logit, probability and prediction."""
    z = F.round(_logit([*model.coefficients, model.intercept]), digits)
    return (_with_intercept(rows, len(model.terms)).withColumn("logit", z)
            .withColumn("probability_positive", F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("logit"))), digits))
            .withColumn("predicted", (F.col("logit") > 0).cast("int")).drop("at", "x"))
