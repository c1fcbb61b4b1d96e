"""The steps of the exact logistic regression on packed documents."""

from __future__ import annotations

import random

import pytest

from marketlens.operators import exact_logit


def test_logit_sums_are_exact_beyond_64_bits(spark):
    """Sums over rows of products near 10^17, more than 64 bits hold, against Python's integers."""
    rng = random.Random(5)
    rows = [(float(k % 2), 40.0 * rng.random(), sorted(rng.sample(range(6), 3)), [rng.randint(1, 10 ** 8) for _ in range(3)])
            for k in range(3000)]
    df = spark.createDataFrame(rows, "label double, balance double, at array<int>, x array<bigint>")
    packed = df.repartition(3).mapInArrow(exact_logit._packed, exact_logit.PACKED)
    expected = [0] * 6
    for _, balance, at, x in rows:
        share = int(balance * float(sum(x)) / 1e4 + 0.5)
        for i, v in zip(at, x):
            expected[i] += v * share
    assert exact_logit._by_feature(packed, None, 6) == expected
    with pytest.raises(Exception, match="beyond 64 bits"):
        exact_logit._by_feature(packed, [10 ** 12] * 6, 6)


def test_a_step_reads_packed_documents(spark):
    """One small shuffle a step: no row a document and feature leaves its task."""
    df = spark.createDataFrame([(1.0, 1.0, [0, 1], [3, 4]), (0.0, 1.0, [], []), (None, 0.0, [1], [5])],
                               "label double, balance double, at array<int>, x array<bigint>")
    packed = df.coalesce(1).mapInArrow(exact_logit._packed, exact_logit.PACKED)
    sums = list(packed.mapInArrow(exact_logit._gradient([0, 0], 2), "i int, high bigint, low bigint").collect())
    unit = exact_logit.UNIT
    assert {r["i"]: (r["high"] << exact_logit.LOW_BITS) + r["low"] for r in sums} == {0: -3 * unit // 2, 1: -4 * unit // 2}
