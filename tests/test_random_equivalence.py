"""Randomised equivalence checks of column expressions against known results
(one Spark job per property, thousands of cases)."""

from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from marketlens.functions.exact import percent_rounded
from marketlens.functions.text import normalise_text, tokens
from tests.conftest import assembled_text

def test_cleaning_leaves_the_known_tokens(spark):
    rng = random.Random(7)
    cases = [assembled_text(rng) for _ in range(3000)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "id long, t string")
    got = {r["id"]: list(r["tk"]) for r in
           df.select("id", tokens(normalise_text(F.col("t"))).alias("tk")).collect()}
    bad = [(t, got[i], want) for i, (t, want) in enumerate(cases) if got[i] != want]
    assert not bad, bad[:3]


def test_percent_rounding_equals_decimal_half_up(spark):
    rng = random.Random(11)
    pairs = []
    for _ in range(5000):
        b = rng.randint(1, 10 ** rng.randint(1, 7))
        pairs.append((rng.randint(0, b), b))
    pairs += [(1, 8), (1, 16), (1, 32), (1, 200), (1, 400), (3, 8)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(percent_rounded(F.col("a"), F.col("b"))).collect()]
    want = [float((Decimal(a) * 100 / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP))
            for a, b in pairs]
    assert got == want
