from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from marketlens.llm.hard_negatives import hard_negatives, open_bands, pack, unpack

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, pair string, e string, vec int, score int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "p", "e", 2, 3) for r in rows], SCHEMA)


def brute(rows, positives=5, negatives=5):
    use = []
    for i, v, y in rows:
        if y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        y = (y + 1) % 10 if i is not None and i % 7 == 0 else y
        row = (i, y, tuple(v))
        if row not in use:
            use.append(row)
    low = -math.inf
    ints = {r: [math.floor(256 * x) for x in r[2]] for r in use}
    out = []
    for i in sorted({r[0] for r in use if r[0] is not None and r[0] % 100 == 0}):
        anchor = min((r for r in use if r[0] == i), key=lambda r: r[1:])
        others = [(-sum(a * b for a, b in zip(ints[anchor], ints[r])), low if r[0] is None else r[0], r)
                  for r in use if r[0] != i and len(r[2]) == len(anchor[2])]
        others.sort(key=lambda t: t[:2])
        for top, _, p in [t for t in others if t[2][1] == anchor[1]][:positives]:
            band = [t for t in others if t[2][1] != anchor[1] and -80 * top <= -100 * t[0] <= -100 * top][:negatives]
            out.extend((i, p[0], k + 1, t[2][0], -top, -t[0]) for k, t in enumerate(band))
    return sorted(out, key=repr)


def mined(spark, rows, **options):
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    df = hard_negatives(table(spark, rows), lambda v: v % 100 == 0, label=moved, **options)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sample(n, dim, seed, values=None):
    rng = random.Random(seed)
    x = values or [k / 64 for k in range(-64, 65)]
    return [(i, [rng.choice(x) for _ in range(dim)], rng.randrange(4)) for i in range(n)]


def test_equals_brute_force(spark):
    rows = sample(420, 6, 1)
    assert mined(spark, rows) == brute(rows)


def test_ties_blocks_and_chunks(spark):
    rows = sample(520, 2, 2, values=[-0.5, 0.25, 0.5])  # few scores: ties everywhere
    want = brute(rows)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows, block_rows=40, chunk_rows=2) == want


def test_one_label_holds_most_rows(spark):
    rows = [(i, v, 3 if i % 3 else y) for i, v, y in sample(300, 5, 3)]
    assert mined(spark, rows, block_rows=64) == brute(rows)


def test_odd_rows(spark):
    rows = sample(230, 3, 4)
    rows += [(None, [1.0, 1.0, 1.0], 1), (None, [1.0, 1.0, 1.0], 1), (None, [0.5, 0.5, 0.5], 2),
             (500, None, 1), (501, [1.0, 1.0, 1.0], None), (600, [], 1), (603, [], 1), (604, [], 2),
             (605, [float("nan"), 1.0, 1.0], 1), (606, [None, 1.0, 1.0], 1), (607, [float("inf"), 1.0, 1.0], 1),
             (700, [0.0, 0.0, 0.0], 1), (800, [1.0, 2.0], 1), (801, [1.0, 2.0], 1), (802, [1.0, 2.0], 3)]
    rows += rows[100:110] + [(200, [0.25, 0.5, 0.75], 0)]  # repeats, and one id with other values
    assert mined(spark, rows) == brute(rows)


def test_huge_components_are_exact(spark):
    rows = [(i, [float(x) * 2.0 ** 21 for x in v], y) for i, v, y in sample(120, 2, 5)]
    assert mined(spark, rows) == brute(rows)
    beyond = [(i, [3e38, 1.0], i % 2) for i in range(3)]
    assert mined(spark, beyond)  # held at the end of the range


def test_few_and_no_rows(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    rows = [(100, [1.0], 1), (101, [1.0], 1), (102, [0.9], 2)]
    assert mined(spark, rows) == brute(rows) == [(100, 101, 1, 102, 65536, 58880)]


def test_packed_pairs_sort_by_anchor_descending_score_and_id():
    rng = random.Random(6)
    pairs = [(rng.randint(-3, 3), rng.choice([-2 ** 63 + 1, -5, 0, 5, 2 ** 63 - 1]), rng.randint(0, 1),
              rng.choice([-2 ** 63, -1, 0, 7])) for _ in range(200)]
    keys = sorted(pack(*p) for p in pairs)
    assert [unpack(k) for k in keys] == sorted(pairs, key=lambda p: (p[0], -p[1], p[2], p[3]))


def test_the_iterator_holds_only_open_bands():
    def endless():
        yield pack(1, 100, 0, 5)
        for i in range(100_000):
            yield pack(1, 90, 1, i)
    out = open_bands(endless(), 5, 5, 80, 100)
    assert [r[3] for r in out] == [0, 1, 2, 3, 4]


def test_query_equals_its_sql(spark, duck):
    from marketlens.llm.oracles import OP13
    from marketlens.llm.queries import op13_hard_negatives

    got = op13_hard_negatives(spark, "/root/testdata/sf0.001")
    want = duck.execute(OP13)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("column", ["block", "chunk", "row", "place"])
def test_clashing_columns(spark, column):
    rows = sample(220, 3, 7)
    df = table(spark, rows).withColumn(column, F.lit("x"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    got = hard_negatives(df, lambda v: v % 100 == 0, label=moved)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
