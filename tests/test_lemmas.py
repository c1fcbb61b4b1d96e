"""Rewrite rules and the skew-safe lookup against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators import text
from marketlens.operators.lemmas import PORTUGUESE_RULES, looked_up, rule_lemmas, rules_table


def by_hand(words, rules):
    out = {}
    for w in words:
        fits = [(-len(s), w[:len(w) - len(s)] + r) for s, r, least in rules
                if w.endswith(s) and len(w) - len(s) >= least]
        fits = sorted(f for f in fits if f[1] != w and f[1] in words)
        if fits:
            out[w] = fits[0][1]
    return out


def table(spark, words, rules):
    df = spark.createDataFrame([(w,) for w in words], "term string")
    return {r["token"]: r["lemma"] for r in rule_lemmas(df, rules_table(spark, rules)).collect()}


def test_rules_equal_brute_force(spark):
    rng = random.Random(1)
    stems = ["".join(rng.choice("abo") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    ends = sorted({e for s, r, _ in PORTUGUESE_RULES for e in (s, r)})
    words = {s + rng.choice(ends) for s in stems for _ in range(12)} | set(stems)
    want = by_hand(words, PORTUGUESE_RULES)
    assert len({len(w) - len(v) for w, v in want.items()}) > 3
    assert table(spark, [*words, *words, None], PORTUGUESE_RULES) == want


def test_the_longest_rule_with_a_known_result_wins(spark):
    rules = [("s", "", 2), ("ais", "al", 1), ("is", "il", 2)]
    assert table(spark, ["animais", "animal", "animai"], rules) == {"animais": "animal"}
    assert table(spark, ["animais", "animai"], rules) == {"animais": "animai"}
    assert table(spark, ["ais", "al", "ai"], rules) == {"ais": "ai"}  # a letter must stay before ais
    assert table(spark, ["x", ""], []) == {}


@pytest.mark.parametrize("broadcast_rows", [0, 100_000])
def test_lookup_keeps_every_row(spark, broadcast_rows):
    rng = random.Random(2)
    rows = [(i, None if i % 50 == 0 else "hot" if i % 3 else f"t{rng.randrange(40)}") for i in range(900)]
    table = spark.createDataFrame([("hot", "h")] + [(f"t{k}", f"l{k}") for k in range(0, 40, 2)], "token string, lemma string")
    df = spark.createDataFrame(rows, "id long, token string")
    got = looked_up(df, table, "token", ["id"], broadcast_rows=broadcast_rows, shares=20)
    known = {"hot": "h", **{f"t{k}": f"l{k}" for k in range(0, 40, 2)}}
    assert sorted(((r["id"], r["token"], r["lemma"]) for r in got.collect()), key=repr) == sorted(
        ((i, t, known.get(t)) for i, t in rows), key=repr)


def test_no_task_holds_a_hot_token(spark):
    rows = spark.range(8000).select(F.col("id"), F.when(F.col("id") % 3 > 0, "hot").otherwise(
        F.concat(F.lit("t"), F.col("id"))).alias("token"))
    table = spark.createDataFrame([("hot", "h"), ("t3", "x")], "token string, lemma string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = looked_up(rows, table, "token", ["id"], broadcast_rows=0, shares=200)
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 8000 and max(sizes) <= 0.15 * 8000


def test_substitution_beyond_the_broadcast_bound(spark, monkeypatch):
    import marketlens.operators.lemmas as module

    df = spark.createDataFrame([(1, ["casas", "x", "casas"]), (2, []), (3, ["bonitas"])], "doc_id long, tokens array<string>")
    lemmas = spark.createDataFrame([("casas", "casa"), ("bonitas", "bonito")], "token string, lemma string")
    want = {1: ["casa", "x", "casa"], 2: [], 3: ["bonito"]}
    for bound in (100_000, 0):
        monkeypatch.setattr(text, "looked_up", lambda *a, **k: module.looked_up(*a, **{**k, "broadcast_rows": bound}))
        got = text.substitute_lemmas(df, "doc_id", "tokens", lemmas).collect()
        assert {r["doc_id"]: list(r["lemmas"]) for r in got} == want
