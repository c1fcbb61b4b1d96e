"""Dictionary forms by rewrite rules (J4), and the lookup of a table that may be large by a
key that may be hot.

A rule replaces a suffix: ``ais`` by ``al`` where at least two letters stay.  Of the rules
that fit a token the one with the longest suffix wins whose result occurs in the vocabulary;
tokens without one keep their form.  Rules meet tokens in an equi-join on suffixes: each
distinct token is spread into its last 1, 2, ... characters, as many as the longest rule
has, so neither the number of rules nor that of tokens is bounded.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Endings of Portuguese words as the cleaned corpus writes them, without accents (fixed
# values): suffix, replacement, least number of letters before the suffix.
PORTUGUESE_RULES = (
    ("s", "", 2), ("es", "", 3), ("is", "il", 2), ("ais", "al", 1), ("eis", "el", 2), ("ois", "ol", 2), ("ns", "m", 2),
    ("oes", "ao", 1), ("aes", "ao", 2), ("as", "o", 3), ("a", "o", 4), ("inho", "o", 3), ("inha", "a", 3),
    ("mente", "", 3), ("ando", "ar", 2), ("endo", "er", 2), ("indo", "ir", 2), ("ados", "ar", 2), ("ado", "ar", 2),
    ("idos", "ir", 2), ("ido", "ir", 2), ("ou", "ar", 2), ("aram", "ar", 2), ("ei", "ar", 2),
)

BROADCAST_ROWS = 100_000  # of a lookup table that every task gets whole; larger ones are joined by key
HOT_SHARES = 1_000        # a key with over a thousandth of all rows is dealt to several tasks


def rules_table(spark: SparkSession, rules=PORTUGUESE_RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "suffix string, replacement string, least int")


def rule_lemmas(vocabulary: DataFrame, rules: DataFrame, term_col: str = "term") -> DataFrame:
    """(token, lemma) for the tokens that a rule rewrites into another token of the
    vocabulary; ties of equally long suffixes go to the smaller lemma."""
    known = vocabulary.select(F.col(term_col).alias("token")).filter("token IS NOT NULL").distinct()
    longest = rules.agg(F.coalesce(F.max(F.char_length("suffix")), F.lit(0))).first()[0]  # one number
    ends = known.select("token", F.explode(F.sequence(F.lit(1), F.least(F.char_length("token"), F.lit(longest))))
                        .alias("k")) if longest else known.select("token", F.lit(1).alias("k")).limit(0)
    asked = ends.select("token", "k", F.expr("right(token, k)").alias("ending"))
    fits = (asked.join(rules, F.col("ending") == F.col("suffix"))
            .filter(F.char_length("token") - F.col("k") >= F.col("least"))
            .select("token", "k", F.concat(F.expr("left(token, char_length(token) - k)"), "replacement").alias("lemma"))
            .filter(F.col("lemma") != F.col("token")))
    attested = fits.join(known.select(F.col("token").alias("lemma")), "lemma", "left_semi")
    best = F.min(F.struct((-F.col("k")).alias("minus"), "lemma"))
    return attested.groupBy("token").agg(best.alias("b")).select("token", F.col("b.lemma").alias("lemma"))


def looked_up(rows: DataFrame, table: DataFrame, key: str, spread: Sequence[str],
              broadcast_rows: int = BROADCAST_ROWS, shares: int = HOT_SHARES) -> DataFrame:
    """``rows`` left-joined with ``table`` by ``key``, which is unique in ``table``.

    A table of at most ``broadcast_rows`` rows is broadcast, after counting up to there.
    With a larger one the join shuffles by key, and a key that more than one ``shares``-th
    of all rows hold (there are fewer than ``shares`` of those, so they are broadcast) is dealt
    into as many parts as it has shares, by a hash of the ``spread`` columns; its row of
    ``table`` is repeated for each."""
    if table.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return rows.join(F.broadcast(table), key, "left")
    counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
    limit = rows.count() // shares + 1
    hot = (counts.filter(F.col("_n") > limit)
           .select(F.col(key).alias("_hot"), F.ceil(F.col("_n") / limit).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = (rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
             .withColumn("_part", F.pmod(F.xxhash64(*spread), parts))
             .drop("_hot", "_parts"))
    repeated = (table.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
                .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), (parts - 1).cast("long"))))
                .drop("_hot", "_parts"))
    return dealt.join(repeated, [key, "_part"], "left").drop("_part")
