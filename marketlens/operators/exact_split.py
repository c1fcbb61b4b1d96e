"""J5 with exact sizes: the held-out rows are those with the smallest digests of each class.

How many rows a class gives follows from the counts alone (largest remainders).  Which
digest is a class's k-th smallest is found by narrowing: a histogram over the next bits of
the digests that are still in question, one row a class and bin, tells the bin it lies in.
Most data need one or two passes, none needs more than four; each reads ids and labels
only, sums in the tasks first and shuffles counts, never rows.  No row is ranked, but those
that share the very last digest.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LEVELS, BITS = 4, 15  # of the 60-bit digest


def digest(id_col: str, seed: int | str) -> Column:
    """60 bits of md5(id ':' seed)."""
    text = F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def held_out(counts: dict, percent: int) -> dict:
    """Rows to hold out of each class: ``ceil(percent % of all)`` in all, shared out in
    proportion; what whole numbers leave over goes to the largest remainders, ties to the
    smaller class (null first)."""
    n = sum(counts.values())
    total = -(-n * percent // 100)
    shares = {c: Fraction(total * k, n) for c, k in counts.items()} if n else {}
    out = {c: int(s) for c, s in shares.items()}
    order = sorted(shares, key=lambda c: (out[c] - shares[c], c is not None, c if c is not None else 0))
    for c in order[:total - sum(out.values())]:
        out[c] += 1
    return out


def exact_split(df: DataFrame, id_col: str, label_col: str, test_percent: int = 20, seed: int = 42,
                split_col: str = "split") -> DataFrame:
    """Adds ``split_col``: in each class of ``label_col`` the exact number of rows with the
    smallest (digest, id) are ``test``, the others ``train``.  Ids are keys; a null id
    takes part with a null digest, which is never held out before others are."""
    last = (1 << 60) - 1
    h = F.coalesce(digest(id_col, seed), F.lit(last))
    rows = df.withColumn("_digest", h)
    asked = rows.select(F.col(label_col).alias("c"), F.col("_digest").alias("d"))
    counts = {r["c"]: r["n"] for r in asked.groupBy("c").agg(F.count("*").alias("n")).collect()}  # a row a class
    wanted = held_out(counts, test_percent)

    # class -> (first digest in question, width in bits, rows still to find, rows in question)
    search = {c: (0, 60, k, counts[c]) for c, k in wanted.items()}
    for level in range(LEVELS):
        open_ = {c: s for c, s in search.items() if 0 < s[2] < s[3]}
        if not open_:
            break
        width = 60 - BITS * (level + 1)
        of = F.lit(False)
        for c, (low, bits, _, _) in open_.items():
            of = of | (F.col("c").eqNullSafe(F.lit(c)) & F.col("d").between(low, low + (1 << bits) - 1))
        bins = asked.filter(of).groupBy("c", F.shiftright("d", width).alias("bin")).agg(F.count("*").alias("n"))
        upto = Window.partitionBy("c").orderBy("bin")  # at most 2^15 rows a class
        reached = bins.withColumn("upto", F.sum("n").over(upto))
        need = F.lit(None).cast("long")
        for c, (_, _, k, _) in open_.items():
            need = F.when(F.col("c").eqNullSafe(F.lit(c)), F.lit(k)).otherwise(need)
        hit = (reached.filter(F.col("upto") >= need).groupBy("c")
               .agg(F.min(F.struct("bin", "n", "upto")).alias("b")))
        for r in hit.collect():  # a row a class
            b, k = r["b"], search[r["c"]][2]
            search[r["c"]] = (b["bin"] << width, width, k - (b["upto"] - b["n"]), b["n"])

    test, tied = F.lit(False), []
    for c, (low, bits, k, n) in search.items():
        mine = F.col(label_col).eqNullSafe(F.lit(c))
        if k == n:
            test = test | (mine & (F.col("_digest") <= low + (1 << bits) - 1))
        else:
            test = test | (mine & (F.col("_digest") < low))
            if k:
                tied.append((mine & (F.col("_digest") == low), k))
    if not tied:
        return rows.withColumn(split_col, F.when(test, "test").otherwise("train")).drop("_digest")
    of = F.lit(None).cast("int")  # which rows share the last digest, and how many of them are held out
    take = F.lit(0)
    for i, (rule, k) in enumerate(tied):
        of, take = F.when(rule, F.lit(i)).otherwise(of), F.when(rule, F.lit(k)).otherwise(take)
    marked = rows.withColumns({"_tie": of, "_take": take, "_test": test})
    ranked = (marked.filter("_tie IS NOT NULL")
              .withColumn("_place", F.row_number().over(Window.partitionBy("_tie").orderBy(id_col)))
              .withColumn("_test", F.col("_place") <= F.col("_take")).drop("_place"))
    whole = marked.filter("_tie IS NULL").unionByName(ranked)
    return (whole.withColumn(split_col, F.when(F.col("_test"), "test").otherwise("train"))
            .drop("_digest", "_tie", "_take", "_test"))
