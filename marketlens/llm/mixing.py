r"""Mixing sources to target weights by Pareto order sampling, with DataFrame functions only.

A document's size is its number of words (runs of anything but ASCII white space).
Sources share the total size by weight; a source's target stops at ``cap`` times its
size and the excess goes to the others by weight until none is above (one pass over the
sources in the order in which they fill up).  With rate = target / size of the source,
every document is taken ``floor(rate)`` whole times for certain.  The rest is a Pareto
order sample: each document draws odds from a random number, divided by its inclusion
odds; documents are ranked by that quotient and the first ones are taken, up to where
the words taken come nearest to the target.  Inclusion odds are those of the source's
rate, part / (1 - part), times a tilt by size: 1 for a document of the source's mean size,
down to 1/2 for a short one and up to 2 for a long one, so that words, not rows, are drawn
evenly.  The odds of the source are the same for all its documents and cancel in the
ranks, which are kept per source; ``key`` is the quotient of draw and tilt, put into (0, 1).

Random numbers are digests of the document's id, so reruns and retried tasks agree.
Ranks come from running totals over bins (``common.running_total``): a source with a
third of all rows is spread over as many tasks as there are bins.

Nulls and edge cases: a null text has size 0; a null source is a source of its own, the
last; a null id draws as any other; rows that repeat an id draw the same number and are
ranked by size; sources without words get and give nothing; an empty table gives an
empty result; further columns are ignored (``mix_documents`` keeps them).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of, running_total, stage_table, uniform

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0) -> DataFrame:
    """(source, source_size, source_rows, target) from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    place = Window.orderBy(F.col("source").asc_nulls_last())
    per = (per.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                            (F.row_number().over(place) - 1) % len(weights) + 1))
           .withColumn("cap", F.col("source_size") * F.lit(float(cap))))
    full = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("left", F.sum("source_size").over(everything)
                          - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.sum("w").over(after))
           .withColumn("full", F.col("level") * F.col("w") > F.col("cap")))
    level = F.max(F.when(~F.col("full"), F.col("level"))).over(everything)  # of the first not full
    return per.select("source", "source_size", "source_rows",
                      F.when(F.col("full"), F.col("cap"))
                      .otherwise(F.least(F.coalesce(level, F.lit(0.0)) * F.col("w"), F.col("cap"))).alias("target"))


def pareto_copies(sizes: DataFrame, targets: DataFrame, seed: str = "mix", bins: int = 1024) -> DataFrame:
    """``sizes`` (doc_id, source, size, optional mark, the last tie) with source_size, target, copies."""
    t = targets.withColumnRenamed("source", "_source")
    rows = (sizes.join(t, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size"))
                        .otherwise(F.lit(0.0)))
            .withColumn("whole", F.floor("rate"))
            .withColumn("part", F.col("rate") - F.col("whole")))
    own = F.col("size").cast("double") * F.col("source_rows").cast("double")
    mean = F.col("source_size").cast("double")  # both times the rows of the source
    tilt = F.when(mean > 0, (own * 2.0 + mean) / (own + mean * 2.0)).otherwise(F.lit(1.0))
    u = uniform(F.col("doc_id"), seed=seed)
    draw = u / (F.lit(1.0) - u)
    quotient = F.col("draw") / F.col("tilt")
    ranked = (rows.withColumns({"draw": draw, "tilt": tilt})
              .withColumn("key", quotient / (F.lit(1.0) + quotient)))
    ranked = running_total(ranked, ["source"], "key", F.col("size"), "before", bins,
                           ["doc_id", "size", *(["mark"] if "mark" in sizes.columns else [])])
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    extra = (F.col("part") > 0) & (F.col("before") + F.col("size") / 2 <= rest)
    return (ranked.withColumn("copies", F.col("whole") + extra.cast("long"))
            .drop("rate", "whole", "part", "draw", "tilt", "key", "before", "source_rows"))


def mix(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0, seed: str = "mix") -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for each document."""
    sizes = stage_table(columns_of(documents, "doc_id", "source", "text")
                        .select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    out = pareto_copies(sizes, source_targets(sizes, weights, cap), seed)
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"), F.col("copies").cast("long"))


def mix_documents(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: float = 3.0,
                  seed: str = "mix") -> DataFrame:
    """The mix itself: all columns of ``documents``, each row as often as it is taken."""
    names = documents.columns
    # rows alike in every column are one key; their copies are summed before the join
    mark = F.md5(F.to_json(F.struct(*[F.col(f"`{n}`") for n in names])))
    sizes = stage_table(documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark")),
                        "sizes")
    copies = (pareto_copies(sizes, source_targets(sizes, weights, cap), seed)
              .groupBy(F.col("mark").alias("_key")).agg(F.sum("copies").alias("_copies")))
    rows = (documents.select(mark.alias("_mark"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("_row"))
            .groupBy("_mark").agg(F.first("_row").alias("_row")))  # combined before the shuffle
    return (rows.join(copies, F.col("_mark") == F.col("_key")).filter("_copies > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
            .select(*[F.col(f"_row.`{n}`") for n in names]))
