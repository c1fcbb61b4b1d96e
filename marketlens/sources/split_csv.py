"""Quoted CSV with line breaks inside values, read by many tasks.

Spark's multi-line reader takes a file as one piece of work, since a piece from the middle
can't tell whether it begins inside quotes.  Here files are read as lines, in splits, and
the state at a split's start follows from the splits before it:

1. each split's number of quote characters is summed; a running sum over a file's splits
   (one row a split) says which of them begin inside a quoted value;
2. inside a split, a running sum over its lines marks those that begin a record;
3. the lines of a record are put together again, wherever its last line lies, and parsed.

Splits hold at most ``spark.sql.files.maxPartitionBytes``, so no task holds more lines
than that; lines are shuffled once, by split, and after that only those of records that
began in an earlier split.

Quotes inside quoted values are doubled (the reference's format); unquoted values hold
none.  ``\\r\\n`` counts as ``\\n``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'


def _quotes(text: str) -> Column:
    return F.length(text) - F.length(F.replace(F.col(text), F.lit(QUOTE), F.lit("")))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line_no, line): every line; ``line_no`` grows within a split."""
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line_no"),
        F.regexp_replace("value", "\r$", "").alias("line"))


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, line_no, record): the quoted records of all files, where they begin.
    The header is a record like any other; blank lines between records are left out."""
    every = lines(spark, path).withColumn("quotes", _quotes("line"))
    inside = Window.partitionBy("file", "split").orderBy("line_no")
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)

    # one row a split: the parity before it, and the last record that begins before it
    parity = (every.groupBy("file", "split").agg(F.sum("quotes").alias("total"))
              .select("file", "split", F.pmod(F.coalesce(F.sum("total").over(before), F.lit(0)), F.lit(2))
                      .alias("open")))
    marked = every.join(parity, ["file", "split"]).withColumn(
        "begins", F.pmod(F.col("open") + F.coalesce(F.sum("quotes").over(upto), F.lit(0)), F.lit(2)) == 0)
    own = F.max(F.when(F.col("begins"), F.col("line_no"))).over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = marked.withColumn("own", own)
    last = (marked.filter("begins").groupBy("file", "split").agg(F.max("line_no").alias("last_begun")))
    carried = parity.join(last, ["file", "split"], "left").select(
        "file", "split",
        F.last(F.when(F.col("last_begun").isNotNull(), F.struct("split", "last_begun")), ignorenulls=True)
        .over(before).alias("owner"))
    owned = marked.join(carried, ["file", "split"]).select(
        "file", "split", F.coalesce(F.when(F.col("own").isNotNull(), F.col("split")), F.col("owner.split")).alias("in_split"),
        F.coalesce("own", "owner.last_begun").alias("begun"),
        F.struct("split", "line_no", "line").alias("part"))
    # a record's lines lie in its own split, but for the last one's of a split: only what other
    # splits hold of that one is moved, to where it began
    parts = F.array_sort(F.collect_list("part"))
    own_lines = owned.filter(F.col("in_split") == F.col("split")).groupBy("file", "split", "begun").agg(parts.alias("parts"))
    rest = (owned.filter(F.col("in_split") != F.col("split")).groupBy("file", F.col("in_split").alias("split"))
            .agg(F.first("begun").alias("rest_of"), parts.alias("rest")))
    whole = own_lines.join(rest, ["file", "split"], "left").withColumn(
        "parts", F.when(F.col("rest_of") == F.col("begun"), F.concat("parts", "rest")).otherwise(F.col("parts")))
    return (whole.select("file", "split", F.col("begun").alias("line_no"),
                         F.array_join(F.col("parts.line"), "\n").alias("record"))
            .filter(F.col("record") != ""))


def read_quoted_csv(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str],
                    position: str | None = None) -> DataFrame:
    """The files' records as rows of ``schema``.  Each file's first record must name its
    columns in order.  ``position`` adds a sortable place of the row in the input."""
    found = records(spark, path)
    first = Window.partitionBy("file").orderBy("split", "line_no")
    heads = (found.filter(F.col("split") == 0).select("file", "split", "line_no", "record")
             .withColumn("at", F.row_number().over(first)).filter("at = 1")
             .select("file", F.col("line_no").alias("head_no"), F.col("record").alias("head")))
    names = schema.fieldNames()
    expected = ",".join(names)
    plain = F.replace(F.replace(F.col("head"), F.lit(QUOTE), F.lit("")), F.lit("﻿"), F.lit(""))
    checked = F.when(plain == expected, F.lit(True)).otherwise(F.raise_error(
        F.concat(F.lit(f"CSV header does not conform to the schema; expected {expected}, found "), plain)))
    body = found.join(heads.withColumn("fits", checked), "file").filter(
        F.col("fits") & ~((F.col("split") == 0) & (F.col("line_no") == F.col("head_no"))))
    place = F.concat_ws("|", "file", F.lpad(F.col("split").cast("string"), 20, "0"),
                        F.lpad(F.col("line_no").cast("string"), 20, "0"))
    row = F.from_csv("record", schema.simpleString()[7:-1].replace(":", " "), options)
    columns = [F.col(f"r.{n}").alias(n) for n in names]
    if position:
        columns.append(F.col(position))
        body = body.withColumn(position, place)
    return body.select(row.alias("r"), *([position] if position else [])).select(*columns)
