"""Helpers shared by the corpus operators: stage tables in the shared folder, Arrow
text access, distributed running totals and connected components.

A stage table is a Parquet table under ``spark.checkpoint.dir``.  It cuts the lineage
(a lost executor costs only the tasks it ran), it is columnar and has statistics, and
the shuffle files behind it are released as soon as it is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.session import ensure_checkpoint_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within the block, shuffle files go when the job that made them has ended."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a stage table and read it back."""
    spark = df.sparkSession
    path = stage_path(spark, label)
    with released_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(*tables: DataFrame) -> None:
    """Remove stage tables that no later plan reads."""
    for df in tables:
        spark = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, whatever else ``df`` carries."""
    return df.select(*[F.col(f"`{n}`") for n in names])


NULL_ID = -(2 ** 63)


def id_key(col: str = "doc_id") -> Column:
    """A null id takes part as the smallest id; ``id_value`` turns it back."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID).cast("long"))


def id_value(col: str) -> Column:
    return F.when(F.col(col) != F.lit(NULL_ID).cast("long"), F.col(col))


def text_digest(text: Column) -> list[Column]:
    """The 128 bits of a text's md5, as the columns d1 and d2."""
    return [F.conv(F.substring(F.md5(text), at, 16), 16, -10).cast("long").alias(name)
            for name, at in (("d1", 1), ("d2", 17))]


# ------------------------------------------------------------------ arrow text access
def text_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string or binary column (null: empty), no copy."""
    import pyarrow as pa

    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or
                                pa.types.is_large_string(array.type) else b"")
    kind = (np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
            else np.int32)
    _, offsets, data = array.buffers()
    if offsets is None or len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def row_chunks(offsets: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of about ``size`` bytes each (one long row stands alone)."""
    start, n = 0, len(offsets) - 1
    while start < n:
        end = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield start, end
        start = end


# 64-bit mixing of an unsigned numpy array (fixed multipliers of the splitmix64 finisher).
_MIX_1, _MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX_1
    x = (x ^ (x >> np.uint64(27))) * _MIX_2
    return x ^ (x >> np.uint64(31))


class RollingHash:
    """Polynomial hashes mod 2^64 of any substrings of a byte array, vectorised: one
    prefix sum, then two lookups and a product for each substring."""

    def __init__(self, multiplier: int = 0x9E3779B97F4A7C15):
        self.up, self.down = multiplier, pow(multiplier, -1, 2 ** 64)
        self._powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._powers[0]) < n:
            size = 1 << (n - 1).bit_length()
            with np.errstate(over="ignore"):
                self._powers = tuple(
                    np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, m, np.uint64))])
                    for m in (self.up, self.down))
        return self._powers[0][:n], self._powers[1][:n]

    def prefix(self, data: np.ndarray) -> np.ndarray:
        up, _ = self.powers(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=out[1:])
        return out

    def at(self, prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        _, down = self.powers(len(prefix))
        return (prefix[ends] - prefix[starts]) * down[starts]


# --------------------------------------------------------------- ranks without one task
def running_total(df: DataFrame, groups: Sequence[str], key: str, amount: Column, out: str,
                  bins: int = 1024, ties: Sequence[str] = ()) -> DataFrame:
    """Adds ``out``: the sum of ``amount`` over the rows of the same group that come
    before this one in the order of ``key`` (a double in [0, 1)), then ``ties``.

    No group meets in one task: rows are binned by ``key``; the bins' sums (at most
    ``bins`` rows a group) are accumulated first, and a window runs inside each bin.
    ``key`` should be spread evenly, as a hash or a random number is.
    """
    binned = df.withColumns({"_amount": amount,
                             "_bin": F.floor(F.col(key) * F.lit(float(bins))).cast("int")})
    sums = binned.groupBy(*groups, "_bin").agg(F.sum("_amount").alias("_bin_sum"))
    before = Window.partitionBy(*groups).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sums.withColumn("_before", F.coalesce(F.sum("_bin_sum").over(before), F.lit(0)))
            .select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)],
                    F.col("_bin").alias("_b"), "_before"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    same.append(F.col("_bin") == F.col("_b"))
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    inside = (Window.partitionBy(*groups, "_bin").orderBy(key, *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (binned.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0)))
            .join(sums, cond, "left")
            .withColumn(out, F.col("_before") + F.col("_inside"))
            .drop("_amount", "_bin", "_inside", "_b", "_before", *[f"_g{i}" for i in range(len(groups))]))


def uniform(*parts: Column, seed: str = "") -> Column:
    """A repeatable number in (0, 1) from the parts' text: 52 bits of their md5."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    bits = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2 ** 52))


# -------------------------------------------------------------- connected components
def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable from each node of ``edges``
    (columns u, v).  Alternating large-star and small-star rounds; each round is two
    aggregations to a minimum (combined before the shuffle) and two joins that Spark
    can split, so a node with a third of all edges is no single task's work.  Round
    tables go to the shared folder; the driver sees one count and one sum a round.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            near = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            near = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = near.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("w"), F.least("u", "m").alias("m"))
        joined = near.join(low, F.col("u") == F.col("w"))
        if large:
            out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = joined.select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                                                  F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))
                                .alias("e")).select("e.u", "e.v")
        return out.filter(F.col("u") != F.col("v")).distinct()

    def mark(e: DataFrame) -> tuple:
        with released_shuffles(e.sparkSession):
            return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stage_table(edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
                      .filter(F.col("u") != F.col("v")).distinct(), "edges")
    seen = mark(now)
    for _ in range(max_rounds):
        after = stage_table(star(star(now, True), False), "edges")
        found = mark(after)
        drop_stage(now)
        now = after
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError(f"connected components: not settled after {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
