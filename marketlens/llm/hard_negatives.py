"""Hard-negative mining by a secondary-sort shuffle.

For each anchor, rows of its label with the highest scores are its positives; the
hardest rows of other labels within a band below a positive's score are that positive's
negatives.  Rows are dealt into blocks by a hash; a unit of work is one block of rows
against one chunk of anchors.  Two passes over the units:

1. Each unit keeps the best positives of its anchors; merged, they are the anchors'
   positives, a fixed number each.
2. Knowing the bands, each unit keeps of its rows the hardest few inside each band.

What is shuffled is therefore a few pairs an anchor and block, never all pairs.  Pairs
are packed into 25-byte keys (anchor, descending score, positive before negative, id)
that sort as bytes; ``repartitionAndSortWithinPartitions`` brings an anchor's pairs to
one partition in order.  An iterator streams over them: a positive opens its band, a
negative goes to every open band, a band that is full or passed is closed.  It holds the
open bands of one anchor and nothing else.

Components become ``floor(scale * x)``, scores are their integer inner products: by
matrix product in double precision where no sum can reach 2^53, else in Python's
integers (scores beyond 64 bits are held at the ends of that range).

Nulls and edge cases: rows with a null label, a null vector or a null or non-finite
component take no part; an empty vector scores 0 with other empty ones; vectors of
different lengths never meet.  Rows alike in id, label and vector are one row.  Rows
that share an id but differ are separate candidates, never positives or negatives of
that id; as an anchor, the smallest of them by (label, vector) stands for the id.  A row
with a null id is no anchor; as a candidate it comes before all ids among ties.  An empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of, id_key, id_value, stage_table
from marketlens.llm.vectors import matrices

PAIR = ">QQBQ"  # anchor, descending score, 0 positive or 1 negative, id
_SHIFT, _LAST = 1 << 63, (1 << 63) - 1
EXACT = 2.0 ** 53


def pack(anchor: int, score: int, kind: int, vec: int) -> bytes:
    return struct.pack(PAIR, anchor + _SHIFT, _LAST - score, kind, vec + _SHIFT)


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, vec = struct.unpack(PAIR, key)
    return anchor - _SHIFT, _LAST - score, kind, vec - _SHIFT


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), as doubles where that is exact, else as Python integers."""
    with np.errstate(over="ignore"):
        out = np.floor(x * float(scale))
    if not out.size or np.abs(out).max() < EXACT:
        return out
    return np.array([[int(v) * scale if abs(v) >= EXACT else math.floor(v * scale) for v in row]
                     for row in x.tolist()], object).reshape(x.shape)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of ``a`` with those of ``b``, in 64 bits."""
    if a.dtype != object and b.dtype != object:
        most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
        if most < EXACT:
            return (a @ b.T).astype(np.int64)
    wide = [[sum(x * y for x, y in zip(p, q, strict=True)) for q in b.astype(object).tolist()]
            for p in a.astype(object).tolist()]
    held = [[int(min(max(s, -_LAST), _LAST)) for s in row] for row in wide]
    return np.array(held, np.int64).reshape(len(a), len(b))


def first_rows(rows: np.ndarray, score: np.ndarray, vec: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of ``rows`` with the highest scores, ties by smaller id."""
    if len(rows) > k:
        s = score[rows]
        rows = rows[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return rows[np.lexsort((vec[rows], -score[rows]))][:k]


def _unit_scores(left, right, scale: int, step: int = 256):
    """For each anchor of a unit: its place in ``right``, the block's ids, whether they
    have its label, and the scores."""
    blocks = {x.shape[1]: (rows, scaled(x, scale)) for rows, x in matrices(left["e"].combine_chunks())}
    vec, label = left["vec"].to_numpy(), left["label"].to_numpy()
    ids, labels = right["vec"].to_numpy(), right["label"].to_numpy()
    for places, q in matrices(right["e"].combine_chunks()):
        if q.shape[1] not in blocks:
            continue
        rows, x = blocks[q.shape[1]]
        q = scaled(q, scale)
        for at in range(0, len(places), step):
            scores = products(q[at:at + step], x)
            for i, place in enumerate(places[at:at + step]):
                other = vec[rows] != ids[place]
                yield place, ids[place], vec[rows], other, label[rows] == labels[place], scores[i]


def _best_positives(k: int, scale: int):
    def run(key, left, right):
        import pyarrow as pa

        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            for _, anchor, vec, other, same, score in _unit_scores(left, right, scale):
                best = first_rows(np.flatnonzero(other & same), score, vec, k)
                out[0].extend([anchor] * len(best))
                out[1].extend(vec[best])
                out[2].extend(score[best])
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["anchor", "vec", "score"])
    return run


def _band_negatives(k: int, low: int, high: int, scale: int):
    """Packed pairs: the hardest ``k`` rows of other labels inside each positive's band."""
    def run(key, left, right):
        import pyarrow as pa

        out: list[bytes] = []
        if left.num_rows and right.num_rows:
            bands = right["positives"].to_pylist()
            for place, anchor, vec, other, same, score in _unit_scores(left, right, scale):
                rows, kept = np.flatnonzero(other & ~same), set()
                for top in set(bands[place]):
                    floor = -((-low * top) // high)
                    inside = rows[(score[rows] <= top) & (score[rows] >= floor)]
                    kept.update(first_rows(inside, score, vec, k).tolist())
                out.extend(pack(int(anchor), int(score[r]), 1, int(vec[r])) for r in kept)
        return pa.table([pa.array(out, pa.binary())], names=["pair"])
    return run


def open_bands(pairs, positives: int, negatives: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive, rank, negative, positive_score, negative_score) from packed pairs
    in order; holds at most ``positives`` open bands."""
    now, opened, bands = None, 0, []
    for key in pairs:
        anchor, score, kind, vec = unpack(key)
        if anchor != now:
            now, opened, bands = anchor, 0, []
        if kind == 0:
            if opened < positives:
                opened += 1
                bands.append([vec, score, 0])
            continue
        bands = [b for b in bands if b[2] < negatives and low * b[1] <= high * score]
        for band in bands:
            band[2] += 1
            yield anchor, band[0], band[2], vec, band[1], score


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def participants(embeddings: DataFrame, label: Column) -> DataFrame:
    """(vec, label, e): rows that take part, each once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (columns_of(embeddings, "vec_id", "embedding", "label")
            .select(F.col("vec_id").cast("long").alias("vec_id"), "embedding",
                    F.col("label").cast("long").alias("label"))
            .filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(id_key("vec_id").alias("vec"), F.coalesce(label, F.col("label")).cast("long").alias("label"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("e"))
            .dropDuplicates())


def hard_negatives(embeddings: DataFrame, is_anchor: Callable[[Column], Column], label: Column | None = None,
                   positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                   block_rows: int = 16384, chunk_rows: int = 32768) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` tells anchors by their id; ``label`` replaces the label (an expression
    over vec_id and label; null keeps it).  A negative's score times ``high`` lies between
    the positive's score times ``low`` and times ``high``."""
    spark = embeddings.sparkSession
    rows = stage_table(participants(embeddings, F.col("label") if label is None else label), "participants")
    anchors = stage_table(
        rows.filter(id_value("vec").isNotNull() & F.coalesce(is_anchor(F.col("vec")), F.lit(False)))
        .groupBy("vec").agg(F.min(F.struct("label", "e")).alias("row"))
        .select("vec", "row.label", "row.e"), "anchors")
    n, n_anchors = rows.count(), anchors.count()
    blocks, chunks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(n_anchors / chunk_rows))
    index = (rows.withColumn("block", F.pmod(F.xxhash64("vec", "e"), F.lit(blocks)))
             .withColumn("chunk", F.explode(_numbers(chunks))).groupBy("block", "chunk"))

    def units(asked: DataFrame, work, schema: str) -> DataFrame:
        dealt = (asked.withColumn("chunk", F.pmod(F.xxhash64("vec", F.lit(1)), F.lit(chunks)))
                 .withColumn("block", F.explode(_numbers(blocks))))
        return index.cogroup(dealt.groupBy("block", "chunk")).applyInArrow(work, schema)

    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "vec")
    found = stage_table(
        units(anchors, _best_positives(positives, scale), "anchor long, vec long, score long")
        .withColumn("place", F.row_number().over(best)).filter(F.col("place") <= positives)
        .select("anchor", "vec", "score"), "positives")
    bands = found.groupBy("anchor").agg(F.collect_list("score").alias("positives"))
    banded = anchors.join(bands, F.col("vec") == F.col("anchor")).select("vec", "label", "e", "positives")
    hard = units(banded, _band_negatives(negatives, low, high, scale), "pair binary")

    def part(key: bytes) -> int:
        return hash(unpack(key)[0])

    def emit(pairs) -> Iterator[tuple]:
        for anchor, positive, rank, negative, top, score in open_bands(
                (key for key, _ in pairs), positives, negatives, low, high):
            yield anchor, positive, rank, negative, top, score

    keys = (found.rdd.map(lambda r: (pack(r[0], r[2], 0, r[1]), None))
            .union(hard.rdd.map(lambda r: (bytes(r[0]), None))))
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    out = keys.repartitionAndSortWithinPartitions(n_parts, part).mapPartitions(emit)
    named = spark.createDataFrame(
        out, "anchor_id long, positive long, rank int, negative long, positive_score long, negative_score long",
        verifySchema=False)
    return named.select("anchor_id", id_value("positive").alias("positive_id"), "rank",
                        id_value("negative").alias("negative_id"), "positive_score", "negative_score")
