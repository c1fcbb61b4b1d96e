"""Approximate nearest neighbours by a hash-prefix forest.

Rows are dealt evenly into blocks.  A block's index is a forest: each tree is the sorted
array of the rows' long hash strings (signs against random hyperplanes).  A query
descends every tree to the longest prefix that matches anything, then all trees ascend
together, one level at a time, until the matching ranges hold ``share`` entries for each
row of the block and ``k`` rows that may answer; every row in the ranges of that level is
scored exactly by its inner product in double precision.  Each block returns its nearest
``k``, the blocks' answers are merged.  Nothing but ``k`` bounds the candidates from
below, so small tables are searched as large ones are.

The stated queries visit every block, in chunks, so a unit of work is one block against
one chunk and has a bounded size whatever the number of rows; rows are dealt by a hash
of their id, so equal or frequent vectors spread over all blocks.  The number of trees
and the share of candidates are what recall was measured with (see the README).

Nulls and edge cases: null, empty and zero vectors and those with null or non-finite
components take no part; vectors of different lengths are never compared; a null vec_id
is no query and no candidate; rows alike in vec_id and vector are one row; rows that share
a vec_id but differ are separate candidates, none of them for the queries of that id, and
the smallest vector of an id is the one that asks; with fewer candidates than ``k`` a query
gets all; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import NULL_ID
from marketlens.llm.vectors import matrices, planes, unit, vectors

DEPTH = 24  # signs in a hash string


class Forest:
    """Sorted hash strings of a block's vectors, one array for each tree."""

    def __init__(self, x: np.ndarray, trees: int, seed: int, depth: int = DEPTH):
        self.x, self.trees, self.depth, self.seed = x, trees, depth, seed
        codes = self.codes(x)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, 1)

    def codes(self, x: np.ndarray) -> np.ndarray:
        h = planes(self.trees * self.depth, x.shape[1], self.seed)
        signs = (unit(x) @ h.T >= 0).reshape(len(x), self.trees, self.depth)
        return (signs @ (1 << np.arange(self.depth - 1, -1, -1)).astype(np.int64)).T

    def _ranges(self, codes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Each tree's range of the rows whose first ``level`` signs are the queries'."""
        shift = self.depth - level
        prefix = codes >> shift
        low = np.stack([np.searchsorted(s, p << shift) for s, p in zip(self.sorted, prefix, strict=True)])
        high = np.stack([np.searchsorted(s, (p + 1) << shift) for s, p in zip(self.sorted, prefix, strict=True)])
        return low, high

    def _rows(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        seen = np.zeros(len(self.x), bool)
        for order, a, b in zip(self.order, low, high, strict=True):
            seen[order[a:b]] = True
        return np.flatnonzero(seen)

    def candidates(self, queries: np.ndarray, least: int, k: int, ids: np.ndarray, own: np.ndarray):
        """For each query the rows under other ids than its own in all trees' ranges, at the
        deepest common level where the ranges hold ``least`` entries and ``k`` such rows (or
        at the root, where all rows are)."""
        codes = self.codes(queries)
        low = np.zeros((self.trees, len(queries)), np.int64)
        high = np.full((self.trees, len(queries)), len(self.x))
        levels = np.zeros(len(queries), np.int64)
        for level in range(self.depth, 0, -1):  # descend to the bottom, ascend together
            at = np.flatnonzero(levels == 0)
            if not len(at):
                break
            lo, hi = self._ranges(codes[:, at], level)
            enough = (hi - lo).sum(axis=0) >= least
            done = at[enough]
            low[:, done], high[:, done], levels[done] = lo[:, enough], hi[:, enough], level
        for q in range(len(queries)):
            rows, level = self._rows(low[:, q], high[:, q]), levels[q]
            found = rows[ids[rows] != own[q]]
            while len(found) < k and level > 0:
                level -= 1
                lo, hi = self._ranges(codes[:, [q]], level)
                rows = self._rows(lo[:, 0], hi[:, 0])
                found = rows[ids[rows] != own[q]]
            yield found


def _search(k: int, trees: int, share: float, seed: int):
    def run(key, left, right):
        import pyarrow as pa

        out: list[list] = [[], [], []]
        dims = {x.shape[1]: (rows, x) for rows, x in matrices(left["e"].combine_chunks())} if left.num_rows else {}
        ids = left["vec"].to_numpy()
        for q_rows, q in matrices(right["e"].combine_chunks()) if right.num_rows else []:
            if q.shape[1] not in dims:
                continue
            rows, x = dims[q.shape[1]]
            forest, own = Forest(x, trees, seed), ids[rows]
            q_ids = right["vec"].to_numpy()[q_rows]
            columns = np.ascontiguousarray(x.T)
            for i, found in enumerate(forest.candidates(q, math.ceil(share * len(x)), k, own, q_ids)):
                score = np.zeros(len(found))
                for d, part in enumerate(columns):  # in order, as a plain sum of products
                    score += part[found] * q[i, d]
                best = np.lexsort((own[found], -score))[:k]
                out[0].extend([q_ids[i]] * len(best))
                out[1].extend(own[found][best])
                out[2].extend(score[best])
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                         pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "score"])
    return run


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def nearest(embeddings: DataFrame, is_query: Callable[[Column], Column], k: int = 20, trees: int = 128,
            share: float = 1.0, block_rows: int = 8192, chunk_rows: int = 4096, seed: int = 23) -> DataFrame:
    """query_id, rank, vec_id, score.  ``is_query`` tells queries by their id."""
    rows = vectors(embeddings).filter(F.col("ok") & (F.col("vec") != F.lit(NULL_ID).cast("long")))
    rows = (rows.select("vec", "e", F.coalesce(is_query(F.col("vec")), F.lit(False)).alias("asks"))
            .dropDuplicates(["vec", "e"]))
    n, n_queries = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    blocks, chunks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(n_queries / chunk_rows))
    index = (rows.withColumn("block", F.pmod(F.xxhash64("vec"), F.lit(blocks)))
             .withColumn("chunk", F.explode(_numbers(chunks)))
             .select("block", "chunk", "vec", "e"))
    asking = (rows.filter("asks").groupBy(F.col("vec").alias("q")).agg(F.min("e").alias("least"))
              .select(F.col("q").alias("vec"), F.col("least").alias("e")))
    asked = (asking.withColumn("chunk", F.pmod(F.xxhash64("vec", F.lit(1)), F.lit(chunks)))
             .withColumn("block", F.explode(_numbers(blocks)))
             .select("block", "chunk", "vec", "e"))
    found = (index.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk"))
             .applyInArrow(_search(k, trees, share, seed),
                           "query_id long, vec_id long, score double"))
    rank = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

