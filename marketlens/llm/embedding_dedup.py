"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosine
verification inside the buckets, connected components over the links.

Equal vectors collapse to their smallest id first.  Each table hashes a vector to
``bits`` signs; vectors in one bucket are compared exactly, in double precision, block
against block.  A pair that meets in several tables counts in the first of them only
(each row carries all its bucket numbers), so link counts need no pair list: a bucket
returns, for each vector, its number of links and the root of its local group.

Sizes follow the data: ``bits`` keeps an average bucket near ``bucket_rows``, and the
number of tables is what makes a pair at exactly the threshold slip through all of them
with a probability of ``miss`` (closer pairs slip through less).  A bucket with more
than ``block_rows`` vectors is cut into blocks by a hash of the id; every pair of blocks
is a unit of its own, so no task holds more than two blocks.

Nulls and edge cases: null, empty and zero vectors and those with null or non-finite
components link with nothing; vectors of different lengths never link; a null vec_id
counts as the smallest id; repeated rows are equal vectors, each counted; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import connected_components, drop_stage, id_value, stage_table
from marketlens.llm.vectors import matrices, planes, unit, vectors


def table_plan(n: int, threshold: float, bucket_rows: int, miss: float) -> tuple[int, int]:
    """(bits, tables) for ``n`` different vectors."""
    bits = min(max(round(math.log2(max(n, 2) / bucket_rows)), 4), 24)
    agree = 1 - math.acos(threshold) / math.pi
    return bits, math.ceil(math.log(miss) / math.log1p(-(agree ** bits)))


def _hashes(bits: int, tables: int, seed: int):
    """(rep, weight, vector, bucket numbers of all tables)."""
    def run(batches):
        import pyarrow as pa

        weights = (1 << np.arange(bits)).astype(np.int64)
        for batch in batches:
            for rows, x in matrices(batch.column(2)):
                h = planes(bits * tables, x.shape[1], seed)
                signs = (unit(x) @ h.T >= 0).reshape(len(rows), tables, bits)
                sig = (signs @ weights).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)),
                     pa.array([r.tobytes() for r in x], pa.binary()),
                     pa.array([r.tobytes() for r in sig], pa.binary()),
                     pa.array(list(sig.astype(np.int64)), pa.list_(pa.int64()))],
                    names=["rep", "weight", "x", "sigs", "buckets"])
    return run


def runs_of_keys(batches, n_keys: int):
    """Arrow rows that arrive ordered by their first ``n_keys`` columns, as one table
    for each key."""
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            key = tuple(keys[:, a])
            if held and key != last:
                yield last, pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield last, pa.Table.from_batches(held)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``n`` reaches over the links (i, j)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def _bucket_links(threshold: float):
    """(rep, links first found here, local root) of each bucket or pair of blocks."""
    def run(batches):
        import pyarrow as pa

        for (table, _, _, lo, hi), rows in runs_of_keys(batches, 5):
            if rows.num_rows < 2:
                continue
            rows = rows.sort_by("rep")
            rep = rows["rep"].to_numpy()
            weight = rows["weight"].to_numpy()
            sub = rows["sub"].to_numpy()
            x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float64).reshape(len(rep), -1)
            sigs = np.frombuffer(b"".join(rows["sigs"].to_pylist()), np.uint32).reshape(len(rep), -1)
            u = unit(x)
            left, right = np.flatnonzero(sub == lo), np.flatnonzero(sub == hi)
            ii, jj = [], []
            for a in range(0, len(left), 512):
                part = left[a:a + 512]
                near = u[part] @ u[right].T >= threshold
                p, q = np.nonzero(near)
                p, q = part[p], right[q]
                keep = p < q if lo == hi else slice(None)
                p, q = p[keep], q[keep]
                for t in range(int(table)):  # a pair belongs to the first table it meets in
                    fresh = sigs[p, t] != sigs[q, t]
                    p, q = p[fresh], q[fresh]
                ii.append(p)
                jj.append(q)
            i, j = np.concatenate(ii), np.concatenate(jj)
            if not len(i):
                continue
            links = np.zeros(len(rep), np.int64)
            np.add.at(links, i, weight[j])
            np.add.at(links, j, weight[i])
            root = _roots(len(rep), i, j)
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rep[hit]), pa.array(links[hit]), pa.array(rep[root[hit]])],
                names=["rep", "links", "root"])
    return run


def near_links(reps: DataFrame, n: int, threshold: float = 0.9, bucket_rows: int = 200,
               miss: float = 1e-6, block_rows: int = 2048, seed: int = 11) -> DataFrame:
    """(rep, links, root) rows of all buckets, for ``reps`` (rep, weight, e)."""
    bits, tables = table_plan(n, threshold, bucket_rows, miss)
    hashed = stage_table(reps.mapInArrow(
        _hashes(bits, tables, seed),
        "rep long, weight long, x binary, sigs binary, buckets array<long>"), "hashed")
    spread = hashed.select("rep", "weight", "x", "sigs", F.length("x").cast("long").alias("dim"),
                           F.posexplode("buckets").alias("t", "bucket"))
    spread = spread.withColumn("t", F.col("t").cast("long"))
    full = (spread.groupBy("t", "dim", "bucket").agg(F.count("*").alias("n_rows"))
            .filter(F.col("n_rows") > block_rows)
            .select("t", "dim", "bucket", F.ceil(F.col("n_rows") / block_rows).cast("int").alias("blocks")))
    full = stage_table(full, "full")
    cut = (spread.join(full, ["t", "dim", "bucket"], "left")
           .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
           .withColumn("sub", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("long"))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks").cast("long") - 1)))
           .select("t", "dim", "bucket", F.least("sub", "other").alias("lo"),
                   F.greatest("sub", "other").alias("hi"), "sub", "rep", "weight", "x", "sigs"))
    keys = ["t", "dim", "bucket", "lo", "hi"]
    found = stage_table(cut.repartition(*keys).sortWithinPartitions(*keys)
                        .mapInArrow(_bucket_links(threshold), "rep long, links long, root long"), "links")
    drop_stage(hashed, full)
    return found


def embedding_dedup(embeddings: DataFrame, threshold: float = 0.9, **options) -> DataFrame:
    """vec_id, n_links, component_id, kept for each vector; see the module's docstring."""
    every = (vectors(embeddings).withColumn("k1", F.xxhash64("e"))
             .withColumn("k2", F.xxhash64(F.reverse("e"))))
    reps = stage_table(every.filter("ok").groupBy("k1", "k2")
                       .agg(F.min("vec").alias("rep"), F.count("*").alias("weight"),
                            F.min_by("e", "vec").alias("e")), "vectors")
    n = reps.count()
    found = near_links(reps.select("rep", "weight", "e"), n, threshold, **options)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    parts = connected_components(found.filter("rep <> root")
                                 .select(F.col("rep").alias("u"), F.col("root").alias("v")))
    known = (reps.select("k1", "k2", "rep", "weight").join(links, "rep", "left")
             .join(parts, F.col("rep") == F.col("node"), "left")
             .select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
                     F.coalesce("component", "rep").alias("root"), F.lit(True).alias("known")))
    out = (every.select("vec", F.when(F.col("ok"), F.col("k1")).alias("k1"), "k2")
           .join(known, ["k1", "k2"], "left")
           .select("vec", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                   F.coalesce("root", "vec").alias("root")))
    return out.select(id_value("vec").alias("vec_id"), "n_links", id_value("root").alias("component_id"),
                      (F.col("vec") == F.col("root")).alias("kept"))
