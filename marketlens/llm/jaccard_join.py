r"""N-gram Jaccard join with prefix filters under several global token orders.

Words are runs of anything but ASCII white space, A-Z lower-cased.  A document's set are
its distinct ``n``-word shingles (the whole sequence, if it has fewer words), as 64-bit
hashes.  Two documents link when ``100 * |A and B| >= percent * |A or B|``.

Equal sets collapse to one representative first.  Under a global order of shingles, two
sets that link share a shingle among their first ``|A| - ceil(t |A|) + 1``.  All orders
here put frequent shingles last, so that common lines and passages seldom are in a
prefix (frequency classes come from counts of all shingles in hashed cells: a fixed
number of cells, and any order is a valid one), and differ in the hash that orders a
class.  A candidate pair shares a prefix shingle under the first order.  A bound
comes first: with the hashes counted in cells, the intersection is at most the sum of the
cells' smaller counts, and pairs that this bound rules out are dropped.  Of the others,
those that also share a prefix shingle under each of the other orders have their whole
sets compared; only the texts of their documents are read again for it.

Groups of copies must not cost the square of their size: in a first round every prefix
shingle proposes only pairs with one document, its hub.  Verified links give components;
what remains are pairs in different components that share a prefix shingle.  For each
shingle, the documents outside its largest component meet all others, one by one if
those are in small components, else block by block: a document and a block of a large
component are one row, compared inside a task.  All that meet are verified, whatever
their number, so no link between different components is lost.

Nulls and edge cases: a null, empty or blank text has an empty set and links with
nothing; a null doc_id counts as the smallest id; rows that repeat a doc_id are one node
that has the links of all its rows (in ``one_of_each``, rows of one id with different
texts are nodes of their own); an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import (RollingHash, columns_of, connected_components, drop_stage, id_key,
                                   id_value, mix64, released_shuffles, row_chunks, stage_table, text_bytes, text_digest)

CELL_BITS = 22       # of the cells in which all shingles are counted
CELL_BLOCK = 1 << 12
LARGE = 32           # documents of a component that is compared in blocks
BLOCK = 512
ORDERS = 3


def _tables() -> tuple[np.ndarray, np.ndarray]:
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A"):ord("Z") + 1] += 32
    return space, lower


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int, hasher: RollingHash):
    """(row, hash) of the rows' distinct shingles, ordered by row and hash."""
    space, lower = _tables()
    inside = ~space[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begin[firsts] = inside[firsts]
    over = np.ones(len(data), bool)
    over[:-1] = ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    over[lasts] = True
    start, end = np.flatnonzero(begin), np.flatnonzero(over & inside) + 1
    word = mix64(hasher.at(hasher.prefix(lower[data]), start, end) ^ (end - start).astype(np.uint64))
    row = np.searchsorted(offsets, start, side="right") - 1
    words = np.bincount(row, minlength=len(offsets) - 1)
    factor = np.uint64(0x9E3779B97F4A7C15)
    size = len(word) - n + 1
    if size > 0:
        whole = word[:size].copy()
        for k in range(1, n):
            whole = whole * factor + word[k:k + size]
        at = np.flatnonzero(row[:size] == row[n - 1:])
        rows, hashes = row[at], mix64(whole[at])
    else:
        rows, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    short = np.flatnonzero((words > 0) & (words < n))
    if len(short):
        first = np.searchsorted(row, short)
        few = word[first].copy()
        for k in range(1, n - 1):
            more = words[short] > k
            few[more] = few[more] * factor + word[first[more] + k]
        rows = np.concatenate([rows, short])
        hashes = np.concatenate([hashes, mix64(few + words[short].astype(np.uint64))])
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    fresh = np.ones(len(rows), bool)
    fresh[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[fresh], hashes[fresh]


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def _prefix_places(rows, hashes, counts, classes, percent, order):
    """(rows, places) of the hashes in each row's prefix under one global order."""
    cell = classes[(hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    seed = np.uint64(order * 0x632BE59BD9B4E019 % 2 ** 64)
    by = np.lexsort((mix64(hashes ^ seed), cell, rows))
    first = np.cumsum(counts) - counts
    place = np.arange(len(rows)) - first[rows]
    take = place < prefix_size(counts, percent)[rows]
    return rows[by[take]], by[take]


def _prefixes(rows, hashes, counts, classes, percent, order):
    at = _prefix_places(rows, hashes, counts, classes, percent, order)[1]
    return rows[at], hashes[at]


def _chunks(batches, n: int, text_at: int = 1):
    hasher = RollingHash()
    for batch in batches:
        data, offsets = text_bytes(batch.column(text_at))
        for a, b in row_chunks(offsets, 1 << 20):
            base = offsets[a]
            rows, hashes = shingle_sets(data[base:offsets[b]], offsets[a:b + 1] - base, n, hasher)
            yield batch.slice(a, b - a), rows, hashes, np.bincount(rows, minlength=b - a)


def _cells(n: int):
    """Per task: counts of all cells, one row for each block of cells."""
    def run(batches):
        import pyarrow as pa

        total = np.zeros(1 << CELL_BITS, np.uint32)
        for _, _, hashes, _ in _chunks(batches, n, 0):
            np.add.at(total, (hashes >> np.uint64(64 - CELL_BITS)).astype(np.int64), 1)
        rows = total.reshape(-1, CELL_BLOCK)
        seen = np.flatnonzero(rows.any(axis=1))
        if len(seen):
            yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array([rows[k].tobytes() for k in seen], pa.binary())],
                                             names=["block", "counts"])
    return run


def _add_cells(rows):
    import pyarrow as pa

    total = np.zeros(CELL_BLOCK, np.uint64)
    for c in rows["counts"].to_pylist():
        total += np.frombuffer(c, np.uint32)
    return pa.table([pa.array([rows["block"][0].as_py()], pa.int64()), pa.array([total.tobytes()], pa.binary())],
                    names=["block", "counts"])


def _lists(values, counts, kind):
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _cell_counts(rows, hashes, counts):
    """For each row, its hashes counted in at least twice as many cells (a power of two);
    a cell's number are the hash's first bits."""
    bits = np.clip(np.ceil(np.log2(np.maximum(2 * counts, 2))), 6, 24).astype(np.int64)
    size = np.where(counts > 0, 1 << bits, 0)
    base = np.cumsum(size) - size
    at = base[rows] + (hashes >> (64 - bits[rows]).astype(np.uint64)).astype(np.int64)
    cells = np.minimum(np.bincount(at, minlength=int(size.sum())), 255).astype(np.uint8)
    return [cells[x:x + n].tobytes() for x, n in zip(base, size, strict=True)]


def _folded(cells: np.ndarray, size: int) -> np.ndarray:
    return cells.astype(np.int64).reshape(size, -1).sum(axis=1)


def _may_link(a: np.ndarray, b: np.ndarray, n: int, m: int, percent: int) -> bool:
    if a.max() == 255 or b.max() == 255:
        return True  # a count that is not whole
    size = min(len(a), len(b))
    most = int(np.minimum(_folded(a, size), _folded(b, size)).sum())
    return 100 * most >= percent * (n + m - most)


def _bounded(percent: int):
    """The candidate pairs (u, v) whose cells don't rule a link out."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            n, m = (batch.column(k).to_numpy() for k in (2, 4))
            a, b = batch.column(3), batch.column(5)
            hit = [i for i in range(batch.num_rows)
                   if _may_link(np.frombuffer(a[i].as_buffer(), np.uint8), np.frombuffer(b[i].as_buffer(), np.uint8),
                                int(n[i]), int(m[i]), percent)]
            take = pa.array(hit, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], names=["u", "v"])
    return run


def _prefix_rows(n: int, percent: int, classes: np.ndarray):
    """doc, set size, two digests of the set, its cells, prefix under the first order."""
    def run(batches):
        import pyarrow as pa

        for part, rows, hashes, counts in _chunks(batches, n):
            starts = np.minimum(np.cumsum(counts) - counts, max(len(hashes) - 1, 0))
            digest = []
            for seed in (1, 2):
                mixed = mix64(hashes * np.uint64(2) + np.uint64(seed))
                sums = np.add.reduceat(mixed, starts) if len(mixed) else np.zeros(len(counts), np.uint64)
                digest.append(np.where(counts > 0, sums, np.uint64(0)).view(np.int64))
            p_rows, p = _prefixes(rows, hashes, counts, classes, percent, 1)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts.astype(np.int64)), pa.array(digest[0]), pa.array(digest[1]),
                 pa.array(_cell_counts(rows, hashes, counts), pa.binary()),
                 _lists(p.view(np.int64), np.bincount(p_rows, minlength=len(counts)), pa.int64())],
                names=["doc", "n", "s1", "s2", "cells", "prefix"])
    return run


def _set_rows(n: int, percent: int, classes: np.ndarray):
    """doc, its whole set as sorted hashes, and which of them are in its prefixes under
    the other orders."""
    def run(batches):
        import pyarrow as pa

        for part, rows, hashes, counts in _chunks(batches, n):
            cut = np.concatenate([[0], np.cumsum(counts)])
            columns = [part.column(0),
                       pa.array([hashes[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())]
            for order in range(2, ORDERS + 1):
                _, at = _prefix_places(rows, hashes, counts, classes, percent, order)
                inside = np.zeros(len(hashes), bool)
                inside[at] = True
                columns.append(pa.array([np.packbits(inside[x:y]).tobytes()
                                         for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc", "whole", "p2", "p3"])
    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum()) if len(b) else 0


def _verify(percent: int):
    """(u, v) of the candidate pairs that pass the other orders' filters and link."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            u, v = batch.column(0), batch.column(1)
            columns = [batch.column(k) for k in range(2, 8)]
            hit = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(columns[k][i].as_buffer(), np.uint64) for k in (0, 3))
                x2, x3, y2, y3 = (s[np.unpackbits(np.frombuffer(columns[k][i].as_buffer(), np.uint8), count=len(s))
                                    .astype(bool)] for k, s in ((1, x), (2, x), (4, y), (5, y)))
                if not _common(x2, y2) or not _common(x3, y3):
                    continue
                both = _common(x, y)
                if 100 * both >= percent * (len(x) + len(y) - both):
                    hit.append(i)
            take = pa.array(hit, pa.int64())
            yield pa.RecordBatch.from_arrays([u.take(take), v.take(take)], names=["u", "v"])
    return run


class _Cells:
    """The cell counts of a block's documents, as one matrix for each number of cells."""

    def __init__(self, docs: np.ndarray, sizes: np.ndarray, cells: list[bytes]):
        self.groups = []
        length = np.array([len(c) for c in cells])
        for k in np.unique(length):
            at = np.flatnonzero(length == k)
            counts = np.frombuffer(b"".join(cells[i] for i in at), np.uint8).reshape(len(at), k).astype(np.int32)
            self.groups.append((docs[at], sizes[at], (counts == 255).any(axis=1), {int(k): counts}))

    def may_link(self, m: int, cells: np.ndarray, percent: int) -> np.ndarray:
        """Documents of the block that the bound doesn't rule out."""
        mine, out = {len(cells): cells.astype(np.int32)}, []
        for docs, n, whole, folded in self.groups:
            size = min(max(folded), len(cells))
            for counts in (folded, mine):
                if size not in counts:
                    full = counts[max(counts)]
                    counts[size] = full.reshape(*full.shape[:-1], size, -1).sum(axis=-1, dtype=np.int32)
            most = np.minimum(folded[size], mine[size]).sum(axis=1)
            keep = 100 * most >= percent * (n + m - most)
            keep |= whole | (cells.max() == 255)
            keep &= 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
            out.append(docs[keep])
        return np.concatenate(out)


def _bounded_blocks(percent: int):
    """Pairs of a block's documents with those that came to meet them, under the bound."""
    def run(key, members, others):
        import pyarrow as pa

        u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if members.num_rows and others.num_rows:
            block = _Cells(members["doc"].to_numpy(), members["n"].to_numpy(), members["cells"].to_pylist())
            for x, m, c in zip(others["x"].to_pylist(), others["n"].to_pylist(), others["cells"].to_pylist(), strict=True):
                near = block.may_link(m, np.frombuffer(c, np.uint8), percent)
                u.append(np.minimum(near, x))
                v.append(np.maximum(near, x))
        return pa.table([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))], names=["u", "v"])
    return run


def _may_share(n: str, pos: str, m: str, pos2: str, percent: int) -> Column:
    """Whether a shingle at these places can be the first that two linked sets share: all
    of their intersection is at or after it in both."""
    left = F.least(F.col(n) - F.col(pos), F.col(m) - F.col(pos2))
    return left * (100 + percent) >= F.lit(percent) * (F.col(n) + F.col(m))


def _pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
    return rows.select(F.least(x, y).alias("u"), F.greatest(x, y).alias("v")).distinct()


def _keyed(shared: DataFrame, percent: int) -> DataFrame:
    """Prefix shingles under the size classes in which their documents can meet others.

    Sets that link are in the same class or in neighbouring ones; key k is where classes
    k and k + 1 meet.  The smallest size under a key bounds the intersection from below,
    and so shortens the prefix: to about half of it among sets of like size."""
    ratio = 1.01 * 100 / percent
    size = F.floor(F.log("n") / F.lit(float(np.log(ratio)))).cast("int")
    least = F.floor(F.pow(F.lit(ratio), F.col("key")) * (1 - 1e-9))
    return (shared.withColumn("class", size)
            .withColumn("key", F.explode(F.array(F.col("class"), F.col("class") - 1)))
            .filter((F.col("n") - F.col("pos")) * (100 + percent) >= percent * (F.col("n") + least)))


def _apart(keyed: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows whose shingle and key are met in several components, as a stage table,
    with component, its size, and whether it has most of the documents there."""
    names = ["tok", "key", "class", "pos", "doc", "n"]
    placed = (keyed.join(parts, F.col("doc") == F.col("node"), "left")
              .select(*names, F.coalesce("component", "doc").alias("part")))
    counts = placed.groupBy("tok", "key", "part").agg(F.count("*").alias("c"))
    mixed = (counts.groupBy(F.col("tok").alias("tok2"), F.col("key").alias("key2"))
             .agg(F.max(F.struct("c", F.col("part"))).alias("top"), F.count("*").alias("k")).filter("k > 1"))
    members = parts.groupBy(F.col("component").alias("of")).agg(F.count("*").alias("size"))
    return stage_table(
        placed.join(mixed, (F.col("tok") == F.col("tok2")) & (F.col("key") == F.col("key2")))
        .join(members, F.col("part") == F.col("of"), "left")
        .select(*names, "part", (F.col("part") == F.col("top.part")).alias("main"),
                F.coalesce("size", F.lit(1)).alias("size")), "mixed")


def _close(pairs: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (u, v) that the bound leaves."""
    a = cells.select(F.col("doc").alias("u"), "n", "cells")
    b = cells.select(F.col("doc").alias("v"), F.col("n").alias("m"), F.col("cells").alias("cells2"))
    return (pairs.join(a, "u").join(b, "v").select("u", "v", "n", "cells", "m", "cells2")
            .mapInArrow(_bounded(percent), "u long, v long").distinct())


def _close_blocks(placed: DataFrame, others: DataFrame, cells: DataFrame, percent: int) -> DataFrame:
    """Pairs of large components' documents with documents of other components that share
    a prefix shingle with some of theirs.  What meets is a document and a block of a
    component, so a group of copies is not expanded into pairs."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    large = placed.filter(F.col("size") >= LARGE).withColumn("block", F.pmod(F.xxhash64("doc"), blocks))
    there = large.groupBy("tok", "key", "part", "block").agg(F.max(F.col("n") - F.col("pos")).alias("rest"),
                                                             F.min("n").alias("low"))
    needed = percent * (F.col("m") + F.col("low"))
    met = (there.join(others, ["tok", "key"])
           .filter((F.col("part") != F.col("part2")) & ((100 + percent) * F.col("rest") >= needed)
                   & ((100 + percent) * (F.col("m") - F.col("pos2")) >= needed))
           .select("part", "block", "x").distinct())
    chunks = (met.groupBy("part", "block").agg(F.count("*").alias("c"))
              .select("part", "block", F.ceil(F.col("c") / (4 * BLOCK)).cast("long").alias("chunks")))
    right = stage_table(met.join(chunks, ["part", "block"]).withColumn("chunk", F.pmod(F.xxhash64("x"), F.col("chunks")))
             .join(cells.withColumnRenamed("doc", "x"), "x").select("part", "block", "chunk", "x", "n", "cells"), "meeting")
    left = (large.select("part", "block", "doc").distinct().join(chunks, ["part", "block"])
            .withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
            .join(cells, "doc").select("part", "block", "chunk", "doc", "n", "cells"))
    keys = ["part", "block", "chunk"]
    return (left.groupBy(*keys).cogroup(right.groupBy(*keys))
            .applyInArrow(_bounded_blocks(percent), "u long, v long").distinct())


def _linked(close: DataFrame, docs: DataFrame, n: int, percent: int, classes: np.ndarray) -> DataFrame:
    """The pairs (u, v) of a stage table that link, as a stage table."""
    if close.isEmpty():
        return close
    wanted = close.select(F.explode(F.array("u", "v")).alias("doc")).distinct()
    sets = stage_table(docs.join(wanted, "doc", "left_semi")
                       .mapInArrow(_set_rows(n, percent, classes), "doc long, whole binary, p2 binary, p3 binary"),
                       "sets")
    x = sets.select(F.col("doc").alias("u"), "whole", "p2", "p3")
    y = sets.select(F.col("doc").alias("v"), F.col("whole").alias("w2"), F.col("p2").alias("q2"), F.col("p3").alias("q3"))
    both = close.join(x, "u").join(y, "v").select("u", "v", "whole", "p2", "p3", "w2", "q2", "q3")
    found = stage_table(both.mapInArrow(_verify(percent), "u long, v long"), "linked")
    drop_stage(close, sets)
    return found


def frequency_classes(docs: DataFrame, n: int) -> np.ndarray:
    """The class of each cell of shingles: 0 up to an ordinary count, then by size."""
    counted = (docs.select("text").mapInArrow(_cells(n), "block long, counts binary")
               .groupBy("block").applyInArrow(_add_cells, "block long, counts binary"))
    total = np.zeros((1 << CELL_BITS) // CELL_BLOCK * CELL_BLOCK, float).reshape(-1, CELL_BLOCK)
    with released_shuffles(docs.sparkSession):
        for r in counted.collect():  # one row a block of cells
            total[r["block"]] = np.frombuffer(r["counts"], np.uint64)
    total = total.reshape(-1)
    middle = max(float(np.median(total)), 1.0)
    spread = 1 + 3 / np.sqrt(middle)  # what chance alone puts into a cell
    return np.clip(np.ceil(4 * np.log2(np.maximum(total / (middle * spread), 1.0))), 0, 250).astype(np.uint8)


def jaccard_components(documents: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc (id key), n_shingles, component (id key) for each row of ``documents``."""
    docs = columns_of(documents, "doc_id", "text").select(id_key().alias("doc"), "text")
    classes = frequency_classes(docs, n)
    prefixes = stage_table(docs.mapInArrow(
        _prefix_rows(n, percent, classes), "doc long, n long, s1 long, s2 long, cells binary, prefix array<long>"),
        "prefixes")
    same = ["s1", "s2", "n"]
    reps = stage_table(prefixes.filter("n > 0").groupBy(*same).agg(F.min("doc").alias("rep")), "reps")
    tokens = (prefixes.filter("n > 0").join(reps.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi")
              .select("doc", "n", F.posexplode("prefix").alias("pos", "tok")))
    tokens = stage_table(tokens, "tokens")
    hubs = (tokens.groupBy("tok").agg(F.min(F.struct("pos", "doc", "n")).alias("hub"), F.min("doc").alias("low"),
                                      F.max("doc").alias("far"))
            .filter("low < far").select(F.col("tok").alias("tok2"), "hub"))
    shared = stage_table(tokens.join(hubs, F.col("tok") == F.col("tok2")).select("tok", "pos", "doc", "n", "hub"), "shared")
    drop_stage(tokens)
    cells = prefixes.select("doc", "n", "cells")
    star = shared.filter((F.col("doc") != F.col("hub.doc")) & _may_share("n", "pos", "hub.n", "hub.pos", percent))
    links = _linked(stage_table(_close(_pairs(star, "doc", "hub.doc"), cells, percent), "close"), docs, n, percent, classes)
    parts = stage_table(connected_components(links), "parts")
    # pairs left over: they share a prefix shingle and are in different components
    placed = _apart(_keyed(shared.select("tok", "pos", "doc", "n"), percent), parts)
    hubs = (placed.groupBy("tok", "key").agg(F.min(F.struct("pos", "doc", "n", "part", "class")).alias("hub"))
            .select(F.col("tok").alias("tok2"), F.col("key").alias("key2"), "hub"))
    star = (placed.join(hubs, (F.col("tok") == F.col("tok2")) & (F.col("key") == F.col("key2")))
            .filter((F.col("part") != F.col("hub.part")) & _may_share("n", "pos", "hub.n", "hub.pos", percent)))
    more = _linked(stage_table(_close(_pairs(star, "doc", "hub.doc"), cells, percent), "close"), docs, n, percent, classes)
    if not more.isEmpty():
        links = stage_table(links.unionByName(more), "links")
        drop_stage(parts)
        parts = stage_table(connected_components(links), "parts")
        placed = _apart(placed.select("tok", "key", "class", "pos", "doc", "n"), parts)
    others = placed.filter(~F.col("main")).select("tok", "key", F.col("doc").alias("x"), F.col("n").alias("m"),
                                                  F.col("pos").alias("pos2"), F.col("class").alias("class2"),
                                                  F.col("part").alias("part2"))
    met = (placed.filter(F.col("size") < LARGE).join(others, ["tok", "key"])
           .filter((F.col("part") != F.col("part2")) & _may_share("n", "pos", "m", "pos2", percent)
                   & ((F.col("class") == F.col("key")) | (F.col("class2") == F.col("key")))))
    close = stage_table(_close(_pairs(met, "doc", "x"), cells, percent)
                        .unionByName(_close_blocks(placed, others, cells, percent)).distinct(), "close")
    last = _linked(close, docs, n, percent, classes)
    if not last.isEmpty():
        parts = connected_components(links.unionByName(last))
    out = (prefixes.select("doc", "n", "s1", "s2").join(reps, same, "left")
           .join(parts, F.col("rep") == F.col("node"), "left")
           .select("doc", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc").alias("component")))
    # rows that repeat an id are one node: it is in the smallest of their components
    out = stage_table(out, "jaccard")
    drop_stage(shared, links, placed, more, last, prefixes, reps)
    return out


def jaccard_join(documents: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id for each document."""
    out = jaccard_components(documents, n, percent)
    return out.select(id_value("doc").alias("doc_id"), "n_shingles", id_value("component").alias("component_id"))


def _nodes(documents: DataFrame) -> tuple[DataFrame, Column]:
    """(node, id, d1, d2) of the pairs of id and text in ``documents``, as a stage table,
    and the expression that gives a row's node: a 64-bit hash under the first seed that
    gives no two pairs the same one."""
    text = [F.coalesce(d, F.lit(0).cast("long")) for d in text_digest(F.col("text"))]
    for seed in range(20):
        node = F.xxhash64(F.lit(seed), id_key(), F.col("text").isNull(), *text)
        nodes = stage_table(documents.select(node.alias("node"), id_key().alias("id"), F.col("text").isNull().alias("none"),
                                             text[0].alias("d1"), text[1].alias("d2")).distinct(), "nodes")
        with released_shuffles(documents.sparkSession):
            apart = nodes.groupBy("node").agg(F.count("*").alias("c")).filter("c > 1").isEmpty()
        if apart:
            return nodes, node
        drop_stage(nodes)
    raise RuntimeError("one_of_each: no seed tells all documents apart")


def one_of_each(documents: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, with all its columns: the smallest id, of rows that
    repeat it the smallest text digest.  Nodes are pairs of id and text, so only rows that
    are alike in both or linked by similarity are dropped."""
    names = documents.columns
    nodes, node = _nodes(documents)
    parts = jaccard_components(documents.select(node.alias("doc_id"), "text"), n, percent)
    kept = (parts.select(F.col("doc").alias("node"), "component").join(nodes, "node").groupBy("component")
            .agg(F.min(F.struct("id", "none", "d1", "d2", "node")).alias("least")).select(F.col("least.node").alias("_kept")))
    rows = (documents.select(node.alias("_node"), F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"))
            .groupBy("_node").agg(F.min("_row").alias("_row")))  # combined before the shuffle
    return (rows.join(kept, F.col("_node") == F.col("_kept"), "left_semi")
            .select(*[F.col(f"_row.`{c}`") for c in names]))
