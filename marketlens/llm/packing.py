"""Best-fit packing under conflicts.

Documents are cut into pieces of at most ``capacity`` words and packed into bins of that
capacity.  Two pieces in one bin must not come from one source, nor from one cluster of
duplicates (equal texts; the pieces of a document are in one cluster as well).

Open bins are kept in the order of their residual capacity and carry two bitmaps, of the
sources and of the duplicate clusters inside.  Pieces come largest first; the search
starts at the smallest residual that holds the piece and goes on to the next larger ones
until a bin is found whose bitmaps don't meet the piece's bits: the tightest compatible
bin.  If there is none, a bin is opened.  Bins of equal residual and equal source bitmap
are tried together, so a frequent source doesn't make the search long.

Work is dealt by a hash of the document into parts of about ``part_rows`` documents that
are packed apart, whatever their source or cluster; thousands of documents are enough
for tight bins, and a part's memory is bounded.

Nulls and edge cases: a null or empty text has no words and gets one row without a bin;
a null source is a source of its own; a null doc_id is packed as any other; rows that
repeat a document are duplicates and never share a bin; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of, stage_table
from marketlens.llm.mixing import word_count

CAPACITY = 2048


class Bins:
    """Open bins by residual, then by source bitmap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []                     # sorted, without repeats
        self.at: dict[int, dict[int, list[int]]] = {}      # residual -> sources -> bins
        self.clusters: list[int] = []                      # cluster bitmap of each bin

    def _insert(self, residual: int, sources: int, bin_: int) -> None:
        if residual == 0:
            return  # full
        if residual not in self.at:
            bisect.insort(self.residuals, residual)
            self.at[residual] = {}
        self.at[residual].setdefault(sources, []).append(bin_)

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """The piece's bin and its offset there; ``source`` and ``cluster`` are bits."""
        for k in range(bisect.bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[k]
            for sources, bins in self.at[residual].items():
                if sources & source:
                    continue
                for n, bin_ in enumerate(bins):
                    if self.clusters[bin_] & cluster:
                        continue
                    bins.pop(n)
                    if not bins:
                        del self.at[residual][sources]
                        if not self.at[residual]:
                            del self.at[residual]
                            self.residuals.pop(k)
                    self.clusters[bin_] |= cluster
                    self._insert(residual - size, sources | source, bin_)
                    return bin_, self.capacity - residual
        self.clusters.append(cluster)
        self._insert(self.capacity - size, source, len(self.clusters) - 1)
        return len(self.clusters) - 1, 0


def pack_part(pieces: list[tuple], capacity: int) -> list[tuple[int, int]]:
    """(bin, offset) of each piece (size, source, cluster), which come largest first."""
    bins, source_bit, seen, cluster_bit = Bins(capacity), {}, {}, {}
    for _, _, cluster in pieces:
        seen[cluster] = seen.get(cluster, 0) + 1
    out = []
    for size, source, cluster in pieces:
        s = source_bit.setdefault(source, 1 << len(source_bit))
        c = 0
        if seen[cluster] > 1:  # others can't conflict
            c = cluster_bit.setdefault(cluster, 1 << len(cluster_bit))
        out.append(bins.place(size, s, c))
    return out


def _pack(capacity: int):
    def run(rows):
        import pyarrow as pa

        rows = rows.sort_by([("size", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"),
                             ("piece", "ascending"), ("source", "ascending")])
        placed = pack_part(list(zip(rows["size"].to_pylist(), rows["source"].to_pylist(),
                                    rows["cluster"].to_pylist(), strict=True)), capacity)
        part = rows["part"]
        return pa.table([rows["doc_id"], rows["source"], rows["piece"], rows["size"], part,
                         pa.array([b for b, _ in placed], pa.int64()),
                         pa.array([o for _, o in placed], pa.int64())],
                        names=["doc_id", "source", "piece", "size", "part", "bin", "bin_offset"])
    return run


def pack(documents: DataFrame, capacity: int = CAPACITY, part_rows: int = 4096) -> DataFrame:
    """One row a piece: doc_id, source, piece (from 0), size in words, the bin as part
    and number within the part, and the offset in words inside the bin."""
    sized = stage_table(
        columns_of(documents, "doc_id", "source", "text")
        .select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count(F.col("text")).alias("words"),
                F.xxhash64("text").alias("cluster")), "sized")
    parts = max(1, math.ceil(sized.count() / part_rows))
    last = F.floor((F.col("words") - 1) / capacity)
    pieces = (sized.filter("words > 0")
              .withColumn("part", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(parts)).cast("long"))
              .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
              .withColumn("size", F.least(F.col("words") - F.col("piece") * capacity, F.lit(capacity)).cast("long")))
    packed = (pieces.select("doc_id", "source", "piece", "size", "part", "cluster").groupBy("part")
              .applyInArrow(_pack(capacity), "doc_id long, source string, piece long, size long, part long, "
                                             "bin long, bin_offset long"))
    empty = sized.filter("words = 0").select(
        "doc_id", "source", F.lit(0).cast("long").alias("piece"), F.lit(0).cast("long").alias("size"),
        *[F.lit(None).cast("long").alias(c) for c in ("part", "bin", "bin_offset")])
    return packed.unionByName(empty)
