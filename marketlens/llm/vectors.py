"""Shared by the two embedding operators: which vectors take part, and Arrow access."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of, id_key


def usable(col: str) -> Column:
    """Not null, not empty, every component finite, not all zero."""
    wide = F.transform(F.col(col), lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(col).isNotNull() & finite & F.exists(wide, lambda x: x != 0.0), F.lit(False))


def vectors(embeddings: DataFrame) -> DataFrame:
    """(vec, e, ok): ids (null: the smallest id), components in double, usable or not."""
    return (columns_of(embeddings, "vec_id", "embedding")
            .select(id_key("vec_id").alias("vec"),
                    F.transform("embedding", lambda x: x.cast("double")).alias("e"),
                    usable("embedding").alias("ok")))


def matrices(array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and a matrix for each length of vector in an Arrow list column."""
    offsets = array.offsets.to_numpy()
    flat = array.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    out = []
    for dim in np.unique(size):
        rows = np.flatnonzero(size == dim)
        out.append((rows, flat[offsets[rows][:, None] + np.arange(dim)[None, :]]))
    return out


def planes(count: int, dim: int, seed: int) -> np.ndarray:
    """Random hyperplanes through the origin, the same on every executor."""
    return np.random.default_rng([seed, dim]).standard_normal((count, dim))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one (first by their largest component, so that no square
    overflows or vanishes)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
