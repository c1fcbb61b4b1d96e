from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """``documents`` from (doc_id, text) or (doc_id, text, source) rows, with columns
    whose names clash with the operators' own."""
    def build(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]),
                 "x", 7, 1.5, "y") for r in rows]
        return spark.createDataFrame(full, DOCS + ", doc string, size int, key double, part string")
    return build


@pytest.fixture
def embeddings(spark):
    def build(rows):
        return spark.createDataFrame([(i, v, 0, 1, "z") for i, v in rows],
                                     "vec_id long, embedding array<float>, label int, rep int, e string")
    return build
