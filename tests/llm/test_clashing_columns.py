"""Every name that the row-keeping operators use inside, as a further column."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marketlens.llm.importance import resample
from marketlens.llm.jaccard_join import one_of_each
from marketlens.llm.mixing import mix_documents
from marketlens.llm.pii import redact

NAMES = ["mark", "row", "d", "m", "_d", "_m", "base", "more", "spans", "mention", "start", "kind", "value", "_size",
         "_mark", "_key", "_copies", "_copy", "_row", "size", "copies", "rate", "u", "before", "weight", "_bin",
         "_log_weight", "_n_grams", "key", "bucket", "good", "_good", "_id", "_node", "_kept", "node", "component",
         "a.b", "doc", "n", "tok", "part"]


@pytest.fixture
def clashing(spark):
    texts = ["river stone light house of the and walk " * 3 + f"w{i}" for i in range(12)]
    texts += ["mail ann@example.org now", "call +49 30 1234567 0", None, ""]
    rows = spark.createDataFrame([(i, t, "en", "ab"[i % 2], 5) for i, t in enumerate(texts)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    return rows.select("*", *[F.lit(i).alias(n) for i, n in enumerate(NAMES)])


def kept_whole(out, given):
    assert out.columns == given.columns
    rows = out.collect()
    assert rows and all([r[n] for n in NAMES] == list(range(len(NAMES))) for r in rows)
    return rows


def test_redact(clashing):
    rows = {r["doc_id"]: r["text"] for r in kept_whole(redact(clashing), clashing)}
    assert rows[12] == "mail [EMAIL] now" and rows[13] == "call [PHONE]" and rows[14] is None
    assert len(rows) == 16


def test_mix_documents(clashing):
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    got = sorted(r["doc_id"] for r in kept_whole(mix_documents(clashing), clashing))
    assert set(got) <= set(range(16)) and mix_documents(plain).count() > 0


def test_resample(spark, clashing):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert len(kept_whole(resample(clashing, labels), clashing)) == 16


def test_one_of_each(clashing):
    rows = kept_whole(one_of_each(clashing), clashing)
    assert {12, 13, 14, 15} <= {r["doc_id"] for r in rows}
