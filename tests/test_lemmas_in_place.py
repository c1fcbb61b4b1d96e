"""Dictionary forms from a small table: words are replaced where they lie; equal ids are one document."""

from __future__ import annotations

import pytest

from marketlens.operators import text
from tests.test_term_stats import WORDS, some_documents


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("rows_in_place", [0, 100])
def test_lemmas_are_replaced_where_the_words_lie(spark, monkeypatch, repeated, rows_in_place):
    monkeypatch.setattr(text, "BROADCAST_ROWS", rows_in_place)
    rows = [*some_documents(3, repeated), (1000, None), (1001, ["w1", None, "w3"])]
    lemmas = spark.createDataFrame([("w1", "one"), ("w3", None), ("w7", "a")], "token string, lemma string")
    form = {"w1": "one", "w7": "a"}
    expected = {}
    for i, ws in rows:
        expected.setdefault(i, []).extend((k, form.get(w, w)) for k, w in enumerate(ws or []))
    out = text.substitute_lemmas(spark.createDataFrame(rows, WORDS), "doc_id", "words", lemmas)
    got = out.collect()
    assert len(got) == len(expected)
    assert {r["doc_id"]: r["lemmas"] for r in got} == {
        i: [w for _, w in sorted(pairs, key=lambda p: (p[0], p[1] or ""))] for i, pairs in expected.items()}
    if rows_in_place and not repeated:
        assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
