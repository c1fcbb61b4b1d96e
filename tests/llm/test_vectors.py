from __future__ import annotations

import numpy as np
import pytest

from marketlens.llm.embedding_dedup import embedding_dedup, table_plan
from marketlens.llm.hash_forest import nearest


def brute_links(rows, threshold=0.9):
    good = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    near = {i: {j for j, w in good.items() if j != i and len(w) == len(v)
                and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold} for i, v in good.items()}
    out = {}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(near.get(i, ())), min(seen), min(seen) == i)
    return out


def sample(n=300, dim=16):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((n, dim)).astype(np.float32)
    for i in range(0, n, 5):  # near copies, chains and exact copies
        x[i + 1] = x[i] + 0.1 * rng.standard_normal(dim)
        x[i + 2] = x[i + 1] + 0.25 * rng.standard_normal(dim)
        x[i + 3] = x[i]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [None, [], [0.0] * dim, [float("nan")] * dim, [float("inf")] + [1.0] * (dim - 1),
           [None] * dim, [1.0, 2.0], [2.0, 4.0]]
    return rows + [(1000 + i, v) for i, v in enumerate(odd)]


def links_of(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_links_equal_brute_force(embeddings):
    rows = sample()
    assert links_of(embedding_dedup(embeddings(rows))) == brute_links(rows)


def test_large_buckets_are_cut_into_blocks(embeddings):
    rng = np.random.default_rng(4)
    base = rng.standard_normal(8)
    rows = [(i, (base + 0.2 * rng.standard_normal(8)).astype(np.float32).tolist()) for i in range(200)]
    got = links_of(embedding_dedup(embeddings(rows), block_rows=16))
    assert got == brute_links(rows)


def test_table_plan_follows_the_data():
    assert table_plan(10 ** 9, 0.9, 200, 1e-6)[0] > table_plan(10 ** 4, 0.9, 200, 1e-6)[0]
    bits, tables = table_plan(10 ** 6, 0.9, 200, 1e-6)
    agree = 1 - np.arccos(0.9) / np.pi
    assert (1 - agree ** bits) ** tables <= 1e-6


def test_links_of_an_empty_table(embeddings):
    assert embedding_dedup(embeddings([])).collect() == []


def brute_nearest(rows, k):
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good
                            if j != i and len(w) == len(v))
            out[i] = [(n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return {i: v for i, v in out.items() if v}


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def test_nearest_with_all_candidates_is_exact(embeddings):
    rows = sample()
    got = answers(nearest(embeddings(rows), lambda v: v % 20 == 0, k=20, trees=8, share=8))
    want = brute_nearest(rows, 20)
    assert got.keys() == want.keys()
    for q, found in got.items():
        assert [x[:2] for x in found] == [x[:2] for x in want[q]]
        assert np.allclose([x[2] for x in found], [x[2] for x in want[q]], rtol=1e-12)


def test_recall_of_the_forest(embeddings):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = answers(nearest(embeddings(rows), lambda v: v % 20 == 0, k=20, block_rows=2000, chunk_rows=64))
    q = np.arange(0, 4000, 20)
    score = x[q] @ x.T
    score[np.arange(len(q)), q] = -9
    best = np.argsort(-score, axis=1)[:, :20]
    hits = [len({v for _, v, _ in got[int(i)]} & set(b.tolist())) for i, b in zip(q, best, strict=True)]
    assert np.mean(hits) / 20 >= 0.9


def test_nearest_edge_cases(embeddings):
    assert nearest(embeddings([]), lambda v: v % 20 == 0).collect() == []
    same = [(i, [1.0, 1.0]) for i in range(40)]
    got = answers(nearest(embeddings(same), lambda v: v % 20 == 0, k=5))
    assert [v for _, v, _ in got[0]] == [1, 2, 3, 4, 5]      # ties to the smaller id
    assert [v for _, v, _ in got[20]] == [0, 1, 2, 3, 4]


def test_repeated_rows_are_one_candidate_and_one_query(embeddings):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(60)]
    want = answers(nearest(embeddings(rows), lambda v: v % 20 == 0, k=20, trees=8, share=8))
    assert answers(nearest(embeddings(rows + rows[:30] + rows[:5]), lambda v: v % 20 == 0, k=20, trees=8, share=8)) == want
    # an id with two vectors: the smaller asks, each is a candidate of the others
    two = rows + [(20, [9.0, 9.0, 9.0, 9.0])]
    got = answers(nearest(embeddings(two), lambda v: v % 20 == 0, k=20, trees=8, share=8))
    asks = min(rows[20][1], [9.0] * 4)
    assert all(len(v) == 20 and [r for r, _, _ in v] == list(range(1, 21)) for v in got.values())
    assert got[20] == answers(nearest(embeddings([*rows[:20], (20, asks), *rows[21:]]), lambda v: v % 20 == 0, k=20, trees=8, share=8))[20]


def test_every_query_gets_k_rows_where_there_are_as_many(embeddings):
    """A query whose own id holds most of its range ascends until others are found."""
    rng = np.random.default_rng(3)
    near = (np.ones(8) + 1e-3 * rng.standard_normal((200, 8))).astype(np.float32)
    far = rng.standard_normal((50, 8)).astype(np.float32)
    rows = [(0, v.tolist()) for v in near] + [(i + 1, v.tolist()) for i, v in enumerate(far)]
    got = answers(nearest(embeddings(rows), lambda v: v % 20 == 0, k=20, share=0.01))
    assert sorted(got) == [0, 20, 40] and all(len(v) == 20 for v in got.values())
    assert all(v != 0 for _, v, _ in got[0])


def recall(got, x):
    q = np.arange(0, len(x), 20)
    score = x[q] @ x.T
    score[np.arange(len(q)), q] = -np.inf
    best = np.argsort(-score, axis=1, kind="stable")[:, :20]
    hits = [len({v for _, v, _ in got[int(i)]} & set(b.tolist())) for i, b in zip(q, best, strict=True)]
    return np.mean(hits) / 20, np.mean(np.array(hits) == 20)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_recall_with_the_registered_parameters(spark, sf):
    from marketlens.llm.queries import op3_hash_forest

    folder = f"/root/testdata/{sf}"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in rows] == list(range(len(rows)))
    x = np.array([r["embedding"] for r in rows], float)
    found, exact = recall(answers(op3_hash_forest(spark, folder)), x)
    print(f"{sf}: {len(x)} vectors, recall {found:.4f}, {exact:.4f} of the queries exact")
    assert found >= 0.9


def test_recall_on_more_than_a_block(embeddings):
    y = np.random.default_rng(4).standard_normal((10_000, 64)).astype(np.float32).astype(float)
    got = answers(nearest(embeddings([(i, v.tolist()) for i, v in enumerate(y)]), lambda v: v % 20 == 0, k=20))
    found, exact = recall(got, y)
    print(f"random: {len(y)} vectors, recall {found:.4f}, {exact:.4f} of the queries exact")
    assert found >= 0.9
