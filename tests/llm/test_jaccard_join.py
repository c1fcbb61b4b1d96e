from __future__ import annotations

import random
import re

import pytest

from marketlens.llm.jaccard_join import jaccard_join, one_of_each

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    if not w:
        return set()
    return {tuple(w)} if len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n, percent):
    sets = [(d, shingles(t, n)) for d, t in rows]
    near = {d: set() for d, _ in sets}
    for i, (d, a) in enumerate(sets):
        for e, b in sets[i + 1:]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                near[d].add(e)
                near[e].add(d)
    out = {}
    for d, a in sets:
        seen, todo = {d}, [d]
        while todo:
            for e in near[todo.pop()] - seen:
                seen.add(e)
                todo.append(e)
        out[d] = (len(a), min(seen))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]

    def text(n):
        return [rng.choice(words) for _ in range(n)]

    def edited(w, k):
        w = list(w)
        for _ in range(k):
            w[rng.randrange(len(w))] = rng.choice(words)
        return w

    rows, line = [], text(12)
    for g in range(12):
        base = text(rng.randint(30, 120))
        rows += [" ".join(edited(base, rng.randint(0, 5))) for _ in range(rng.randint(2, 8))]
    hub = text(80)
    rows += [" ".join(edited(hub, k % 7)) for k in range(60)]             # a large group
    rows += [" ".join(line + text(15) + line) for _ in range(40)]          # a common line
    rows += ["", None, "  \n", "one", "ONE", "One two", "one two three", "a b c d", "A B C D", "É b c d", "é b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n,percent", [(4, 85), (5, 80)])
@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(documents, seed, n, percent):
    rows = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join(documents(rows), n, percent).collect()}
    assert got == brute(rows, n, percent)


def test_one_of_each(documents):
    rows = corpus()
    want = brute(rows, 5, 80)
    df = documents(rows)
    out = one_of_each(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(d for d, (_, c) in want.items() if c == d)


def test_edge_cases(documents):
    assert jaccard_join(documents([])).collect() == []
    got = jaccard_join(documents([(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e")])).collect()
    assert [(r["n_shingles"], r["component_id"]) for r in got] == [(2, None)] * 3
    assert one_of_each(documents([(3, "a b c d e"), (3, "a b c d e"), (4, "q")])).count() == 2


def test_components_compared_in_small_blocks(documents, monkeypatch):
    """Every component of two documents counts as large, blocks hold two."""
    import marketlens.llm.jaccard_join as module

    monkeypatch.setattr(module, "LARGE", 2)
    monkeypatch.setattr(module, "BLOCK", 2)
    rows = corpus(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join(documents(rows), 4, 85).collect()}
    assert got == brute(rows, 4, 85)


def test_block_bound_equals_pair_bound():
    import numpy as np

    from marketlens.llm.jaccard_join import _cell_counts, _Cells, _may_link

    rng = np.random.default_rng(1)

    def some(n):
        hashes = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        return _cell_counts(np.zeros(len(hashes), np.int64), hashes, np.array([len(hashes)]))[0], len(hashes)

    block = [some(int(rng.integers(5, 300))) for _ in range(40)]
    cells = _Cells(np.arange(40), np.array([n for _, n in block]), [c for c, _ in block])
    for percent in (5, 20, 85):
        for _ in range(50):
            raw, n = some(int(rng.integers(5, 300)))
            mine = np.frombuffer(raw, np.uint8)
            want = [k for k, (c, m) in enumerate(block) if 100 * min(n, m) >= percent * max(n, m)
                    and _may_link(np.frombuffer(c, np.uint8), mine, m, n, percent)]
            assert sorted(cells.may_link(n, mine, percent).tolist()) == want


def test_one_of_each_decides_by_text(documents):
    """Null and repeated ids: only rows linked by similarity are dropped."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    near = b + " more"
    rows = [(None, a), (None, b), (None, c), (None, c), (5, near), (6, d), (6, a), (6, "q"), (7, ""), (7, None), (8, "")]
    got = one_of_each(documents(rows)).collect()
    assert sorted(repr((r["doc_id"], r["text"])) for r in got) == sorted(map(repr, [
        (None, a), (None, b), (None, c), (6, d), (6, "q"), (7, ""), (7, None), (8, "")]))
