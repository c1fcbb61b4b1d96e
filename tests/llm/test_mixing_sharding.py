from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from marketlens.llm.mixing import mix, mix_documents
from marketlens.llm.sharding import shard


def source_targets(sizes):
    """Water filling, step by step."""
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    fixed, left = {}, dict(sizes)
    while left:
        share = total - sum(fixed.values())
        w = sum(weight[s] for s in left)
        over = [s for s in left if share * weight[s] / w > 3 * sizes[s]]
        if not over:
            return fixed | {s: share * weight[s] / w for s in left}
        for s in over:
            fixed[s] = 3.0 * sizes[s]
            del left[s]
    return fixed


def mixed_rows(n=600):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        source = rng.choice(["a", "b", "b", "b", "b", "c", "d", None])
        rows.append((i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 40))), source))
    return rows + [(n, None, "a"), (n + 1, "", "empty"), (n + 2, "x " * 500, "long"), (None, "y z", "c")]


def test_mix_comes_near_its_targets(documents):
    rows = mixed_rows()
    got = mix(documents(rows)).collect()
    size = Counter()
    source_of = {r[0]: r[2] for r in rows}
    for _, text, source in rows:
        size[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want, taken = source_targets(size), Counter()
    assert len(got) == len(rows)
    for r in got:
        s = source_of[r["doc_id"]]
        assert r["source_size"] == size[s]
        assert r["target"] == pytest.approx(want[s])
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[s] += r["taken"]
    for s, n in size.items():
        assert abs(taken[s] - want[s]) <= max(45, 0.02 * want[s]) or s == "long", (s, n, taken[s], want[s])


def test_mix_is_repeatable_and_takes_effect(documents):
    df = documents(mixed_rows(100))
    first = sorted(mix(df).collect(), key=repr)
    assert first == sorted(mix(df.repartition(7)).collect(), key=repr)
    copies = Counter({r["doc_id"]: r["copies"] for r in first})
    out = mix_documents(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect()) == +copies


def test_mix_of_nothing(documents):
    assert mix(documents([])).collect() == []
    got = mix(documents([(1, None), (2, "")])).collect()
    assert {(r["size"], r["taken"], r["target"]) for r in got} == {(0, 0, 0.0)}


def check_shards(rows, got, shards=8):
    assert len(got) == len(rows)
    per = Counter(r["shard"] for r in got)
    counts = [per[s] for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["law"] == "rows" and r["grown_shard"] is None
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_are_even_and_keep_groups(documents):
    rows = [(i, f"text {i}") for i in range(300)] + [(1000 + i, f"copy {i % 20}") for i in range(100)]
    got = shard(documents(rows)).collect()
    check_shards(rows, got)
    text = dict(rows)
    groups = defaultdict(set)
    for r in got:
        raw = text[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        if text[r["doc_id"]].startswith("copy"):
            groups[text[r["doc_id"]]].add(r["shard"])
    assert all(len(v) == 1 for v in groups.values())  # there is room for every group


def test_a_group_larger_than_a_shard(documents):
    rows = [(i, "same") for i in range(100)] + [(1000 + i, f"t {i}") for i in range(140)]
    got = shard(documents(rows)).collect()
    check_shards(rows, got)
    held = Counter(r["shard"] for r in got if r["doc_id"] < 100)
    assert len(held) <= 5  # 100 rows, 30 to a shard: four shards, or five


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(1, None), (2, None), (None, ""), (3, "é")],
                                  [(i, "x") for i in range(50)], [(7, "r")] * 20])
def test_shard_edge_cases(documents, rows):
    check_shards(rows, shard(documents(rows)).collect())


def test_sharding_is_repeatable(documents):
    df = documents([(i, f"t {i % 70}") for i in range(200)])
    assert sorted(shard(df).collect()) == sorted(shard(df.repartition(5)).collect())


def test_rows_alike_in_id_source_and_size_take_their_own_copies(documents):
    """The mix holds as many rows as the copies sum up to, whatever the ids are."""
    rows = [(None if i % 3 else i // 6, f"w{i % 40} x y", "ab"[i % 2]) for i in range(300)]
    df = documents(rows)
    copies = mix(df).collect()
    assert len({r["copies"] for r in copies if r["doc_id"] is None}) > 1
    assert mix_documents(df).count() == sum(r["copies"] for r in copies)
