from __future__ import annotations

import random
from collections import defaultdict

from marketlens.llm.packing import pack, pack_part


def test_every_piece_goes_to_a_tightest_compatible_bin():
    """Each choice against a look at every bin."""
    rng = random.Random(6)
    pieces = sorted(((rng.randint(1, 60), rng.choice("aaabcdefgh"), rng.randrange(40)) for _ in range(400)),
                    key=lambda p: -p[0])
    bins: list[list] = []
    for (size, source, cluster), (bin_, offset) in zip(pieces, pack_part(pieces, 100), strict=True):
        room = {k: 100 - sum(p[0] for p in b) for k, b in enumerate(bins)}
        fits = {k: r for k, r in room.items()
                if r >= size and all(p[1] != source and p[2] != cluster for p in bins[k])}
        if fits:
            assert fits[bin_] == min(fits.values()) and offset == 100 - fits[bin_]
        else:
            assert (bin_, offset) == (len(bins), 0)
            bins.append([])
        bins[bin_].append((size, source, cluster))


def test_pack_whole_documents(documents):
    rng = random.Random(7)
    rows = [(i, " ".join(["w"] * rng.randint(1, 90)), f"s{rng.randrange(6)}") for i in range(200)]
    rows += [(300 + i, "same text here", f"t{i}") for i in range(10)]
    rows += [(400, "x " * 257, "long"), (401, None, "s1"), (402, "", None), (403, "a", None), (None, "b c", None),
             (404, "again", "u"), (404, "again", "u")]
    got = pack(documents(rows), capacity=100, part_rows=64).collect()
    text = {r[0]: r[1] for r in rows}
    words, bins = defaultdict(int), defaultdict(list)
    for r in got:
        words[r["doc_id"]] += r["size"]
        if r["bin"] is None:
            assert r["size"] == 0 and not (text[r["doc_id"]] or "").split()
        else:
            bins[r["part"], r["bin"]].append(r)
    assert words == defaultdict(int, {d: (2 if d == 404 else 1) * len((t or "").split()) for d, t in text.items()})
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == at
            at += r["size"]
        assert at <= 100
        assert len({r["source"] for r in b}) == len(b)
        assert sum(300 <= (r["doc_id"] or 0) < 310 for r in b) <= 1
    assert pack(documents([])).collect() == []
