from __future__ import annotations

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from marketlens.llm.suffix_dedup import suffix_array, suffix_dedup


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array_is_sorted(codes):
    codes = [*codes, 0]
    assert suffix_array(codes) == sorted(range(len(codes)), key=lambda i: codes[i:])


def brute(rows, length=100):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for p in range(len(raw) - length + 1):
            w = raw[p:p + length]
            if w in seen:
                gone[p:p + length] = [True] * length
            seen.add(w)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        out[doc] = (len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def corpus():
    rng = random.Random(5)
    words = ["ab", "the", "of", "été", "stone", "river", "x", "日本"]

    def text(n):
        return " ".join(rng.choice(words) for _ in range(n))

    passage, long = text(60), text(3000)
    rows = [(1, passage + text(30)), (2, text(20) + passage + text(20)), (3, passage + text(30)), (4, ""),
            (5, None), (6, "short"), (7, "a" * 350), (8, long), (9, long), (10, long[:5000] + "!" + long[5000:]),
            (11, "b" * 99), (12, "b" * 100), (13, "b" * 101), (None, passage), (14, "ab" * 200)]
    return rows + [(100 + i, text(5) + passage[:150] + text(9)) for i in range(60)]


def check(df, rows):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}
    assert got == brute(rows)


def test_equals_brute_force(documents):
    rows = corpus()
    check(suffix_dedup(documents(rows)), rows)


def test_large_classes_are_exact(documents):
    """The ways for classes over the limit: cores, then single windows."""
    rows = corpus()
    check(suffix_dedup(documents(rows), class_limit=3), rows)


def test_empty_table_and_repeated_rows(documents):
    assert suffix_dedup(documents([])).collect() == []
    got = suffix_dedup(documents([(1, "c" * 120), (1, "c" * 120)])).collect()
    assert len(got) == 2 and {r["doc_id"] for r in got} == {1}


def test_rows_of_one_id_with_different_texts(documents):
    """Null and repeated ids: each text keeps its own bytes and loses its own repeats."""
    rng = random.Random(8)

    def text(n):
        return "".join(rng.choice("abcdefgh ") for _ in range(n))

    passage = text(300)
    rows = [(None, "a" * 350), (None, "short"), (None, text(500)), (None, None), (None, ""), (5, passage + text(50)),
            (5, "tiny"), (5, text(30) + passage + text(700)), (5, text(900)), (9, text(10) + passage)]
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, signed_md5(r[1] or "")))
    want = brute([(k, t) for k, (_, t) in enumerate(order)])
    for limit in (512, 1):
        got = suffix_dedup(documents(rows), class_limit=limit).collect()
        assert sorted(repr(tuple(r)) for r in got) == sorted(
            repr((order[k][0], *found)) for k, found in want.items())


def signed_md5(text):
    raw = hashlib.md5(text.encode()).digest()
    return tuple(int.from_bytes(raw[k:k + 8], "big", signed=True) for k in (0, 8))


def test_anchors_are_sorted_as_one_code():
    """The suffix array covers fewer codes than the segments have bytes; the windows found
    are those of a brute force."""
    import random

    import marketlens.llm.suffix_dedup as module

    rng, length, gram = random.Random(5), 20, 6
    lefts, rights = ([bytes(rng.choice(b"ab") for _ in range(m)) for _ in range(3)] for m in (8, length + 4))
    rows = []
    for k in range(60):
        lead = rng.randrange(1, 8)
        anchor = rng.choice([b"anchor", b"ANCHOR"])
        left, right = rng.choice(lefts)[-lead:], rng.choice(rights)
        windows = rng.randrange(1, lead + 2)
        raw = (left + anchor + right)[:windows + length - 1]
        rows.append(((k % 7, 0, 0), 1000 * k, windows, raw, lead))
    seen, sizes, real = {}, [], module.suffix_array
    for doc, pos, windows, raw, lead in rows:
        for off in range(windows):
            seen.setdefault((raw[off:off + length], lead - off), []).append((doc, pos + off))
    want = sorted((d, p, p + length) for places in seen.values() for d, p in places if (d, p) != min(places))

    def counted(codes):
        sizes.append(len(codes))
        return real(codes)
    module.suffix_array = counted
    try:
        got = module._block_repeats(rows, length, gram)
    finally:
        module.suffix_array = real
    assert sorted(got) == want and want
    assert sizes[0] == sum(len(r[3]) - gram + 2 for r in rows) + 1
