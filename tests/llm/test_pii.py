from __future__ import annotations

import hashlib
import re

import pytest

from marketlens.llm.pii import personal_data, redact

PATTERNS = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"))]


def passes_luhn(d):
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(text):
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and passes_luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(out)]


TEXTS = [
    None, "", "no data", "mail a.b+c@d-e.example.com, x@y or p@q..r or @a.b", "a@b.c%d@e.f a@b.c_d@e.f a@b.co\u0001m",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004 1.2.3 999.1.2.3.4 00000000000000000255.0.0.0",
    "4111 1111 1111 1111, 4111-1111-1111-1111 4111111111111112 41111111111111111111 4111  1111 1111 1111",
    "+1 (555) 555-0100 +44 20 7946 0958, +12 +1() +1234567890123456 ++1 555 555 5555 +1.555.555.0100.",
    "é日本😀 4111111111111111 😀 a@b.cd 😀 +1 555 555 0100", "9" * 20_000, "1 " * 20_000, "a." * 20_000 + "@" + "b." * 9_000 + "c",
    "+" + "1 " * 9_000, "1." * 20_000, "4111\u00011111\u00011111\u00011111", "-4111111111111111- 4 4", "x" * 50_000 + "@a.b",
]


@pytest.mark.parametrize("as_one", [False, True])
def test_base_spans_equal_the_patterns(documents, as_one):
    texts = [" | ".join(t for t in TEXTS if t and len(t) < 500)] if as_one else TEXTS
    rows = list(enumerate(texts))
    got = {r["doc_id"]: r for r in personal_data(documents(rows)).collect()}
    for i, text in rows:
        want = brute(text)
        r = got[i]
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (i, want, r)
        assert [r[f"n_{k}"] for k, _ in PATTERNS] == [sum(s.startswith(k) for s in want) for k, _ in PATTERNS]
        assert set(filter(None, r["spans"].split(","))) >= set(want)


def bootstrapped():
    """Members' numbers after trusted words: cards first, then unseen identifiers."""
    rows = []
    for i in range(8):
        card = f"411111111111111{1}"
        digits = f"4{i:014d}"
        card = next(digits + str(c) for c in range(10) if passes_luhn(digits + str(c)))
        rows.append((i, f"text w{i} member number {card} ends here"))
        rows.append((100 + i, f"text v{i} your account {card} ends today"))
    rows.append((200, "their member number AB-998877 ends here"))
    rows.append((201, "and your account AB-998877 ends today"))
    rows += [(300 + i, f"year {1990 + i} page 10{i}55 of volume 77{i}66") for i in range(5)]
    return rows


def test_contexts_discover_unseen_identifiers(documents):
    got = {r["doc_id"]: r["spans"] for r in personal_data(documents(bootstrapped())).collect()}
    assert got[200] == "card:20:29" and got[201] == "card:17:26"
    assert all(got[300 + i] == "" for i in range(5))


def test_redaction(documents):
    rows = [(501, "to a@b.com now"), (502, "clean"), (503, None), (504, "x 1.2.3.4,+1 555 555 0100 y"),
            (505, "4111111111111111")]
    df = documents(rows + bootstrapped())
    out = redact(df)
    assert out.columns == df.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got[501] == "to [EMAIL] now" and got[502] == "clean" and got[503] is None
    assert got[504] == "x [IP],[PHONE] y" and got[505] == "[CARD]"
    assert got[200] == "their member number [CARD] ends here"


def test_edge_rows(documents):
    assert personal_data(documents([])).collect() == []
    got = personal_data(documents([(None, "a@b.cd"), (1, "a@b.cd"), (1, "a@b.cd"), (1, "none")])).collect()
    assert sorted((str(r["doc_id"]), r["spans"]) for r in got) == [
        ("1", ""), ("1", "email:0:6"), ("1", "email:0:6"), ("None", "email:0:6")]


def test_long_chains_of_contexts(documents):
    """Five contexts, each trusted only once the one before it has told its values."""
    cards = [next(f"4{i:014d}{c}" for c in range(10) if passes_luhn(f"4{i:014d}{c}")) for i in range(4)]
    levels = [cards] + [[f"ZQ-{k}{i}8877" for i in range(4)] for k in range(1, 6)]
    rows = []
    for k, (told, new) in enumerate(zip(levels[:-1], levels[1:], strict=True)):
        for i, v in enumerate(new):
            word = "abcde"[k] + "wxyz"[i]
            rows += [(len(rows) + n, f"ctx{word} word{word} {t} end{word}") for n, t in enumerate([*told, v])]
    got = {r["doc_id"]: r["spans"] for r in personal_data(documents(rows)).collect()}
    for i, text in rows:
        value = text.split()[2]
        assert got[i] == f"card:{text.index(value)}:{text.index(value) + len(value)}", text


def test_a_long_text_with_many_matches(documents):
    """A third of a megabyte with 16,000 addresses and as many candidates between them."""
    text = " ".join(f"a{i % 7}@b{i % 5}.cd id x{1_000_000 + i}" for i in range(16_000))
    assert len(text) > 330_000
    df = documents([(1, text), (2, None)])
    got = {r["doc_id"]: r for r in personal_data(df).collect()}
    want = brute(text)
    assert got[1]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert got[1]["n_email"] == 16_000
    out = {r["doc_id"]: r["text"] for r in redact(df).collect()}
    assert "@" not in out[1] and out[1].count("[EMAIL]") >= 16_000 and out[2] is None


def test_masks_of_overlapping_spans_over_many_runs(documents):
    """Spans of several kinds that overlap, in numbers beyond one run of them."""
    unit = "4111 1111 1111 1111@b.cd 1.2.3.4@e.fg +1 555 555 0100@x.yz é😀 "
    text = unit * 400
    got = redact(documents([(1, text)])).collect()[0]["text"]
    spans = [s.split(":") for s in personal_data(documents([(1, text)])).collect()[0]["spans"].split(",")]
    want, at = "", 0
    for kind, start, end in spans:
        if int(start) >= at:
            want += text[at:int(start)] + f"[{kind.upper()}]"
        at = max(at, int(end))
    assert len(spans) > 1000 and got == want + text[at:]
