from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.llm import spelling
from marketlens.llm.spelling import pivots_of, prefix_of, spelling_variants

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, least_length=5, least_n=3, ratio=2, noise=97):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_n}
    letters = {c for w in words for c in w}

    def near(w):
        cuts = {w[:i] + w[i + 1:] for i in range(len(w))}
        swaps = {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        more = {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        return {v for v in cuts | swaps | more if v in words and v != w}
    out, forms = {}, {}
    for w, n in words.items():
        around = near(w)
        best = min(around, key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= ratio * n:
            forms[w] = best
        out[w] = len(around)
    result = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        result.append((w, form, root, n, out[w], words[form] if form else None))
    return sorted(result)


def grouped(df, **options):
    got = spelling_variants(df, **{"noise": 97, **options})
    return sorted(tuple(r) for r in got.select("word", "form", "root", "n", "n_near", "form_n").collect())


def corpus(n, seed, letters="abcdeé"):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 8))) for _ in range(40)]

    def word():
        w = rng.choice(stems[:1 + int(len(stems) * rng.random() ** 2)])
        while rng.random() < 0.3:
            i, c = rng.randrange(len(w)), rng.choice(letters)
            w = rng.choice([w[:i] + w[i + 1:], w[:i] + c + w[i + 1:], w[:i] + c + w[i:]]) or w
        return w.upper() if rng.random() < 0.1 else w
    return [(i, rng.choice([" ", ", ", "1"]).join(word() for _ in range(rng.randint(0, 120)))) for i in range(n)]


def test_equals_brute_force(spark, documents):
    rows = corpus(120, 1)
    want = brute(rows)
    assert len({r[2] for r in want}) < len(want) and any(r[1] and r[1] != r[2] for r in want)
    assert grouped(documents(rows)) == want


def test_few_letters_repeat_their_bigrams(spark, documents):
    rows = corpus(150, 2, "ab")
    assert grouped(documents(rows)) == brute(rows)


def test_one_beginning_holds_a_third_of_all_words(spark, documents):
    rng = random.Random(3)
    words = ["qz" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 6))) if i % 3 else
             "".join(rng.choice("defg") for _ in range(6)) for i in range(400)]
    rows = [(i, " ".join(words) + " " + " ".join(rng.sample(words, 50))) for i in range(4)]
    assert grouped(documents(rows)) == brute(rows)


def test_odd_rows(spark, documents):
    rows = [(1, None), (2, ""), (None, "Wörter wörter WöRTER ÀÀÀÀÀ ààààà"), (None, "Wörter wörter ÀÀÀÀÀ"),
            (3, "abcde abcde abcde abcdf abcdf abcdf abcdf abcdf abcdf abcdf × × ×××××"), (3, "abcde ×××××" * 3),
            (4, "short " * 70_000 + "shorts " * 30_000), (5, "1234 中文 \x00 don't")]
    assert grouped(documents(rows)) == brute(rows)


def test_chains_are_followed_to_the_root(spark, documents):
    steps = ["aaaaaa", "baaaaa", "bcaaaa", "bcdaaa", "bcdeaa", "bcdefa", "bcdefg"]
    rows = [(0, " ".join(" ".join([w] * (3 * 2 ** k)) for k, w in enumerate(steps)))]
    got = grouped(documents(rows), noise=0)
    assert got == brute(rows, noise=0)
    assert {r[2] for r in got} == {"bcdefg"}


def test_ties_go_to_the_smaller_word(spark, documents):
    rows = [(0, "aaaab " * 3 + "aaaac " * 6 + "aaaaa " * 6 + "aaaaA " * 0 + "caaab " * 6)]
    got = {r[0]: r[1] for r in grouped(documents(rows), noise=0)}
    assert got["aaaab"] == "aaaaa"


def test_empty_tables_and_clashing_columns(spark, documents):
    assert grouped(documents([])) == [] and grouped(documents([(1, "1 2 3"), (2, "one two")])) == []
    rows = corpus(30, 4)
    df = documents(rows).withColumns({c: F.lit("x") for c in ("word", "n", "key", "u", "v", "root", "form")})
    assert grouped(df) == brute(rows)


def test_words_are_handed_on_when_many():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["ab cd ef", "ab gh"])], names=["doc_id", "text"])
    out = list(spelling._count_words(0, held=2)(iter([batch])))
    assert len(out) == 2
    total = Counter()
    for b in out:
        for w, n in zip(*(c.to_pylist() for c in b.columns)):
            total[w] += n
    assert total == {"ab": 2, "cd": 1, "ef": 1, "gh": 1}


@given(st.lists(st.tuples(st.integers(0, 9), st.sampled_from("abcdef")), min_size=3, max_size=8, unique_by=lambda p: p[0]))
@settings(max_examples=150, deadline=None)
def test_pivots_are_disjoint_and_cheapest(prefix):
    prefix, frequency = sorted(prefix), {c: 3 ** k for k, c in enumerate("abcdef")}
    if prefix[-1][0] - prefix[0][0] < 2:
        return
    cost = dict(prefix)
    pairs = [(frequency[cost[p]] + frequency[cost[q]], (p, q)) for p in cost for q in cost if q - p >= 2]
    assert tuple(pivots_of(prefix, frequency)) == min(pairs)[1]


@given(st.text("abcdeéz", min_size=1, max_size=8), st.integers(0, 8), st.sampled_from(["", "a", "z", "ÿ"]), st.booleans())
@settings(max_examples=200, deadline=None)
def test_one_edit_changes_few_letter_bits(word, at, letter, replaced):
    other = word[:at] + letter + word[at + replaced:]
    assert (spelling.letter_bits(word) ^ spelling.letter_bits(other)).bit_count() <= 4


def test_a_prefix_holds_every_occurrence_of_its_last_bigram():
    frequency = {"ab": 1, "ba": 5, "bc": 2}
    assert prefix_of("abababc", frequency) == [(0, "ab"), (2, "ab"), (4, "ab")]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, sf_dir):
    from marketlens.llm.queries import op11_spelling_variants

    docs = pq.read_table(f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = op11_spelling_variants(spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == brute([(d["doc_id"], d["text"]) for d in docs])


def test_query_equals_its_sql(spark, duck):
    from marketlens.llm.oracles import OP11
    from marketlens.llm.queries import op11_spelling_variants

    got = op11_spelling_variants(spark, "/root/testdata/sf0.001")
    want = duck.execute(OP11)
    names = [c[0] for c in want.description]
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(want.fetchall())
