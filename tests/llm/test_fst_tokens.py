from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from marketlens.llm import fst_tokens
from marketlens.llm.fst_tokens import Transducer, code_points, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", "b", "the", "ing", " ", "  ", "\n", "\t", " \n ", "'", "'s", "'re", "'r", "'l", "'ll", "''", "S", "1", "23",
          "!", "..", "é", "ü", "中", "\xa0", " ", "́", "\U0001F600", "<|endoftext|>", "<|endof", "-", "'ve",
          "'d", "'t ", "_", "\r\n", "ſ", "٣", " '", "﻿", "\x00", "\x85", "aaaa", "zqxj", "x y "]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def machine():
    return Transducer(PATH)


def texts(n, seed, most=25):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, most))) for _ in range(n)]


def counts(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in df.collect()), key=repr)


def brute(tokenizer, rows):
    out = []
    for i, text, *_ in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        out.append((i, len((text or "").encode()), n, n > 1024))
    return sorted(out, key=repr)


def test_the_machine_equals_the_library(tokenizer, machine):
    for text in texts(3000, 1):
        codes = code_points(text.encode(), machine.merges.special).tolist()
        assert machine.walk(machine.names[machine.start], codes)[1] == len(tokenizer.encode(text).ids), text


def test_every_prefix_is_counted_as_if_the_text_ended_there(tokenizer, machine):
    text = "It's the re-entering of 2024's 'll zqxjaaaaaaab  \n\n x naïve 中文 !!?'re"
    name, total = machine.names[machine.start], 0
    for k, code in enumerate(code_points(text.encode(), []).tolist()):
        name, change = machine.step(name, code)
        total += change
        assert total == len(tokenizer.encode(text[:k + 1]).ids)


@pytest.mark.parametrize("chunk", [3, 7, 64])
def test_chunk_maps_compose(spark, documents, tokenizer, chunk):
    rows = [(i, t) for i, t in enumerate(texts(250, chunk, 60))]
    assert counts(token_counts(documents(rows), PATH, chunk=chunk)) == brute(tokenizer, rows)


def test_odd_rows(spark, documents, tokenizer):
    rows = [(1, None), (2, ""), (None, "two words"), (None, "two words"), (3, "a " * 1024), (4, "a " * 1025),
            (5, " " * 9000), (6, "\n" * 9000 + "x"), (7, "<|endoftext|>" * 3), (1, "another text"), (8, "'" * 5000)]
    assert counts(token_counts(documents(rows), PATH)) == brute(tokenizer, rows)


def test_very_long_texts(spark, documents, tokenizer):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    rows = [(1, " ".join(rng.choice(words) for _ in range(200_000))), (2, "ab" * 60_000), (3, "short")]
    assert counts(token_counts(documents(rows), PATH)) == brute(tokenizer, rows)


def test_a_full_table_is_compiled_anew(tokenizer):
    small = Transducer(PATH, states=40)
    for text in texts(200, 9):
        small.make_room()
        codes = code_points(text.encode(), small.merges.special).tolist()
        assert small.walk(small.names[small.start], codes)[1] == len(tokenizer.encode(text).ids)
    assert len(small.names) < 400


def test_the_table_grows(machine):
    grown = Transducer(PATH)
    grown._table(4)
    for text in texts(200, 10):
        codes, ends = code_points(text.encode(), grown.merges.special), np.array([0])
        ends[0] = len(codes)
        total, _ = grown.run(codes, np.array([0]), ends, np.array([grown.start]))
        assert total[0] == machine.walk(machine.names[machine.start], codes.tolist())[1]
    assert grown.bits > 8


def test_empty_table(spark, documents):
    assert counts(token_counts(documents([]), PATH)) == []


def test_clashing_columns(spark, tokenizer):
    rows = [(1, "some text here", 5, "h", 7, 8, 9), (2, "x " * 4000, 5, "h", 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, head string, number int, tokens int, after int")
    assert counts(token_counts(df, PATH)) == brute(tokenizer, rows)


def test_query_equals_the_library(spark, tokenizer):
    from marketlens.llm.queries import op12_fst_tokens

    docs = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    got = counts(op12_fst_tokens(spark, "/root/testdata/sf0.001"))
    assert got == brute(tokenizer, [(d["doc_id"], d["text"]) for d in docs])


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        fst_tokens.Merges(public_tokenizers.path("word_bpe_49k.json"))
