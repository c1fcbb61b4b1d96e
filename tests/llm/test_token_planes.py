from __future__ import annotations

import io
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

from marketlens.llm.token_planes import PlaneReader, PlaneWriter, from_planes, to_planes, token_planes  # noqa: E402

PATH = P.path("word_bpe_49k.json")


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [0, 1, 7, 8, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2 ** 32, n, dtype=np.uint32)
    assert (from_planes(to_planes(ids, kind), n) == ids).all()


class Memory(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, n, at):
        return self.getvalue()[at:at + n]


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_file_round_trip_and_random_access(kind):
    out, every = Memory(), []
    writer = PlaneWriter(out, kind, chunk_ids=100)
    for d in range(30):
        ids = np.arange(d * 13, dtype=np.uint32) + d
        every.append(ids)
        writer.add(np.array([d]), np.array([len(ids)]), ids)
    writer.close()
    reader, flat = PlaneReader(out, kind), np.concatenate(every)
    assert reader.documents[1].tolist() == [len(x) for x in every]
    for k in reversed(range(len(reader.chunks))):
        assert (reader.chunk(k) == flat[k * 100:(k + 1) * 100]).all()


def rows():
    texts = ["Hello, world. It's 12,5 o'clock!!, fine.", None, "", " \n", "É, é. à.\nÇa…, <|endoftext|>, x<|ENDOFTEXT|>",
             "一 三 a一b, 一", "é combining, İstanbul ΑΣ ﬁ x y", "\x1c a\x0bb\x0cc", "word " * 3000, "..., .\n,"]
    return [(10 - i, t) for i, t in enumerate(texts)] + [(None, "first"), (3, "again, and again.")]


def brute(rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    at, out = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_ids_read_back_equal_the_tokenizer(documents, kind):
    got = [tuple(r) for r in token_planes(documents(rows()), PATH, kind=kind).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows()), key=repr)


def test_empty_table(documents):
    assert token_planes(documents([]), PATH).collect() == []
