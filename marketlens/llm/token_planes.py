"""Token-ID output as bit-plane files.

A file holds the ids of consecutive documents in ascending order of doc_id.  Ids are cut
into chunks of a fixed number of unsigned 32-bit integers; a chunk is transposed into
planes (its lowest bytes, its next bytes, ...; or its lowest bits, ...), each plane is
compressed with zstandard, and planes that are all zero cost a few bytes.  Layout:

    planes of chunk 0 | planes of chunk 1 | ... | document index | chunk index | trailer

The document index holds id and token count of each document, the chunk index the first
byte, the number of ids and the planes' compressed sizes of each chunk, so any chunk can
be read alone; the trailer gives both indexes' sizes.

Spark deals documents to files by ranges of doc_id; each task streams one file into the
shared folder under a name of its own, so a retried task never meets the half-written
file of a lost one; the manifest (one row a file) names the files that count.

Tokenizing is per distinct word: the pre-tokenizer never joins across ASCII white space,
so a worker encodes each word once and looks it up from then on.

Nulls and edge cases: a null text is empty and has the end id alone; a null doc_id
counts as the smallest id; rows that repeat a doc_id are separate documents, ordered by
their text; an empty table gives no file and an empty result; further columns are
ignored.
"""

from __future__ import annotations

import itertools
import struct
import sys
import types
import uuid
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import (columns_of, id_key, id_value, row_chunks, stage_path,
                                   stage_table, text_bytes)

CHUNK_IDS = 1 << 16
WORDS_KEPT = 1_000_000  # of the words a worker remembers
TRAILER = "<QQ8s"
MAGIC = b"IDPLANES"


class WordCoder:
    """Ids of texts, word by word, through a tokenizer of the tokenizers library."""

    SEPARATOR = " 一 "  # a word no other word is joined with

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.encode(self.SEPARATOR, add_special_tokens=False).ids
        self.clear()

    def clear(self) -> None:
        self.place: dict[bytes, int] = {}
        self.n_ids = 0
        self.flat = np.zeros(1 << 16, np.uint32)
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if len(a) >= n else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])

    def _keep(self, words: list[bytes], ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        """Words and where each one's ids lie in ``ids``."""
        n = len(self.place)
        self.flat = self._room(self.flat, self.n_ids + len(ids))
        self.start, self.size = (self._room(a, n + len(words)) for a in (self.start, self.size))
        self.flat[self.n_ids:self.n_ids + len(ids)] = ids
        self.start[n:n + len(words)] = start + self.n_ids
        self.size[n:n + len(words)] = size
        self.n_ids += len(ids)
        self.place.update(zip(words, range(n, n + len(words)), strict=True))

    def learn(self, words: list[bytes]) -> None:
        """Encodes new words, many in one call with a separator between them; those that
        could be joined with it (or be a special token) one by one."""
        mark, sep = self.SEPARATOR.strip().encode(), self.separator
        odd = [w for w in words if b"<" in w or mark in w]
        if odd:
            words = [w for w in words if not (b"<" in w or mark in w)]
        groups = [words[a:a + 256] for a in range(0, len(words), 256)]
        between = self.SEPARATOR.encode()
        texts = [between.join(g).decode() for g in groups]
        for some, e in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, np.uint32)
            last = len(ids) - len(sep) + 1
            hit = ids[:last] == sep[0]
            for k in range(1, len(sep)):
                hit &= ids[k:last + k] == sep[k]
            cut = np.flatnonzero(hit)
            if len(cut) != len(some) - 1:
                odd.extend(some)
                continue
            start = np.concatenate([[0], cut + len(sep)])
            self._keep(some, ids, start, np.concatenate([cut, [len(ids)]]) - start)
        for w in odd:
            ids = np.array(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids, np.uint32)
            self._keep([w], ids, np.zeros(1, np.int64), np.array([len(ids)]))

    @staticmethod
    def _plain_stops(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows in which every stop or comma before a blank or a line end follows a
        letter or digit (ASCII, or one of the Latin letters U+00C0 to U+00FF): there the
        tokenizer splits as well, so they can be looked up apart."""
        n = len(data)
        at = np.flatnonzero((data == 44) | (data == 46))
        at = at[at + 1 < n]
        at = at[(data[at + 1] == 32) | (data[at + 1] == 10)]
        one, two = data[at - 1], data[at - 2]
        word = (((one | 32) >= 97) & ((one | 32) <= 122)) | ((one >= 48) & (one <= 57))
        word |= (two == 0xC3) & (one >= 0x80) & (one <= 0xBF) & (one != 0x97) & (one != 0xB7)
        row = np.searchsorted(offsets, at, side="right") - 1
        plain = np.ones(len(offsets) - 1, bool)
        plain[row[~word | (at - offsets[row] < 2)]] = False
        return plain

    @staticmethod
    def _words(text: bytes, plain: bool) -> list[bytes]:
        """The words to look up; the tokenizer lower-cases, but for special tokens."""
        if b"<" not in text:
            text = text.lower()
        if plain:
            for stop in (b",", b"."):
                for blank in (b" ", b"\n"):
                    text = text.replace(stop + blank, b" " + stop + blank)
        return text.split()

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows' texts, each closed by ``end``, and the count of each row."""
        if len(self.place) > WORDS_KEPT:
            self.clear()
        n_texts = len(offsets) - 1
        split = [self._words(data[x:y].tobytes(), p) for x, y, p in
                 zip(offsets[:-1], offsets[1:], self._plain_stops(data, offsets), strict=True)]
        words = list(itertools.chain.from_iterable(split))
        new = set(words).difference(self.place)
        if new:
            self.learn(list(new))
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        n_words = np.array([len(ws) for ws in split], np.int64)
        take = self.size[at]
        ends = np.cumsum(take)
        text_end = np.concatenate([[0], ends])[np.cumsum(n_words)]
        counts = np.diff(np.concatenate([[0], text_end])) + 1
        out = np.full(int(counts.sum()), end, np.uint32)
        if len(at):
            inside = np.arange(int(ends[-1])) + np.repeat(self.start[at] - ends + take, take)
            text_of = np.repeat(np.arange(n_texts), counts - 1)
            out[np.arange(len(inside)) + text_of] = self.flat[inside]
        return out, counts


def _coder(path: str) -> WordCoder:
    """The worker's coder; it lives as long as the worker does."""
    kept = sys.modules.setdefault("_marketlens_word_coders", types.ModuleType("_marketlens_word_coders"))
    if not hasattr(kept, "coders"):
        kept.coders = {}
    if path not in kept.coders:
        kept.coders[path] = WordCoder(path)
    return kept.coders[path]


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(raw[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, k], bitorder="little").tobytes() for k in range(32)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1)
    else:
        bits = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
                         for p in planes], axis=1)
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


class PlaneWriter:
    def __init__(self, stream, kind: str = "byte", chunk_ids: int = CHUNK_IDS, level: int = 3):
        import zstandard

        self.stream, self.kind, self.chunk_ids = stream, kind, chunk_ids
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.held: list[np.ndarray] = []
        self.n_held = self.at = self.n_ids = 0
        self.docs, self.counts, self.chunks = [], [], []

    def add(self, docs: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(docs)
        self.counts.append(counts)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.chunk_ids:
            every = np.concatenate(self.held)
            whole = len(every) // self.chunk_ids * self.chunk_ids
            for a in range(0, whole, self.chunk_ids):
                self._chunk(every[a:a + self.chunk_ids])
            self.held, self.n_held = [every[whole:]], len(every) - whole

    def _chunk(self, ids: np.ndarray) -> None:
        blobs = [self.zstd.compress(p) for p in to_planes(ids, self.kind)]
        self.chunks.append([self.at, len(ids), *map(len, blobs)])
        for b in blobs:
            self.stream.write(b)
            self.at += len(b)

    def close(self) -> None:
        if self.n_held:
            self._chunk(np.concatenate(self.held))
        docs = np.stack([np.concatenate(self.docs), np.concatenate(self.counts)]).astype("<i8")
        index = self.zstd.compress(docs.tobytes())
        chunks = self.zstd.compress(np.array(self.chunks, "<i8").tobytes())
        self.stream.write(index)
        self.stream.write(chunks)
        self.stream.write(struct.pack(TRAILER, len(index), len(chunks), MAGIC))


class PlaneReader:
    """Random access: ``documents`` (ids, counts) and ``chunk(k)``."""

    def __init__(self, source, kind: str = "byte"):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        body = source.size() - struct.calcsize(TRAILER)
        n_index, n_chunks, magic = struct.unpack(TRAILER, source.read_at(struct.calcsize(TRAILER), body))
        if magic != MAGIC:
            raise ValueError("not a plane file")
        planes = 4 if kind == "byte" else 32
        raw = source.read_at(n_index + n_chunks, body - n_index - n_chunks)
        both = np.frombuffer(self.zstd.decompress(bytes(raw[:n_index])), "<i8").reshape(2, -1)
        self.documents = both[0], both[1]
        self.chunks = np.frombuffer(self.zstd.decompress(bytes(raw[n_index:])), "<i8").reshape(-1, 2 + planes)

    def chunk(self, k: int) -> np.ndarray:
        at, n, *sizes = (int(x) for x in self.chunks[k])
        planes = []
        for s in sizes:
            planes.append(self.zstd.decompress(bytes(self.source.read_at(s, at))))
            at += s
        return from_planes(planes, n)


def _open(path: str):
    import pyarrow.fs as fs

    store, inner = fs.FileSystem.from_uri(path)
    return store, inner


def _write_files(folder: str, tokenizer: str, end: int, kind: str, chunk_ids: int):
    def run(batches):
        import pyarrow as pa

        writer, path, n_docs, first = None, None, 0, 0
        coder = _coder(tokenizer)
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = text_bytes(batch.column(1))
            for a, b in row_chunks(offsets, 1 << 20):
                if writer is None:
                    store, inner = _open(folder)
                    store.create_dir(inner, recursive=True)
                    path = f"{folder}/{uuid.uuid4().hex}.planes"
                    stream = store.open_output_stream(f"{inner}/{path.rsplit('/', 1)[1]}")
                    writer, first = PlaneWriter(stream, kind, chunk_ids), docs[a]
                ids, counts = coder.encode(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], end)
                writer.add(docs[a:b], counts, ids)
                n_docs += b - a
        if writer is not None:
            writer.close()
            writer.stream.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([int(first)], pa.int64()), pa.array([n_docs], pa.int64()),
                 pa.array([writer.n_ids], pa.int64())], names=["path", "first", "n_docs", "n_ids"])
    return run


def _read_files(kind: str):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, inner = _open(path)
                with store.open_input_file(inner) as source:
                    reader = PlaneReader(source, kind)
                    docs, counts = reader.documents
                    crcs = np.zeros(len(docs), np.int64)
                    k, ids, at = 0, np.zeros(0, np.uint32), 0
                    for d, n in enumerate(counts.tolist()):
                        crc = 0
                        while n:
                            if at == len(ids):
                                ids, at, k = reader.chunk(k), 0, k + 1
                            part = ids[at:at + n]
                            crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                            at += len(part)
                            n -= len(part)
                        crcs[d] = crc
                for a in range(0, len(docs), 50_000):
                    s = slice(a, a + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(docs[s].astype(np.int64)),
                         pa.array((before + np.cumsum(counts) - counts)[s].astype(np.int64)),
                         pa.array(counts[s].astype(np.int64)), pa.array(crcs[s])],
                        names=["doc", "start", "n_tokens", "ids_crc32"])
    return run


def write_token_files(documents: DataFrame, folder: str, tokenizer: str, end: int = 2, kind: str = "byte",
                      chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """Writes the files and returns the manifest (path, first, n_docs, n_ids, before)."""
    docs = columns_of(documents, "doc_id", "text").select(
        id_key().alias("doc"), F.coalesce("text", F.lit("")).alias("text"))
    manifest = stage_table(docs.repartitionByRange("doc").sortWithinPartitions("doc", "text")
                           .mapInArrow(_write_files(folder, tokenizer, end, kind, chunk_ids),
                                       "path string, first long, n_docs long, n_ids long"), "manifest")
    order = Window.orderBy("first", "path").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(order), F.lit(0).cast("long")))


def read_token_files(manifest: DataFrame, kind: str = "byte") -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone."""
    n = max(manifest.count(), 1)
    out = (manifest.select("path", "before").repartition(n)
           .mapInArrow(_read_files(kind), "doc long, start long, n_tokens long, ids_crc32 long"))
    return out.select(id_value("doc").alias("doc_id"), "start", "n_tokens", "ids_crc32")


def token_planes(documents: DataFrame, tokenizer: str, folder: str | None = None, end: int = 2,
                 kind: str = "byte") -> DataFrame:
    folder = folder or stage_path(documents.sparkSession, "planes")
    if "://" not in folder:
        folder = f"file://{folder}" if folder.startswith("/") else folder.replace("file:/", "file:///", 1)
    return read_token_files(write_token_files(documents, folder, tokenizer, end, kind), kind)
