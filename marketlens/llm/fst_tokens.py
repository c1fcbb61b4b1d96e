"""Token counts by a compiled finite-state tokenizer.

A byte-level BPE tokenizer (a file of the tokenizers library) becomes one deterministic
transducer over code points.  Its states combine two parts:

- where the pre-tokenizer's pattern stands: inside a run of letters, digits or other
  characters, inside white space with its last character held back, after an apostrophe
  that may open a contraction, or between pieces;
- what the merges can still change inside the open piece.  A prefix's encoding ends in one
  token, and the encoding of the longer prefix is that of a shorter one plus one token, so
  a state keeps, for each suffix of the piece that begins some token, the last token
  before it and how many tokens fewer there are.  Two prefixes with equal entries behave
  alike from then on: that is what makes the machine finite.

Each transition carries the change of the number of tokens of the text read so far, as
if it ended there.  Transitions are compiled when they are first met, into a hash table
of integers that many texts step through together (one array operation a position for
all of them).  Which neighbouring tokens stand is asked of the tokenizer's own merges,
and which class a character has of its own pre-tokenizer.

Texts are cut into chunks of a fixed number of code points.  A chunk's map takes the
state before it to (tokens, state after it).  After a printable character and a space
the state no longer depends on what came before, so a map is kept as the short head up to
there, the tokens after it, and the state at the end; a chunk without such a place keeps
its whole text as head.  Maps of all chunks are computed side by side; Spark brings those
of a document together in order, and they compose by a running scan.  Special strings are
one symbol that ends the piece before it, and chunks never cut one.

Nulls and edge cases: a null text is empty and has no tokens; a null doc_id stays null;
rows that repeat a doc_id are separate documents; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import json
import pickle
import sys
import types

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of

CHUNK = 4096              # code points of a chunk
LANES_BYTES = 16_000_000  # text that steps together
STATES = 250_000          # of a worker's table; a full one is compiled anew as needed
SPECIAL = 0xD800          # the special string as a symbol: no text holds this code point
START, LETTERS, DIGITS, OTHERS, SPACES, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(9)
# The contractions the pattern knows (fixed values): 's 't 'm 'd at once, 're 've 'll in two steps.
AT_ONCE = {ord(c) for c in "stmd"}
IN_TWO = {ord("r"): QUOTE_R, ord("v"): QUOTE_V, ord("l"): QUOTE_L}
SECOND = {QUOTE_R: ord("e"), QUOTE_V: ord("e"), QUOTE_L: ord("l")}
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1
    characters for themselves, the others for 256 and up, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Merges:
    """Vocabulary as a trie over bytes, and which tokens may stand side by side."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"] or {}
        if (spec["model"]["type"], pre.get("type"), pre.get("add_prefix_space")) != ("BPE", "ByteLevel", False) \
                or spec["normalizer"] or not pre.get("use_regex"):
            raise ValueError(f"{path}: no byte-level BPE tokenizer without normalizer and prefix space")
        self.special = [t["content"] for t in spec["added_tokens"]]
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.child: dict[int, int] = {}   # node << 8 | byte
        self.token: list[int] = [-1]      # of a node, -1: none
        self.text: dict[int, str] = {}
        for word, i in spec["model"]["vocab"].items():
            if word in self.special:
                continue
            node = 0
            for c in word:
                key = node << 8 | byte_of[c]
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                node = self.child[key]
            self.token[node], self.text[i] = i, word
        self.inner = {key >> 8 for key in self.child}  # nodes that longer tokens go through
        self.forget()

    def forget(self) -> None:
        self.beside: dict[tuple[int, int], bool] = {}
        self.entries: dict[tuple, tuple] = {}  # equal entries are kept once

    def stands(self, left: int, right: int) -> bool:
        """Whether ``right`` follows ``left`` (-1: begins a piece) in an encoding."""
        key = (left, right)
        known = self.beside.get(key)
        if known is None:
            word = (self.text[left] if left >= 0 else "") + self.text[right]
            ids = [t.id for t in self.tokenizer.model.tokenize(word)]
            known = self.beside[key] = ids == [i for i in key if i >= 0]
        return known

    # A piece so far: ((trie node of a suffix, last token before it, tokens up to there
    # less tokens in all), ...), longest suffix first; the last entry is the empty suffix.
    EMPTY = ((0, -1, 0),)

    def extend(self, piece: tuple, byte: int) -> tuple[tuple, int]:
        """The piece with one byte more and the change of its number of tokens."""
        grown, last, change = [], None, 0
        for node, before, less in piece:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            token = self.token[node]
            if last is None and token >= 0 and self.stands(before, token):
                last, change = token, less + 1
            if node in self.inner:
                grown.append((node, before, less))
        if last is None:
            raise ValueError("a byte of the text is not in the vocabulary")
        one = self.entries
        out = [(n, b, less - change) for n, b, less in grown]
        out.append((0, last, 0))
        return tuple([one.setdefault(e, e) for e in out]), change

    def read(self, piece: tuple, code: int) -> tuple[tuple, int]:
        total = 0
        for byte in chr(code).encode():
            piece, change = self.extend(piece, byte)
            total += change
        return piece, total


class Transducer:
    """States by number, transitions in an open-addressing table of integers."""

    def __init__(self, path: str, states: int = STATES):
        self.merges, self.limit = Merges(path), states
        self.classes: dict[int, int] = {}
        self.clear()

    def clear(self) -> None:
        self.merges.forget()
        self.names: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self._table(20)
        self.used = 0
        self.walked: dict[int, tuple[int, int]] = {}  # transitions that single lanes have met
        self.start = self.state((START, Merges.EMPTY, 0))
        self.settled = self.state((SPACES, Merges.EMPTY, 32))

    def state(self, name: tuple) -> int:
        n = self.number.get(name)
        if n is None:
            n = self.number[name] = len(self.names)
            self.names.append(name)
        return n

    # ------------------------------------------------------------------ compilation
    def kind(self, code: int) -> int:
        """The character's class, as the tokenizer's own pattern sees it."""
        found = self.classes.get(code)
        if found is None:
            split = self.merges.tokenizer.pre_tokenizer.pre_tokenize_str
            found = next((k for k, mate in ((LETTERS, "a"), (DIGITS, "1"), (OTHERS, "!"))
                          if len(split(mate + chr(code))) == 1), SPACES)
            self.classes[code] = found
        return found

    def step(self, name: tuple, code: int) -> tuple[tuple, int]:
        """The state after ``code`` and the change of the number of tokens.  Names are
        (mode, piece, character held back)."""
        mode, piece, held = name
        if code == SPECIAL:
            return (START, Merges.EMPTY, 0), 1
        kind, read = self.kind(code), self.merges.read
        if mode == SPACES:  # piece: the run without its last character ``held``
            whole, last = read(piece, held)
            if kind == SPACES:
                _, change = read(whole, code)
                return (SPACES, whole, code), change
            if held == 32:  # the held blank belongs to what follows
                opened, first = read(Merges.EMPTY, 32)
                opened, more = read(opened, code)
                return (kind, opened, 0), first + more - last
            _, alone = read(Merges.EMPTY, held)  # a piece of its own
            after, change = self.step((START, Merges.EMPTY, 0), code)
            return after, change + alone - last
        if mode == QUOTE and code in AT_ONCE or mode in SECOND and code == SECOND[mode]:
            letters = [ord("'"), *([] if mode == QUOTE else [k for k, m in IN_TWO.items() if m == mode]), code]
            contraction, parts = Merges.EMPTY, 0
            for c in letters:
                contraction, change = read(contraction, c)
                parts += change
            before = 1 if mode == QUOTE else 1 + read(Merges.EMPTY, letters[1])[1]
            return (START, Merges.EMPTY, 0), parts - before
        if mode == QUOTE and code in IN_TWO:
            opened, change = read(Merges.EMPTY, code)
            return (IN_TWO[code], opened, 0), change
        run = LETTERS if mode in SECOND else OTHERS if mode == QUOTE else mode
        if run == kind and run != START:
            piece, change = read(piece, code)
            return (run, piece, 0), change
        if kind == SPACES:
            return (SPACES, Merges.EMPTY, code), read(Merges.EMPTY, code)[1]
        opened, change = read(Merges.EMPTY, code)
        return (QUOTE if code == ord("'") else kind, opened, 0), change

    # ------------------------------------------------------------------ the table
    def _table(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.full(1 << bits, -1, np.int64)
        self.goes = np.zeros(1 << bits, np.int64)  # state after << 8 | change + 128

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of the keys; of unknown ones the free slot where they belong."""
        at = self._slots(keys)
        got = self.keys[at]
        open_ = np.flatnonzero((got != keys) & (got != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            got = self.keys[at[open_]]
            open_ = open_[(got != keys[open_]) & (got != -1)]
        return at

    def _insert(self, key: int, after: int, change: int) -> None:
        if 2 * self.used >= 1 << self.bits:
            kept = np.flatnonzero(self.keys >= 0)
            old = self.keys[kept].tolist(), self.goes[kept].tolist()
            self._table(self.bits + 1)
            for k, g in zip(*old, strict=True):
                self._put(k, g)
        self._put(key, after << 8 | change + 128)
        self.used += 1

    def _put(self, key: int, goes: int) -> None:
        at = (key * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while self.keys[at] != -1:
            at = (at + 1) & ((1 << self.bits) - 1)
        self.keys[at], self.goes[at] = key, goes

    def advance(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States after one symbol each, and the changes."""
        keys = states << 21 | codes
        at = self._find(keys)
        new = np.flatnonzero(self.keys[at] != keys)
        if len(new):
            for key in np.unique(keys[new]).tolist():
                name, change = self.step(self.names[key >> 21], key & 0x1FFFFF)
                bits = self.bits
                self._insert(key, self.state(name), change)
                if self.bits != bits:  # all slots have moved
                    new = slice(None)
            at[new] = self._find(keys[new])
        goes = self.goes[at]
        return goes >> 8, (goes & 255) - 128

    def run(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray,
            states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each lane's tokens and last state; lane i reads codes[starts[i]:ends[i]]."""
        order = np.argsort(starts - ends, kind="stable")  # longest first
        size = (ends - starts)[order]
        at, state = starts[order].copy(), states[order].astype(np.int64)
        total = np.zeros(len(order), np.int64)
        live = np.searchsorted(-size, -np.arange(int(size.max(initial=0))), side="left")
        for n in live.tolist():
            after, change = self.advance(state[:n], codes[at[:n]])
            state[:n] = after
            total[:n] += change
            at[:n] += 1
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return total[back], state[back]

    def walk(self, name: tuple, codes: list[int]) -> tuple[tuple, int]:
        """One lane alone, by names."""
        now, total = self.state(name), 0
        for code in codes:
            key = now << 21 | code
            goes = self.walked.get(key)
            if goes is None:
                after, change = self.step(self.names[now], code)
                goes = self.walked[key] = (self.state(after), change)
            now, total = goes[0], total + goes[1]
        return self.names[now], total

    def make_room(self) -> None:
        """Between batches: a full table goes, as its transitions are compiled again."""
        if len(self.names) > self.limit:
            self.clear()


def _transducer(path: str) -> Transducer:
    """The worker's transducer; it lives as long as the worker does."""
    kept = sys.modules.setdefault("_marketlens_transducers", types.ModuleType("_marketlens_transducers"))
    if not hasattr(kept, "by_path"):
        kept.by_path = {}
    if path not in kept.by_path:
        kept.by_path[path] = Transducer(path)
    kept.by_path[path].make_room()
    return kept.by_path[path]


def code_points(text: bytes, special: list[str]) -> np.ndarray:
    decoded = text.decode("utf-8", "replace")
    for mark in special:
        if mark in decoded:
            decoded = decoded.replace(mark, chr(SPECIAL))
    return np.frombuffer(decoded.encode("utf-32-le", "surrogatepass"), np.uint32).view(np.int32)


def settled_at(codes: np.ndarray) -> int:
    """Just after the first printable ASCII character with a space behind it; -1: none."""
    hit = (codes[:-1] > 32) & (codes[:-1] < 127) & (codes[1:] == 32)
    at = int(hit.argmax()) if len(hit) else 0
    return at + 2 if len(hit) and hit[at] else -1


def chunk_maps(path: str, chunk: int = CHUNK, lanes_bytes: int = LANES_BYTES):
    """(doc_id, n_bytes, row, chunk number, head, tokens after it, state after it) from
    (doc_id, text, row)."""
    def lanes(batch, machine):
        import pyarrow as pa

        rows, numbers, lasts, heads, parts, starts, froms, n = [], [], [], [], [], [], [], 0
        texts = batch.column(1).cast(pa.binary()).to_pylist()
        for row, text in enumerate(texts):
            codes = code_points(text or b"", machine.merges.special)
            pieces = max(1, -(-len(codes) // chunk))
            for k in range(pieces):
                piece = codes[k * chunk:(k + 1) * chunk]
                skip = 0 if k == 0 else settled_at(piece)
                froms.append(machine.start if k == 0 else machine.settled if skip >= 0 else -1)
                skip = len(piece) if skip < 0 else skip
                rows.append(row)
                numbers.append(k)
                lasts.append(k == pieces - 1)
                heads.append(None if k == 0 else piece[:skip].astype("<u4").tobytes())
                parts.append(piece)
                starts.append(n + skip)
                n += len(piece)
        ends = np.cumsum([len(p) for p in parts])
        froms = np.array(froms)
        known = np.flatnonzero(froms >= 0)
        total, state = machine.run(np.concatenate(parts), np.array(starts)[known], ends[known], froms[known])
        tokens, after = [None] * len(rows), [None] * len(rows)
        for i, t, s in zip(known.tolist(), total.tolist(), state.tolist(), strict=True):
            tokens[i] = t
            if not lasts[i]:
                after[i] = pickle.dumps(machine.names[s])
        of = pa.array(rows, pa.int64())
        n_bytes = pa.array([len(t or b"") for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(of), n_bytes.take(of), batch.column(2).take(of), pa.array(numbers, pa.int32()),
             pa.array(heads, pa.binary()), pa.array(tokens, pa.int64()), pa.array(after, pa.binary())],
            names=["doc_id", "n_bytes", "row", "number", "head", "tokens", "after"])

    def run(batches):
        for batch in batches:
            at = 0
            while at < batch.num_rows:  # some megabytes of text at a time
                take, size = 0, 0
                while at + take < batch.num_rows and (not take or size < lanes_bytes):
                    value = batch.column(1)[at + take]
                    size += value.as_buffer().size if value.is_valid else 0
                    take += 1
                yield lanes(batch.slice(at, take), _transducer(path))
                at += take
    return run


def composed(path: str):
    """(doc_id, n_bytes, n_tokens) from maps in order of (row, number): a running scan that
    holds one state."""
    def run(batches):
        import pyarrow as pa

        def closed(done):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*done, strict=True)],
                                              names=["doc_id", "n_bytes", "n_tokens"])

        doc, total, state = None, 0, None
        for batch in batches:
            machine, done = _transducer(path), []
            for doc_id, n_bytes, _, number, head, n, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if number == 0:
                    if doc is not None:
                        done.append((*doc, total))
                    doc, total = (doc_id, n_bytes), n
                else:
                    name, more = machine.walk(pickle.loads(state), np.frombuffer(head, "<u4").tolist())
                    total += more + (n or 0)
                    if n is None:
                        after = pickle.dumps(name)
                state = after
            if done:
                yield closed(done)
        if doc is not None:
            yield closed([(*doc, total)])
    return run

def token_counts(documents: DataFrame, path: str, limit: int = 1024, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each document; see the module's docstring."""
    docs = (columns_of(documents, "doc_id", "text")
            .select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                    F.monotonically_increasing_id().alias("row")))
    maps = docs.mapInArrow(chunk_maps(path, chunk), "doc_id long, n_bytes long, row long, number int, "
                                                    "head binary, tokens long, after binary")
    ordered = maps.repartition("row").sortWithinPartitions("row", "number")
    return (ordered.mapInArrow(composed(path), "doc_id long, n_bytes long, n_tokens long")
            .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
