"""Suffix-array dedup: removes every byte covered by a long string that starts earlier.

Routing.  Equal strings must meet.  Every ``length``-byte window owns one anchor, the
window's smallest hashed ``anchor``-byte gram (leftmost on ties), so equal windows own
equal anchors at equal offsets.  Consecutive windows with one anchor form a segment.
Anchors that occur once are dropped by a count (combined before the shuffle); equal
segments of the rest collapse to their earliest occurrence, later ones are removed
whole.  What is left are classes: different segments around one repeated anchor.

Suffix sorting.  Classes are concatenated into blocks of bounded size and each block's
suffix array is built by linear grouping: suffix groups are processed in descending
order of their Lyndon prefixes; previous-smaller pointers tell which smaller suffixes a
group extends, and those are split off by how many of the group's members point to
them; a second pass emits each group's order from the suffixes already placed.  Nothing
is renamed or sorted recursively.  Neighbours in the array with a common prefix of
``length`` bytes are equal windows; all but the earliest are removed.

A class with more than ``class_limit`` different segments (a passage inside very many
documents) is not put into one task: its segments are cut into ranges of windows and
classed anew by the bytes that all windows of a range cover.  Where a class is still
larger, its windows are keyed one by one by a 128-bit hash and reduced to the earliest
with a combining aggregate, which is exact as well.  The same ranges tell, inside a
small class, which windows can be equal to any other; the rest is not sorted.

Nulls and edge cases: a null text is empty; texts shorter than ``length`` lose nothing;
a null doc_id counts as the smallest id; a document is its doc_id and a 128-bit digest of
its text, so rows of one id (or of none) with different texts are documents of their own,
in the order of the digest, and rows alike in both are one document given twice (equal
places don't remove each other); an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import (NULL_ID, RollingHash, columns_of, drop_stage, id_key, mix64,
                                   row_chunks, stage_table, text_bytes, text_digest)

CHUNK = 1 << 20        # bytes of text hashed at a time
POSITION_BITS = 26     # of a packed (hash, position) key
CLASS_LIMIT = 512      # segments of a class sorted in one block
BLOCK_BYTES = 1 << 14  # of a block that one suffix array covers
RANGES = 5             # of window starts around the anchor, see _cores
SEGMENT = ["h", "doc", "pos", "windows", "lead", "raw"]
DOC = "struct<id: long, d1: long, d2: long>"  # id key and text digest; compared in this order


def suffix_array(codes: list[int]) -> list[int]:
    """The suffix array of ``codes``, whose last value is smaller than all others.

    Group labels are the group's first rank, so labels compare as groups do.  A group of one
    suffix is kept as that suffix, without a set around it.
    """
    n = len(codes)
    by_code = {}
    for i, c in enumerate(codes):
        if c in by_code:
            by_code[c].append(i)
        else:
            by_code[c] = [i]
    label, members, first_of_end = [0] * n, [None] * n, [0] * (n + 1)
    rank = 0
    for c in sorted(by_code):
        group = by_code[c]
        for i in group:
            label[i] = rank
        members[rank] = set(group) if len(group) > 1 else group[0]
        first_of_end[rank + len(group)] = rank
        rank += len(group)
    smaller = [-1] * n  # previous-smaller pointers
    end = n
    while end > 0:
        here = first_of_end[end]
        if here == end - 1:  # one suffix: it extends one smaller suffix at most
            i = members[here]
            if type(i) is set:
                i = i.pop()
            p = i - 1
            while p >= 0 and label[p] >= here:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                old = label[p]
                rest = members[old]
                if type(rest) is set and len(rest) > 1:
                    top = old + len(rest)
                    rest.remove(p)
                    new = label[p] = top - 1
                    members[new] = p
                    first_of_end[top] = new
                    first_of_end[new] = old
            end = here
            continue
        pointed = {}
        for i in sorted(members[here]):
            p = i - 1
            while p >= 0 and label[p] >= here:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        by_count = {}
        for p, times in pointed.items():
            g = label[p]
            if times in by_count:
                groups = by_count[times]
                if g in groups:
                    groups[g].append(p)
                else:
                    groups[g] = [p]
            else:
                by_count[times] = {g: [p]}
        for times in sorted(by_count, reverse=True):
            for old, moved in by_count[times].items():
                rest = members[old]
                if type(rest) is int or len(moved) == len(rest):
                    continue  # the whole group moves: it stays where it is
                top = old + len(rest)
                if len(moved) == 1:
                    p = moved[0]
                    rest.remove(p)
                    new = label[p] = top - 1
                    members[new] = p
                else:
                    moved = set(moved)
                    rest -= moved
                    new = old + len(rest)
                    for p in moved:
                        label[p] = new
                    members[new] = moved
                first_of_end[top] = new
                first_of_end[new] = old
        end = here
    order, fill = [-1] * n, list(range(n))
    order[0] = n - 1
    label[n - 1] = -1  # of a suffix that is placed
    for r in range(n):
        p = order[r] - 1
        while p >= 0:
            g = label[p]
            if g < 0:
                break
            at = fill[g]
            fill[g] = at + 1
            order[at] = p
            label[p] = -1
            p = smaller[p]
    return order


def _anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int, hasher: RollingHash):
    """Segments of one chunk: row, start in the row, windows, bytes from the start to the
    anchor, gram hash, segment hash."""
    n, span = len(data), length - gram + 1
    if n < length:
        return None
    prefix = hasher.prefix(data)
    starts = np.arange(n - gram + 1)
    _, down = hasher.powers(n + 1)
    grams = mix64((prefix[gram:] - prefix[:-gram]) * down[:n - gram + 1])
    keep = np.uint64((1 << 64) - (1 << POSITION_BITS))
    low = (grams & keep) | starts.astype(np.uint64)
    reach = 1
    while reach * 2 <= span:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < span:
        low = np.minimum(low[:len(low) - (span - reach)], low[span - reach:])
    anchor = (low & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    windows = n - length + 1
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:windows]
    valid = np.arange(windows) + length <= offsets[row + 1]
    at = np.flatnonzero(valid)
    if not len(at):
        return None
    fresh = np.ones(len(at), bool)
    fresh[1:] = (anchor[at][1:] != anchor[at][:-1]) | (at[1:] != at[:-1] + 1)
    head = np.flatnonzero(fresh)
    first, last = at[head], at[np.append(head[1:], len(at)) - 1]
    a = anchor[first]
    shape = ((last - first + 1).astype(np.uint64) << np.uint64(32)) | (a - first).astype(np.uint64)
    segment = mix64(hasher.at(prefix, first, last + length) + mix64(shape))
    return row[first], first - offsets[row[first]], last - first + 1, a - first, grams[a], segment


def _pieces(offsets: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row, from byte, to byte) of bounded chunks; a row longer than a
    chunk comes in pieces that overlap by ``length - 1`` bytes."""
    for a, b in row_chunks(offsets, CHUNK):
        if offsets[b] - offsets[a] <= 2 * CHUNK or b > a + 1:
            yield a, b, int(offsets[a]), int(offsets[b])
            continue
        at, end = int(offsets[a]), int(offsets[b])
        while at < end:
            yield a, b, at, min(at + CHUNK + length - 1, end)
            at += CHUNK


def _doc_tuples(array) -> list[tuple[int, int, int]]:
    return list(zip(*(array.field(k).to_pylist() for k in range(3)), strict=True))


def _doc_array(docs):
    import pyarrow as pa

    return pa.StructArray.from_arrays([pa.array([d[k] for d in docs], pa.int64()) for k in range(3)],
                                      names=["id", "d1", "d2"])


def _anchor_rows(length: int, gram: int):
    def run(batches):
        import pyarrow as pa

        hasher = RollingHash()
        for batch in batches:
            docs = batch.column(0)
            data, offsets = text_bytes(batch.column(1))
            for a, b, lo, hi in _pieces(offsets, length):
                local = np.clip(offsets[a:b + 1], lo, hi) - lo
                found = _anchors(data[lo:hi], local, length, gram, hasher)
                if found is None:
                    continue
                row, start, windows, lead, h, segment = found
                shift = lo - offsets[a] if b == a + 1 else 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(segment.view(np.int64)),
                     docs.take(pa.array(a + row)), pa.array(start + shift),
                     pa.array(windows.astype(np.int32)), pa.array(lead.astype(np.int32))],
                    names=["h", "seg", "doc", "pos", "windows", "lead"])
    return run


def _segment_texts(batches):
    """The bytes of each document's wanted segments: one row a segment."""
    import pyarrow as pa

    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        docs = batch.column(0)
        lists = batch.column(2)
        wants = lists.flatten()
        counts = np.diff(lists.offsets.to_numpy())
        h, pos, size, windows, lead = (wants.field(k).to_numpy(zero_copy_only=False)
                                       for k in ("h", "pos", "size", "windows", "lead"))
        row = np.repeat(np.arange(len(docs)), counts)
        for lo in range(0, len(row), 50_000):
            part = slice(lo, lo + 50_000)
            at = offsets[row[part]] + pos[part]
            raw = [data[s:s + n].tobytes() for s, n in zip(at, size[part], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[part]), docs.take(pa.array(row[part])), pa.array(pos[part]),
                 pa.array(windows[part]), pa.array(lead[part]), pa.array(raw, pa.binary())],
                names=SEGMENT)


def _cores(windows: int, lead: int, length: int, gram: int):
    """The windows of a segment by how far they reach left of the anchor, in ``RANGES``
    ranges: (range, first window, number of windows, from byte, to byte), the bytes
    being those that all windows of the range cover."""
    spare = length - gram
    step = -(-(spare + 1) // RANGES)
    for k in range(RANGES):
        lo, hi = k * step, min((k + 1) * step - 1, spare)
        a, b = max(lead - hi, 0), min(lead - lo, windows - 1)
        if a <= b:
            yield k, a, b - a + 1, lead - lo, lead + gram + spare - hi


def _trimmed(rows: list[tuple], length: int, gram: int) -> list[tuple]:
    """A class's segments, cut to the windows whose cores occur in another segment of
    the class too; the others can't be equal to anything."""
    seen: dict[tuple, int] = {}
    cores = []
    for _, _, windows, lead, raw in rows:
        own = [(a, n, (k, raw[x:y])) for k, a, n, x, y in _cores(windows, lead, length, gram)]
        cores.append(own)
        for _, _, key in own:
            seen[key] = seen.get(key, 0) + 1
    out = []
    for (doc, pos, _, lead, raw), own in zip(rows, cores, strict=True):
        kept = [(a, n) for a, n, key in own if seen[key] > 1]
        if kept:
            a, b = min(a for a, _ in kept), max(a + n for a, n in kept)
            out.append((doc, pos + a, b - a, raw[a:b + length - 1], lead - a))
    return out


def _block_repeats(rows: list[tuple], length: int, gram: int) -> list[tuple[tuple, int, int]]:
    """(doc, start, end) of windows of the block that have an earlier equal window.

    Every window of a segment covers the segment's anchor, and equal windows have it at the
    same place, so the anchor's bytes are one code: less is sorted, with the same result."""
    codes, owner, base = [], [], []
    anchors: dict[bytes, int] = {}
    for k, (_, _, _, raw, lead) in enumerate(rows):
        base.append(len(codes))
        codes.extend(raw[:lead])
        codes.append(anchors.setdefault(raw[lead:lead + gram], 256 + len(anchors)))
        codes.extend(raw[lead + gram:])
        codes.append(-1)
        owner.extend([k] * (len(codes) - base[-1]))
    codes.append(-2)
    run: list[tuple[int, int]] = []
    found = []

    def close():
        if len(run) > 1:
            least = min(run)
            found.extend((d, p, p + length) for d, p in run if (d, p) != least)

    last = None
    for s in suffix_array(codes)[1:]:
        k = owner[s]
        doc, pos, windows, raw, _ = rows[k]
        off = s - base[k]
        if off >= windows:
            continue
        word = raw[off:off + length]
        if word != last:
            close()
            run, last = [], word
        run.append((doc, pos + off))
    close()
    return found


def _merge(spans: list[tuple[tuple, int, int]]) -> list[tuple[tuple, int, int]]:
    out: list[list[int]] = []
    for d, s, e in sorted(spans):
        if out and out[-1][0] == d and s <= out[-1][2]:
            out[-1][2] = max(out[-1][2], e)
        else:
            out.append([d, s, e])
    return [tuple(x) for x in out]


def _sorted_blocks(length: int, gram: int):
    """Rows arrive ordered by class; whole classes are gathered into blocks."""
    def run(batches):
        import pyarrow as pa

        def emit(rows):
            spans = _merge(_block_repeats(rows, length, gram))
            if spans:
                d, s, e = zip(*spans, strict=True)
                yield pa.RecordBatch.from_arrays([_doc_array(d), pa.array(s, pa.int64()), pa.array(e, pa.int64())],
                                                 names=["doc", "start", "end"])

        block, size, last, held = [], 0, None, []
        for batch in batches:
            h_, docs, *rest = batch.columns
            for h, *row in zip(h_.to_pylist(), _doc_tuples(docs), *(c.to_pylist() for c in rest), strict=True):
                if h != last:
                    more = _trimmed(held, length, gram)
                    block += more
                    size += sum(len(r[3]) for r in more)
                    held, last = [], h
                    if size >= BLOCK_BYTES:
                        yield from emit(block)
                        block, size = [], 0
                held.append(tuple(row))
        block += _trimmed(held, length, gram)
        if block:
            yield from emit(block)
    return run


def _core_rows(length: int, gram: int):
    """Segments of large classes cut into their ranges, classed anew by their cores."""
    def run(batches):
        import hashlib

        import pyarrow as pa

        for batch in batches:
            out: list[list] = [[] for _ in SEGMENT]
            docs = batch.column(1)
            rest = (batch.column(k).to_pylist() for k in range(2, len(SEGMENT)))
            for i, (pos, windows, lead, raw) in enumerate(zip(*rest, strict=True)):
                for k, a, n, x, y in _cores(windows, lead, length, gram):
                    key = hashlib.blake2b(raw[x:y], digest_size=8, key=k.to_bytes(1, "little")).digest()
                    row = (int.from_bytes(key, "little", signed=True), i, pos + a, n, lead - a,
                           raw[a:a + n + length - 1])
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
            columns[1] = docs.take(columns[1])
            yield pa.RecordBatch.from_arrays(columns, names=SEGMENT)
    return run


def _window_keys(length: int):
    """Each window of the large classes with a 128-bit hash of its bytes."""
    def run(batches):
        import pyarrow as pa

        one, two = RollingHash(), RollingHash(0xD6E8FEB86659FD93)
        for batch in batches:
            data, offsets = text_bytes(batch.column(5))
            docs = batch.column(1)
            pos, windows = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            for a, b in row_chunks(offsets, CHUNK):
                piece = data[offsets[a]:offsets[b]]
                count = windows[a:b].astype(np.int64)
                row = np.repeat(np.arange(a, b), count)
                step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                at = offsets[row] - offsets[a] + step
                k1, k2 = (mix64(x.at(x.prefix(piece), at, at + length)).view(np.int64) for x in (one, two))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1), pa.array(k2), docs.take(pa.array(row)), pa.array(pos[row] + step)],
                    names=["k1", "k2", "doc", "pos"])
    return run


def _class_sizes(segments: DataFrame) -> DataFrame:
    """Classes of more than one segment."""
    return (segments.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
            .select(F.col("h").alias("h2"), "n"))


def repeated_spans(docs: DataFrame, length: int = 100, gram: int = 32,
                   class_limit: int = CLASS_LIMIT) -> tuple[DataFrame, list[DataFrame]]:
    """(doc, start, end) byte ranges covered by a ``length``-byte string that also
    starts earlier; ranges of a document may overlap.  Second: the stage tables read."""
    seg_schema = f"h long, seg long, doc {DOC}, pos long, windows int, lead int"
    anchors = stage_table(docs.mapInArrow(_anchor_rows(length, gram), seg_schema), "anchors")
    often = stage_table(anchors.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
                        .select(F.col("h").alias("h2")), "often")
    again = stage_table(anchors.join(often, F.col("h") == F.col("h2"), "left_semi"), "again")
    drop_stage(anchors, often)
    first = stage_table(again.groupBy("h", "seg")
                        .agg(F.min(F.struct("doc", "pos", "windows", "lead")).alias("w"))
                        .select("h", "seg", "w.*"), "first")
    whole = (again.alias("a").join(first.alias("f"), ["h", "seg"])
             .filter("a.doc <> f.doc OR a.pos <> f.pos")
             .select("a.doc", F.col("a.pos").alias("start"),
                     (F.col("a.pos") + F.col("a.windows") + (length - 1)).alias("end")))
    classes = stage_table(_class_sizes(first), "classes")
    wanted = (first.join(classes, F.col("h") == F.col("h2"))
              .groupBy("doc").agg(F.collect_list(F.struct(
                  "h", "pos", (F.col("windows") + (length - 1)).alias("size"), "windows", "lead")).alias("wants")))
    raw_schema = f"h long, doc {DOC}, pos long, windows int, lead int, raw binary"
    raw = stage_table(docs.withColumnRenamed("doc", "doc2").join(wanted, F.col("doc2") == F.col("doc"))
                      .select("doc", "text", "wants").mapInArrow(_segment_texts, raw_schema), "segments")
    sized = raw.join(classes, F.col("h") == F.col("h2"))
    cores = stage_table(sized.filter(F.col("n") > class_limit).select(*SEGMENT)
                        .mapInArrow(_core_rows(length, gram), raw_schema), "cores")
    core_sized = cores.join(_class_sizes(cores), F.col("h") == F.col("h2"))
    small = (sized.filter(F.col("n") <= class_limit)
             .unionByName(core_sized.filter(F.col("n") <= class_limit)).select(*SEGMENT))
    sorted_ = (small.repartition("h").sortWithinPartitions("h")
               .mapInArrow(_sorted_blocks(length, gram), f"doc {DOC}, start long, end long"))
    keys = (core_sized.filter(F.col("n") > class_limit).select(*SEGMENT)
            .mapInArrow(_window_keys(length), f"k1 long, k2 long, doc {DOC}, pos long"))
    keys = stage_table(keys, "windows")
    least = keys.groupBy("k1", "k2").agg(F.min(F.struct("doc", "pos")).alias("w")).select("k1", "k2", "w.*")
    large = (keys.alias("a").join(least.alias("f"), ["k1", "k2"])
             .filter("a.doc <> f.doc OR a.pos <> f.pos")
             .select("a.doc", F.col("a.pos").alias("start"), (F.col("a.pos") + length).alias("end")))
    spans = stage_table(whole.unionByName(sorted_).unionByName(large), "spans")
    drop_stage(again, first, raw, classes, cores, keys)
    return spans, [spans]


def _kept(batches):
    import hashlib

    import pyarrow as pa

    for batch in batches:
        data, offsets = text_bytes(batch.column(1))
        lists = batch.column(2)
        removed, runs, digests = [], [], []
        for k in range(len(lists)):
            raw = data[offsets[k]:offsets[k + 1]]
            spans = lists[k].as_py()
            if not spans:
                removed.append(0)
                runs.append(0)
                digests.append(hashlib.sha256(raw.tobytes()).hexdigest())
                continue
            edge = np.zeros(len(raw) + 1, np.int32)
            se = np.array([(x["start"], x["end"]) for x in spans], np.int64)
            np.add.at(edge, se[:, 0], 1)
            np.add.at(edge, se[:, 1], -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            runs.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            digests.append(hashlib.sha256(raw[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed, pa.int64()),
             pa.array(runs, pa.int64()), pa.array(digests, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def suffix_dedup(documents: DataFrame, length: int = 100, gram: int = 32,
                 class_limit: int = CLASS_LIMIT) -> DataFrame:
    """Per document what remains after the removal; see the module's docstring."""
    key = F.struct(id_key().alias("id"), *text_digest(F.coalesce("text", F.lit(""))))
    docs = columns_of(documents, "doc_id", "text").select(key.alias("doc"), "text")
    spans, _ = repeated_spans(docs, length, gram, class_limit)
    per_doc = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = (docs.withColumnRenamed("doc", "doc2")
              .join(per_doc, F.col("doc2") == F.col("doc"), "left").select("doc2.id", "text", "spans"))
    out = joined.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
