"""Spelling variant grouping with pivotal grams.

Words of a corpus are near when they differ by one inserted, deleted or replaced code
point.  Candidates come from bigrams, the rare ones first (by the number of words that
hold them, ties by the bigram):

- a word's *prefix* is every occurrence of its bigrams up to the third in that order;
- its *pivots* are two bigrams of the prefix that share no code point, chosen by dynamic
  programming over their places so that the sum of their frequencies is least.

One edit touches at most one of two disjoint pivots.  If it lies at or after the second,
the first survives and everything up to its end is unchanged; if it lies before, the
second survives with everything from its start on.  And of two near words, the one whose
prefix ends earlier in the order has its surviving pivot in the other's prefix.  So each
word is indexed under (beginning through its first pivot) and (end from its second pivot
on), once for each length its partner can have, and asks with the beginnings and ends at
the bigrams of its own prefix.  Equal sides mean equal places: the position limit is part
of the key, and the join is one on equal keys that Spark can split where a key is hot.
A candidate is verified inside the join by its edit distance, so only links come out.

Words are counted in each task first, then over the corpus; nothing but the frequencies of
bigrams (at most the square of the alphabet, 8 100) reaches the driver.  A word's form is
its most frequent near word if that is frequent enough; forms are followed to the root by
pointer jumping, a few rounds, as frequencies at least double with each step.

Noise: with ``noise`` n, a run loses one code point where n divides the crc32 of
``<doc_id>:<run>``; 0 turns it off.

Nulls and edge cases: a null text has no words; a null doc_id is written as the empty
text in the crc32; rows that repeat a doc_id are separate documents, and each is counted;
an empty table or one without words gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import columns_of, drop_stage, stage_table

RUN = re.compile("[a-zÀ-ÿ]+")  # after A-Z are lower-cased
WORDS_HELD = 400_000  # different words a task counts before it hands them on


def _count_words(noise: int, held: int = WORDS_HELD):
    """(word, n) of a task's texts, handed on whenever ``held`` different ones are met."""
    def run(batches):
        import pyarrow as pa

        def table(counts):
            return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                               pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts: Counter = Counter()
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for doc, text in zip(batch.column(0).to_pylist(), texts, strict=True):
                if not text.is_valid:
                    continue
                # bytes.lower knows A-Z only
                runs = RUN.findall(text.as_buffer().to_pybytes().lower().decode("utf-8", "replace"))
                if not noise:
                    counts.update(runs)
                else:
                    seed = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word, n in Counter(runs).items():
                        h = zlib.crc32(word.encode(), seed)
                        if h % noise == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                        counts[word] += n
                if len(counts) >= held:
                    yield table(counts)
                    counts = Counter()
        if counts:
            yield table(counts)
    return run


def words_of(documents: DataFrame, least_length: int, least_n: int, noise: int = 0) -> DataFrame:
    """(word, n): words of enough code points and occurrences."""
    found = (columns_of(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .mapInArrow(_count_words(noise), "word string, n long"))
    return (found.filter(F.char_length("word") >= least_length).groupBy("word")
            .agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n))


def gram_frequencies(words: DataFrame) -> dict[str, int]:
    """In how many words each bigram is; bounded by the square of the alphabet."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = F.array_distinct(F.transform(places, lambda i: F.col("word").substr(i, F.lit(2))))
    counted = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    return {r["gram"]: r["n"] for r in counted.collect()}


def prefix_of(word: str, frequency: dict[str, int]) -> list[tuple[int, str]]:
    """(place, bigram) of all occurrences up to the third in order of frequency."""
    grams = [word[i:i + 2] for i in range(len(word) - 1)]
    order = sorted((frequency[g], g) for g in grams)
    last = order[min(2, len(order) - 1)]
    return [(i, g) for i, g in enumerate(grams) if (frequency[g], g) <= last]


def pivots_of(prefix: list[tuple[int, str]], frequency: dict[str, int], pivots: int = 2) -> list[int]:
    """Places of ``pivots`` disjoint bigrams of least total frequency.  best[k] after a
    place: the cheapest k disjoint ones so far, as (cost, places)."""
    best: list[list] = [[(0, ())] + [None] * pivots]  # before the first place
    for at, (place, gram) in enumerate(prefix):
        # the row of the last place that this bigram doesn't overlap
        free = next((j for j in range(at, 0, -1) if prefix[j - 1][0] + 2 <= place), 0)
        row = list(best[-1])
        for k in range(1, pivots + 1):
            if best[free][k - 1] is not None:
                cost, places = best[free][k - 1]
                with_it = (cost + frequency[gram], (*places, place))
                if row[k] is None or with_it < row[k]:
                    row[k] = with_it
        best.append(row)
    return list(best[-1][pivots][1])


def letter_bits(word: str) -> int:
    """31 bits for which letters a word has and 31 for the parity of their numbers; one
    edit changes at most two of each."""
    some, odd = 0, 0
    for c in word:
        bit = 1 << ord(c) % 31
        some |= bit
        odd ^= bit
    return some << 31 | odd


def _keys(frequency: dict[str, int]):
    """(word, indexed, key, size): under which keys a word is indexed, for partners of
    each size, and with which it asks."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out: list[list] = [[], [], [], [], []]

            def put(word, indexed, key, size):
                for column, value in zip(out, (word, indexed, key, size, letters), strict=True):
                    column.append(value)
            for word in batch.column(0).to_pylist():
                n, prefix = len(word), prefix_of(word, frequency)
                first, second = pivots_of(prefix, frequency)
                letters = letter_bits(word)
                for size in (n - 1, n, n + 1):
                    put(word, True, "<" + word[:first + 2], size)
                    put(word, True, ">" + word[second:], size)
                for place, _ in prefix:
                    put(word, False, "<" + word[:place + 2], n)
                    put(word, False, ">" + word[place:], n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.bool_()), pa.array(out[2], pa.string()),
                 pa.array(out[3], pa.int32()), pa.array(out[4], pa.int64())],
                names=["word", "indexed", "key", "size", "letters"])
    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(u, v), u before v: all pairs of words one edit apart, once each."""
    keys = stage_table(words.select("word").mapInArrow(
        _keys(gram_frequencies(words)), "word string, indexed boolean, key string, size int, letters long"), "word-keys")
    there = keys.filter("indexed").select(F.col("word").alias("u"), "key", "size", "letters")
    here = keys.filter("NOT indexed").select(F.col("word").alias("v"), F.col("key").alias("k"),
                                             F.col("size").alias("s"), F.col("letters").alias("l"))
    alike = F.bit_count(F.col("letters").bitwiseXOR(F.col("l"))) <= 4  # cheap, before the distance
    near = alike & (F.levenshtein("u", "v", 1) == 1)
    pairs = there.join(here, (F.col("key") == F.col("k")) & (F.col("size") == F.col("s"))
                       & (F.col("u") != F.col("v")) & near)
    found = stage_table(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
                        "near-words")
    drop_stage(keys)
    return found


def _roots(forms: DataFrame, most_n: int) -> DataFrame:
    """(word, root) for words with a form: pointer jumping, each round twice as far."""
    now = stage_table(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(max(1, math.ceil(math.log2(max(2, math.log2(max(2, most_n)) + 1))))):
        step = now.select(F.col("word").alias("w"), F.col("root").alias("r"))
        after = stage_table(now.join(step, F.col("root") == F.col("w"), "left")
                            .select("word", F.coalesce("r", "root").alias("root")), "roots")
        drop_stage(now)
        now = after
    return now


def spelling_variants(documents: DataFrame, least_length: int = 5, least_n: int = 3, ratio: int = 2,
                      noise: int = 0) -> DataFrame:
    """word, form, root, n, n_near, form_n; see the module's docstring."""
    if least_length < 4 or ratio < 2:
        raise ValueError("two disjoint bigrams need words of four code points; forms need a ratio of 2 or more")
    words = stage_table(words_of(documents, least_length, least_n, noise), "words")
    pairs = near_pairs(words)
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    known = words.select(F.col("word").alias("v0"), F.col("n").alias("v_n"))
    best = (both.join(known, F.col("v") == F.col("v0")).groupBy("u")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("v_n")).alias("minus"), "v")).alias("best")))
    near = words.join(best, F.col("word") == F.col("u"), "left")
    enough = -F.col("best.minus") >= F.lit(ratio) * F.col("n")
    near = stage_table(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                   F.when(enough, F.col("best.v")).alias("form"),
                                   F.when(enough, -F.col("best.minus")).alias("form_n")), "variants")
    formed = near.filter(F.col("form").isNotNull())
    most = near.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    roots = _roots(formed, most).select(F.col("word").alias("w"), "root")
    return (near.join(roots, F.col("word") == F.col("w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
