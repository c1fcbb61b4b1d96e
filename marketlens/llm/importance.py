"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and runs of punctuation, one and two at
a time): one of all raw text, one of the target text, the documents labelled good.  A
document's log weight is the mean log ratio of the two over its n-grams.  Documents are
drawn without replacement in proportion to weight ** ``sharpness`` by the Gumbel top-k
trick: the ``k`` largest of ``sharpness * log weight + Gumbel noise`` are kept.  ``k`` is
the number of documents at or above the log weight that separates the labelled good
from the labelled bad best; with ``k`` or ``keep_share`` given, that many.

Counts of the raw model cover every whole text.  The target model and the separating
weight come from at most ``label_rows`` labelled documents (those with the smallest
digests of their ids), a documented bound; the sample's ids are what is broadcast.
Counts meet as one row for each task and bucket; the model has ``2 ** bucket_bits``
buckets whatever the data.  Texts are never shuffled.

Nulls and edge cases: a null or empty text has no n-grams and log weight 0; null labels
are skipped; without good (or without bad) labels all documents are kept; a null doc_id
draws as any other; rows that repeat a doc_id share their noise; an empty table gives an
empty result; further columns are ignored (``resample`` keeps them).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.llm.common import RollingHash, columns_of, mix64, row_chunks, stage_table, text_bytes, uniform

BUCKET_BITS = 15
LABEL_ROWS = 20_000
SHARPNESS = 200.0


def _classes() -> np.ndarray:
    kind = np.full(256, 2, np.uint8)  # punctuation
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[128:] = 1
    for a, b in ("09", "AZ", "az"):
        kind[ord(a):ord(b) + 1] = 1
    return kind


def gram_buckets(data: np.ndarray, offsets: np.ndarray, bits: int, hasher: RollingHash):
    """(row, bucket) of every n-gram of the rows."""
    kind = _classes()[data]
    fresh = np.ones(len(data), bool)
    fresh[1:] = kind[1:] != kind[:-1]
    fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
    cut = np.flatnonzero(fresh)
    end = np.append(cut[1:], len(data))
    word = kind[cut] != 0
    cut, end = cut[word], end[word]
    token = mix64(hasher.at(hasher.prefix(data), cut, end) ^ (end - cut).astype(np.uint64))
    row = np.searchsorted(offsets, cut, side="right") - 1
    pair = row[1:] == row[:-1]
    two = mix64(token[:-1][pair] * np.uint64(0x9E3779B97F4A7C15) + token[1:][pair])
    shift = np.uint64(64 - bits)
    return np.concatenate([row, row[1:][pair]]), (np.concatenate([token, two]) >> shift).astype(np.int64)


def _count(bits: int):
    """Per task: n-grams of each bucket in all rows and in the target rows."""
    def run(batches):
        import pyarrow as pa

        hasher, size = RollingHash(), 1 << bits
        counts = np.zeros((2, size), np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            good = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for a, b in row_chunks(offsets, 1 << 20):
                base = offsets[a]
                row, bucket = gram_buckets(data[base:offsets[b]], offsets[a:b + 1] - base, bits, hasher)
                counts[0] += np.bincount(bucket, minlength=size)
                counts[1] += np.bincount(bucket[good[a:b][row]], minlength=size)
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])],
                                         names=["bucket", "raw", "target"])
    return run


def _score(table: np.ndarray, bits: int, text_at: int):
    """All columns, and the mean log ratio of the row's n-grams and their number."""
    def run(batches):
        import pyarrow as pa

        hasher = RollingHash()
        for batch in batches:
            data, offsets = text_bytes(batch.column(text_at))
            n = np.zeros(batch.num_rows, np.int64)
            total = np.zeros(batch.num_rows)
            for a, b in row_chunks(offsets, 1 << 20):
                base = offsets[a]
                row, bucket = gram_buckets(data[base:offsets[b]], offsets[a:b + 1] - base, bits, hasher)
                n[a:b] = np.bincount(row, minlength=b - a)
                total[a:b] = np.bincount(row, table[bucket], minlength=b - a)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(n), pa.array(total / np.maximum(n, 1))],
                names=[*batch.schema.names, "_n_grams", "_log_weight"])
    return run


def labelled_sample(labels: DataFrame, label_rows: int = LABEL_ROWS) -> DataFrame:
    """At most ``label_rows`` labelled ids, one row an id (good if all its labels are)."""
    return (columns_of(labels, "doc_id", "quality").filter("doc_id IS NOT NULL AND quality IS NOT NULL")
            .groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))
            .orderBy(uniform(F.col("doc_id"), seed="label"), "doc_id").limit(label_rows))


def fit(documents: DataFrame, sample: DataFrame, bits: int = BUCKET_BITS) -> np.ndarray:
    """The log ratio of each bucket."""
    ids = F.broadcast(sample.filter("good").select(F.col("doc_id").alias("_id"), F.lit(True).alias("_good")))
    texts = (columns_of(documents, "doc_id", "text").join(ids, F.col("doc_id") == F.col("_id"), "left")
             .select("text", F.coalesce("_good", F.lit(False)).alias("good")))
    counted = (texts.mapInArrow(_count(bits), "bucket long, raw long, target long")
               .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")))
    raw, target = np.ones(1 << bits), np.ones(1 << bits)
    for r in counted.collect():  # one row a bucket
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    # the target is a part of the raw text: smooth it towards the raw model
    prior = raw / raw.sum()
    target = target - 1 + prior * len(raw)
    return np.log(target / target.sum()) - np.log(prior)


def scored(documents: DataFrame, table: np.ndarray, bits: int = BUCKET_BITS) -> DataFrame:
    schema = T.StructType([*documents.schema.fields, T.StructField("_n_grams", T.LongType()),
                           T.StructField("_log_weight", T.DoubleType())])
    return documents.mapInArrow(_score(table, bits, documents.columns.index("text")), schema)


def separating(weights: np.ndarray, good: np.ndarray) -> float:
    """The weight from which on documents count as good, so that the shares of good
    documents below and bad ones above add up to least (midway between neighbours)."""
    if not good.any() or good.all():
        return -math.inf
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    lost = np.concatenate([[0], np.cumsum(g)]) / g.sum()
    caught = np.concatenate([[0], np.cumsum(~g)]) / (~g).sum()
    split = np.concatenate([[True], w[1:] > w[:-1], [True]])
    at = int(np.argmax(np.where(split, caught - lost, -2.0)))
    if at == 0:
        return -math.inf
    return float((w[at - 1] + w[at]) / 2) if at < len(w) else math.inf


def gumbel_key(doc_id: Column, log_weight: Column, sharpness: float = SHARPNESS, seed: str = "gumbel") -> Column:
    return F.lit(sharpness) * log_weight - F.log(-F.log(uniform(doc_id, seed=seed)))


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024, exact_rows: int = 10_000) -> float:
    """The ``k``-th largest value of ``column``: histograms of ever narrower ranges (one
    row a bin comes to the driver), then at most ``exact_rows`` values."""
    if k <= 0:
        return math.inf
    low, high, n = df.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return -math.inf
    inside = df.select(column)
    while n > exact_rows and high > low:
        width = (high - low) / bins
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1))
        rows = (inside.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"),
                                                   F.max(column).alias("high")).orderBy(F.desc("bin")).collect())
        for r in rows:
            if k <= r["n"]:
                break
            k -= r["n"]
        if r["n"] == n:
            break
        low, high, n = r["low"], r["high"], r["n"]
        inside = inside.filter(F.col(column).between(low, high))
    if high == low:
        return float(low)
    return float(inside.orderBy(F.desc(column)).limit(k).agg(F.min(column)).first()[0])


def _cut(documents: DataFrame, labels: DataFrame, label_rows: int, sharpness: float, k: int | None):
    sample = stage_table(labelled_sample(labels, label_rows), "labels")
    table = fit(documents, sample)
    scores = stage_table(
        scored(columns_of(documents, "doc_id", "text"), table).drop("text")
        .withColumn("key", gumbel_key(F.col("doc_id"), F.col("_log_weight"), sharpness)), "scores")
    known = (scores.join(F.broadcast(sample), "doc_id").select("_log_weight", "good").toPandas())
    least = separating(known["_log_weight"].to_numpy(float), known["good"].to_numpy(bool))
    if k is None:
        k = scores.filter(F.col("_log_weight") >= least).count()
    return table, scores, least, kth_largest(scores, "key", k)


def classify(documents: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS,
             sharpness: float = SHARPNESS, k: int | None = None) -> DataFrame:
    """doc_id, n_grams, log_weight, key, kept for each document."""
    _, scores, _, cut = _cut(documents, labels, label_rows, sharpness, k)
    return scores.select("doc_id", F.col("_n_grams").alias("n_grams"), F.col("_log_weight").alias("log_weight"),
                         "key", (F.col("key") >= F.lit(cut)).alias("kept"))


def resample(documents: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS,
             sharpness: float = SHARPNESS, k: int | None = None) -> DataFrame:
    """The documents that are kept, with all their columns.  They are scored once more
    where they are read, which is cheaper than a shuffle of their texts."""
    table, _, _, cut = _cut(documents, labels, label_rows, sharpness, k)
    key = gumbel_key(F.col("doc_id"), F.col("_log_weight"), sharpness)
    # the input row travels as one struct, so none of its names can clash
    rows = documents.select("doc_id", "text", F.struct(*[F.col(f"`{n}`") for n in documents.columns]).alias("row"))
    return (scored(rows, table).filter(key >= F.lit(cut))
            .select(*[F.col(f"row.`{n}`").alias(n) for n in documents.columns]))
