"""Split, vocabulary, TF-IDF, class weights and batching.

TF-IDF follows the reference's library defaults: raw counts, smooth idf
``ln((1 + n) / (1 + df)) + 1`` over the n training documents, L2-normalised rows,
vocabulary = the ``max_features`` most frequent terms (ties by term), indexed in
alphabetical order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART_DOCS = 5_000  # documents of a part whose terms are counted together


def stable_hash(id_col: str | Column, seed: int | str = 42) -> Column:
    """Uniform 32-bit value from md5(id ':' seed); the same in any engine with md5 and
    independent of partitioning."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    digest = F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def train_test_split(df: DataFrame, id_col: str, test_percent: int = 20, seed: int = 42,
                     split_col: str = "split") -> DataFrame:
    """A row is ``test`` when its hash bucket (0-99) is below ``test_percent``.
    Sizes are near, not exactly, 80/20; the assignment never depends on partitioning."""
    bucket = stable_hash(id_col, seed) % 100
    return df.withColumn(split_col, F.when(bucket < test_percent, "test").otherwise("train"))


def explode_words(df: DataFrame, id_col: str, array_col: str, word_col: str = "term",
                  pos_col: str | None = None) -> DataFrame:
    """One row per array element (with its position if ``pos_col``).

    Written as an outer explode plus a NULL filter: for a plain explode Catalyst
    infers ``size(array) > 0`` and pushes that predicate below the preceding
    exchange, which evaluates the whole text-cleaning expression twice, the first
    time before the work is spread out.
    """
    if pos_col:
        out = df.select(id_col, F.posexplode_outer(array_col).alias(pos_col, word_col))
    else:
        out = df.select(id_col, F.explode_outer(array_col).alias(word_col))
    return out.filter(F.col(word_col).isNotNull())


def document_terms(df: DataFrame, id_col: str, terms_col: str) -> DataFrame:
    """(doc, term, tf): raw term counts per document."""
    return (explode_words(df, id_col, terms_col)
            .groupBy(id_col, "term").agg(F.count("*").alias("tf")))


def repeats(df: DataFrame, id_col: str) -> bool:
    """Whether rows share an id (null counts as one)."""
    return bool(df.groupBy(id_col).agg(F.count("*").alias("_n")).filter("_n > 1").limit(1).count())


def term_stats(df: DataFrame, id_col: str, terms_col: str) -> DataFrame:
    """(term, total_count, doc_freq).  A document's distinct terms are known in its row, so
    what is grouped over documents has one entry a term, never one a document and term.
    Rows that share an id are one document: only where there are any, arrays are put together."""
    docs = df.select(id_col, F.col(terms_col).alias("_terms"))
    if repeats(df, id_col):
        docs = docs.groupBy(id_col).agg(F.flatten(F.collect_list("_terms")).alias("_terms"))
    both = F.posexplode_outer(F.concat("_terms", F.array_distinct("_terms"))).alias("_pos", "term")
    entries = docs.select(F.size("_terms").alias("_n"), both).filter(F.col("term").isNotNull())
    of_all = F.col("_pos") < F.col("_n")
    return entries.groupBy("term").agg(F.count_if(of_all).alias("total_count"), F.count_if(~of_all).alias("doc_freq"))


def top_terms(stats: DataFrame, max_features: int = 5000) -> DataFrame:
    """H5: the ``max_features`` terms of ``term_stats`` with the highest corpus count (ties
    by term), indexed 0.. in alphabetical order, with their document frequency.  The limit
    is the feature: Spark keeps a top-N per task and merges at most N rows per task."""
    top = stats.orderBy(F.desc("total_count"), F.asc("term")).limit(max_features)
    # At most max_features rows: ranking them in one window partition is bounded.
    return top.withColumn("term_index",
                          (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def fit_tfidf(train: DataFrame, id_col: str, terms_col: str, max_features: int = 5000) -> DataFrame:
    """Vocabulary (term, term_index, total_count, doc_freq, idf) from training rows."""
    n_docs = train.agg(F.count("*")).scalar()
    vocab = top_terms(term_stats(train, id_col, terms_col), max_features)
    return vocab.withColumn(
        "idf", F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("doc_freq"))) + F.lit(1.0))


def transform_tfidf(df: DataFrame, id_col: str, terms_col: str, vocab: DataFrame) -> DataFrame:
    """(doc, term, term_index, weight) for vocabulary terms, each document's
    weights scaled to unit L2 norm.  Terms outside the vocabulary are ignored.

    Documents are dealt out by id as they are, with their arrays; counts, weights and norms
    of a document are then made where it lies (with a vocabulary that is broadcast), and the
    result is partitioned by id.  A part has few documents, however many there are in all."""
    rows = df.select(id_col, terms_col)
    parts = rows.count() // PART_DOCS + 1
    known = vocab.select("term", "term_index", "idf")
    tf = document_terms(rows.repartition(parts, id_col), id_col, terms_col)
    w = (tf.join(known, "term")
         .withColumn("w", F.col("tf") * F.col("idf")))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return w.select(id_col, "term", "term_index", (F.col("w") / norm).alias("weight"))


def class_weights(df: DataFrame, label_col: str) -> DataFrame:
    """Balanced weights n / (k * n_c) per label."""
    counts = df.groupBy(label_col).agg(F.count("*").alias("n"))
    n_total = df.agg(F.count("*")).scalar()
    k = df.agg(F.countDistinct(label_col)).scalar()
    return counts.withColumn("weight", n_total.cast("double") / (k * F.col("n")))


def with_class_weights(df: DataFrame, label_col: str, weight_col: str = "weight") -> DataFrame:
    w = class_weights(df, label_col).select(label_col, F.col("weight").alias(weight_col))
    return df.join(w, label_col, "left")


def assign_batches(df: DataFrame, id_col: str, batch_size: int = 32, seed: int = 42,
                   n_buckets: int | None = None, group_col: str | None = None) -> DataFrame:
    """A seeded permutation of the rows and fixed-size batches, numbered within
    ``group_col`` when given (e.g. per split).

    Rows are ordered by (hash(id, seed), id).  The position is computed without a
    single-partition window: the uniform hash range is cut into ``n_buckets`` equal
    buckets, rows are ranked inside their (group, bucket), and each bucket's offset
    is the running count of the buckets before it in its group (a table with one row
    per group and bucket).  Adds ``position`` (0-based) and ``batch_id``.
    """
    if n_buckets is None:
        n_buckets = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    groups = [group_col] if group_col else []
    h = stable_hash(id_col, seed)
    keyed = df.withColumn("_h", h).withColumn(
        "_bucket", ((F.col("_h") * F.lit(n_buckets)) / F.lit(2 ** 32)).cast("long"))
    ranked = keyed.withColumn("_rn", F.row_number().over(
        Window.partitionBy(*groups, "_bucket").orderBy("_h", id_col)))
    sizes = keyed.groupBy(*groups, "_bucket").agg(F.count("*").alias("_size"))
    # One row per (group, bucket): the running sum over them is bounded.
    offsets = sizes.select(*groups, "_bucket", (F.sum("_size").over(
        Window.partitionBy(*groups).orderBy("_bucket")
        .rowsBetween(Window.unboundedPreceding, -1))).alias("_offset"))
    pos = F.coalesce(F.col("_offset"), F.lit(0)) + F.col("_rn") - 1
    return (ranked.join(offsets, [*groups, "_bucket"])
            .withColumn("position", pos.cast("long"))
            .withColumn("batch_id", F.floor(F.col("position") / F.lit(batch_size)).cast("long"))
            .drop("_h", "_bucket", "_rn", "_offset"))
