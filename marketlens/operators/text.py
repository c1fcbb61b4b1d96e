"""Text operators over a corpus DataFrame."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlens.functions.text import join_tokens, normalise_text, tokens
from marketlens.operators.features import repeats
from marketlens.operators.lemmas import BROADCAST_ROWS, looked_up

PAD_ID = 0
UNKNOWN_ID = 1
FIRST_TERM_ID = 2


def remove_stopwords(df: DataFrame, input_col: str, output_col: str,
                     language: str = "portuguese", words: list[str] | None = None) -> DataFrame:
    """Drop stop words from an array column (case-sensitive: tokens are already
    lower case, as in the reference)."""
    words = words if words is not None else StopWordsRemover.loadDefaultStopWords(language)
    remover = StopWordsRemover(inputCol=input_col, outputCol=output_col, stopWords=words,
                               caseSensitive=True)
    return remover.transform(df)


def clean_reviews(df: DataFrame, text_col: str, output_col: str = "clean_text",
                  tokens_col: str | None = "tokens", language: str = "portuguese") -> DataFrame:
    """Normalise -> tokenise -> drop stop words -> re-join.  Keeps the token array
    in ``tokens_col`` (set None to drop it).  Whole texts, no truncation."""
    raw = "_raw_tokens"
    keep = tokens_col or "_tokens"
    out = df.withColumn(raw, tokens(normalise_text(F.col(text_col))))
    out = remove_stopwords(out, raw, keep, language).drop(raw)
    out = out.withColumn(output_col, join_tokens(F.col(keep)))
    return out if tokens_col else out.drop(keep)


def _positions(df: DataFrame, id_col: str, tokens_col: str, token: str) -> DataFrame:
    """(id, _pos, token) per token, plus one (id, NULL, NULL) row for a document
    without tokens, so per-document results need no join back to the corpus.
    (An outer explode also keeps Catalyst from pushing ``size(tokens) > 0`` below
    the corpus exchange, which would clean every text twice.)"""
    return df.select(id_col, F.posexplode_outer(tokens_col).alias("_pos", token))


def _replaced(pairs: list[tuple[str, str]], output_col: str):
    """Each row's words by their forms in ``pairs``, where the row lies."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.columns
            offsets = lists.offsets
            words = lists.values.slice(offsets[0].as_py(), offsets[-1].as_py() - offsets[0].as_py())
            known = pa.array([t for t, _ in pairs], words.type)
            forms = pa.array([form for _, form in pairs], words.type)
            found = pc.coalesce(forms.take(pc.index_in(words, value_set=known)), words)
            out = pa.ListArray.from_arrays(pc.subtract(offsets, offsets[0]), found)
            yield pa.RecordBatch.from_arrays([ids, out], [batch.schema.names[0], output_col])
    return run


def _substituted_in_place(df: DataFrame, id_col: str, tokens_col: str, pairs: list[tuple[str, str]],
                          output_col: str) -> DataFrame:
    """No word is moved; only where rows share an id, they are put together by position."""
    schema = T.StructType([df.schema[id_col], T.StructField(output_col, T.ArrayType(T.StringType()))])
    out = df.select(id_col, tokens_col).mapInArrow(_replaced(pairs, output_col), schema)
    if not repeats(df, id_col):
        return out
    entries = F.transform(output_col, lambda w, i: F.struct(i.alias("_pos"), w.alias("_t")))
    together = out.groupBy(id_col).agg(F.array_sort(F.flatten(F.collect_list(entries))).alias("_pairs"))
    return together.select(id_col, F.transform("_pairs", lambda p: p["_t"]).alias(output_col))


def substitute_lemmas(df: DataFrame, id_col: str, tokens_col: str, lemmas: DataFrame,
                      output_col: str = "lemmas") -> DataFrame:
    """Replace each token by its dictionary form from a ``(token, lemma)`` table,
    keeping tokens without an entry; returns (id, lemmas).  The table may be of any
    size, a token in any share of the documents.

    A table of at most ``BROADCAST_ROWS`` rows goes to every task, which replaces the words
    where they lie.  With a larger one (``lemmas.looked_up``) a document's positions are
    gathered for each of its distinct tokens first, so what is joined by token is a row a
    document and token, not an occurrence; then documents are re-assembled in order."""
    pairs = [tuple(r) for r in lemmas.select("token", "lemma").limit(BROADCAST_ROWS + 1).collect()]
    if len(pairs) <= BROADCAST_ROWS and len({t for t, _ in pairs}) == len(pairs):
        return _substituted_in_place(df, id_col, tokens_col, [p for p in pairs if p[0] is not None], output_col)
    at = _positions(df, id_col, tokens_col, "token").groupBy(id_col, "token").agg(F.collect_list("_pos").alias("_at"))
    mapped = looked_up(at, lemmas.select("token", "lemma"), "token", spread=[id_col])
    word = F.coalesce("lemma", "token")
    entries = F.transform("_at", lambda p: F.struct(p.alias("_pos"), word.alias("_t")))
    return (mapped.groupBy(id_col)
            .agg(F.array_sort(F.flatten(F.collect_list(entries))).alias("_pairs"))
            .select(id_col, F.transform("_pairs", lambda p: p["_t"]).alias(output_col)))


def plural_lemmas(vocabulary: DataFrame, term_col: str = "term") -> DataFrame:
    """A (token, lemma) table derived from a vocabulary by one rule: a term ending in
    "s" whose stem without the "s" is itself in the vocabulary maps to that stem."""
    v = vocabulary.select(F.col(term_col).alias("token")).distinct()
    stems = v.select(F.col("token").alias("lemma"))
    candidates = (v.filter(F.col("token").endswith("s") & (F.length("token") > 2))
                  .withColumn("lemma", F.expr("substring(token, 1, length(token) - 1)")))
    return candidates.join(stems, "lemma", "left_semi").select("token", "lemma")


def encode_fixed_length(df: DataFrame, id_col: str, tokens_col: str, vocab: DataFrame,
                        max_len: int = 50, term_col: str = "term",
                        index_col: str = "term_index") -> DataFrame:
    """Per document (id, n_tokens, input_ids, attention_mask).

    ``input_ids``: the id of every token (vocabulary index + FIRST_TERM_ID, or
    UNKNOWN_ID), truncated to ``max_len`` and padded with PAD_ID; ``attention_mask``:
    1 for a token, 0 for padding; ``n_tokens``: the full token count.  The encoding
    holds ``max_len`` ids by definition, so only those tokens are exploded with their
    position and joined to the vocabulary; each document's ids are re-assembled in order.
    """
    vocab_ids = vocab.select(
        F.col(term_col).alias("_term"), (F.col(index_col) + FIRST_TERM_ID).cast("int").alias("_id"))
    heads = df.select(id_col, F.slice(tokens_col, 1, max_len).alias("_head"), F.size(tokens_col).alias("n_tokens"))
    entry = F.when(F.col("_pos").isNotNull(),
                   F.struct("_pos", F.coalesce(F.col("_id"), F.lit(UNKNOWN_ID)).alias("_id")))
    per_doc = (heads.select(id_col, "n_tokens", F.posexplode_outer("_head").alias("_pos", "_term"))
               .join(vocab_ids, "_term", "left").groupBy(id_col)
               .agg(F.array_sort(F.collect_list(entry)).alias("_pairs"),
                    F.coalesce(F.first("n_tokens"), F.lit(0)).alias("n_tokens")))
    token_ids = F.transform("_pairs", lambda p: p["_id"])
    padded = F.slice(F.concat(token_ids, F.array_repeat(F.lit(PAD_ID), max_len)), 1, max_len)
    return per_doc.select(id_col, "n_tokens", padded.alias("input_ids"),
                          _mask(F.col("n_tokens"), max_len).alias("attention_mask"))


def _mask(n_tokens, max_len: int):
    """[1]*min(n, max_len) + [0]*(max_len - min(n, max_len)).  Built without a lambda
    over an outer column: Catalyst would inline the token expression into the lambda
    and re-evaluate it once per position."""
    k = F.least(n_tokens, F.lit(max_len))
    return F.concat(F.array_repeat(F.lit(1), k), F.array_repeat(F.lit(0), F.lit(max_len) - k))


def attention_mask(df: DataFrame, id_col: str, tokens_col: str, max_len: int = 50) -> DataFrame:
    """J15 alone: needs only the token count."""
    counted = df.select(id_col, F.size(tokens_col).alias("_n"))
    return counted.select(id_col, _mask(F.col("_n"), max_len).alias("attention_mask"))
