"""The review-text pipeline as named queries (J1-J16 on the review corpus).

Corpus = reviews with a message (the K2 result) keyed by review id, label =
``is_positive``.  Every step reads the whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.text import terms
from marketlens.operators import exact_logit, features, lemmas, model, model_store, text
from marketlens.operators.exact_split import exact_split
from marketlens.session import cut_lineage, scratch_folder
from marketlens.sources.marketplace import Marketplace

MAX_FEATURES = 5000   # vocabulary size of the TF-IDF features (reference setting)
MAX_LEN = 50          # encoded sequence length (reference setting)
BATCH_SIZE = 32       # batch size (reference setting)
TEST_PERCENT = 20     # held-out share (reference setting)
SEED = 42             # split / shuffle seed (reference setting)


def review_corpus(m: Marketplace) -> DataFrame:
    """(doc_id, text, label): reviews with a message, label = score >= 3."""
    return (m.order_reviews.filter(F.col("review_comment_message").isNotNull())
            .select(F.col("review_id").alias("doc_id"),
                    F.col("review_comment_message").alias("text"),
                    F.when(F.col("review_score") >= 3, 1).otherwise(0).alias("label")))


def cleaned_corpus(m: Marketplace) -> DataFrame:
    """Corpus + clean_text, tokens (stop words removed), terms (>= 2 chars), split.

    The corpus is hash-partitioned by doc_id first: cleaning is CPU-heavy per row
    and runs in parallel whatever the input file layout, and every later per-document
    step (term counts, norms, re-assembly) reuses this partitioning without another
    shuffle.
    """
    corpus = review_corpus(m).repartition("doc_id")  # AQE may coalesce small corpora
    cleaned = text.clean_reviews(corpus, "text", "clean_text", "tokens")
    with_terms = cleaned.withColumn("terms", terms(F.col("tokens")))
    return features.train_test_split(with_terms, "doc_id", TEST_PERCENT, SEED)


def cleaned_once(m: Marketplace, *columns: str) -> DataFrame:
    """``columns`` of the cleaned corpus for queries that read it several times (vocabulary fit and
    transform, lemma table and substitution, model fit and scoring): cleaned once
    and checkpointed in the shared folder, so the CPU-heavy cleaning never runs
    twice in a query and a lost executor does not recompute it."""
    return cut_lineage(cleaned_corpus(m).select("doc_id", *columns))


def _train(m: Marketplace) -> DataFrame:
    return cleaned_corpus(m).filter(F.col("split") == "train")


def _train_terms(m: Marketplace) -> DataFrame:
    return cleaned_once(m, "split", "terms").filter(F.col("split") == "train")


def review_clean_text(m: Marketplace) -> DataFrame:
    return cleaned_corpus(m).select("doc_id", "label", "clean_text")


def lemma_substitution(m: Marketplace) -> DataFrame:
    """J4 with a lemma table derived from the corpus vocabulary (plural -> singular
    where the singular occurs); any (token, lemma) table can be passed to
    ``text.substitute_lemmas``."""
    c = cleaned_once(m, "tokens")
    vocab = features.explode_words(c, "doc_id", "tokens", "term")
    out = text.substitute_lemmas(c, "doc_id", "tokens", cut_lineage(text.plural_lemmas(vocab)))
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmatized_text"))


def rule_lemmas(m: Marketplace) -> DataFrame:
    """The dictionary forms that the Portuguese rules give the corpus's tokens."""
    vocab = features.explode_words(cleaned_corpus(m), "doc_id", "tokens", "term")
    return lemmas.rule_lemmas(vocab, lemmas.rules_table(vocab.sparkSession))


def lemmas_by_rules(m: Marketplace) -> DataFrame:
    """Every review with its tokens' dictionary forms, by the Portuguese rules."""
    c = cleaned_once(m, "tokens")
    vocab = features.explode_words(c, "doc_id", "tokens", "term")
    table = cut_lineage(lemmas.rule_lemmas(vocab, lemmas.rules_table(c.sparkSession)))
    out = text.substitute_lemmas(c, "doc_id", "tokens", table)
    return out.select("doc_id", F.array_join("lemmas", " ").alias("lemmatized_text"))


def split_train_test(m: Marketplace) -> DataFrame:
    return cleaned_corpus(m).select("doc_id", "split")


def split_exact(m: Marketplace) -> DataFrame:
    """J5 with exact sizes, stratified by label."""
    return exact_split(review_corpus(m).select("doc_id", "label"), "doc_id", "label", TEST_PERCENT, SEED)


def vocabulary_top_n(m: Marketplace) -> DataFrame:
    train = _train_terms(m)
    return features.top_terms(features.term_stats(train, "doc_id", "terms"), MAX_FEATURES).select(
        "term", "term_index", "total_count", "doc_freq")


def tfidf_fit(m: Marketplace) -> DataFrame:
    vocab = features.fit_tfidf(_train_terms(m), "doc_id", "terms", MAX_FEATURES)
    return vocab.select("term", "term_index", "doc_freq", F.round("idf", 6).alias("idf"))


def tfidf_transform(m: Marketplace) -> DataFrame:
    c = cleaned_once(m, "split", "terms")
    vocab = features.fit_tfidf(c.filter(F.col("split") == "train"), "doc_id", "terms", MAX_FEATURES)
    w = features.transform_tfidf(c, "doc_id", "terms", vocab)
    return w.select("doc_id", "term", "term_index", F.round("weight", 6).alias("weight"))


def _digest_coefficients(vocab: DataFrame) -> DataFrame:
    digest = F.conv(F.substring(F.md5("term"), 1, 8), 16, 10).cast("long")
    return vocab.select("term", ((digest % 2001 - 1000) / 1000.0).alias("coefficient"))


def saved_model_scores(m: Marketplace) -> DataFrame:
    """The model of ``linear_scores`` saved as tables, published past a
    deny-list, loaded from where it was published, and scored with."""
    c = cleaned_once(m, "split", "terms")
    spark = c.sparkSession
    vocab = cut_lineage(features.fit_tfidf(c.filter(F.col("split") == "train"), "doc_id", "terms", MAX_FEATURES))
    saved, serving = scratch_folder(spark, "model"), scratch_folder(spark, "serving")
    model_store.save(model_store.linear_text_model(vocab, _digest_coefficients(vocab)), saved)
    report = model_store.publish(spark, {"sentiment": saved, "bert": saved}, serving, exclude=("bert",))
    path = report.filter(F.col("status") == "published").first()["path"]
    return model_store.load(spark, path).score(c.select("doc_id", "terms"), "doc_id", "terms")


def linear_scores(m: Marketplace) -> DataFrame:
    """J10, J12, I17 with a deterministic model: each term's coefficient is a digest of
    the term, in [-1, 1]."""
    c = cleaned_once(m, "split", "terms")
    vocab = cut_lineage(features.fit_tfidf(c.filter(F.col("split") == "train"), "doc_id", "terms", MAX_FEATURES))
    coefficients = _digest_coefficients(vocab)
    return model.linear_scores(features.transform_tfidf(c, "doc_id", "terms", vocab), coefficients, c, "doc_id")


def class_weights(m: Marketplace) -> DataFrame:
    return features.class_weights(_train(m), "label").select("label", "n", "weight")


def _encoded(m: Marketplace) -> DataFrame:
    c = cleaned_once(m, "split", "tokens", "terms")
    vocab = features.fit_tfidf(c.filter(F.col("split") == "train"), "doc_id", "terms", MAX_FEATURES)
    return text.encode_fixed_length(c, "doc_id", "tokens", vocab, MAX_LEN)


def _as_text(array_col: str):
    return F.array_join(F.transform(array_col, lambda x: x.cast("string")), ",")


def encode_fixed_length(m: Marketplace) -> DataFrame:
    """J14; ids are shown as comma-joined text."""
    return _encoded(m).select("doc_id", "n_tokens", _as_text("input_ids").alias("input_ids"))


def attention_mask(m: Marketplace) -> DataFrame:
    mask = text.attention_mask(cleaned_corpus(m), "doc_id", "tokens", MAX_LEN)
    return mask.select("doc_id", _as_text("attention_mask").alias("attention_mask"))


def shuffle_batches(m: Marketplace) -> DataFrame:
    """J16 on the training split: seeded permutation position and batch id."""
    train = _train(m).select("doc_id")
    return features.assign_batches(train, "doc_id", BATCH_SIZE, SEED).select(
        "doc_id", "position", "batch_id")


def logreg_scores(m: Marketplace) -> DataFrame:
    """J9 + J10: fit on the training split, score every review.

    The cleaned terms are materialised once in the checkpoint folder: the vocabulary
    fit, the iterative classifier fit and the scoring all read them.
    """
    c = cleaned_once(m, "label", "split", "terms")
    fitted = model.fit_sentiment_model(c.filter(F.col("split") == "train"), "doc_id", "terms",
                                       "label", MAX_FEATURES)
    return model.score(fitted, c).select("doc_id", "split", "label", "logit",
                                         "probability_positive", "predicted")


def logreg_metrics(m: Marketplace) -> DataFrame:
    """J11-J13 per split; batches of 32 numbered within each split in the seeded order
    (the batch-mean loss is how the reference reports its test loss)."""
    scored = cut_lineage(logreg_scores(m))  # numbering reads its rows twice
    batches = features.assign_batches(scored, "doc_id", BATCH_SIZE, SEED, group_col="split")
    return model.binary_metrics(batches, "logit", "label", batch_col="batch_id",
                                group_cols=["split"])


def _exact_logit(m: Marketplace) -> tuple[DataFrame, exact_logit.LinearModel]:
    """Every review's features, and the model fitted on those of the training split."""
    c = cleaned_once(m, "label", "split", "terms")
    vocab = cut_lineage(features.fit_tfidf(c.filter(F.col("split") == "train"), "doc_id", "terms", MAX_FEATURES))
    weights = features.transform_tfidf(c, "doc_id", "terms", vocab)
    rows = cut_lineage(exact_logit.feature_rows(c.select("doc_id", "split", "label"), weights, "doc_id"))
    terms = [r["term"] for r in vocab.orderBy("term_index").collect()]  # at most MAX_FEATURES
    return rows, exact_logit.fit(rows.filter(F.col("split") == "train"), terms, "label")


def exact_logit_model(m: Marketplace) -> DataFrame:
    """J9 with sums that don't depend on their order: (term, coefficient); the intercept
    has the empty term."""
    rows, fitted = _exact_logit(m)
    return fitted.table(rows.sparkSession, digits=6)


def exact_logit_scores(m: Marketplace) -> DataFrame:
    """J9 + J10: fitted on the training split, every review scored."""
    rows, fitted = _exact_logit(m)
    return exact_logit.scores(rows, fitted, "doc_id").select(
        "doc_id", "split", "label", "logit", "probability_positive", "predicted")


def exact_logit_metrics(m: Marketplace) -> DataFrame:
    """J11-J13 of ``exact_logit_scores``, per split, in batches of 32."""
    scored = cut_lineage(exact_logit_scores(m))
    batches = features.assign_batches(scored, "doc_id", BATCH_SIZE, SEED, group_col="split")
    out = model.binary_metrics(batches, "logit", "label", batch_col="batch_id", group_cols=["split"])
    return out.select("split", "n", "accuracy", F.round("bce_loss", 6).alias("bce_loss"),
                      F.round("bce_loss_batched", 6).alias("bce_loss_batched"))


def binary_metrics(m: Marketplace) -> DataFrame:
    """J11-J13 and I17 on a deterministic score: the rating baseline's logit
    ``coalesce(review_score, 0) - 2.5`` against ``is_positive``, per split, with
    batches of 32 in the seeded order.  Losses are rounded to 9 decimals (sums of
    doubles depend on their order in the last bits)."""
    scored = (m.order_reviews.filter(F.col("review_comment_message").isNotNull())
              .select(F.col("review_id").alias("doc_id"),
                      (F.coalesce(F.col("review_score"), F.lit(0)).cast("double") - F.lit(2.5))
                      .alias("logit"),
                      F.when(F.col("review_score") >= 3, 1).otherwise(0).alias("label")))
    split = features.train_test_split(scored, "doc_id", TEST_PERCENT, SEED)
    batches = features.assign_batches(split, "doc_id", BATCH_SIZE, SEED, group_col="split")
    out = model.binary_metrics(batches, "logit", "label", batch_col="batch_id", group_cols=["split"])
    return out.select("split", "n", "accuracy", F.round("bce_loss", 9).alias("bce_loss"),
                      F.round("bce_loss_batched", 9).alias("bce_loss_batched"))
