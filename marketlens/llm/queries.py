"""The registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.suffix_dedup import suffix_dedup

    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.embedding_dedup import embedding_dedup

    return embedding_dedup(_table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_hash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.hash_forest import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, k=20)


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.mixing import mix

    return mix(_table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.jaccard_join import jaccard_join

    return jaccard_join(_table(spark, sf_dir, "documents"), n=4, percent=85)


def op6_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.importance import classify

    return classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.sharding import shard

    return shard(_table(spark, sf_dir, "documents"), shards=8)


def op8_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from marketlens.llm.token_planes import token_planes

    return token_planes(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2)


def op9_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op10_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.pii import personal_data

    return personal_data(_table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlens.llm.spelling import spelling_variants

    return spelling_variants(_table(spark, sf_dir, "documents"), least_length=5, least_n=3, ratio=2, noise=97)


def op12_fst_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from marketlens.llm.fst_tokens import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=1024)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from marketlens.llm.hard_negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    return hard_negatives(_table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0, label=moved,
                          positives=5, negatives=5, low=80, high=100, scale=256)


QUERIES = (op1_suffix_dedup, op2_embedding_dedup, op3_hash_forest, op4_pareto_mix, op5_jaccard_join,
           op6_importance, op7_label_shards, op8_token_planes, op9_conflict_packing,
           op10_contextual_pii, op11_spelling_variants, op12_fst_tokens, op13_hard_negatives)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    from marketlens.llm.oracles import ORACLES

    return dict(ORACLES)
