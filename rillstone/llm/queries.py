"""The queries of this subpackage: each gets its rows through its operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_kmtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kmtree import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    return shard_documents(_table(spark, sf_dir, "documents"), shards=40)


def tokenizer(name: str) -> str:
    """Where a public tokenizer's file lies; every executor has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import score_toxicity

    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), tokens=2048)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import score_quality

    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"), length=100)


def op5_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .forest import near_duplicate_vectors

    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), at_least=0.93)


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), percent=85, size=5)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_documents

    return mix_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_toxicity, op2_kmtree, op3_sharding, op4_suffixes, op5_forest, op6_minhash, op7_language, op8_mixing, op9_packing, op10_quality)}
ORACLES: dict[str, str] = {"op4_suffixes": oracles.SUFFIXES, "op5_forest": oracles.FOREST, "op6_minhash": oracles.MINHASH}
