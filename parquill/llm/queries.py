"""One query for each operator, over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parquill.llm import oracles
from parquill.llm.bpe import bpe
from parquill.llm.decontamination import decontamination
from parquill.llm.embedding_dedup import embedding_dedup
from parquill.llm.jaccard_join import jaccard_join
from parquill.llm.language_id import language_id
from parquill.llm.line_dedup import line_dedup
from parquill.llm.lm_scoring import lm_scoring
from parquill.llm.sharding import sharding
from parquill.llm.substring_dedup import substring_dedup
from parquill.llm.url_filter import url_filter

#: The rules of the url query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents")).drop("kept")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(_table(spark, sf_dir, "documents"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe(_table(spark, sf_dir, "documents"), tokenizer_path(), tokens=False)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(_table(spark, sf_dir, "documents")).drop("body", "group_id")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding(_table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def _url_rules(spark: SparkSession) -> DataFrame:
    return spark.sql("select * from values " + ", ".join(str(r) for r in URL_RULES) + " as rules(host, path, verdict)")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(_table(spark, sf_dir, "pages"), _url_rules(spark))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(_table(spark, sf_dir, "embeddings"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_substring_dedup, op2_lm_scoring, op3_line_dedup, op4_bpe, op5_jaccard_join, op6_sharding, op7_language_id, op8_url_filter, op9_embedding_dedup, op10_decontamination)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": oracles.SUBSTRING,
        "op5_jaccard_join": oracles.JACCARD,
        "op8_url_filter": oracles.URLS,
        "op9_embedding_dedup": oracles.EMBEDDINGS,
        "op10_decontamination": oracles.DECONTAMINATION,
    }
