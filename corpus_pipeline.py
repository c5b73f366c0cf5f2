"""A corpus from raw documents: language, lines, near copies, benchmark text, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; run() applies
them in order, with every result written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parquill.llm._common import written
from parquill.llm.bpe import bpe
from parquill.llm.decontamination import decontamination
from parquill.llm.jaccard_join import jaccard_join
from parquill.llm.language_id import fit, predictor, training_rows
from parquill.llm.line_dedup import line_dedup
from parquill.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a language, `und`: null texts and those without a letter.

    Nothing is rejected if no labelled row teaches languages. Repeated rows and null ids stay, each
    row is judged by its own whole text; an empty table stays empty.
    """
    docs = docs.select(*COLUMNS)
    network = fit(training_rows(docs))
    if network is None:
        return docs
    return docs.withColumn("found", predictor(spark, network)("text")).where(F.col("found.lang_pred") != "und").select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without lines of recurring templates; a document that has no other text goes.

    Rows without such lines stay as they are, null and empty texts too; repeated rows lose the same
    lines. n_chars is counted anew (null for a null text).
    """
    out = line_dedup(docs, keep=("lang", "source"))
    out = out.where((F.col("n_dropped") == 0) | (F.trim("text") != ""))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


#: What tells rows apart: doc_id and text, nulls included.
_ROW = {"id_": "coalesce(doc_id, 0L)", "none_": "doc_id is null", "body_": "xxhash64(text)"}


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least doc_id (null ids last).

    Rows that repeat a doc_id and text are copies like others; rows of one doc_id with different texts
    are different documents, and of those in one class the one with the least hash stays. Texts
    without words, null ones included, are no copies of anything: all stay. An empty table stays empty.
    """
    docs, keys = docs.select(*COLUMNS).withColumns({k: F.expr(v) for k, v in _ROW.items()}), list(_ROW)
    found = jaccard_join(docs).where("group_id is not null").select("group_id", (F.col("doc_id").isNull()).alias("none_"), F.coalesce("doc_id", F.lit(0)).alias("id_"), F.col("body").alias("body_"))
    chosen = found.groupBy("group_id").agg(F.min(F.struct("none_", "id_", "body_")).alias("one")).select("one.*").distinct()
    empty = F.col("text").isNull() | F.col("text").rlike(r"^[\x20\x09-\x0D]*$")
    kept = docs.where(~empty).join(chosen, keys, "left_semi").dropDuplicates(keys)
    return kept.unionByName(docs.where(empty)).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents that hold a window of a benchmark item.

    Each row is judged by its own whole text, so repeated rows go or stay together, and rows of one
    doc_id with different texts apart; null texts and null ids stay unless the text has a hit. Empty
    tables, of documents or of the benchmark, are fine.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs, keys = docs.select(*COLUMNS).withColumns({k: F.expr(v) for k, v in _ROW.items()}), list(_ROW)
    gone = decontamination(docs, benchmark).where("contaminated").select(F.coalesce("doc_id", F.lit(0)).alias("id_"), F.col("doc_id").isNull().alias("none_"), F.col("body").alias("body_"))
    return docs.join(gone.distinct(), keys, "left_anti").select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, with digests of ids and decoded text; one row per row.

    A null or empty text has no tokens. Null ids and repeated rows stay; an empty table stays empty.
    """
    return bpe(docs, tokenizer_path()).drop("decoded")


STAGES = [
    ("language_id", identify),
    ("line_dedup", drop_lines),
    ("jaccard_join", one_of_each),
    ("decontamination", decontaminate),
    ("bpe", encode),
]

#: Trained networks and sampled paths are nothing that SQL expresses; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs
