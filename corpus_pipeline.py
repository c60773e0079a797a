"""The corpus pipeline: documents through the operators of ``kpiforge.llm``, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored as Parquet and read
again as the next one's docs.  All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiforge.llm import decontam, langid, mixing, ngram_join, sharding
from kpiforge.llm.text import documents, free_names, row_key, ship, store_result


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language stay (``und``: no text, or not a letter in it); the classifier learns from
    these documents."""
    ship(spark)
    found = langid.identify(docs, keyed=True)
    key, = free_names(docs, "__key")
    known = found.filter(F.col("lang_pred") != langid.UNKNOWN).select(F.col("doc_id").alias(key)).distinct()
    # every row by its own text, also where ids are null or repeated
    own = docs.withColumn(key, row_key(F.col("doc_id"), F.col("text")))
    return own.join(known, key, "left_semi").drop(key)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of the n-gram Jaccard join stays."""
    ship(spark)
    return ngram_join.one_of_each(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it (not at all, once, or repeated)."""
    ship(spark)
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining row gets a shard and a slot."""
    ship(spark)
    return sharding.interleave(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("mixture", mixture),
    ("shards", shards),
]
# the stages learn models and draw by hashes, which SQL cannot express; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's rows are stored and read again.

    What a stage read and wrote on its way is deleted once its rows are stored."""
    def after(stages: list) -> DataFrame:
        if not stages:
            return documents(spark, sf_dir)
        name, stage = stages[-1]
        return store_result(spark, lambda: stage(spark, after(stages[:-1]), sf_dir), f"stage-{name}")

    return STAGES[-1][1](spark, after(STAGES[:-1]), sf_dir)
