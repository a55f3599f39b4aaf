"""The corpus pipeline: rules, classifier, near-dedup and packing, each stage over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from concordia.llm import line_crf, near_dedup, packing, repetition
from concordia.llm._cluster import settle, ship, workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Null, empty and repetitive texts go; repeated rows and ids are judged row by row. An empty table stays empty."""
    ship(spark)
    return repetition.keep_unrepetitive(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is fitted on labelled rows of the whole table; its verdicts hold for those that came so far.

    Without labels the model knows nothing, scores 0.5 and keeps all texts that have a word."""
    corpus = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    return line_crf.keep_good(docs, line_crf.train(corpus, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; by text, so different texts under one id all stay, and null ids are compared too."""
    ship(spark)
    return near_dedup.keep_one_of_each(docs, unique_ids=False)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every row with its place; a null or empty text is its end id alone."""
    ship(spark)
    return packing.best_fit_packing(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("quality classifier", quality_classifier), ("near dedup", near_dedup_stage), ("packing", pack)]

#: No SQL: the classifier is a trained model and the packing depends on the tasks' order.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before wrote is deleted."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with workspace(spark):
        for name, stage in STAGES[:-1]:
            docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        return STAGES[-1][1](spark, docs, sf_dir)
