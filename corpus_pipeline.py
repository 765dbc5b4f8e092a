"""A training corpus from documents: stages that each take and give a table.

Every stage works on all that the one before kept. All but the last give the columns of
documents; the last gives the encoded corpus. ``run`` writes each stage's result to the shared folder
and reads it back for the next, so a stage that is lost starts from a written table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skygrain.llm import bpe, decontaminate, langid, quality, simhash
from skygrain.llm.common import fold, small_batches, table
from skygrain.session import durable


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and not in doubt; learned from three quarters of the labelled ones.

    Null texts, texts without a letter and ambiguous ones go. A language that differs from ``lang`` is no reason to go.
    """
    small_batches(spark)
    model = langid.learn(docs.filter(fold(F.col("doc_id"), 4) != 2))
    names = ("_lang", "_score", "_ambiguous")
    return langid.identify(docs, model, names=names).filter(~F.col("_ambiguous")).drop(*names)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least the threshold; learned from the labels of four fifths of them."""
    small_batches(spark)
    labels = table(spark, sf_dir, "labels").filter(fold(F.col("doc_id"), 5) != 0)
    model = quality.learn(docs, labels)
    return quality.score(docs, model, name="_score").filter(F.col("_score") >= quality.THRESHOLD).drop("_score")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents whose fingerprints of 3-word shingles differ in 3 bits or fewer the one with the smallest id."""
    small_batches(spark)
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    small_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every whole text: ``doc_id, n_tokens, ids``."""
    small_batches(spark)
    rows = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# classifiers, fingerprints, latent vectors and merges are not SQL; tests/llm/test_pipeline.py has the brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
