"""A corpus from raw documents to tokens: every stage is one of the operators of docketry.llm.

Each stage works on what the stage before kept; it is written as Parquet to the shared folder and
read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.bpe import encode_documents, public_tokenizer
from docketry.llm.common import read_table, stage
from docketry.llm.langid import UNDETERMINED, predict_languages, train_languages
from docketry.llm.mixing import copies_of, soft_mixing
from docketry.llm.ngram_join import ngram_jaccard_join
from docketry.llm.quality import fold, score_quality, train_quality

LEAST_QUALITY = 0.5
LEAST_LEAD = 0.55  # score below which no language leads
TARGETS = {"clean": 0.94, "toxic": 0.03, "low": 0.03}


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier takes for good."""
    network = train_quality(docs, read_table(spark, sf_dir, "labels"), fold("doc_id", 3) == 1)
    scored = score_quality(docs, network, keep=True)
    return scored.where(F.col("score") >= LEAST_QUALITY).select(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters in which one language leads."""
    scored = predict_languages(docs, train_languages(docs, fold("doc_id", 5) == 0), keep=True)
    return scored.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_LEAD)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    found = ngram_jaccard_join(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.dropDuplicates(["doc_id"]).join(found, "doc_id", "left_semi").select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once, or more often."""
    rates = soft_mixing(docs, read_table(spark, sf_dir, "labels"), TARGETS)
    taken = rates.select("doc_id", copies_of("rate", "doc_id").alias("copies")).where("copies > 0")
    return docs.join(taken, "doc_id").select(*docs.columns, F.explode(F.sequence(F.lit(1), "copies"))).drop("col")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return encode_documents(docs, public_tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("encoding", encoding),
]

# Learned models and tokens can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
