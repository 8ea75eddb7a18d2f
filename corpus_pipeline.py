"""From raw documents to packed sequences: language, copies, near copies, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberline.llm.decontamination import decontaminated
from emberline.llm.exact_dedup import deduplicated
from emberline.llm.language_id import identified
from emberline.llm.ngram_join import one_of_each
from emberline.llm.packing import best_fit_packing, public_tokenizer
from emberline.session import drop_staged, stage, staged_so_far


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return identified(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that of the largest id."""
    return deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 of their five-word shingles."""
    return one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in training sequences."""
    return best_fit_packing(docs, public_tokenizer())


STAGES = [("language", language), ("copies", copies), ("near_copies", near_copies), ("leaks", leaks), ("packing", packing)]

#: The stages are learned models, similarity joins and packings, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other; each reads the stored result of the one before.

    What a stage stored for itself is deleted with its input once its result is stored.
    """
    docs, begin = spark.read.parquet(f"{sf_dir}/documents.parquet"), staged_so_far()
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
        drop_staged(spark, begin, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
