"""From raw documents to packed training batches: quality, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns is written as Parquet and read again as
the next stage's docs. Labels for the two classifiers come from the ``labels`` table beside the documents; each learns from
the documents that its stage is given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contractlake.llm import packing, quality, simhash_trie, toxicity
from contractlake.llm.queries import table
from contractlake.llm.stage import saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score of 0.3 or more)."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't rejected as toxic (score under 0.5)."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of near-duplicates."""
    return simhash_trie.keep_one(docs, words_per_shingle=3, budget=3)


def length_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of each document that is left."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier), ("toxicity", toxicity_filter), ("SimHash near-dedup", simhash_near_dedup), ("packing", length_packing)]

#: Trained models and fingerprints can't be written in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed rows of all documents that pass the stages."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
