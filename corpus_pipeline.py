"""Corpus cleaning in stages, each one operator of ``lakegraph.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegraph.llm import decontaminate, jaccard_join, packing, quality, store, suffix_dedup
from lakegraph.llm.queries import read, vocabulary

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# near copies: Jaccard of at least 80 percent on runs of five words
NEAR_SIZE, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host passes."""
    return quality.keep(docs, COLUMNS)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard_join.keep_smallest(docs, COLUMNS, NEAR_SIZE, NEAR_PERCENT)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one holds;
    n_chars follows the text."""
    out = suffix_dedup.dedup(docs, COLUMNS)
    return out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the benchmark's passages."""
    return decontaminate.keep_clean(docs, read(spark, sf_dir, "benchmark"), COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' pieces in packed sequences."""
    return packing.pack(packing.pieces(docs, vocabulary("byte_bpe_50k.json")))


STAGES = [("quality_rules", quality_rules),
          ("ngram_jaccard_join", ngram_jaccard_join),
          ("suffix_array_dedup", suffix_array_dedup),
          ("benchmark_decontamination", benchmark_decontamination),
          ("best_fit_packing", best_fit_packing)]

# byte-exact suffix matches and tokenizer ids have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store.saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
