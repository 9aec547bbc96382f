"""From raw documents to packed training sequences: five stages, each on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's documents. All but the last return the columns of documents. Edge cases are those of the operators: null
and empty texts fail the quality rules, repeated rows are copies of which one stays, other columns are carried along,
and an empty table goes through as one.
"""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import decontaminate, jaccard_join, line_dedup, packing, quality

#: SQL cannot express the stages from the first one on (distances of learned histograms, packing).
ORACLE_SQL = None
SEQUENCE_TOKENS = 1024
END_ID = 2


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document has; ``n_chars`` follows the text."""
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates on five-word shingles, at a similarity of 0.8 or more."""
    return jaccard_join.deduplicate(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of benchmark items."""
    return decontaminate.remove(docs, spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids, packed into sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, spaced=True, size=SEQUENCE_TOKENS)


STAGES = [("quality rules", quality_rules), ("line dedup", line_deduplication), ("n-gram Jaccard join", near_duplicates),
          ("benchmark decontamination", benchmark_decontamination), ("best-fit packing", best_fit_packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    for k, (_, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return found
        path = session.scratch(spark, f"pipeline-{k}")
        found.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
