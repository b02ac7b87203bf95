"""The corpus pipeline: toxic texts, exact copies, near copies and benchmark leaks go; what stays is packed.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the
columns of documents. `run` writes each stage's result to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelattice.llm import decontamination, exact, jaccard, packing, toxicity
from carelattice.llm.common import stored
from carelattice.llm.tokens import default_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.keep_first(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, default_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_leaks),
    ("packing", pack),
]

#: Learning, tokenising and the packing search have no SQL form; tests check every stage against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
