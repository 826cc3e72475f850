"""The corpus pipeline: toxicity, SimHash near-dedup, decontamination, secrets, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before
kept, and returns the columns of documents; the last returns the packed pieces.
``run`` writes every stage's result under the shared checkpoint folder and reads it again.

Nulls, ties, repeated rows, empty tables and extra columns are treated as each
operator's docstring says; extra columns of documents are kept up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.llm.common import read_table, written
from cardrisk.llm.decontaminate import decontaminate
from cardrisk.llm.packing import pack
from cardrisk.llm.secret_scan import redacted
from cardrisk.llm.simhash import keep_one
from cardrisk.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return keep_clean(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the smallest id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; secrets in their texts are replaced by their kind."""
    return redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("simhash", near_dedup), ("decontamination", decontamination), ("secrets", secrets), ("packing", packing)]

# A language model's Viterbi decoding, BK-trees and a tokenizer are beyond SQL: tests/llm has brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
