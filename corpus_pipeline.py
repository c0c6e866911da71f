"""Clean a corpus in five stages, each by an operator of airledger.llm.

Every stage takes what the one before kept and returns the columns of documents, the last one
adds the ids. The stages decide, in this order: rows whose text is judged toxic go; of each
group of near copies one row stays; benchmark passages are cut out; secrets are masked; texts
are encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airledger.llm.op1_toxicity import without_toxic
from airledger.llm.op3_minhash_dedup import without_near_duplicates
from airledger.llm.op5_secrets import redacted
from airledger.llm.op7_bpe import encoded
from airledger.llm.op10_decontamination import decontaminated
from airledger.llm.tables import passing, read, staged


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redacted(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = passing(docs.drop("ids", "n_tokens"), encoded)
    return rows.withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("encoding", encoding),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
