"""Documents to packed training sequences, stage by stage.

Each stage works on the rows that the one before it kept and returns the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bin_slack, circulant_minhash, line_chunks, suffix_decon, target_llr
from tallyloom.llm.queries import byte_subwords, table
from tallyloom.runtime import scratch_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the text rules and the ratio of trusted to raw n-grams."""
    trusted = target_llr.trusted_texts(docs, table(spark, sf_dir, "labels"))
    judged = target_llr.judge(docs, target_llr.fit(docs, trusted))
    return judged.where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand elsewhere first. ``n_chars`` follows."""
    deduped = line_chunks.dedup_passages(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType.simpleString()
        deduped = deduped.selectExpr(
            *[f"cast(char_length(text) AS {kind}) AS n_chars" if c == "n_chars" else f"`{c}`" for c in docs.columns])
    return deduped.select(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id."""
    return circulant_minhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    return suffix_decon.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of 1024."""
    return bin_slack.pack(docs, byte_subwords())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", minhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: The n-gram ratio, the rolling hash and the tokenizer have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = f"{scratch_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
