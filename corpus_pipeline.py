"""Training-corpus pipeline: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweir.llm.common import read
from tradeweir.llm.decontaminate import keep_clean
from tradeweir.llm.near import keep_one
from tradeweir.llm.packing import pack_documents
from tradeweir.llm.quality import keep_good
from tradeweir.llm.suffixes import remove_repeats
from tradeweir.session import scratch_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more."""
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("y"))
    return keep_good(docs, labels)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat 100 bytes of an earlier place; ``n_chars`` counts what is left."""
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    kept = remove_repeats(docs, carry=others).withColumnRenamed("kept_text", "text")
    if "n_chars" in others:
        kept = kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of the benchmark."""
    return keep_clean(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens."""
    return pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeats", repeats),
    ("decontamination", decontamination),
    ("packing", packing),
]
# Learned scores and token ids cannot be had from SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_folder(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
