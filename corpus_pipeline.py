"""A pipeline over documents: each stage calls one operator and hands on what it keeps."""

from __future__ import annotations

import uuid

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontamination import find_leaks, without
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.packing import pack
from tidemark.llm.simhash import drop_near_duplicates
from tidemark.llm.toxicity import CATEGORIES, drop_toxic
from tidemark.session import remove, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity chain doesn't reject."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"), CATEGORIES)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that earlier ones hold."""
    return dedup_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs, shingle=3, distance=2)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return without(docs, find_leaks(docs, _table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces that the documents are packed in."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), longest=1024)


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", lines),
    ("near_duplicates", near_copies),
    ("decontamination", leaks),
    ("packing", packed),
]

#: SQL can express neither the trained chain nor the patience alignment nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each but the last written to the shared folder and read again.

    A stage's table goes when the next one is written; that of the last but one stays, for the result reads it.
    """
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs, done = _table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if done:
            remove(spark, done)
        done = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
