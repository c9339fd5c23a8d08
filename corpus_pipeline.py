"""A corpus pipeline: quality filter, near-duplicates, repeated passages, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import packing, quality_gam, simhash_dedup, suffix_dedup
from tidemark.llm.common import documents, keep, ship


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more, learnt from the labelled ones."""
    ship(spark)
    model = quality_gam.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest doc_id stays.

    A document without a doc_id stays. Rows that repeat a doc_id stay or go together: they stay
    where one of them stands for its group, so that no group is lost whole.
    """
    ship(spark)
    found = simhash_dedup.near_duplicates(docs, shingle=3, distance=3)
    gone = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept")
    return docs.join(gone.select("doc_id"), "doc_id", "left_anti").select(docs.columns)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that repeated 200-byte strings cover."""
    ship(spark)
    return suffix_dedup.cleaned(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and place in it."""
    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality classifier", quality_filter),
    ("simhash near-dedup", near_dedup),
    ("suffix-array dedup", passage_dedup),
    ("packing", pack_sequences),
]

# SQL has neither the classifier nor the tokenizer; tests hold every stage against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again as the next one's documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
