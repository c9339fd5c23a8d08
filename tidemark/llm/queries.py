"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import (
    alignment,
    embedding_dedup,
    licenses,
    merge_dropout,
    mixing,
    packing,
    preferences,
    quality_gam,
    simhash_dedup,
    sketches,
    suffix_dedup,
    token_output,
    vector_codes,
)
from tidemark.llm.common import documents, ship
from tidemark.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: three-word shingles, at most 3 differing bits."""
    return simhash_dedup.near_duplicates(documents(spark, sf_dir), shingle=3, distance=3)


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and classes of all embeddings of one label at a cosine of 0.93 or more."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return embedding_dedup.near_duplicates(vectors, threshold=0.93)


@query
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of all documents, learnt from the labelled ones that are not held out."""
    docs = documents(spark, sf_dir)
    model = quality_gam.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_gam.score(docs, model)


@query
def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What repeated 200-byte strings take from each document."""
    return suffix_dedup.removed(documents(spark, sf_dir))


@query
def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as token ids, written as packed segments and read back."""
    path = shared_dir(spark, "token-segments")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_output.write_ids(documents(spark, sf_dir), path, tokenizer, end_id=2)
    return token_output.read_ids(spark, path, digest=True)


@query
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 ids."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(documents(spark, sf_dir), tokenizer, end_id=1)


@query
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threshold-scaled sketches of all documents, of their edited texts and their likeness."""
    return sketches.fingerprints(documents(spark, sf_dir))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licenses that whole documents, or lines of them, are."""
    return licenses.scan(documents(spark, sf_dir))


@query
def op6_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with merge dropout, and the digest of what they decode to."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return merge_dropout.encode(
        documents(spark, sf_dir), model, seed=2024, dropout=0.1, digest=True
    )


@query
def op7_preference_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as chosen ones against the same with another last answer."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    pairs = preferences.format_pairs(*preferences.swapped_answers(conversations))
    for name in ("chosen_spans", "rejected_spans"):
        pairs = pairs.withColumn(name, preferences.spans_as_text(F.col(name)))
    return pairs


@query
def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that each document gives to a mix of its sources weighing 1, 2 and 3 in turn."""
    return mixing.mix(documents(spark, sf_dir), weights=(1, 2, 3), epochs=3)


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings by codebooks of 16 entries for each of 8 parts."""
    return vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in all documents."""
    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(documents(spark, sf_dir), a, b)


ORACLES["op11_vector_codes"] = vector_codes.ORACLE
ORACLES["op12_source_mixing"] = mixing.ORACLE
ORACLES["op5_license_scan"] = licenses.ORACLE
ORACLES["op7_preference_formatting"] = preferences.ORACLE
