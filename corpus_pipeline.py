"""From raw documents to token ids: five stages, each one of the training-data operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the last return the columns of ``docs``; between
stages the rows are written as Parquet and read again, so no stage recomputes another.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import bpe, langid, mixing, simhash, substrings
from larkspur.llm.common import shared_folder


def tell_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; texts that are null, have no letter, or are like no language go."""
    return langid.recognised(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that near-equal fingerprints of three-word shingles link: the one with the smallest id."""
    return simhash.keep_first(docs, shingle=3, distance=2)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the passages of 35 or more words that occur again; white space elsewhere stays."""
    cut = substrings.cut_repeats(docs, layout=True)
    changed = F.col("row").withField("text", F.col("kept"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length("kept").cast(docs.schema["n_chars"].dataType))
    return cut.select(F.when(F.size("spans") > 0, changed).otherwise(F.col("row")).alias("row")).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each once, in the order of a mix of sources weighted by size to the power 0.7."""
    return mixing.mixed_order(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a digest of what they decode to and its slot and place in the mix.

    Written rows lose their order, so the mix is read by (slot, place), which depend on the rows alone: they are the same
    as in the stage before.
    """
    placed = mixing.interleave(docs, mixing.tempered_parts(docs))
    docs = placed.select("row.doc_id", "row.lang", "row.source", "row.text", "slot", "place")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN, back=True)
    return encoded.select(
        "row.doc_id", "row.lang", "row.source", "ids", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2("bytes", 256).alias("decoded_sha256"), "row.slot", "row.place",
    )


STAGES = [
    ("language_id", tell_language),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("mixing", mix_sources),
    ("byte_level_bpe", encode_tokens),
]

ORACLE_SQL = None  # SQL has no tokenizer; tests/llm compares run() with a plain Python version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
