"""Documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents; the last one
returns the pieces of the packed sequences with their token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import prepared
from millrace.llm.mixing import mixed
from millrace.llm.packing import pack_documents
from millrace.llm.simhash import simhash_dedup
from millrace.llm.substrings import substring_dedup
from millrace.llm.toxicity import toxicity_scores
from millrace.session import written

#: Words of a repeated passage, tokens of a sequence, and the weights along the sources.
WINDOW, CAPACITY, WEIGHTS = 35, 2048, (1, 2, 3)
#: Pieces that a worker remembers: fewer than alone, since workers serve the other stages too.
REMEMBERED = 600_000


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    labels = prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity_scores(docs, labels).where("predicted = 0").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHashes of 4-word shingles within 4 bits."""
    prepared(spark)
    return simhash_dedup(docs, words=4, max_bits=4)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without repeated passages; texts that hold none stay as they are."""
    prepared(spark)
    found = substring_dedup(docs, window=WINDOW)
    cut = F.col("_sub_removed") > 0
    text = F.when(cut, F.col("_sub_kept")).otherwise(F.col("text"))
    chars = F.when(cut, F.char_length("_sub_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumn("text", text).withColumn("n_chars", chars).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed(docs, weights=WEIGHTS, cap=3.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, their ids (16 bits each), and their places in sequences."""
    prepared(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY, keep=["doc_id", "lang", "source"], id_bits=16, remembered=REMEMBERED)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("source_mixing", mixing),
    ("best_fit_packing", packing),
]

#: The first stage's models are not expressible in SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
