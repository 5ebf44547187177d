"""Corpus pipeline: documents go through language ID, exact dedup, n-gram Jaccard join, substring dedup and packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet and read again as the next
one's docs.  All but the last keep the columns of documents, whatever others there are.

Repeated ids and null columns: each stage does with them what its operator's docstring says; rows that share a doc_id are
told apart by their texts in every stage.  An empty table passes all stages and gives no pieces.

All stages run in the same executors, whose heap doesn't shrink between them; each therefore lowers the session's limit on
the bytes of a batch that goes to a Python worker (small_batches).  No result depends on where batches end.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from screenforge.llm import exact_dedup, language_id, ngram_join, packing, substring_dedup
from screenforge.llm.queries import tokenizer_path
from screenforge.session import shared_folder, small_batches, spread


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return language_id.drop_unknown(spread(small_batches(docs)))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.drop_exact_duplicates(small_batches(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more."""
    return ngram_join.drop_near_duplicates(small_batches(docs))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that start earlier elsewhere."""
    return substring_dedup.drop_repeats(small_batches(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, mixed by source."""
    return packing.packed(small_batches(docs), tokenizer_path("word_bpe_49k.json")).drop("ids")


STAGES = [("language ID", languages), ("exact dedup", exact), ("n-gram Jaccard join", near), ("substring dedup", repeats), ("packing", pack)]

#: Language ID has no SQL; the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what lies between them is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{k - 1}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return docs
