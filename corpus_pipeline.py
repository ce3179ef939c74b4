"""The documents table made ready for training, in five stages of the library's operators.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last
return the columns of docs, and its other columns, whatever their names, are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from nestline.llm import bpe, contamination, lines, near, quality
from nestline.llm.buffers import free_name
from nestline.sources.scratch import written


def good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network doesn't reject; it learns from the labels outside the held-out fifth."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = quality.fit(docs, labels, ~quality.held_out(F.col("doc_id"), 5, 0))
    return quality.keep_good(docs, network)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that later documents repeat; n_chars is that of the new text."""
    found = free_name(docs, "cleaned")
    text = F.col(found)["kept"]
    changed = {"text": text, "n_chars": F.length(text).cast("long")}
    return lines.without_repeats(docs, found).select(
        *[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return near.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return contamination.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each text's encoding and its decoding."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(docs, path, public_tokenizers.PATTERN, ["doc_id"])


STAGES = [
    ("quality classifier", good_texts),
    ("line dedup", without_repeated_lines),
    ("near-dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("byte-level BPE", token_ids),
]

#: A trained network and BPE have no SQL; the tests hold run() against plain versions of the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of sf_dir, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if number == 0 else written(docs, "stage"), sf_dir)
    return docs
