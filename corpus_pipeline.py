"""A training-data pipeline over `documents`: each stage works on all that its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from glyphforge.llm import bpe, lines, minhash, mixing, quality
from glyphforge.llm.common import Workspace


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below 0.5 go."""
    return quality.accepted(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go, and documents that had no other words."""
    out = lines.drop_lines(docs)
    return out.where("n_removed = 0 or text rlike '[^ \\\\x09-\\\\x0D]'").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with a similarity of 0.8 or more, the one of the smallest doc_id stays."""
    gone = minhash.near_duplicates(docs, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: packed in blocks of 512 words, source weights 1, 2, 3 in turn."""
    return mixing.Mix(docs, block=512).texts(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32-bit integers) and text, the ids decoded again."""
    return bpe.round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality_classifier", quality_classifier), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mix_sources", mix_sources), ("bpe_tokens", bpe_tokens)]

#: The stages fit a model, hash and tokenize, which SQL cannot express; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written as Parquet and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = work.write(docs, name)
    return docs
