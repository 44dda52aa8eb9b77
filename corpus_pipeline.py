"""A training corpus from raw documents, stage by stage, each stage written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.mixing import Mix
from starloom.llm.near_dup import NearDuplicates, Shape
from starloom.llm.packing import Limits, pack, text_encoder
from starloom.llm.suffix_dedup import RepeatedBytes
from starloom.llm.weak_quality import WeakQuality
from starloom.sources.scratch import Workspace


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that have changed."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised classifier does not take for junk."""
    return WeakQuality(docs).good()


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates (five words, 0.8)."""
    return NearDuplicates(docs, shape=Shape(words=5, percent=80)).survivors()


def repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 200 that stand elsewhere too."""
    return _measured(RepeatedBytes(docs, length=200).cleaned())


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of the sources by target weight, at most twice each."""
    return _measured(Mix(docs, keep=tuple(docs.columns)).mixed())


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the tokenized texts in sequences of 1024."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encode = text_encoder(ranks, public_tokenizers.PATTERN, "text", end=0)
    return pack(docs, "doc_id", ["text"], encode, Limits(1024, 1024, 1024))


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("repeated_bytes", repeated_bytes),
    ("mixed", mixed),
    ("packed", packed),
]

# A trained classifier, MinHash and a tokenizer are not SQL; tests hold the stages against
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
