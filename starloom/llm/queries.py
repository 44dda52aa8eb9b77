"""One query per operator, applied with production parameters to its whole table."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starloom.llm import (
    ann,
    fill_middle,
    html_text,
    importance,
    licenses,
    linear,
    mixing,
    near_dup,
    packing,
    quality_rules,
    secret_scan,
    suffix_dedup,
    warc,
    weak_quality,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encode = packing.text_encoder(ranks, public_tokenizers.PATTERN, "text", end=0)
    return packing.pack(documents, "doc_id", ["text"], encode, packing.Limits(1024, 1024, 1024))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return licenses.scan(documents, licenses.train(documents))


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), every=50, best=5)


def op4_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_quality.WeakQuality(table(spark, sf_dir, "documents")).scored()


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_rules.train(documents, table(spark, sf_dir, "labels"))
    return quality_rules.judge(documents, model)


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = near_dup.Shape(words=2, percent=80)
    return near_dup.NearDuplicates(table(spark, sf_dir, "documents"), shape=shape).membership()


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.RepeatedBytes(table(spark, sf_dir, "documents"), length=200).report()


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, targets = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.ImportanceDraw(documents, targets).ranked()


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.transformed(table(spark, sf_dir, "documents"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = secret_scan.train(secret_scan.labelled_samples(documents))
    return secret_scan.report(secret_scan.scan(documents, model))


def secret_base_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op13_secrets`` that base patterns alone decide."""
    documents = table(spark, sf_dir, "documents")
    found = secret_scan.report(secret_scan.scan(documents, secret_scan.fit([], [])))
    return found.drop("spans")


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op10_quality_rules`` that base rules alone decide."""
    model = linear.fit([], np.zeros(0), np.zeros(0), 1 << linear.BITS, np.zeros(0, bool))
    judged = quality_rules.judge(table(spark, sf_dir, "documents"), model)
    return judged.drop("probability", "kept")


def mix_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op5_mix`` that need neither targets nor a draw."""
    return op5_mix(spark, sf_dir).select("doc_id", "size", "source_size")


QUERIES = {
    "op1_pack": op1_pack,
    "op2_licenses": op2_licenses,
    "op3_ann": op3_ann,
    "op4_weak_quality": op4_weak_quality,
    "op5_mix": op5_mix,
    "op6_warc": op6_warc,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_html_text": op9_html_text,
    "op10_quality_rules": op10_quality_rules,
    "op11_importance": op11_importance,
    "op12_fill_middle": op12_fill_middle,
    "op13_secrets": op13_secrets,
    "secret_base_spans": secret_base_spans,
    "quality_base_counts": quality_base_counts,
    "mix_sizes": mix_sizes,
}
