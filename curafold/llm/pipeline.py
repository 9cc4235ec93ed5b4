"""The corpus pipeline's stages, each over all documents that the stage before it kept.

Each stage takes documents with any further columns, whose names it can't clash with, and gives defined results for nulls
in any column, empty and very long texts, repeated rows and ids, and empty tables; its operator's docstring states them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, near_texts, packing, pii, quality_classifier
from .common import documents, staged
from .tokens import default_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go. An empty text is judged by its metadata; without labels of both kinds all stay."""
    return quality_classifier.keep_good(docs, documents(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row with the smallest doc_id stays, whatever ids repeat or are missing; null and empty texts are equal."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (SimHash candidates over five-word shingles, exact similarity 0.8 or more) one row with the smallest doc_id stays; texts without words are alike."""
    return near_texts.deduplicate(docs)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; a null text stays null, and n_chars follows the text."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become pieces of at most 2048 tokens with their places in sequences; a null or empty text is one token."""
    return packing.pack(docs, default_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("private", private), ("packed", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
