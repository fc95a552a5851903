"""A training-corpus pipeline: documents in, encoded documents out, in five written stages."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from stackweave.llm import bpe, exact_dedup, mixing, quality, simhash
from stackweave.llm.queries import TOKENIZERS, table
from stackweave.session import Scratch, ship_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among ``docs``."""
    ship_package(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), Scratch(spark, "pipeline-quality"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts: that with the smallest doc_id."""
    ship_package(spark)
    return exact_dedup.keep_first(docs, Scratch(spark, "pipeline-exact"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked within 4 bits: that with the smallest doc_id."""
    ship_package(spark)
    return simhash.keep_one(docs, Scratch(spark, "pipeline-near"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: every document as often as it is taken, whole."""
    ship_package(spark)
    return mixing.mixed(docs, Scratch(spark, "pipeline-mix"))


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document's whole text, with the digests of ids and decoded text."""
    ship_package(spark)
    found = bpe.tokenised(docs, f"{TOKENIZERS}/byte_bpe_50k.json", with_ids=True)
    return found.drop("text", "decoded")


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: SQL has neither the classifier, nor XXH64, nor byte-pair merges: tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return docs
