"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stackweave.llm import bpe, divergence, exact_dedup, filter_audit, html, langid, mixing, neighbours, oracles, quality, secrets, simhash, suffix_dedup, warc
from stackweave.session import Scratch

#: Folder of the public vocabulary files on every node.
TOKENIZERS = "/opt/tokenizers"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), Scratch(spark, "op1"), F.col("vec_id") % 20 == 0)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "op2"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(table(spark, sf_dir, "documents"), Scratch(spark, "op3"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"), Scratch(spark, "op4"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages").select("page_id", "html"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.tokenised(docs, f"{TOKENIZERS}/byte_bpe_50k.json").drop("text")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), Scratch(spark, "op7"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs)).drop("text")
    return found.withColumn("held_out", F.coalesce(langid.fold() == 2, F.lit(False)))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), Scratch(spark, "op9"))
    taken = F.col("epochs") * F.col("size") + F.col("part")
    return mixed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), Scratch(spark, "op10"))


def op11_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), Scratch(spark, "op12"))


def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), Scratch(spark, "op13"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": op1_neighbours,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_secrets": op4_secrets,
    "op5_html_text": op5_html_text,
    "op6_bpe": op6_bpe,
    "op7_simhash": op7_simhash,
    "op8_language": op8_language,
    "op9_mix": op9_mix,
    "op10_warc": op10_warc,
    "op11_suffixes": op11_suffixes,
    "op12_divergence": op12_divergence,
    "op13_filters": op13_filters,
}
ORACLES: dict[str, str] = {
    "op3_exact_dedup": oracles.EXACT_DEDUP,
    "op4_secrets": oracles.SECRETS,
    "op9_mix": oracles.MIX,
    "op10_warc": oracles.WARC,
    "op12_divergence": oracles.DIVERGENCE,
    "op13_filters": oracles.FILTER_AUDIT,
}
