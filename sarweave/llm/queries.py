"""The registered queries of this subpackage, and DuckDB SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarweave.llm import decontaminate, licenses, minhash, mixing, oracles, pii, quality_crf, quality_rules, sharding, substring_dedup, suffix_dedup


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents with benchmark items, a row for each pair."""
    out = decontaminate.flag_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", F.inline("leaks"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan_pii(table(spark, sf_dir, "documents"))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
    base = F.filter("pii", lambda s: s.kind.isin(*pii.BASE))
    count = lambda k: F.size(F.filter("pii", lambda s: s.kind == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, pii.BASE), F.sha2(said(base), 256).alias("base_sha256"), said("pii").alias("spans"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.shuffle_into_shards(table(spark, sf_dir, "documents"), n_shards=8)
    text = F.coalesce("text", F.lit(""))
    return shards.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op9_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document its tokens, expected shares of the domains, fitted rate and copies."""
    out = mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    shares = [F.col("posterior")[k].alias(f"p_{d}") for k, d in enumerate(mixing.DOMAINS)]
    return out.select("doc_id", "source", "tokens", *shares, "rate", "copies")


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_suffix_dedup, op3_decontamination, op4_quality_rules, op5_license_scan, op6_pii, op7_sharding, op8_minhash, op9_quality_crf, op10_mixing)}
ORACLES = oracles.ORACLES
