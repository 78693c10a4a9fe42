"""The corpus pipeline: five stages over documents, each written and read again before the next.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
documents. Rows with null ids or texts, repeated rows and extra columns pass as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarweave.llm import decontaminate, minhash, mixing, quality_crf, sharding
from sarweave.session import Scratch, materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_own_names(docs: DataFrame, stage) -> DataFrame:
    """stage over docs whose other columns are out of the way of those that it adds."""
    other = {c: f"__sw_own_{c}" for c in docs.columns if c not in ("doc_id", "text")}
    back = [F.col(other.get(c, c)).alias(c) for c in docs.columns]
    return stage(docs.withColumnsRenamed(other)).select(*back)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line model predicts to be good."""
    model = quality_crf.train(docs, _table(spark, sf_dir, "labels"))
    return _with_own_names(docs, lambda d: quality_crf.score(d, model).where(F.col("score") >= quality_crf.THRESHOLD))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return minhash.drop_near_duplicates(docs, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    found = lambda d: decontaminate.flag_leaks(d, _table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0)
    return _with_own_names(docs, found)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; a scarce domain is not repeated to reach its target, since copies have just gone."""
    mixed = lambda d: mixing.mix(d, _table(spark, sf_dir, "labels"), repeat=False).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return _with_own_names(docs, mixed)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return sharding.shuffle_into_shards(docs, n_shards=8)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]
#: The classifiers and the fit are iterative; the stages are tested against plain versions instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        # What a stage wrote on its way is not needed once its rows are written.
        with Scratch(spark) as scratch:
            docs = scratch.keep(materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower()))
    return STAGES[-1][1](spark, docs, sf_dir)
