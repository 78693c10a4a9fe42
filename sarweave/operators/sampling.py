"""Seeded samples that any engine can repeat: ranks by SHA-1 of key and seed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sample_key(key: str, seed: int) -> Column:
    return F.sha1(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))).cast("binary"))


def keyed_sample(rows: DataFrame, key: str, k: int, seed: int) -> DataFrame:
    """k rows; the limit is kept per task before it meets in one."""
    return rows.orderBy(sample_key(key, seed), key).limit(k)


def per_bucket(rows: DataFrame, bucket: str, key: str, k: int, seed: int) -> DataFrame:
    """At most k rows of each bucket. Spark keeps k per task and bucket before the shuffle."""
    place = F.row_number().over(Window.partitionBy(bucket).orderBy(sample_key(key, seed), key))
    return rows.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
