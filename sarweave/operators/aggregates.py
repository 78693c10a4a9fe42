"""Aggregate operators: labels, histograms, medians, duplicates, gaps, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dominant_label(rows: DataFrame, group: str, label: str = "label") -> DataFrame:
    """The commonest positive label of each group (ties: lookalike last, then by name), or background."""
    counts = rows.groupBy(group, label).count()
    order = F.struct(-F.col("count"), (F.col(label) == "lookalike").cast("int"), F.col(label))
    best = F.min(F.when(F.col(label) != "background", F.struct(order.alias("o"), F.col(label).alias("l"))))
    return counts.groupBy(group).agg(best.alias("b")).select(group, F.coalesce("b.l", F.lit("background")).alias("dominant"))


def histogram(rows: DataFrame, group: str, value: str, bins: int) -> DataFrame:
    """Counts in bins of equal width over each group's own range; the last bin is closed on the right."""
    span = rows.groupBy(group).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    width = F.col("_hi") - F.col("_lo")
    place = F.when(width > 0, F.least(F.floor((F.col(value) - F.col("_lo")) / F.nullif(width, F.lit(0)) * bins), F.lit(bins - 1))).otherwise(bins // 2)
    return rows.where(F.col(value).isNotNull()).join(span, group).select(group, place.cast("int").alias("bin")).groupBy(group, "bin").agg(F.count("*").alias("n"))


def upper_median(rows: DataFrame, value: str) -> DataFrame:
    """One row with median: the middle value, the upper of two; null where there is none.

    Equal values are counted first and only these counts are ranked in one task. Meant for counts: folders whose
    numbers of files add up to N have at most about sqrt(2 N) different ones.
    """
    times = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("_times"))
    upto = F.sum("_times").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    every = F.sum("_times").over(Window.orderBy(value).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return times.select(value, (upto > F.floor(every / 2)).alias("_above")).agg(F.min(F.when(F.col("_above"), F.col(value))).alias("median"))


def gaps(counts: DataFrame, folder: str, n: str, fraction: float = 0.25) -> DataFrame:
    """Folders with less than a fraction of the upper median number of files."""
    middle = upper_median(counts, n)
    return counts.join(F.broadcast(middle), F.col(n) < F.col("median") * fraction).select(folder, n, "median")


def duplicates(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur twice or more, and how often."""
    return rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def later_duplicates(rows: DataFrame, key: str, order: str) -> DataFrame:
    """All rows of a key but its first."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n > 1").drop("_n")


def partial_hash(content: Column, edge: int = 65536) -> Column:
    """SHA-256 of the first and last edge bytes and the length."""
    n = F.octet_length(content)
    tail = F.when(n > edge, F.substring(content, F.greatest(n - edge + 1, F.lit(edge + 1)), F.lit(edge))).otherwise(F.lit(b""))
    return F.sha2(F.concat(F.substring(content, F.lit(1), F.lit(edge)), tail, n.cast("string").cast("binary")), 256)


def contiguous(rows: DataFrame, group: str, number: str) -> DataFrame:
    """Per group the first and last part number, how many there are, and the numbers from 1 that lack."""
    parts = rows.groupBy(group).agg(F.min(number).alias("first"), F.max(number).alias("last"), F.array_sort(F.collect_set(number)).alias("have"))
    lacks = F.array_except(F.sequence(F.lit(1), F.col("last")), F.col("have"))
    return parts.select(group, "first", "last", F.size("have").alias("parts"), F.size(lacks).alias("lacking"), F.array_join(lacks.cast("array<string>"), ",").alias("gaps"))
