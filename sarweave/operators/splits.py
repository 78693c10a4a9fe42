"""Leakage-free train, val and test splits: groups stay whole, labels are spread by quota."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sarweave.config import DEFAULT, Config
from sarweave.operators.aggregates import dominant_label


def quotas(n: Column, c: Config = DEFAULT) -> tuple[Column, Column]:
    """How many of n groups go to train and to val; the rest is test.

    Shares are rounded half-even. With three groups or more, val and test get one each at least, taken
    from train while it has more than one, else (for test) from val.
    """
    total = sum(c.ratios)
    train, val = (F.bround(n * F.lit(r / total), 0).cast("int") for r in c.ratios[:2])
    val = F.when(train + val > n, F.greatest(F.lit(0), n - train)).otherwise(val)
    few = (n >= 3) & (val == 0)
    train, val = F.when(few & (train > 1), train - 1).otherwise(train), F.when(few, 1).otherwise(val)
    test_before = n - F.bround(n * F.lit(c.ratios[0] / total), 0).cast("int") - F.when(few, 0).otherwise(val)
    none = (n >= 3) & (test_before == 0)
    return F.when(none & (train > 1), train - 1).otherwise(train), F.when(none & (train <= 1) & (val > 1), val - 1).otherwise(val)


def assign_splits(rows: DataFrame, group: str, label: str = "label", c: Config = DEFAULT) -> DataFrame:
    """group, dominant and split. Groups are ranked within their label by a keyed hash, in ranges rather than in one sort per label.

    Ranks come from counts of 4096 hash ranges per label and places within a range, so that no
    task holds all groups of a label.
    """
    groups = dominant_label(rows, group, label)
    order = F.sha1(F.concat(F.lit(f"{c.seed}|"), F.col(group).cast("string")).cast("binary"))
    keyed = groups.withColumn("_key", order).withColumn("_range", F.substring("_key", 1, 3))
    before = Window.partitionBy("dominant").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = keyed.groupBy("dominant", "_range").agg(F.count("*").alias("_n"))
    ranges = ranges.select("dominant", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy("dominant")).alias("_all"))
    place = F.row_number().over(Window.partitionBy("dominant", "_range").orderBy("_key", group)) + F.col("_before")
    train, val = quotas(F.col("_all"), c)
    split = F.when(F.col("_place") <= train, "train").when(F.col("_place") <= train + val, "val").otherwise("test")
    return keyed.join(ranges, ["dominant", "_range"]).withColumn("_place", place).select(group, "dominant", split.alias("split"))


def leaks(manifest: DataFrame, group: str) -> DataFrame:
    """Groups that are in two splits or more."""
    return manifest.groupBy(group).agg(F.countDistinct("split").alias("n_splits")).where("n_splits > 1")


def overlaps(manifest: DataFrame, key: str) -> DataFrame:
    """Keys that two splits share, with the pair of splits."""
    m = manifest.select(key, "split").distinct()
    other = m.select(key, F.col("split").alias("other"))
    return m.join(other, key).where("split < other")


def balance(manifest: DataFrame, label: str = "label", tolerance: float = 0.2) -> DataFrame:
    """split, label, the label's share of the split and of all rows, and whether they differ by tolerance at most.

    A label that a split lacks has share 0 there; a split without rows gives none. Rows without a split or label don't count.
    """
    n = manifest.where(F.col("split").isNotNull() & F.col(label).isNotNull()).groupBy("split", label).agg(F.count("*").alias("_n"))
    sizes = n.groupBy("split").agg(F.sum("_n").alias("_size"))
    every = n.groupBy(label).agg(F.sum("_n").alias("_of_label")).withColumn("_all", F.sum("_of_label").over(Window.partitionBy(F.lit(0))))
    pairs = every.withColumn("split", F.explode(F.array(*(F.lit(s) for s in ("train", "val", "test"))))).join(sizes, "split").join(n, ["split", label], "left")
    share, overall = F.coalesce("_n", F.lit(0)) / F.col("_size"), F.col("_of_label") / F.col("_all")
    return pairs.select("split", label, share.alias("share"), overall.alias("overall"), (F.abs(share - overall) <= tolerance).alias("within"))


def train_ready(rows: DataFrame) -> DataFrame:
    """Rows that may train: eligible, whole, calibrated, and of a positive label; a column that is missing passes."""
    rules = {
        "eligible_for_classifier": lambda c: F.upper(c) != "N", "truncated": lambda c: F.upper(c) != "Y",
        "is_calibrated": lambda c: F.upper(c) == "Y", "label": lambda c: F.lower(c).isin("oil", "lookalike"),
    }
    for name, keep in rules.items():
        if name in rows.columns:
            rows = rows.where(keep(F.coalesce(F.col(name), F.lit(""))))
    return rows
