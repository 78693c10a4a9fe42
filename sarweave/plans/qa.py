"""Checks as queries: each gives findings (module, check, severity, ok, message), none is raised."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sarweave.functions import scalars as S

log = logging.getLogger(__name__)

SEVERITIES = ("hard", "soft", "info")
FINDING = ("module", "check", "severity", "ok", "message")


def finding(table: DataFrame, module: str, check: str, severity: str, bad: Column, *, said: str = "bad rows") -> DataFrame:
    """One finding: ok where no row of table is bad; the message counts them."""
    n = F.count_if(F.coalesce(bad, F.lit(False)))
    return table.agg(n.alias("n")).select(
        F.lit(module).alias("module"), F.lit(check).alias("check"), F.lit(severity).alias("severity"), (F.col("n") == 0).alias("ok"),
        F.concat(F.col("n").cast("string"), F.lit(f" {said}")).alias("message"),
    )


def empty(table: DataFrame, module: str, check: str, severity: str, said: str) -> DataFrame:
    """One finding: ok where table has no row."""
    return finding(table, module, check, severity, F.lit(True), said=said)


def several(table: DataFrame, module: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """Findings of one table in one pass: (check, severity, bad) each."""
    counts = table.agg(*(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"n{i}") for i, (_, _, bad) in enumerate(checks)))
    rows = F.array(*(F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"), (F.col(f"n{i}") == 0).alias("ok"), F.concat(F.col(f"n{i}").cast("string"), F.lit(" bad rows")).alias("message")) for i, (c, s, _) in enumerate(checks)))
    return counts.select(F.explode(rows).alias("f")).select(F.lit(module).alias("module"), "f.*")


def guarded(spark: SparkSession, checks: list[tuple[str, str, Callable[[], DataFrame]]]) -> DataFrame:
    """Findings of checks (module, check, function), each run by itself: one that fails is a hard finding, and the others go on.

    Only findings come to the driver, a row for each check.
    """
    rows = []
    for module, name, make in checks:
        try:
            rows += [tuple(r) for r in make().select(*FINDING).collect()]
        except Exception as e:
            rows.append((module, name, "hard", False, f"did not run: {type(e).__name__}"))
            log.exception("check %s of %s did not run", name, module)
    return spark.createDataFrame(rows, "module string, check string, severity string, ok boolean, message string")


def report(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rollup(findings: DataFrame) -> DataFrame:
    """Per module: checks, failures by severity, and the verdict (failures that are hard fail, soft warn)."""
    failed = lambda s: F.count_if((F.col("severity") == s) & ~F.col("ok"))
    verdict = F.when(F.col("hard_failures") > 0, "FAIL").when(F.col("soft_failures") > 0, "WARN").otherwise("PASS")
    return findings.groupBy("module").agg(F.count("*").alias("checks"), failed("hard").alias("hard_failures"), failed("soft").alias("soft_failures")).withColumn("verdict", verdict)


def null_counts(table: DataFrame, columns: list[str]) -> DataFrame:
    """Per column how many cells are null or a null word, in one pass."""
    counts = table.agg(*(F.count_if(S.nullish(F.col(c))).alias(c) for c in columns))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in columns))).alias("x")).select("x.*")


def outside(table: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Values that the vocabulary lacks, and how often they occur."""
    return table.where(~F.coalesce(F.col(column), F.lit("")).isin(*allowed)).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def gate(failed_percent: Column, failed: Column, gaps: Column) -> Column:
    """Whether a build may start: stop where too many files fail or too many folders have gaps."""
    return (
        F.when(failed_percent > 5, "stop: failures").when((gaps >= 2) & (failed > 0) & (failed_percent >= 1), "stop: failures and gaps")
        .when(gaps >= 3, "stop: gaps").otherwise("go")
    )
