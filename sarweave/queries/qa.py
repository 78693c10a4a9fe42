"""Checks, audits, gates and summaries as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarweave.functions import radiometry as R
from sarweave.functions import scalars as S
from sarweave.operators import aggregates, joins, splits
from sarweave.plans import qa
from sarweave.queries import query, raster, table
from sarweave.queries.relational import SPLIT_SQL, crops

CELLS = "cells AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'NaN' ELSE o_orderstatus END AS status, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderpriority END AS priority FROM orders)"


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    status = F.when(k % 9 == 0, None).when(k % 11 == 0, "NaN").otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select("o_orderkey", status.alias("status"), F.when(k % 7 == 0, "").otherwise(F.col("o_orderpriority")).alias("priority"))


@query(f"""WITH {CELLS} SELECT 'status' AS "column", count_if(status IS NULL OR lower(trim(status)) IN ('', 'nan', 'none', 'null'))::BIGINT AS nulls FROM cells
UNION ALL SELECT 'priority', count_if(priority IS NULL OR lower(trim(priority)) IN ('', 'nan', 'none', 'null'))::BIGINT FROM cells""")
def required_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null cells of required columns."""
    return qa.null_counts(cells(spark, sf_dir), ["status", "priority"])


@query(f"WITH {CELLS} SELECT status AS value, count(*) AS n FROM cells WHERE coalesce(status, '') NOT IN ('O', 'F') GROUP BY status")
def vocab_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that are not in the vocabulary."""
    return qa.outside(cells(spark, sf_dir), "status", ("O", "F"))


@query("""WITH f AS (SELECT doc_id, source AS folder, n_chars AS width, text, doc_id % 83 = 0 AS failed FROM documents),
c AS (SELECT folder, count(*) AS n FROM f GROUP BY folder), m AS (SELECT list_sort(list(n))[count(*) // 2 + 1] AS median FROM c),
d AS (SELECT count(*) AS n FROM (SELECT sha256(text) FROM f GROUP BY 1 HAVING count(*) > 1)), g AS (SELECT count(*) AS n FROM c, m WHERE c.n < m.median * 0.25)
SELECT count(*) AS files, count_if(failed)::BIGINT AS failed, count_if(abs(width - 2000) / 2000 > 0.35)::BIGINT AS odd_sizes, (SELECT n FROM d) AS duplicate_groups, (SELECT n FROM g) AS gaps,
  CASE WHEN 100.0 * count_if(failed) / count(*) > 5 THEN 'stop: failures' WHEN (SELECT n FROM g) >= 2 AND count_if(failed) > 0 AND 100.0 * count_if(failed) / count(*) >= 1 THEN 'stop: failures and gaps' WHEN (SELECT n FROM g) >= 3 THEN 'stop: gaps' ELSE 'go' END AS gate FROM f""")
def raw_audit_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a raw tree (failures, odd sizes, duplicates, gaps) and the gate that they pass or not."""
    f = table(spark, sf_dir, "documents").select(F.col("source").alias("folder"), F.col("n_chars").alias("width"), F.sha2("text", 256).alias("digest"), (F.col("doc_id") % 83 == 0).alias("failed"))
    counts = f.groupBy("folder").agg(F.count("*").alias("n"))
    facts = f.agg(F.count("*").alias("files"), F.count_if("failed").alias("failed"), F.count_if(F.abs(F.col("width") - 2000) / 2000 > 0.35).alias("odd_sizes"))
    dups = aggregates.duplicates(f, "digest").agg(F.count("*").alias("duplicate_groups"))
    gaps = aggregates.gaps(counts, "folder", "n").agg(F.count("*").alias("gaps"))
    one = F.lit(1).alias("_one")
    row = facts.select("*", one).join(dups.select("*", one), "_one").join(gaps.select("*", one), "_one").drop("_one")
    return row.select("*", qa.gate(100 * F.col("failed") / F.col("files"), F.col("failed"), F.col("gaps")).alias("gate"))


@query("""SELECT e.user_id, round(100.0 * count_if(event_type = 'error' OR value < 10) / count(*), 6) AS failed_percent,
  CASE WHEN 100.0 * count_if(event_type = 'error' OR value < 10) / count(*) > 5 THEN 'stop: failures' WHEN user_id % 4 >= 2 AND count_if(event_type = 'error' OR value < 10) > 0 AND 100.0 * count_if(event_type = 'error' OR value < 10) / count(*) >= 1 THEN 'stop: failures and gaps' WHEN user_id % 4 >= 3 THEN 'stop: gaps' ELSE 'go' END AS gate FROM events e GROUP BY user_id""")
def step0_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate for many folders at once."""
    bad = F.count_if((F.col("event_type") == "error") | (F.col("value") < 10))
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(bad.alias("failed"), F.count("*").alias("n"))
    percent = 100.0 * F.col("failed") / F.col("n")
    return e.select("user_id", F.round(percent, 6).alias("failed_percent"), qa.gate(percent, F.col("failed"), F.col("user_id") % 4).alias("gate"))


FINDINGS = f"""{SPLIT_SQL}, {CELLS},
m AS (SELECT crops.image_id, crops.scene, crops.label, split FROM crops JOIN splits USING (scene)),
f AS (
  SELECT 'splits' AS module, 'leakage' AS "check", 'hard' AS severity, count(*) AS n, ' leaking groups' AS said FROM (SELECT scene FROM m GROUP BY scene HAVING count(DISTINCT split) > 1)
  UNION ALL SELECT 'splits', 'every crop in a split', 'hard', count(*), ' crops without a split' FROM (SELECT image_id FROM crops WHERE image_id NOT IN (SELECT image_id FROM m))
  UNION ALL SELECT 'splits', 'unique ids', 'hard', count(*), ' repeated ids' FROM (SELECT image_id FROM m GROUP BY image_id HAVING count(*) > 1)
  UNION ALL SELECT 'schema', 'status present', 'hard', count(*), ' bad rows' FROM cells WHERE status IS NULL OR lower(trim(status)) IN ('', 'nan', 'none', 'null')
  UNION ALL SELECT 'schema', 'priority known', 'soft', count(*), ' bad rows' FROM cells WHERE priority = ''
  UNION ALL SELECT 'joins', 'files in metadata', 'soft', count(*), ' ids of one side' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
findings AS (SELECT module, "check", severity, n = 0 AS ok, n || said AS message FROM f)"""


def findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = crops(spark, sf_dir)
    m = c.join(splits.assign_splits(c, "scene").select("scene", "split"), "scene")
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return qa.report([
        qa.empty(splits.leaks(m, "scene"), "splits", "leakage", "hard", "leaking groups"),
        qa.empty(c.join(m, "image_id", "left_anti"), "splits", "every crop in a split", "hard", "crops without a split"),
        qa.empty(aggregates.duplicates(m, "image_id"), "splits", "unique ids", "hard", "repeated ids"),
        qa.several(cells(spark, sf_dir), "schema", [("status present", "hard", S.nullish(F.col("status"))), ("priority known", "soft", F.col("priority") == "")]),
        qa.empty(joins.missing_both_ways(documents, labels, ["doc_id"]), "joins", "files in metadata", "soft", "ids of one side"),
    ])


@query(f"WITH {FINDINGS} SELECT * FROM findings")
def split_and_join_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of the split, schema and join checks."""
    return findings(spark, sf_dir)


@query(f"""WITH {SPLIT_SQL}, m AS (SELECT split, crops.label FROM crops JOIN splits USING (scene)), n AS (SELECT split, count(*) AS size FROM m GROUP BY split),
l AS (SELECT label, count(*) / sum(count(*)) OVER () AS overall FROM m GROUP BY label)
SELECT split, label, round(count(m.label) / size, 9) AS share, round(overall, 9) AS overall, abs(count(m.label) / size - overall) <= 0.2 AS within
FROM n CROSS JOIN l LEFT JOIN m USING (split, label) GROUP BY split, label, size, overall""")
def split_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of labels in each split against all crops."""
    c = crops(spark, sf_dir)
    m = c.join(splits.assign_splits(c, "scene").select("scene", "split"), "scene")
    r = lambda x: F.round(x, 9).alias(x)
    return splits.balance(m).select("split", "label", r("share"), r("overall"), "within")


@query(f"""WITH {CELLS} SELECT 'schema' AS module, 'priority known' AS "check", 'soft' AS severity, count_if(priority = '') = 0 AS ok, count_if(priority = '') || ' bad rows' AS message FROM cells
UNION ALL SELECT 'schema', 'lacks its column', 'hard', false, 'did not run: AnalysisException'
UNION ALL SELECT 'schema', 'status present', 'hard', count(*) = 0, count(*) || ' bad rows' FROM cells WHERE status IS NULL OR lower(trim(status)) IN ('', 'nan', 'none', 'null')""")
def guarded_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of which one can't run: it is a hard finding, and those after it are run all the same."""
    c = cells(spark, sf_dir)
    return qa.guarded(spark, [
        ("schema", "priority known", lambda: qa.finding(c, "schema", "priority known", "soft", F.col("priority") == "")),
        ("schema", "lacks its column", lambda: qa.finding(c, "schema", "lacks its column", "soft", F.col("no_such_column") == "")),
        ("schema", "status present", lambda: qa.finding(c, "schema", "status present", "hard", S.nullish(F.col("status")))),
    ])


@query(f"""WITH {FINDINGS}, r AS (SELECT module, count(*) AS checks, count_if(severity = 'hard' AND NOT ok)::BIGINT AS hard_failures, count_if(severity = 'soft' AND NOT ok)::BIGINT AS soft_failures FROM findings GROUP BY module)
SELECT *, CASE WHEN hard_failures > 0 THEN 'FAIL' WHEN soft_failures > 0 THEN 'WARN' ELSE 'PASS' END AS verdict FROM r""")
def findings_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings by module, with a verdict."""
    return qa.rollup(findings(spark, sf_dir))


@query("""WITH s AS (SELECT l_returnflag AS label, l_discount * 100 - 2 AS damping FROM lineitem) SELECT label, round(avg((damping < 3 OR damping > 20)::INT), 6) AS outside, round(median(damping), 6) AS median, avg((damping < 3 OR damping > 20)::INT) < 0.5 AS plausible FROM s GROUP BY label""")
def damping_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many damping ratios lie out of their band, and their median."""
    s = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"), (F.col("l_discount") * 100 - 2).alias("damping"))
    out = F.avg(((F.col("damping") < 3) | (F.col("damping") > 20)).cast("int"))
    return s.groupBy("label").agg(F.round(out, 6).alias("outside"), F.round(F.median("damping"), 6).alias("median"), (out < 0.5).alias("plausible"))


@query(f"""WITH {raster.PIX}, m AS (SELECT scene, max(v * 30 - 15) AS hi FROM pix GROUP BY scene), s AS (SELECT scene FROM m ORDER BY scene LIMIT 6)
SELECT scene, max(round_even((greatest(-30, least(v * 30 - 15, 0)) + 30) / 30 * 65535, 0)::INT) > 255 AS is_16bit FROM pix WHERE scene IN (SELECT scene FROM s) GROUP BY scene""")
def bit_depth_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the first six calibrated scenes: whether their pixels use more than eight bits."""
    ln = raster.lines(spark, sf_dir)
    some = ln.select("scene").distinct().orderBy("scene").limit(6)
    deep = F.array_max(F.transform("v", lambda v: R.to_uint16(v * 30 - 15)))
    return ln.join(some, "scene", "left_semi").groupBy("scene").agg((F.max(deep) > 255).alias("is_16bit"))


@query("""SELECT count(*) AS crops, count(DISTINCT scene) AS scenes, count_if(label = 'oil')::BIGINT AS oil, count_if(label = 'lookalike')::BIGINT AS lookalike, round(count_if(label = 'oil') / count(*), 6) AS oil_share
FROM (SELECT o_custkey AS scene, CASE WHEN o_orderpriority LIKE '1%' THEN 'oil' WHEN o_orderpriority LIKE '2%' THEN 'lookalike' ELSE 'background' END AS label FROM orders)""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a run."""
    n = lambda x: F.count_if(F.col("label") == x)
    return crops(spark, sf_dir).agg(F.count("*").alias("crops"), F.countDistinct("scene").alias("scenes"), n("oil").alias("oil"), n("lookalike").alias("lookalike"), F.round(n("oil") / F.count("*"), 6).alias("oil_share"))


@query("SELECT label, n, round(n / sum(n) OVER (), 9) AS share FROM (SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'oil' WHEN o_orderpriority LIKE '2%' THEN 'lookalike' ELSE 'background' END AS label, count(*) AS n FROM orders GROUP BY 1)")
def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with their shares."""
    c = crops(spark, sf_dir).groupBy("label").agg(F.count("*").alias("n"))
    total = c.agg(F.sum("n").alias("t"))
    return c.join(F.broadcast(total)).select("label", "n", F.round(F.col("n") / F.col("t"), 9).alias("share"))
