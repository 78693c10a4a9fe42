"""Joins, aggregates, splits, samples and set operations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarweave.functions import names as N
from sarweave.functions import scalars as S
from sarweave.operators import aggregates, joins, sampling, splits
from sarweave.queries import query, table
from sarweave.queries.names import _KEY, _NOPOL, PATHS_SQL, paths

LABEL_SQL = "CASE WHEN o_orderpriority LIKE '1%' THEN 'oil' WHEN o_orderpriority LIKE '2%' THEN 'lookalike' ELSE 'background' END"


def crops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as crops: image_id, scene (customer), label (priority)."""
    p = F.col("o_orderpriority")
    label = F.when(p.startswith("1"), "oil").when(p.startswith("2"), "lookalike").otherwise("background")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("image_id"), F.col("o_custkey").alias("scene"), label.alias("label"))


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
  round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY l_returnflag, l_linestatus""")
def pricing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional sums and means per group, in one pass with partial aggregation."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") <= F.lit("1998-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
        F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"),
        F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("count_order"),
    )


@query(f"""WITH {PATHS_SQL},
f AS (SELECT p_partkey, folder, {_NOPOL} AS base, nullif(upper(regexp_extract(stem, '(?i)(?:^|[_\\-.])(vv|vh)$', 1)), '') AS pol, path FROM s),
p AS (SELECT folder, base, string_agg(pol, ',' ORDER BY pol != 'VV', pol, path) AS pol_tags, string_agg(path, ',' ORDER BY pol != 'VV', pol, path) AS band_files FROM f WHERE pol IS NOT NULL GROUP BY folder, base)
SELECT * FROM p UNION ALL SELECT folder, base, 'VV', path FROM f WHERE pol IS NULL AND NOT EXISTS (SELECT 1 FROM p WHERE p.folder = f.folder AND p.base = f.base)""")
def pol_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one base paired by polarisation, VV first; stacked files where no pair has the base."""
    p = F.col("path")
    files = paths(spark, sf_dir).select(N.parent(p).alias("folder"), N.without_polarisation(N.stem(p)).alias("base"), N.polarisation(N.stem(p)).alias("pol"), "path")
    out = joins.pair_polarisations(files)
    return out.select("folder", "base", F.array_join("pol_tags", ",").alias("pol_tags"), F.array_join("band_files", ",").alias("band_files"))


@query(f"""WITH {PATHS_SQL},
k AS (SELECT *, {_KEY} AS key, regexp_matches(lower(stem), '(^|[_\\-.])(mask|label|labels|gt|lbl|ann)([_\\-.]|$)') OR len(list_filter(string_split(folder, '/'), lambda x: list_has_any(regexp_split_to_array(lower(x), '[_\\-\\s.]+'), ['mask', 'label', 'labels', 'gt', 'lbl', 'ann']) OR regexp_matches(x, '(?i)((_masks?|_labels?|_gt)$)|(^(masks?|labels?)_)|(^(masks?|gt|labels)$)'))) > 0 AS is_mask FROM s),
j AS (SELECT i.p_partkey, m.path AS mask, row_number() OVER (PARTITION BY i.p_partkey ORDER BY i.folder != m.folder, len(string_split(m.path, '/')), m.path) AS n
  FROM (SELECT * FROM k WHERE NOT is_mask) i LEFT JOIN (SELECT * FROM k WHERE is_mask) m ON i.key = m.key)
SELECT p_partkey, mask FROM j WHERE n = 1""")
def mask_pairing_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best mask of each image with its key: of its folder, then least deep, then by path."""
    p = F.col("path")
    files = paths(spark, sf_dir).select("p_partkey", "path", N.parent(p).alias("folder"), N.pairing_key(N.stem(p)).alias("key"), N.is_mask_path(p).alias("is_mask"))
    images = files.where("NOT is_mask").select("p_partkey", "folder", "key")
    masks = files.where("is_mask").select("key", F.col("path").alias("mask"), F.col("folder").alias("mask_folder"))
    return joins.find_masks(images, masks, F.array("folder")).select("p_partkey", "mask")


@query("""SELECT l_orderkey, l_linenumber, format('{}_inst{:03d}', o_orderpriority, l_linenumber) AS feature_id, coalesce(c_mktsegment, '') AS segment, coalesce(c_name, '') AS scene_name
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def left_lookup_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instances with scene and location columns looked up, blank where a lookup misses."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_name")
    out = li.join(o, "l_orderkey", "left").join(c, "o_custkey", "left")
    blank = lambda x, as_: F.coalesce(x, F.lit("")).alias(as_)
    return out.select("l_orderkey", "l_linenumber", N.feature_id(F.col("o_orderpriority"), F.col("l_linenumber")).alias("feature_id"), blank("c_mktsegment", "segment"), blank("c_name", "scene_name"))


@query("""SELECT p_partkey, coalesce(a.s_name, b.s_name, c.s_name) AS value, CASE WHEN a.s_name IS NOT NULL THEN 1 WHEN b.s_name IS NOT NULL THEN 2 WHEN c.s_name IS NOT NULL THEN 3 END AS step FROM part
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 5000) a ON a.s_suppkey = p_partkey
LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) b ON b.s_suppkey = p_partkey // 10
LEFT JOIN (SELECT s_nationkey, min(s_name) AS s_name FROM supplier GROUP BY s_nationkey) c ON c.s_nationkey = p_size""")
def cascade_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A value by the first of three keys that finds it."""
    s = table(spark, sf_dir, "supplier").withColumnRenamed("s_name", "value")
    left = table(spark, sf_dir, "part").select("p_partkey", F.col("p_partkey").alias("a"), F.floor(F.col("p_partkey") / 10).alias("b"), F.col("p_size").alias("c"))
    steps = [
        (s.where("s_acctbal > 5000").select(F.col("s_suppkey").alias("a"), "value"), ["a"]),
        (s.where("s_acctbal > 0").select(F.col("s_suppkey").alias("b"), "value"), ["b"]),
        (s.groupBy(F.col("s_nationkey").alias("c")).agg(F.min("value").alias("value")), ["c"]),
    ]
    return joins.cascade(left, steps, "value").select("p_partkey", "value", "step")


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'metadata' ELSE 'files' END AS only_in
FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT 2 * doc_id AS doc_id FROM labels) l ON d.doc_id = l.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL""")
def anti_join_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that only the files or only the metadata have."""
    labels = table(spark, sf_dir, "labels").select((2 * F.col("doc_id")).alias("doc_id"))
    return joins.missing_both_ways(table(spark, sf_dir, "documents"), labels, ["doc_id"], ("files", "metadata"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key is a member."""
    c = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(c, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


@query("""WITH p AS (SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, (user_id % 20) * 0.37::DOUBLE AS lat, (event_id % 31) * 0.41::DOUBLE AS lon FROM events),
g AS (SELECT strftime(ts, '%Y-%m-%d') AS day, (user_id % 40) * 0.25::DOUBLE AS glat, (event_id % 53) * 0.25::DOUBLE AS glon, max(value) AS u, min(value) AS v FROM events GROUP BY ALL),
j AS (SELECT p.*, u, v, row_number() OVER (PARTITION BY event_id ORDER BY abs(lat - glat) + abs(lon - glon), glat, glon) AS n
  FROM p LEFT JOIN g ON p.day = g.day AND round_even(lat, 0) = round_even(glat, 0) AND round_even(lon, 0) = round_even(glon, 0))
SELECT event_id, day, round(sqrt(u * u + v * v), 6) AS wind_speed, CASE WHEN u IS NULL THEN '' ELSE 'era5' END AS wind_source FROM j WHERE n = 1""")
def weather_cell_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wind of the nearest grid point of the same day and one-degree cell."""
    e = table(spark, sf_dir, "events")
    day = F.date_format("ts", S.DAY).alias("day")
    points = e.select("event_id", day, ((F.col("user_id") % 20) * F.lit(0.37)).alias("lat"), ((F.col("event_id") % 31) * F.lit(0.41)).alias("lon"))
    grid = e.groupBy(day, ((F.col("user_id") % 40) * F.lit(0.25)).alias("glat"), ((F.col("event_id") % 53) * F.lit(0.25)).alias("glon")).agg(F.max("value").alias("u"), F.min("value").alias("v"))
    out = joins.nearest_cell(points, grid, ["u", "v"])
    return out.select("event_id", "day", F.round(F.sqrt(F.col("u") ** 2 + F.col("v") ** 2), 6).alias("wind_speed"), F.when(F.col("u").isNull(), "").otherwise("era5").alias("wind_source"))


DOMINANT_SQL = f"""crops AS (SELECT o_orderkey AS image_id, o_custkey AS scene, {LABEL_SQL} AS label FROM orders),
counts AS (SELECT scene, label, count(*) AS n FROM crops GROUP BY scene, label),
ranked AS (SELECT scene, label, row_number() OVER (PARTITION BY scene ORDER BY label = 'background', n DESC, label = 'lookalike', label) AS k FROM counts),
dom AS (SELECT scene, label AS dominant FROM ranked WHERE k = 1)"""
SPLIT_SQL = f"""{DOMINANT_SQL},
placed AS (SELECT *, row_number() OVER (PARTITION BY dominant ORDER BY sha1('42|' || scene)) AS place, count(*) OVER (PARTITION BY dominant) AS n FROM dom),
q0 AS (SELECT *, round_even(n * 0.70::DOUBLE, 0)::INT AS tr, round_even(n * 0.15::DOUBLE, 0)::INT AS va FROM placed),
q1 AS (SELECT * REPLACE (CASE WHEN tr + va > n THEN greatest(0, n - tr) ELSE va END AS va), n - tr - CASE WHEN tr + va > n THEN greatest(0, n - tr) ELSE va END AS te FROM q0),
q2 AS (SELECT * REPLACE (CASE WHEN n >= 3 AND va = 0 AND tr > 1 THEN tr - 1 ELSE tr END AS tr, CASE WHEN n >= 3 AND va = 0 THEN 1 ELSE va END AS va) FROM q1),
q3 AS (SELECT * REPLACE (CASE WHEN n >= 3 AND te = 0 AND tr > 1 THEN tr - 1 ELSE tr END AS tr, CASE WHEN n >= 3 AND te = 0 AND tr <= 1 AND va > 1 THEN va - 1 ELSE va END AS va) FROM q2),
splits AS (SELECT scene, dominant, CASE WHEN place <= tr THEN 'train' WHEN place <= tr + va THEN 'val' ELSE 'test' END AS split FROM q3)"""


@query(f"WITH {DOMINANT_SQL} SELECT * FROM dom")
def dominant_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label that stands for a scene."""
    return aggregates.dominant_label(crops(spark, sf_dir), "scene")


@query(f"WITH {SPLIT_SQL} SELECT * FROM splits")
def group_safe_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes in train, val and test by label quotas."""
    return splits.assign_splits(crops(spark, sf_dir), "scene")


@query("""SELECT o_custkey AS scene, count(DISTINCT CASE WHEN o_orderkey % 97 = 0 THEN 'val' ELSE 'train' END) AS n_splits FROM orders GROUP BY o_custkey HAVING n_splits > 1""")
def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes whose crops lie in two splits."""
    m = crops(spark, sf_dir).withColumn("split", F.when(F.col("image_id") % 97 == 0, "val").otherwise("train"))
    return splits.leaks(m, "scene")


@query("""WITH m AS (SELECT DISTINCT o_custkey AS scene, ['train', 'val', 'test'][o_orderkey % 3 + 1] AS split FROM orders)
SELECT a.scene, a.split, b.split AS other FROM m a JOIN m b ON a.scene = b.scene AND a.split < b.split""")
def split_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that two splits share."""
    names = F.array(F.lit("train"), F.lit("val"), F.lit("test"))
    return splits.overlaps(crops(spark, sf_dir).withColumn("split", F.element_at(names, (F.col("image_id") % 3 + 1).cast("int"))), "scene")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag != 'N' AND l_linestatus != 'O' AND l_linenumber % 4 IN (0, 1)""")
def training_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that may train a classifier."""
    labels = F.array(F.lit("oil"), F.lit("LookAlike"), F.lit("background"), F.lit(None))
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", "n").otherwise("y").alias("eligible_for_classifier"),
        F.when(F.col("l_linestatus") == "O", "Y").otherwise("N").alias("truncated"), F.lit("y").alias("is_calibrated"),
        F.element_at(labels, (F.col("l_linenumber") % 4 + 1).cast("int")).alias("label"),
    )
    return splits.train_ready(rows).select("l_orderkey", "l_linenumber")


@query("SELECT sha256(text) AS digest, count(*) AS n FROM documents GROUP BY 1 HAVING n > 1")
def dup_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that occur twice or more."""
    d = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("digest"))
    return aggregates.duplicates(d, "digest")


@query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha256(text) ORDER BY doc_id) AS n FROM documents) WHERE n > 1")
def dup_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files with equal contents but the first of each."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return aggregates.later_duplicates(d, "digest", "doc_id").select("doc_id")


@query("""WITH b AS (SELECT doc_id, encode(text) AS t, octet_length(encode(text)) AS n FROM documents)
SELECT doc_id, sha256(t[1:65536] || CASE WHEN n > 65536 THEN t[greatest(n - 65535, 65537):n] ELSE ''::BLOB END || encode(n::VARCHAR)) AS digest FROM b""")
def partial_file_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of a file's head, tail and size."""
    return table(spark, sf_dir, "documents").select("doc_id", aggregates.partial_hash(F.col("text").cast("binary")).alias("digest"))


@query("""WITH c AS (SELECT source || '/' || (doc_id % 37 // 4) AS folder, count(*)::BIGINT AS n FROM documents GROUP BY 1),
m AS (SELECT list_sort(list(n))[count(*) // 2 + 1] AS median FROM c)
SELECT folder, n, median FROM c, m WHERE n < median * 0.25""")
def folder_gaps_upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folders with far fewer files than the upper median."""
    folder = F.concat_ws("/", "source", F.floor(F.col("doc_id") % 37 / 4).cast("string"))
    counts = table(spark, sf_dir, "documents").groupBy(folder.alias("folder")).agg(F.count("*").alias("n"))
    return aggregates.gaps(counts, "folder", "n")


@query("""SELECT source, count(*) AS files, count_if(doc_id % 4 = 0)::BIGINT AS masks, bool_or(lang = 'fr') AS has_lookalike, string_agg(DISTINCT lang, ',' ORDER BY lang) AS formats,
  min_by(n_chars, doc_id) AS first_width, sum(n_chars)::BIGINT AS total_bytes FROM documents GROUP BY source""")
def dataset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of facts per dataset."""
    return table(spark, sf_dir, "documents").groupBy("source").agg(
        F.count("*").alias("files"), F.count_if(F.col("doc_id") % 4 == 0).alias("masks"), F.bool_or(F.col("lang") == "fr").alias("has_lookalike"),
        F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("formats"), F.min_by("n_chars", "doc_id").alias("first_width"), F.sum("n_chars").alias("total_bytes"),
    )


@query("""WITH n AS (SELECT l_returnflag AS label, l_extendedprice AS v FROM lineitem), r AS (SELECT label, min(v) AS lo, max(v) AS hi FROM n GROUP BY label)
SELECT label, least(floor((v - lo) / (hi - lo) * 40), 39)::INT AS bin, count(*) AS n FROM n JOIN r USING (label) GROUP BY 1, 2""")
def label_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty bins over each label's own range."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("label"), F.col("l_extendedprice").alias("v"))
    return aggregates.histogram(li, "label", "v", 40)


@query("SELECT l_returnflag AS label, round(median(l_extendedprice), 6) AS median, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, max(l_extendedprice) AS largest FROM lineitem GROUP BY 1")
def label_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median, 95th percentile and maximum by label."""
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("label")).agg(
        F.round(F.median("l_extendedprice"), 6).alias("median"), F.round(F.percentile("l_extendedprice", 0.95), 6).alias("p95"), F.max("l_extendedprice").alias("largest")
    )


@query("SELECT o_orderkey FROM orders ORDER BY sha1(o_orderkey || ':' || 42), o_orderkey LIMIT 25")
def keyed_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty-five rows by seeded rank."""
    return sampling.keyed_sample(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 25, 42)


@query(f"""SELECT image_id, label FROM (SELECT o_orderkey AS image_id, {LABEL_SQL} AS label, row_number() OVER (PARTITION BY {LABEL_SQL} ORDER BY sha1(o_orderkey || ':' || 7), o_orderkey) AS n FROM orders) WHERE n <= 10""")
def risk_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten rows of each risk bucket by seeded rank."""
    return sampling.per_bucket(crops(spark, sf_dir).select("image_id", "label"), "label", "image_id", 10, 7)


@query("""WITH p AS (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag != 'R'),
g AS (SELECT l_orderkey, min(l_linenumber) AS first, max(l_linenumber) AS last, count(DISTINCT l_linenumber)::INT AS parts, list_distinct(list(l_linenumber)) AS have FROM p GROUP BY l_orderkey)
SELECT l_orderkey, first, last, parts, len(list_filter(range(1, last + 1), lambda x: NOT list_contains(have, x)))::INT AS lacking, array_to_string(list_filter(range(1, last + 1), lambda x: NOT list_contains(have, x)), ',') AS gaps FROM g""")
def part_contiguity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive parts that lack between 1 and the last."""
    li = table(spark, sf_dir, "lineitem").where("l_returnflag != 'R'")
    return aggregates.contiguous(li, "l_orderkey", "l_linenumber")


@query("""SELECT o_orderkey, o_orderstatus, '' AS note FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, '', o_orderpriority FROM orders WHERE o_orderstatus != 'O'""")
def schema_align_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old and new rows in one table; columns that one side lacks are blank."""
    o = table(spark, sf_dir, "orders")
    old = o.where("o_orderstatus = 'O'").select("o_orderkey", "o_orderstatus")
    new = o.where("o_orderstatus != 'O'").select("o_orderkey", F.col("o_orderpriority").alias("note"))
    return old.unionByName(new, allowMissingColumns=True).na.fill("")


@query("SELECT o_orderkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'kept' ELSE 'new' END AS origin FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def resume_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of finished folders, and new rows of the folders that are not finished."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    finished = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    done = o.join(finished, "o_custkey", "left_semi").withColumn("origin", F.lit("kept"))
    fresh = o.join(finished, "o_custkey", "left_anti").withColumn("origin", F.lit("new"))
    return done.unionByName(fresh).select("o_orderkey", "origin")


@query("""WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Y' ELSE 'N' END AS has_real_geo, CASE WHEN c_custkey % 4 = 0 THEN 'x' ELSE (c_acctbal / 200)::VARCHAR END AS lat FROM customer)
SELECT c_custkey, CASE WHEN has_real_geo = 'N' AND try_cast(lat AS DOUBLE) IS NULL THEN 15.0 ELSE round(try_cast(lat AS DOUBLE), 6) END AS lat, has_real_geo = 'N' AND try_cast(lat AS DOUBLE) IS NULL AS synthetic FROM c""")
def synthetic_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a usable location get one; others stay."""
    k = F.col("c_custkey")
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(k % 3 == 0, "Y").otherwise("N").alias("has_real_geo"), F.when(k % 4 == 0, "x").otherwise((F.col("c_acctbal") / 200).cast("string")).alias("lat"))
    lat = F.col("lat").try_cast("double")
    needs = ~S.truthy(F.col("has_real_geo")) & lat.isNull()
    return c.select("c_custkey", F.when(needs, F.lit(15.0)).otherwise(F.round(lat, 6)).alias("lat"), needs.alias("synthetic"))


@query("""SELECT event_id, to_json({k: try_cast(json_extract_string(props, '$.k') AS INTEGER), tags: [event_type, 'VV'], domain: CASE WHEN event_type = 'click' THEN 'power' ELSE 'native' END}) AS state FROM events""")
def json_state_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State written as JSON and read again, with a map looked up by tag and a default."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", F.from_json("props", "k INT")["k"].alias("k"))
    domain = F.coalesce(F.try_element_at(F.create_map(F.lit("click"), F.lit("power")), F.col("event_type")), F.lit("native"))
    state = F.to_json(F.struct("k", F.array("event_type", F.lit("VV")).alias("tags"), domain.alias("domain")))
    back = F.from_json(state, "k INT, tags ARRAY<STRING>, domain STRING")
    return e.select("event_id", F.to_json(back).alias("state"))


@query("""SELECT count(*) AS files, count_if(a != b)::BIGINT AS different FROM (SELECT doc_id, sha256(text) AS a FROM documents) JOIN (SELECT doc_id, sha256(CASE WHEN doc_id % 100 = 0 THEN text || ' ' ELSE text END) AS b FROM documents) USING (doc_id)""")
def content_hash_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs compared by the hashes of all their files."""
    d = table(spark, sf_dir, "documents")
    a = d.select("doc_id", F.sha2("text", 256).alias("a"))
    b = d.select("doc_id", F.sha2(F.when(F.col("doc_id") % 100 == 0, F.concat("text", F.lit(" "))).otherwise(F.col("text")), 256).alias("b"))
    both = a.join(b, "doc_id", "full_outer")
    return both.agg(F.count("*").alias("files"), F.count_if(~F.col("a").eqNullSafe(F.col("b"))).alias("different"))


@query("""WITH r AS (SELECT o_orderkey, o_orderdate::DATE AS d, (o_orderkey % 40)::INT AS n FROM orders)
SELECT o_orderkey, substr(sha1('10,20,30,40|' || strftime(d, '%Y-%m-%d') || '|' || strftime(d + n, '%Y-%m-%d')), 1, 16) AS cache_key, least(n + 1, 31)::INT AS n_days, strftime(d + least(n, 30), '%Y-%m-%d') AS last_day FROM r""")
def request_cache_key_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cache key of a download request and the days that it asks for, 31 at most."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), (F.col("o_orderkey") % 40).cast("int").alias("n"))
    end = F.date_add("d", F.col("n"))
    key = F.substring(F.sha1(F.concat_ws("|", F.lit("10,20,30,40"), F.date_format("d", S.DAY), F.date_format(end, S.DAY)).cast("binary")), 1, 16)
    days = F.slice(F.sequence("d", end), 1, 31)
    return o.select("o_orderkey", key.alias("cache_key"), F.size(days).alias("n_days"), F.date_format(F.element_at(days, -1), S.DAY).alias("last_day"))


@query("""SELECT doc_id, array_to_string(list_sort(list_distinct(list_filter(string_split(regexp_replace(lower(text), '[^a-z]+', ' ', 'g'), ' '), lambda x: length(x) > 9))), ' ') AS long_words,
  len(list_intersect(string_split(source, 'r'), ['s', 'c1', 'c2'])) AS shared FROM documents""")
def array_set_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct, sorted and intersected arrays."""
    words = F.split(F.regexp_replace(F.lower("text"), "[^a-z]+", " "), " ")
    long = F.array_sort(F.array_distinct(F.filter(words, lambda x: F.length(x) > 9)))
    shared = F.array_intersect(F.split("source", "r"), F.array(F.lit("s"), F.lit("c1"), F.lit("c2")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(long, " ").alias("long_words"), F.size(shared).cast("bigint").alias("shared"))
