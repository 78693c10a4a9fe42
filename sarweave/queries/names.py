"""Names, paths, cells: queries over pages, documents, orders and part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sarweave.config import Config
from sarweave.functions import names as N
from sarweave.functions import scalars as S
from sarweave.queries import query, table

#: A tree of files made from keys: folders with image and mask trees, pol-split and masked stems.
FOLDERS = ("01_oil_images/pass1", "01_oil_mask/pass1", "Images", "look-alike/masks", "scene.set/GT", "plain", "02_Look_Alike_imgs", "")
STEMS = ("S1A_{k}_VV", "S1A_{k}_vh", "mask_S1A_{k}", "S1A_{k}_Mask", "S1A_{k}.gt", "VV", "scene{k}-VH", "x{k}_labels")
SUFFIXES = ("tif", "PNG", "txt", "jp2")


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """p_partkey and a relative path, all combinations of the lists above in turn."""
    part = table(spark, sf_dir, "part").select("p_partkey")
    pick = lambda xs, by: F.element_at(F.array(*map(F.lit, xs)), (F.pmod(by, F.lit(len(xs))) + 1).cast("int"))
    k = F.col("p_partkey")
    name = F.replace(pick(STEMS, F.floor(k / 8)), F.lit("{k}"), F.floor(k / 64).cast("string"))
    folder = pick(FOLDERS, k)
    file = F.concat(name, F.lit("."), pick(SUFFIXES, F.floor(k / 3)))
    return part.select("p_partkey", F.when(folder == "", file).otherwise(F.concat(folder, F.lit("/"), file)).alias("path"))


def _list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


PATHS_SQL = f"""paths AS (SELECT p_partkey, CASE WHEN folder = '' THEN file ELSE folder || '/' || file END AS path FROM (
  SELECT p_partkey, {_list(FOLDERS)}[p_partkey % 8 + 1] AS folder,
    replace({_list(STEMS)}[(p_partkey // 8) % 8 + 1], '{{k}}', (p_partkey // 64)::VARCHAR) || '.' || {_list(SUFFIXES)}[(p_partkey // 3) % 4 + 1] AS file
  FROM part)),
named AS (SELECT p_partkey, path, regexp_extract(path, '([^/]*)$', 1) AS leaf, regexp_replace(path, '/?[^/]*$', '') AS folder FROM paths),
s AS (SELECT *, regexp_extract(leaf, '^(.+?)(\\.[^.]*)?$', 1) AS stem FROM named)"""
MASK_TOKENS_SQL = "['mask', 'label', 'labels', 'gt', 'lbl', 'ann']"
_NOPOL = "CASE WHEN regexp_matches(stem, '(?i)^(vv|vh)$') OR NOT regexp_matches(stem, '(?i)[_\\-.](vv|vh)$') THEN stem ELSE regexp_replace(regexp_replace(stem, '(?i)[_\\-.](vv|vh)$', ''), '[_\\-. ]+$', '') END"
_KEY = f"lower(regexp_replace(regexp_replace({_NOPOL}, '(?i)_(masks?|labels?|gt|lbl|ann)$', ''), '(?i)^(masks?|labels?|gt|lbl|ann)_', ''))"
_MASKDIR = "list_has_any(regexp_split_to_array(lower({0}), '[_\\-\\s.]+'), " + MASK_TOKENS_SQL + ") OR regexp_matches({0}, '(?i)((_masks?|_labels?|_gt)$)|(^(masks?|labels?)_)|(^(masks?|gt|labels)$)')"
_PARALLEL = """list_transform(string_split(folder, '/'), lambda x: CASE
    WHEN regexp_matches(x, '(?i)_(images_and_ground_truth|images?|imgs?)$') THEN regexp_replace(x, '(?i)_(images_and_ground_truth|images?|imgs?)$', '_mask')
    WHEN lower(x) IN ('images', 'image', 'imgs', 'img') THEN CASE WHEN lower(x) != x AND regexp_matches(x, '^[A-Z]') THEN 'Mask' ELSE 'mask' END
    ELSE x END)"""


@query(f"""WITH {PATHS_SQL}
SELECT p_partkey, folder, stem, lower(regexp_extract(leaf, '^.+\\.([^.]+)$', 1)) AS suffix,
  lower(regexp_extract(leaf, '^.+\\.([^.]+)$', 1)) IN ('tif', 'tiff', 'img', 'jp2', 'png', 'jpg', 'jpeg') AND NOT starts_with(leaf, '.') AS is_raster
FROM s""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder, stem, suffix and whether a path is a raster's."""
    p = F.col("path")
    return paths(spark, sf_dir).select("p_partkey", N.parent(p).alias("folder"), N.stem(p).alias("stem"), N.suffix(p).alias("suffix"), N.is_raster(p).alias("is_raster"))


@query(f"""WITH {PATHS_SQL}
SELECT p_partkey, list_has_any(regexp_split_to_array(lower(stem), '[_\\-.]+'), {MASK_TOKENS_SQL}) AS mask_name,
  list_has_any(regexp_split_to_array(lower(replace(stem, '-', '_')), '_'), {MASK_TOKENS_SQL}) AS audit_mask,
  {_MASKDIR.format("folder")} AS mask_dir,
  list_has_any(regexp_split_to_array(lower(folder), '[_\\-\\s.]+'), ['images', 'image', 'imgs', 'img', 'scenes', 'scene', 'sar']) AS image_dir,
  list_has_any(regexp_split_to_array(lower(stem), '[_\\-.]+'), {MASK_TOKENS_SQL}) OR len(list_filter(string_split(folder, '/'), lambda x: {_MASKDIR.format("x")})) > 0 AS mask_path
FROM s""")
def mask_dir_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mask and image predicates on names, folders and whole paths."""
    p = F.col("path")
    return paths(spark, sf_dir).select(
        "p_partkey", N.is_mask_name(N.stem(p)).alias("mask_name"), N.looks_like_mask(N.stem(p)).alias("audit_mask"),
        N.is_mask_dir(N.parent(p)).alias("mask_dir"), N.is_image_dir(N.parent(p)).alias("image_dir"), N.is_mask_path(p).alias("mask_path"),
    )


@query(f"""WITH {PATHS_SQL}
SELECT p_partkey, nullif(upper(regexp_extract(stem, '(?i)(?:^|[_\\-.])(vv|vh)$', 1)), '') AS pol, {_NOPOL} AS base,
  regexp_replace(regexp_replace(stem, '(?i)_(masks?|labels?|gt|lbl|ann)$', ''), '(?i)^(masks?|labels?|gt|lbl|ann)_', '') AS no_mask, {_KEY} AS stem_key
FROM s""")
def string_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stems without polarisation and mask tokens, and the key by which images and masks pair."""
    s = N.stem(F.col("path"))
    return paths(spark, sf_dir).select("p_partkey", N.polarisation(s).alias("pol"), N.without_polarisation(s).alias("base"), N.without_mask_tokens(s).alias("no_mask"), N.pairing_key(s).alias("stem_key"))


_UNDER = "CASE WHEN up = '' THEN {0} ELSE up || '/' || {0} END"
_IMGDIR = "list_has_any(regexp_split_to_array(lower(own), '[_\\-\\s.]+'), ['images', 'image', 'imgs', 'img', 'scenes', 'scene', 'sar'])"
_SEARCH = ", ".join(
    [x for m in N.MASK_FOLDERS for x in (_UNDER.format(f"'{m}'"), f"CASE WHEN {_IMGDIR} THEN " + _UNDER.format(f"(base || '_{m}')") + " END", f"CASE WHEN {_IMGDIR} THEN " + _UNDER.format(f"('{m}_' || base)") + " END")]
)


@query(f"""WITH {PATHS_SQL},
f AS (SELECT DISTINCT folder, regexp_replace(folder, '/?[^/]*$', '') AS up, regexp_extract(folder, '([^/]*)$', 1) AS own FROM s),
g AS (SELECT *, regexp_replace(own, '(?i)(_images|_image|_imgs|_img|images|image|imgs|img)$', '') AS base, array_to_string({_PARALLEL}, '/') AS par FROM f),
h AS (SELECT folder, CASE WHEN par != folder THEN par END AS parallel, list_filter([folder, CASE WHEN par != folder THEN par END, {_SEARCH}], lambda x: x IS NOT NULL) AS every FROM g)
SELECT folder, parallel, array_to_string(list_filter(every, lambda x, i: list_position(every, x) = i), '>') AS searched FROM h""")
def mask_search_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parallel mask folder of each folder, and all folders searched, in order."""
    f = F.col("folder")
    return paths(spark, sf_dir).select(N.parent(F.col("path")).alias("folder")).distinct().select(
        "folder", N.parallel_mask_folder(f).alias("parallel"), F.array_join(N.mask_search_folders(f), ">").alias("searched")
    )


@query("""SELECT doc_id, CASE WHEN contains(lower(source), 'src1') THEN 'oil' WHEN regexp_matches(lower(source || '/' || CASE WHEN doc_id % 3 = 0 THEN 'Look_Alike' WHEN doc_id % 3 = 1 THEN 'oil_spill' ELSE 'x' END), 'look[-_]?alike') THEN 'lookalike' ELSE 'oil' END AS label,
  CASE WHEN contains(lower(source), 'src2') THEN false WHEN contains(lower(source), 'src3') THEN true ELSE lang = 'en' END AS calibrated FROM documents""")
def label_calibration_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Default label and calibration of paths, by overrides, patterns and data type."""
    c = Config(label_overrides={"SRC1": "oil"}, uncalibrated_match=("src2",), calibrated_match=("src3",))
    d = table(spark, sf_dir, "documents")
    kind = F.when(F.col("doc_id") % 3 == 0, "Look_Alike").when(F.col("doc_id") % 3 == 1, "oil_spill").otherwise("x")
    path = F.concat("source", F.lit("/"), kind)
    dtype = F.when(F.col("lang") == "en", "float32").otherwise("uint8")
    return d.select("doc_id", N.default_label(path, c).alias("label"), N.is_calibrated(F.col("source"), dtype, c).alias("calibrated"))


@query("""SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_name, p_size) > 1
  THEN regexp_replace(regexp_replace(p_type || '/ ' || p_brand, '[^A-Za-z0-9]+', '-', 'g'), '^-|-$', '', 'g') || '__' || p_name || p_size ELSE p_name || p_size END AS scene_id FROM part""")
def unique_scene_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene ids: the base, with its folder before it where the base occurs twice or more."""
    part = table(spark, sf_dir, "part")
    times = part.groupBy("p_name", "p_size").agg(F.count("*").alias("times"))
    folder = F.concat("p_type", F.lit("/ "), "p_brand")
    base = F.concat("p_name", F.col("p_size").cast("string"))
    return part.join(times, ["p_name", "p_size"]).select("p_partkey", N.scene_id(base, folder, F.col("times")).alias("scene_id"))


@query("""WITH c AS (SELECT o_orderkey, [NULL, ' yes', 'Y', 'TRUE', '1', 'no', 'N', 'False', '0', 'nan', 'maybe', '', 'None'][o_orderkey % 13 + 1] AS cell FROM orders),
w AS (SELECT *, lower(trim(cell)) AS w FROM c)
SELECT o_orderkey, coalesce(w IN ('true', '1', 'y', 'yes'), false) AS truthy, cell IS NULL OR w IN ('', 'nan', 'none', 'null') AS nullish,
  CASE WHEN w IN ('true', '1', 'y', 'yes') THEN 'Y' ELSE 'N' END AS yes_no,
  CASE WHEN cell IS NULL OR w = 'nan' THEN 'false' WHEN w IN ('y', 'yes') THEN 'Y' WHEN w IN ('true', '1') THEN 'true' WHEN w IN ('n', 'no') THEN 'N' WHEN w IN ('false', '0') THEN 'false' ELSE cell END AS flag
FROM w""")
def bool_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flag cells in both vocabularies, null words among them."""
    cells = F.array(*map(F.lit, (None, " yes", "Y", "TRUE", "1", "no", "N", "False", "0", "nan", "maybe", "", "None")))
    cell = F.element_at(cells, (F.col("o_orderkey") % 13 + 1).cast("int"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", cell.alias("cell"))
    c = F.col("cell")
    return o.select("o_orderkey", S.truthy(c).alias("truthy"), S.nullish(c).alias("nullish"), S.yes_no(c).alias("yes_no"), S.norm_bool(c).alias("flag"))


@query("""WITH c AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'x' || value WHEN event_id % 7 = 0 THEN '' ELSE value::VARCHAR END AS cell, props FROM events)
SELECT event_id, round_even(try_cast(cell AS DOUBLE), 6) AS num, coalesce(try_cast(trunc(try_cast(cell AS DOUBLE)) AS INTEGER), 0) AS whole, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k FROM c""")
def numeric_coerce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers from text cells: null or 0 where they don't parse."""
    e = table(spark, sf_dir, "events")
    cell = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("x"), F.col("value").cast("string"))).when(F.col("event_id") % 7 == 0, "").otherwise(F.col("value").cast("string"))
    k = F.from_json("props", "k INT")["k"]
    return e.select("event_id", S.number(cell).alias("num"), S.whole(cell).alias("whole"), k.alias("k"))


@query("""WITH c AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y:%m:%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') WHEN 2 THEN 'bad' END AS a, strftime(ts, '%Y-%m-%d %H:%M:%S') AS b FROM events),
t AS (SELECT event_id, coalesce(try_strptime(a, '%Y:%m:%d %H:%M:%S'), try_strptime(a, '%Y-%m-%dT%H:%M:%SZ'), try_strptime(b, '%Y-%m-%d %H:%M:%S')) AS t FROM c)
SELECT event_id, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(t, '%Y-%m-%d') AS day, year(t) BETWEEN 2016 AND 2025 AS in_window FROM t""")
def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps from tags in several forms, by priority; day bucket and year window."""
    e = table(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    ts = F.col("ts").cast("timestamp")
    a = F.when(kind == 0, F.date_format(ts, "yyyy:MM:dd HH:mm:ss")).when(kind == 1, F.date_format(ts, S.ISO)).when(kind == 2, "bad")
    t = S.timestamp(a, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
    e = e.select("event_id", t.alias("t"))
    return e.select("event_id", F.date_format("t", S.ISO).alias("iso"), F.date_format("t", S.DAY).alias("day"), F.year("t").between(2016, 2025).alias("in_window"))


@query("""SELECT p_partkey, substr(sha1(p_brand || '|' || p_type), 1, 12) AS group_id, ('0x' || substr(sha1(p_name), 1, 8))::BIGINT AS sha_seed,
  list_reduce(list_prepend(7::BIGINT, list_transform(string_split(p_name, ''), lambda c: unicode(c)::BIGINT)), lambda h, x: (h * 131 + x) & 4294967295) AS poly_seed FROM part""")
def hash_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group ids and seeds from hashes."""
    return table(spark, sf_dir, "part").select(
        "p_partkey", S.group_id(F.col("p_brand"), F.col("p_type")).alias("group_id"), S.seed_of(F.col("p_name")).alias("sha_seed"), S.rolling_seed(F.col("p_name"), 7).alias("poly_seed")
    )
