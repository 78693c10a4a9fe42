"""Column functions on file stems and relative paths: masks, polarisations, pairing keys, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sarweave.config import DEFAULT, MASK_TOKENS, RASTER_EXTENSIONS, Config

# Fixed values of the naming scheme.
IMAGE_TOKENS = ("images", "image", "imgs", "img", "scenes", "scene", "sar")
IMAGE_SUFFIX = r"(?i)_(?:images_and_ground_truth|images?|imgs?)$"
MASK_SUFFIX = r"(?i)_(?:masks?|labels?|gt|lbl|ann)$"
MASK_PREFIX = r"(?i)^(?:masks?|labels?|gt|lbl|ann)_"
MASK_DIR = r"(?i)(?:_masks?|_labels?|_gt)$|^(?:masks?|labels?)_|^(?:masks?|gt|labels)$"
POL = r"(?i)(?:^|[_\-.])(vv|vh)$"
MASK_FOLDERS = ("masks", "mask", "labels", "label", "gt", "annotations")
LOOKALIKE = "look[-_]?alike"


def leaf(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def parent(path: Column) -> Column:
    """Path of the folder; empty at the root."""
    return F.regexp_replace(path, r"/?[^/]*$", "")


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(leaf(path), r"^.+\.([^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(leaf(path), r"(?<=.)\.[^.]+$", "")


def is_raster(path: Column) -> Column:
    return suffix(path).isin(*RASTER_EXTENSIONS) & ~leaf(path).startswith(".")


def _any_token(name: Column, separators: str, tokens: tuple[str, ...]) -> Column:
    return F.arrays_overlap(F.split(F.lower(name), separators), F.array(*map(F.lit, tokens)))


def is_mask_name(name: Column) -> Column:
    return _any_token(name, r"[_\-.]+", MASK_TOKENS)


def is_mask_dir(name: Column) -> Column:
    return _any_token(name, r"[_\-\s.]+", MASK_TOKENS) | name.rlike(MASK_DIR)


def is_image_dir(name: Column) -> Column:
    return _any_token(name, r"[_\-\s.]+", IMAGE_TOKENS)


def is_mask_path(path: Column, name: Column | None = None) -> Column:
    """By its own name, or by any folder above it."""
    name = stem(path) if name is None else name
    return is_mask_name(name) | F.exists(F.split(parent(path), "/"), is_mask_dir)


def looks_like_mask(name: Column) -> Column:
    """The auditor's test: dashes separate as underscores do, dots don't."""
    return _any_token(F.replace(name, F.lit("-"), F.lit("_")), "_", MASK_TOKENS)


def without_mask_tokens(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(name, MASK_SUFFIX, ""), MASK_PREFIX, "")


def polarisation(name: Column) -> Column:
    """VV, VH, or null."""
    return F.nullif(F.upper(F.regexp_extract(name, POL, 1)), F.lit(""))


def without_polarisation(name: Column) -> Column:
    """The base of a pol-split stem; a bare VV or VH is its own base, other stems stay as they are."""
    bare = name.rlike(r"(?i)^(?:vv|vh)$")
    cut = F.regexp_replace(F.regexp_replace(name, r"(?i)[_\-.](?:vv|vh)$", ""), r"[_\-. ]+$", "")
    return F.when(bare | polarisation(name).isNull(), name).otherwise(cut)


def pairing_key(name: Column) -> Column:
    return F.lower(without_mask_tokens(without_polarisation(name)))


def parallel_mask_folder(folder: Column) -> Column:
    """The folder of the mask tree that mirrors an image folder; null where no component is an image folder's."""

    def swapped(part: Column) -> Column:
        bare = F.lower(part).isin("images", "image", "imgs", "img")
        cased = F.when((F.lower(part) != part) & part.rlike("^[A-Z]"), "Mask").otherwise("mask")
        return F.when(part.rlike(IMAGE_SUFFIX), F.regexp_replace(part, IMAGE_SUFFIX, "_mask")).when(bare, cased).otherwise(part)

    out = F.array_join(F.transform(F.split(folder, "/"), swapped), "/")
    return F.when(out != folder, out)


def mask_search_folders(folder: Column) -> Column:
    """Folders that may hold the masks of an image folder, in order, each once."""
    up = parent(folder)
    under = lambda name: F.when(up == "", name).otherwise(F.concat(up, F.lit("/"), name))
    own = leaf(folder)
    base = F.regexp_replace(own, r"(?i)(_images|_image|_imgs|_img|images|image|imgs|img)$", "")
    more = []
    for name in map(F.lit, MASK_FOLDERS):
        more.append(under(name))
        more += [F.when(is_image_dir(own), under(x)) for x in (F.concat(base, F.lit("_"), name), F.concat(name, F.lit("_"), base))]
    return F.array_distinct(F.array_compact(F.array(folder, parallel_mask_folder(folder), *more)))


def folder_slug(folder: Column) -> Column:
    cut = F.regexp_replace(F.regexp_replace(folder, "[^A-Za-z0-9]+", "-"), "^-|-$", "")
    return F.when(cut == "", "root").otherwise(cut)


def scene_id(base: Column, folder: Column, times: Column) -> Column:
    """base where it is unique, else with its folder before it."""
    return F.when(times > 1, F.concat(folder_slug(folder), F.lit("__"), base)).otherwise(base)


def default_label(path: Column, c: Config = DEFAULT) -> Column:
    low = F.lower(path)
    out = F.when(F.lit(False), F.lit(""))
    for key, label in c.label_overrides.items():
        out = out.when(F.contains(low, F.lit(key.lower())), label)
    return out.when(low.rlike(LOOKALIKE), "lookalike").otherwise("oil")


def is_calibrated(path: Column, dtype: Column, c: Config = DEFAULT) -> Column:
    """By patterns first, uncalibrated ones before the others; else float rasters are calibrated."""
    low = F.lower(path)
    out = F.when(F.lit(False), F.lit(False))
    for patterns, said in ((c.uncalibrated_match, False), (c.calibrated_match, True)):
        for p in patterns:
            out = out.when(F.contains(low, F.lit(p.lower())), said)
    return out.otherwise(dtype.startswith("float"))


def crop_id(scene: Column, seq: Column) -> Column:
    return F.format_string("%s_crop%03d", scene, seq)


def feature_id(scene: Column, index: Column) -> Column:
    return F.format_string("%s_inst%03d", scene, index)
