"""Column functions on cells: coercion, vocabularies, rounding, hashes, timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Vocabularies of the tables.
TRUE_WORDS = ("true", "1", "y", "yes")
NULL_WORDS = ("", "nan", "none", "null")
DAY = "yyyy-MM-dd"
ISO = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def word(c: Column) -> Column:
    return F.lower(F.trim(c.cast("string")))


def truthy(c: Column) -> Column:
    """Never null."""
    return F.coalesce(word(c).isin(*TRUE_WORDS), F.lit(False))


def nullish(c: Column) -> Column:
    return c.isNull() | word(c).isin(*NULL_WORDS)


def yes_no(c: Column) -> Column:
    return F.when(truthy(c), "Y").otherwise("N")


def norm_bool(c: Column) -> Column:
    """Cells of flag columns: y/yes and n/no become Y and N, true/1 and false/0 become true and false, others stay."""
    w = word(c)
    return (
        F.when(c.isNull() | (w == "nan"), "false").when(w.isin("y", "yes"), "Y").when(w.isin("true", "1"), "true")
        .when(w.isin("n", "no"), "N").when(w.isin("false", "0"), "false").otherwise(c.cast("string"))
    )


def number(c: Column, places: int = 6) -> Column:
    """A double rounded half-even, or null for blank and bad cells (NaN included)."""
    x = F.try_cast(c, "double") if hasattr(F, "try_cast") else c.try_cast("double")
    return F.when(~F.isnan(x), F.bround(x, places))


def whole(c: Column) -> Column:
    """An int, 0 for blank and bad cells."""
    return F.coalesce(c.try_cast("double").cast("int"), F.lit(0))


def group_id(*parts: Column) -> Column:
    return F.substring(F.sha1(F.concat_ws("|", *parts).cast("binary")), 1, 12)


def seed_of(c: Column) -> Column:
    """A seed below 2**32 from the first eight hexadecimal digits of SHA-1."""
    return F.conv(F.substring(F.sha1(c.cast("binary")), 1, 8), 16, 10).cast("bigint")


def rolling_seed(c: Column, seed: int = 0) -> Column:
    """A polynomial hash over code points, base 131, modulo 2**32."""
    return F.aggregate(
        F.transform(F.split(c, ""), lambda x: F.ascii(x).cast("bigint")),
        F.lit(seed).cast("bigint"),
        lambda h, x: (h * 131 + x).bitwiseAND(F.lit(4294967295)),
    )


def timestamp(*cells: Column) -> Column:
    """The first cell that reads as a timestamp, in EXIF or ISO form."""
    return F.coalesce(*(t for c in cells for t in (F.try_to_timestamp(c, F.lit("yyyy:MM:dd HH:mm:ss")), F.try_to_timestamp(c))))


def day(c: Column) -> Column:
    return F.date_format(timestamp(c), DAY)


def unit(key: Column, *salt: object) -> Column:
    """A number in [0, 1) from a key: the engine's keyed randomness."""
    return seed_of(F.concat_ws("|", *(F.lit(str(s)) for s in salt), key.cast("string"))) / F.lit(4294967296.0)
