"""Column functions on pixel values: decibels, 16-bit calibration, value domains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sarweave.config import DEFAULT, Config


def to_db(v: Column, amplitude: bool = False, c: Config = DEFAULT) -> Column:
    return (20 if amplitude else 10) * F.log10(F.greatest(v, F.lit(c.eps)))


def linear(db: Column, amplitude: bool = False) -> Column:
    return F.pow(F.lit(10.0), db / (20 if amplitude else 10))


def to_uint16(db: Column, c: Config = DEFAULT) -> Column:
    """Decibels of the configured range as 0..65535, rounded half-even."""
    cut = F.greatest(F.lit(c.db_low), F.least(db, F.lit(c.db_high)))
    return F.bround((cut - c.db_low) / (c.db_high - c.db_low) * 65535, 0).cast("int")


def from_uint16(p: Column, c: Config = DEFAULT) -> Column:
    return p / 65535 * (c.db_high - c.db_low) + c.db_low


def value_domain(low: Column, p99: Column, integer: Column, hint: str | None = None) -> Column:
    """power, amplitude, db or native, from the least value and the 99th percentile of a sample."""
    if hint:
        return F.lit(hint)
    return F.when(integer | low.isNull(), "native").when(low < -0.5, "db").when(p99 <= 1.5, "power").otherwise("amplitude")


def coarse_domain(low: Column, high: Column, p99_abs: Column) -> Column:
    """The auditor's own rule."""
    return F.when((low < -1) & (high <= 1), "db").when(p99_abs <= 1.5, "power").otherwise("amplitude")


def calibrated(v: Column, domain: Column, c: Config = DEFAULT) -> Column:
    """16-bit pixels by domain; native values pass."""
    db = F.when(domain == "db", v).when(domain == "power", to_db(v, False, c)).otherwise(to_db(v, True, c))
    return F.when(domain == "native", v.cast("int")).otherwise(to_uint16(db, c))


def scaled_8bit(v: Column, low: Column, high: Column) -> Column:
    """0..255 over a value range, cut off rather than rounded; 0 where the range is empty."""
    part = (v - low) / F.nullif(high - low, F.lit(0.0)) * 255
    return F.coalesce(F.least(F.lit(255.0), F.greatest(F.lit(0.0), part)).cast("int"), F.lit(0))
