"""Tunables of the engine, in one frozen record; builders turn them into literals."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values of the data format.
RASTER_EXTENSIONS = ("tif", "tiff", "img", "jp2", "png", "jpg", "jpeg")
MASK_TOKENS = ("mask", "label", "labels", "gt", "lbl", "ann")
LABELS = ("oil", "lookalike", "background")
SPLITS = ("train", "val", "test")
FORMULA_POWER = "v1_linear_neg30_to_0"
FORMULA_NATIVE = "native_8bit_no_db"


@dataclass(frozen=True)
class Config:
    tile: int = 256
    jitter: int = 25
    stride: int = 128
    max_tiles: int = 48
    neg_buffer: int = 300
    neg_ratio: float = 0.4
    neg_per_empty: int = 4
    neg_cap: int = 64
    db_low: float = -30.0
    db_high: float = 0.0
    eps: float = 1e-7
    min_area: int = 20
    ring: int = 20
    lookalike_value: int = 2
    offset_scale_km: float = 50.0
    offset_retries: int = 50
    pixel_m: float = 10.0
    ratios: tuple[float, float, float] = (0.70, 0.15, 0.15)
    seed: int = 42
    label_overrides: dict[str, str] = field(default_factory=dict)
    calibrated_match: tuple[str, ...] = ()
    uncalibrated_match: tuple[str, ...] = ()


DEFAULT = Config()
