"""Profiles and policies: writer styles, augmentation profiles, held-out fonts, field weights."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.functions.rand import SPAN, draw
from inkwell.functions.text import base_name, fold

Range = tuple[float, float]


def checked(name: str, value: Range, low: float, high: float) -> Range:
    """An ordered range of finite numbers within bounds."""
    a, b = value
    if not (math.isfinite(a) and math.isfinite(b) and low <= a <= b <= high):
        raise ValueError(f"{name}: {value} is not an ordered range within {low} and {high}")
    return float(a), float(b)


@dataclass(frozen=True)
class WriterProfile:
    """Ranges from which a writer's traits are drawn: the default profile's, fixed values.  A range of two
    whole numbers gives whole numbers."""

    baseline_amplitude: Range = (0.0, 2.2)
    baseline_period: Range = (3.5, 9.0)
    spacing: Range = (-0.6, 1.8)
    connection_overlap: Range = (0.0, 1.6)
    slant: Range = (-0.12, 0.22)
    stroke_width: Range = (0, 2)
    pressure_bias: Range = (-14, 20)
    pressure_variation: Range = (1, 15)
    ink_texture_density: Range = (0.001, 0.012)
    glyph_width_scale: Range = (0.88, 1.12)
    font_size_scale: Range = (0.90, 1.10)
    font_preference: Range = (0.0, 1.0)
    baseline_phase: Range = (0.0, 2 * math.pi)


@dataclass(frozen=True)
class AugmentationProfile:
    """Chances in percent and ranges of the degradations."""

    rotate: Range = (-2.0, 2.0)
    blur: Range = (0.0, 0.8)
    noise: Range = (0.0, 6.0)
    brightness: Range = (0.9, 1.1)
    fade: Range = (0.7, 1.0)
    stains: int = 10
    scratches: int = 10
    gaps: int = 10
    erosion: int = 20


#: Profiles of our own, by name; a caller may add others.
PROFILES = {
    "clean": AugmentationProfile((0.0, 0.0), (0.0, 0.0), (0.0, 0.0), (1.0, 1.0), (1.0, 1.0), 0, 0, 0, 0),
    "light": AugmentationProfile(), "moderate": AugmentationProfile((-4.0, 4.0), (0.2, 1.4), (2.0, 12.0), (0.8, 1.2), (0.5, 1.0), 20, 20, 25, 35),
    "heavy": AugmentationProfile((-6.0, 6.0), (0.4, 2.2), (4.0, 20.0), (0.7, 1.3), (0.35, 0.9), 40, 35, 50, 50),
}


def profile(name: str, known: dict | None = None):
    known = PROFILES if known is None else known
    if name not in known:
        raise ValueError(f"unknown profile {name!r}; known: {', '.join(sorted(known))}")
    return known[name]


def scaled(base: AugmentationProfile, factor: float) -> AugmentationProfile:
    """A profile with damage scaled and clamped to sound values."""
    cap = lambda v: int(max(0, min(100, round(v * factor))))
    wide = lambda r, limit: tuple(max(-limit, min(limit, v * factor)) for v in r)
    return replace(base, rotate=wide(base.rotate, 15.0), blur=wide(base.blur, 5.0), noise=wide(base.noise, 40.0), stains=cap(base.stains), scratches=cap(base.scratches), gaps=cap(base.gaps), erosion=cap(base.erosion))


def writer_styles(writers: DataFrame, key: str, traits: WriterProfile | None = None) -> DataFrame:
    """(key, traits): each trait uniform in its range, by a draw of its own."""
    out = []
    for t, (a, b) in asdict(traits or WriterProfile()).items():
        u = draw(f"style.{t}", F.col(key))
        whole = isinstance(a, int) and isinstance(b, int)
        value = F.lit(a) + F.floor(u * (b - a + 1) / F.lit(SPAN)).cast("int") if whole else F.lit(a) + u / F.lit(float(SPAN)) * (b - a)
        out.append(value.alias(t))
    return writers.select(key, *out)


def field_weights(mode: str, weights: dict[str, int], custom: dict[str, int] | None = None) -> dict[str, int]:
    """Weights of a mode: snippets take digits and characters only, regular samples all but those;
    explicit weights decide over the mode."""
    if custom:
        if any(w < 0 for w in custom.values()) or not any(custom.values()):
            raise ValueError("weights must not be negative and not all zero")
        return {k: w for k, w in custom.items() if w}
    small = ("character", "numeric")
    keep = {k: w for k, w in weights.items() if (k in small) == (mode == "snippet") and w}
    if not keep:
        raise ValueError(f"no field is left in mode {mode!r}")
    return keep


def font_pool(fonts: DataFrame, style: str, group: str | None = None) -> DataFrame:
    """Fonts (path, style, grp) of a style and group, one of each folded name; all of the style if a
    group has none."""
    of_style = fonts if style == "any" else fonts.where(F.col("style") == style)
    first = of_style.groupBy(fold(base_name(F.col("path"))).alias("name")).agg(F.min(F.struct("path", "style", "grp")).alias("f")).select("f.*")
    if group is None:
        return first
    own = first.where(F.col("grp") == group)
    return own if own.limit(1).count() else first


def allowed_format(field: Column, profile_: Column, format_id: Column, patterns: DataFrame) -> Column:
    """Whether a format id is one of the policy's patterns; other fields may have ``default``,
    ``name_mixed_representative_v1`` or none."""
    rows = [(r["field_type"], r["format_profile"], r["format_id"]) for r in patterns.collect()]
    hit = F.lit(False)
    for f, p, i in rows:
        hit = hit | ((field == f) & (profile_ == p) & (format_id == i))
    dated = field.isin(*sorted({f for f, *_ in rows}))
    return F.when(dated, hit).otherwise(format_id.isin("", "default", "name_mixed_representative_v1"))


def schedule(samples: int, batch: int, accumulate: int, epochs: int, warmup: float) -> dict[str, int]:
    """Steps of a training run: loader batches, optimiser steps, warm-up steps."""
    batches = -(-samples // batch)
    steps = max(1, -(-batches // accumulate)) * epochs
    return {"batches": batches, "steps": steps, "warmup": int(steps * warmup)}


def evaluation_batch(free_bytes: Column) -> Column:
    """A batch size by free memory."""
    gb = free_bytes / float(1 << 30)
    return F.when(gb >= 12, 16).when(gb >= 8, 8).when(gb >= 4, 4).otherwise(1)
