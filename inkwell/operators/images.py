"""Image metrics, geometry and degradations.

Geometry and quality verdicts are column expressions.  Pixels are arrays: small gray images
stay in the JVM or go through Arrow batches as lists; kernels are plain NumPy.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.session import ship

#: Thresholds of the quality rules, fixed values.
DARK, INK, INK_METRIC, EDGE_STEP = 210, 128, 200, 20
MIN_CONTRAST, MIN_COVERAGE, MAX_ASPECT, MAX_WIDTH = 5, 0.0002, 16, 2304
#: Ranges of the share that edge clipping takes from each side, fixed values.
CLIPPING = {"none": (0.0, 0.0), "light": (0.01, 0.02), "moderate": (0.03, 0.05), "heavy": (0.06, 0.09)}


def measure(gray: np.ndarray) -> dict[str, float]:
    """Descriptive metrics of one gray image (height x width)."""
    g = np.asarray(gray, np.float32)
    height, width = g.shape
    low, high = np.percentile(g, (5, 95))
    steps = [np.abs(np.diff(g, axis=a)) for a in (0, 1)]
    pairs = sum(s.size for s in steps)
    return {
        "width": float(width), "height": float(height), "aspect_ratio": width / height, "mean_luminance": float(g.mean(dtype=np.float64)), "luminance_std": float(g.std(dtype=np.float64)),
        "robust_contrast": float(high - low), "ink_coverage": float((g < INK_METRIC).mean()),
        "edge_density": float(sum((s > EDGE_STEP).sum() for s in steps) / pairs) if pairs else 0.0,
    }


def quality(gray: np.ndarray) -> dict[str, float]:
    """Contrast, coverage and ink near the border (corners count for both their sides)."""
    g = np.asarray(gray, np.uint8)
    height, width = g.shape
    low, high = np.percentile(g, (1, 99))
    ink = g < INK
    border = sum(int(x.sum()) for x in (ink[:2], ink[-2:], ink[:, :2], ink[:, -2:]))
    return {"contrast": float(high - low), "coverage": float((g < DARK).mean()), "border_ink": border, "border_limit": max(3, int(np.ceil(max(1, 4 * (width + height)) * 0.002)))}


def ink_box(pixels: Column, width: int, below: int = 220, pad: int = 2) -> Column:
    """(x0, y0, x1, y1) around the ink of a gray image given as rows of ``width``, padded and clipped to
    the image; all of it where there is no ink."""
    places = F.filter(F.transform(pixels, lambda v, k: F.when(v < below, k)), lambda k: k.isNotNull())
    xs, ys = F.transform(places, lambda k: k % width), F.transform(places, lambda k: F.floor(k / width).cast("int"))
    height = F.floor(F.size(pixels) / width).cast("int")
    none = F.size(places) == 0
    low = lambda v: F.when(none, 0).otherwise(F.greatest(F.lit(0), F.array_min(v) - pad))
    high = lambda v, most: F.when(none, most).otherwise(F.least(most, F.array_max(v) + pad))
    return F.struct(low(xs).alias("x0"), low(ys).alias("y0"), high(xs, F.lit(width)).alias("x1"), high(ys, height).alias("y1"))


#: Bounds of a writer's ink and of a line's horizontal scale, fixed values.
INK_RANGE, SCALE_RANGE = (0, 180), (0.70, 1.30)


def baseline(place: Column, amplitude: Column, period: Column, phase: Column) -> Column:
    """How far the character at a place (from 0) lies below the line."""
    return F.sin(phase + F.lit(2 * np.pi) * place / period) * amplitude


def clamped_ink(ink: Column) -> Column:
    return F.greatest(F.lit(INK_RANGE[0]), F.least(F.lit(INK_RANGE[1]), F.bround(ink).cast("int")))


def horizontal_scale(width: Column, spacing: Column, size: Column) -> Column:
    scale = width + spacing / F.greatest(size, F.lit(1))
    return F.greatest(F.lit(SCALE_RANGE[0]), F.least(F.lit(SCALE_RANGE[1]), scale))


def complaints(contrast: Column, coverage: Column, border: Column, limit: Column, width: Column, height: Column) -> Column:
    """The quality rules' errors and warnings as an array of strings."""
    return F.array_compact(F.array(
        F.when((width <= 1) | (height <= 1), "invalid dimensions"), F.when(contrast < MIN_CONTRAST, "insufficient contrast"),
        F.when(coverage < MIN_COVERAGE, "nearly blank"), F.when(border >= limit, "dark ink reaches the image edge"),
        F.when(width / height > MAX_ASPECT, "extreme aspect ratio"), F.when(width > MAX_WIDTH, "extreme image width"),
    ))


def measured(images: DataFrame, pixels: str, width: int) -> DataFrame:
    """Adds the descriptive metrics of gray images given as flat arrays of rows of ``width``."""
    names = ["width", "height", "aspect_ratio", "mean_luminance", "luminance_std", "robust_contrast", "ink_coverage", "edge_density"]

    ship(images.sparkSession)

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def run(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(np.asarray(v, np.float32).reshape(-1, width)) for v in values], columns=names)

    return images.withColumn("_m", run(pixels)).select("*", "_m.*").drop("_m")


def mapped(images: DataFrame, key: str, pixels: str, width: int, kernel: Callable[[np.ndarray, np.random.Generator], np.ndarray], seed: int = 42) -> DataFrame:
    """(key, pixels) after a kernel; its random generator depends on seed and key only."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [kernel(np.asarray(v, np.float64).reshape(-1, width), np.random.default_rng([seed, int(k)])) for k, v in zip(b[key], b[pixels], strict=True)]
            yield pd.DataFrame({key: b[key], pixels: [x.astype(float).ravel().tolist() for x in out]})

    ship(images.sparkSession)
    return images.select(key, pixels).mapInPandas(run, f"{key} long, {pixels} array<double>")


def blend(a: np.ndarray, b: np.ndarray | float, share: float) -> np.ndarray:
    return np.clip(a * (1 - share) + b * share, 0, 255)


def brightness(g, r, low=0.8, high=1.2):
    return np.clip(g * r.uniform(low, high), 0, 255)


def fade(g, r, low=0.35, high=0.75):
    """Less contrast around the mean."""
    return blend(g, g.mean(), 1 - r.uniform(low, high))


def noise(g, r, low=2.0, high=8.0):
    return np.clip(g + r.normal(0, r.uniform(low, high), g.shape), 0, 255)


def blur(g, r, low=0.4, high=1.2):
    """Separable Gaussian, edges repeated."""
    sigma = r.uniform(low, high)
    reach = max(1, int(np.ceil(3 * sigma)))
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    k /= k.sum()
    for axis in (0, 1):
        pad = [(reach, reach) if a == axis else (0, 0) for a in (0, 1)]
        wide = np.pad(g, pad, mode="edge")
        g = np.apply_along_axis(lambda v: np.convolve(v, k, "valid"), axis, wide)
    return np.clip(g, 0, 255)


def erode_ink(g, r, low=0.15, high=0.45):
    """Blend with the lightest value of each 3 x 3 neighbourhood."""
    wide = np.pad(g, 1, mode="edge")
    light = np.max([wide[y : y + g.shape[0], x : x + g.shape[1]] for y in range(3) for x in range(3)], axis=0)
    return blend(g, light, r.uniform(low, high))


def scan_lines(g, r, low=0.03, high=0.12):
    out, step, share = g.copy(), int(r.integers(5, 15)), r.uniform(low, high)
    out[int(r.integers(0, step)) :: step] *= 1 - share
    return out


def paper_texture(g, r, low=1.0, high=4.0):
    """A coarse random field, stretched over the image."""
    small = r.normal(0, 1, (max(2, g.shape[0] // 4), max(2, g.shape[1] // 4)))
    y, x = (np.minimum((np.arange(n) * s) // n, s - 1) for n, s in zip(g.shape, small.shape, strict=True))
    field = small[np.ix_(y, x)]
    field = (field - field.min()) / max(1e-9, np.ptp(field)) - 0.5
    return np.clip(g + field * 4 * r.uniform(low, high), 0, 255)


def ink_gaps(g, r, most=4):
    """Small light holes at ink pixels."""
    out, ink = g.copy(), np.argwhere(g < INK)
    for y, x in ink[r.integers(0, len(ink), int(r.integers(1, most + 1)))] if len(ink) else ():
        out[max(0, y - 1) : y + 1, max(0, x - 1) : x + 1] = 255
    return out


def stains(g, r):
    y, x = np.indices(g.shape)
    for _ in range(int(r.integers(2, 7))):
        cy, cx, ry, rx = r.uniform(0, g.shape[0]), r.uniform(0, g.shape[1]), r.uniform(1, 1 + g.shape[0] / 3), r.uniform(1, 1 + g.shape[1] / 3)
        inside = ((y - cy) / ry) ** 2 + ((x - cx) / rx) ** 2 <= 1
        g = np.where(inside, blend(g, 120, r.uniform(0.05, 0.2)), g)
    return g


def scratches(g, r):
    out = g.copy()
    for _ in range(int(r.integers(1, 6))):
        y0, y1 = r.uniform(0, g.shape[0], 2)
        x = np.arange(g.shape[1])
        out[np.clip((y0 + (y1 - y0) * x / max(1, g.shape[1] - 1)).astype(int), 0, g.shape[0] - 1), x] = 235
    return out


def rotate(g, r, degrees=4.0):
    """Turn around the centre, bilinear, white outside."""
    t = np.deg2rad(r.uniform(-degrees, degrees))
    h, w = g.shape
    y, x = np.indices(g.shape) - np.array([(h - 1) / 2, (w - 1) / 2])[:, None, None]
    sy, sx = np.cos(t) * y + np.sin(t) * x + (h - 1) / 2, np.cos(t) * x - np.sin(t) * y + (w - 1) / 2
    wide = np.pad(g, 1, constant_values=255)
    y0, x0 = (np.clip(np.floor(v).astype(int) + 1, 0, n) for v, n in ((sy, h), (sx, w)))
    fy, fx = np.clip(sy + 1 - y0, 0, 1), np.clip(sx + 1 - x0, 0, 1)
    top, low = wide[y0, x0] * (1 - fx) + wide[y0, x0 + 1] * fx, wide[y0 + 1, x0] * (1 - fx) + wide[y0 + 1, x0 + 1] * fx
    return top * (1 - fy) + low * fy


def tint(g, r, low=0.05, high=0.2):
    """Blend with a paper tone."""
    return blend(g, float(r.choice([245, 235, 225])), r.uniform(low, high))


def clip_edges(g, shares):
    """Cut shares (top, bottom, left, right) off, ten pixels staying on either axis."""
    h, w = g.shape
    top, bottom, left, right = (round(s * n) for s, n in zip(shares, (h, h, w, w), strict=True))
    x, y = min(left, max(0, w - 10)), min(top, max(0, h - 10))
    return g[y : max(y + 10, h - bottom), x : max(x + 10, w - right)]


def resize(g, height, width):
    """Bilinear, sampled at pixel centres."""
    y, x = (np.clip((np.arange(n) + 0.5) * s / n - 0.5, 0, s - 1) for n, s in zip((height, width), g.shape, strict=True))
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, g.shape[0] - 1), np.minimum(x0 + 1, g.shape[1] - 1)
    fy, fx = (y - y0)[:, None], (x - x0)[None, :]
    return (g[np.ix_(y0, x0)] * (1 - fx) + g[np.ix_(y0, x1)] * fx) * (1 - fy) + (g[np.ix_(y1, x0)] * (1 - fx) + g[np.ix_(y1, x1)] * fx) * fy


def resize_and_pad(g, size=384, fill=255):
    """Contained in a square, centred, without distortion."""
    h, w = g.shape
    scale = min(size / h, size / w)
    inner = resize(g, max(1, round(h * scale)), max(1, round(w * scale)))
    out = np.full((size, size), float(fill))
    y, x = (size - inner.shape[0]) // 2, (size - inner.shape[1]) // 2
    out[y : y + inner.shape[0], x : x + inner.shape[1]] = inner
    return out


def low_resolution(g, r):
    """The test split's hold-out: shrunk, enlarged again and blurred."""
    scale = r.uniform(0.55, 0.70)
    small = resize(g, max(1, round(g.shape[0] * scale)), max(1, round(g.shape[1] * scale)))
    return blur(resize(small, *g.shape), r, 2.0, 2.6)


def accepted(make: Callable[[int], np.ndarray], attempts: int = 20) -> tuple[np.ndarray, int]:
    """The first attempt of ``make`` whose image passes the quality rules; fails after the last."""
    for k in range(1, attempts + 1):
        out = make(k)
        q = quality(out)
        if q["contrast"] >= MIN_CONTRAST and q["coverage"] >= MIN_COVERAGE and q["border_ink"] < q["border_limit"]:
            return out, k
    raise RuntimeError(f"no sound image in {attempts} attempts")


#: The steps of a full degradation in their order, with the percentage of images that take each.
CHAIN = ((fade, 60), (brightness, 60), (tint, 30), (stains, 15), (erode_ink, 30), (ink_gaps, 30), (scratches, 20), (rotate, 40), (blur, 50), (noise, 70), (paper_texture, 30), (scan_lines, 20))


def degrade(g: np.ndarray, r: np.random.Generator) -> np.ndarray:
    for step, percent in CHAIN:
        if r.integers(0, 100) < percent:
            g = step(g, r)
    return g


def padded_geometry(width: Column, height: Column, size: int = 384) -> tuple[Column, Column, Column, Column]:
    """(width, height, left, top) of an image contained in a square and centred on it."""
    scale = F.least(F.lit(float(size)) / width, F.lit(float(size)) / height)
    w = F.when(width >= height, F.lit(size)).otherwise(F.bround(width * scale)).cast("int")
    h = F.when(height >= width, F.lit(size)).otherwise(F.bround(height * scale)).cast("int")
    return w, h, F.floor((size - w) / 2).cast("int"), F.floor((size - h) / 2).cast("int")


def crop_geometry(width: Column, height: Column, shares: tuple[Column, Column, Column, Column]) -> tuple[Column, Column, Column, Column]:
    """(left, top, right, bottom) after taking shares from top, bottom, left and right, ten pixels staying."""
    top, bottom, left, right = (F.bround(side * s).cast("int") for side, s in zip((height, height, width, width), shares, strict=True))
    x = F.least(left, F.greatest(F.lit(0), width - 10))
    y = F.least(top, F.greatest(F.lit(0), height - 10))
    return x, y, F.greatest(x + 10, width - right), F.greatest(y + 10, height - bottom)


def backoff(attempt: Column, label: Column, gaps: Column, erode: Column) -> tuple[Column, Column, Column]:
    """(gaps, erosion in percent, safe) of a retry: short labels are spared, from the ninth attempt
    damage falls by tenths, after the fifteenth it is off."""
    short = F.length(F.regexp_replace(label, r"^\s+|\s+$", ""))
    gaps = F.when(short <= 3, F.least(gaps, F.greatest(F.lit(1), short * 3))).otherwise(gaps)
    erode = F.when(short <= 3, F.least(erode, F.lit(35))).otherwise(erode)
    tenths = F.greatest(F.lit(1), 10 - (attempt - 8))
    late = attempt > 8
    return F.when(late, F.greatest(F.lit(1), F.floor(gaps * tenths / 10))).otherwise(gaps).cast("int"), F.when(late, F.floor(erode * tenths / 10)).otherwise(erode).cast("int"), attempt > 15
