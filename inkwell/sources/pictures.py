"""Pictures in PNG files: decoding with verification, encoding, folder scans, tiles of a review sheet.

Eight bits a sample, gray, gray with alpha, RGB, RGBA or palette, not interlaced; any other kind is
reported as unreadable, never guessed.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions.text import base_name, fold
from inkwell.operators.images import measure, quality
from inkwell.operators.stats import moments
from inkwell.session import ship

SIGNATURE = b"\x89PNG\r\n\x1a\n"
#: Samples of a pixel by colour type, fixed values.
SAMPLES = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}
#: Weights of red, green and blue in a gray level, fixed values.
LUMA = (0.299, 0.587, 0.114)


def chunks(content: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(kind, data) of every chunk; a wrong signature, length or checksum fails."""
    if not content.startswith(SIGNATURE):
        raise ValueError("not a PNG file")
    at = len(SIGNATURE)
    while at < len(content):
        if at + 12 > len(content):
            raise ValueError("the file ends inside a chunk")
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        data = content[at + 8 : at + 8 + size]
        end = content[at + 8 + size : at + 12 + size]
        if len(data) < size or len(end) < 4 or zlib.crc32(kind + data) != struct.unpack(">I", end)[0]:
            raise ValueError(f"chunk {kind.decode('latin-1')} is damaged")
        yield kind, data
        if kind == b"IEND":
            return
        at += 12 + size
    raise ValueError("the file has no end")


def decode(content: bytes) -> tuple[np.ndarray, str]:
    """(pixels, mode): height x width x samples; a palette is resolved to RGB."""
    head, palette, body = None, None, []
    for kind, data in chunks(content):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", data)
        elif kind == b"PLTE":
            palette = np.frombuffer(data, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(data)
    if head is None:
        raise ValueError("no header")
    width, height, depth, colour, _, _, interlaced = head
    if depth != 8 or colour not in SAMPLES or interlaced or not width or not height:
        raise ValueError("this kind of picture is not read")
    each = SAMPLES[colour]
    raw = zlib.decompress(b"".join(body))
    if len(raw) != height * (1 + width * each):
        raise ValueError("the pixels are incomplete")
    rows = np.frombuffer(raw, np.uint8).reshape(height, 1 + width * each)
    out = np.zeros((height, width * each), np.uint8)
    above = np.zeros(width * each, np.uint8)
    for y in range(height):
        out[y] = _unfiltered(int(rows[y, 0]), rows[y, 1:], above, each)
        above = out[y]
    pixels = out.reshape(height, width, each)
    if colour == 3:
        if palette is None or pixels.max() >= len(palette):
            raise ValueError("the palette is too short")
        pixels = palette[pixels[..., 0]]
    return pixels, MODES[colour]


def _unfiltered(kind: int, line: np.ndarray, above: np.ndarray, each: int) -> np.ndarray:
    """A row of samples from its differences to the sample on the left, above, or both."""
    if kind == 0:
        return line
    if kind == 1:
        return np.cumsum(line.reshape(-1, each), axis=0, dtype=np.uint8).ravel()
    if kind == 2:
        return line + above
    out = np.zeros(len(line) + each, np.uint8)
    up = np.concatenate([np.zeros(each, np.uint8), above]).astype(int).tolist()
    done = out.tolist()
    for k, v in enumerate(line.tolist(), each):
        a, b, c = done[k - each], up[k], up[k - each]
        if kind == 3:
            guess = (a + b) // 2
        elif kind == 4:
            to_a, to_b, to_c = abs(b - c), abs(a - c), abs(a + b - 2 * c)
            guess = a if to_a <= min(to_b, to_c) else b if to_b <= to_c else c
        else:
            raise ValueError("unknown row filter")
        done[k] = (v + guess) & 255
    return np.array(done[each:], np.uint8)


def encode(pixels: np.ndarray) -> bytes:
    """A PNG file of gray (height x width) or RGB (height x width x 3) pixels."""
    pixels = np.ascontiguousarray(pixels, np.uint8)
    height, width = pixels.shape[:2]
    colour = 2 if pixels.ndim == 3 else 0

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)
    head = struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def gray(pixels: np.ndarray, mode: str) -> np.ndarray:
    if mode in ("L", "LA"):
        return pixels[..., 0]
    return np.rint(pixels[..., :3] @ np.array(LUMA)).astype(np.uint8)


def verified(files: DataFrame) -> DataFrame:
    """(path, mode, width, height, contrast, coverage, border_ink, border_limit, problem) of binary files (path, content)."""
    names = ["path", "mode", "width", "height", "contrast", "coverage", "border_ink", "border_limit", "problem"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    pixels, mode = decode(bytes(content))
                except (ValueError, zlib.error, struct.error) as e:
                    rows.append((path, None, None, None, None, None, None, None, f"unreadable picture: {e}"))
                    continue
                g = gray(pixels, mode)
                q = quality(g)
                rows.append((path, mode, g.shape[1], g.shape[0], q["contrast"], q["coverage"], q["border_ink"], q["border_limit"], None))
            yield pd.DataFrame(rows, columns=names).astype({"width": "Int32", "height": "Int32", "border_ink": "Int64", "border_limit": "Int64"})

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, "path string, mode string, width int, height int, contrast double, coverage double, border_ink long, border_limit long, problem string")


def pictures(spark: SparkSession, root: str) -> DataFrame:
    """(path, content) of the PNG files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.[pP][nN][gG]").load(root).select("path", "content")


def measured(files: DataFrame) -> DataFrame:
    """(path, descriptive metrics) of the readable PNG files in (path, content)."""
    names = ["width", "height", "aspect_ratio", "mean_luminance", "luminance_std", "robust_contrast", "ink_coverage", "edge_density"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"], strict=True):
                try:
                    m = measure(gray(*decode(bytes(content))))
                except (ValueError, zlib.error, struct.error):
                    continue
                rows.append((path, *[m[n] for n in names]))
            yield pd.DataFrame(rows, columns=["path", *names])

    ship(files.sparkSession)
    return files.select("path", "content").mapInPandas(run, "path string, " + ", ".join(f"{n} double" for n in names))


#: Files that the statistics read of each split, and of each group in all, fixed values.
OF_SPLIT, OF_GROUP = 170, 512


def first_files(files: DataFrame, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """The first files of each split folder by name, and of those the first ones in all."""
    rows = files.withColumn("_name", base_name(F.col("path"))).withColumn("_split", F.element_at(F.split("path", "/"), -2))
    place = F.row_number().over(W.partitionBy("_split").orderBy("_name"))
    order = F.array_position(F.array(*[F.lit(s) for s in splits]), F.col("_split"))
    rows = rows.where(F.col("_split").isin(*splits)).withColumn("_r", place).where(F.col("_r") <= OF_SPLIT)
    return rows.orderBy(order, "_name").limit(OF_GROUP).drop("_name", "_split", "_r")


def statistics(made: DataFrame, real: DataFrame | None = None) -> dict:
    """Moments of every metric of made pictures (path, content), and of real ones if there are any: what the
    statistics artefact holds.  A description of a bounded sample, no evidence of realism."""
    names = ["width", "height", "aspect_ratio", "mean_luminance", "luminance_std", "robust_contrast", "ink_coverage", "edge_density"]

    def summary(files: DataFrame) -> dict:
        rows = moments(measured(files), [], names).collect()
        return {r["metric"]: {k: r[k] for k in ("n", "mean", "sd", "least", "most")} for r in rows}

    found = summary(real.orderBy("path").limit(OF_GROUP)) if real is not None else None
    return {"statistics_schema_version": 1, "comparison_available": bool(found), "generated": summary(first_files(made)), "real": found or None, "sample_limit_per_group": OF_GROUP}


def review_sheet(files: DataFrame, kinds: list[str], most: int = 24) -> bytes:
    """A PNG of the first picture of each kind in the order of ``path``, at most ``most``: (path, content, kinds)."""
    rows = files.groupBy(*kinds).agg(F.min(F.struct("path", "content")).alias("f")).select("f.*").orderBy("path").limit(most).collect()
    return encode(sheet([gray(*decode(bytes(r["content"]))) for r in rows]))


def split_entries(spark: SparkSession, root: str, splits: tuple[str, ...] = ("train", "val", "test")) -> DataFrame:
    """(split, name, problem) of every file one level below the split folders, contents unread: those that
    are no .png file are unexpected, a split without a folder is missing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, rows = None, []
    for s in splits:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path, s)
        if not (system.exists(folder) and system.getFileStatus(folder).isDirectory()):
            rows.append((s, None, "missing split directory"))
            continue
        rows += [(s, x.getPath().getName(), "unexpected entry") for x in system.listStatus(folder) if x.isDirectory()]
        files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{s}").select(F.lit(s).alias("split"), base_name(F.col("path")).alias("name"))
        found = files if found is None else found.unionByName(files)
    listed = spark.createDataFrame(rows, "split string, name string, problem string")
    if found is None:
        return listed
    return found.withColumn("problem", F.when(~F.lower("name").endswith(".png"), "unexpected entry")).unionByName(listed)


def folder_size(spark: SparkSession, root: str) -> int:
    """Bytes of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def newest_first(files: DataFrame) -> DataFrame:
    """Files (path, modificationTime) by time, the newest first, then by name."""
    return files.orderBy(F.desc("modificationTime"), fold(F.col("path")), "path")


def sheet(images: list[np.ndarray], width: int = 480, height: int = 150, columns: int = 2) -> np.ndarray:
    """A white sheet of gray pictures in tiles, each shrunk by whole steps to fit and centred."""
    rows = -(-len(images) // columns)
    out = np.full((height * max(1, rows), width * columns), 255, np.uint8)
    for k, g in enumerate(images):
        step = max(1, -(-g.shape[1] // (width - 20)), -(-g.shape[0] // 95))
        small = g[::step, ::step]
        y, x = (k // columns) * height + 8, (k % columns) * width + (width - small.shape[1]) // 2
        out[y : y + small.shape[0], x : x + small.shape[1]] = small
    return out
