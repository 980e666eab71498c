"""CSV sources and sinks: strict and tolerant scans, legacy upgrade, deterministic bytes, safe publishing."""

from __future__ import annotations

import csv
import hashlib
import io
import json
import os
import tempfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import fold, strip

#: Columns of the artefacts in their order, fixed values.
MANIFEST = ("filename", "label", "split", "source", "field_type", "font", "sample_mode", "writer_id", "schema_version")
LABELS = ("filename", "label", "split")
REAL = ("filename", "label", "writer_id")
ASSIGNMENTS = ("writer_id", "split", "schema_version")
LEGACY = ("filename", "label", "split", "field_type", "font", "sample_mode")
VERSION = "1"


def header(spark: SparkSession, path: str) -> list[str]:
    """The column names of a CSV file, without a byte order mark."""
    first = spark.read.text(path).first()
    return next(csv.reader([(first[0] if first else "").removeprefix("﻿")]), [])


def scan(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """All-string rows in the given column order; empty cells stay empty strings.

    The header must equal ``columns``.  Rows with too few or too many cells are kept with
    their raw text in ``_corrupt``, which is null for sound rows.
    """
    columns = list(columns)
    if (found := header(spark, path)) != columns:
        raise ValueError(f"expected the columns {columns}, found {found}")
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_corrupt"])
    df = spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', quote='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt", enforceSchema=True, emptyValue="", nullValue="\0")
    return df.na.fill("", columns)


def scan_tolerant(spark: SparkSession, path: str, required: Iterable[str]) -> DataFrame:
    """All-string rows of whatever columns there are: missing cells are empty, blank rows go,
    rows with more cells than the header fail while they are read."""
    names = header(spark, path)
    if len(set(names)) < len(names):
        raise ValueError("a column name repeats")
    if missing := [c for c in required if c not in names]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    wide = [*names, "_extra"]
    df = spark.read.csv(path, schema=", ".join(f"`{c}` string" for c in wide), header=True, multiLine=True, escape='"', emptyValue="", nullValue="\0", enforceSchema=True)
    df = df.withColumn("_extra", F.when(F.col("_extra").isNotNull(), F.raise_error(F.lit("a row has more cells than the header")))).na.fill("", names)
    blank = F.lit(True)
    for c in names:
        blank = blank & (strip(F.col(c)) == "")
    return df.where(~blank).select(*names)


def upgraded(rows: DataFrame) -> DataFrame:
    """Rows with the six legacy columns as rows of the current manifest."""
    return rows.select("filename", "label", "split", F.lit("synthetic").alias("source"), "field_type", "font", "sample_mode", F.lit("").alias("writer_id"), F.lit(VERSION).alias("schema_version"))


def load(spark: SparkSession, path: str) -> DataFrame:
    """The current manifest, or a legacy one upgraded while it is read."""
    if header(spark, path) == list(LEGACY):
        return upgraded(scan(spark, path, LEGACY).drop("_corrupt"))
    return scan(spark, path, MANIFEST).drop("_corrupt")


def load_legacy_real(spark: SparkSession, path: str) -> DataFrame:
    """A separate real manifest whose writer column is ``writer`` or ``writer_id``."""
    rows = scan_tolerant(spark, path, ["filename", "label"])
    return rows.withColumnRenamed("writer", "writer_id") if "writer" in rows.columns else rows


def real_conflicts(rows: DataFrame, order: str = "line_number") -> DataFrame:
    """(line, filename, problem) of real inputs whose folded name came before: a conflicting label
    first, then a conflicting writer, else a plain duplicate."""
    from pyspark.sql import Window as W

    own = W.partitionBy("_k").orderBy(order)
    rows = rows.withColumn("_k", fold(F.col("filename")))
    rows = rows.withColumns({"_r": F.row_number().over(own), "_l": F.first("label").over(own), "_w": F.first("writer_id").over(own)}).where("_r > 1")
    problem = F.when(F.col("label") != F.col("_l"), "conflicting label").when(F.col("writer_id") != F.col("_w"), "conflicting writer").otherwise("duplicate")
    return rows.select(order, "filename", problem.alias("problem"))


def assignments(spark: SparkSession, path: str, existing: DataFrame) -> DataFrame:
    """(writer_id, split) of the stored assignments and of existing rows; fails while it runs if they disagree."""
    both = scan(spark, path, ASSIGNMENTS).select("writer_id", "split").union(existing.where("source = 'real'").select("writer_id", "split"))
    own = both.groupBy("writer_id").agg(F.collect_set("split").alias("s"))
    sure = F.when(F.size("s") > 1, F.raise_error(F.concat(F.lit("writer in several splits: "), F.col("writer_id")))).otherwise(F.col("s")[0])
    return own.select("writer_id", sure.alias("split"))


def csv_bytes(rows: Iterable[dict], columns: Iterable[str]) -> bytes:
    """Deterministic CSV: a header, line feeds, empty strings for missing cells; other keys fail."""
    out = io.StringIO(newline="")
    writer = csv.DictWriter(out, list(columns), restval="", extrasaction="raise", lineterminator="\n")
    writer.writeheader()
    writer.writerows(rows)
    return out.getvalue().encode()


def json_bytes(value: object) -> bytes:
    return (json.dumps(value, sort_keys=True, indent=2, ensure_ascii=False) + "\n").encode()


def publish(path: str | Path, content: bytes, overwrite: bool = False) -> None:
    """Writes a local file at once or not at all; an existing one stays unless ``overwrite``."""
    path = Path(path)
    handle, part = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as f:
            f.write(content)
            f.flush()
            os.fsync(f.fileno())
        if overwrite:
            os.replace(part, path)
        else:
            os.link(part, path)
    finally:
        Path(part).unlink(missing_ok=True)


def write_sidecar(path: str | Path) -> Path:
    """Writes ``<file>.sha256`` next to a file."""
    path = Path(path)
    side = path.with_name(path.name + ".sha256")
    publish(side, f"{_sha256(path)}  {path.name}\n".encode(), overwrite=True)
    return side


def verify_sidecar(path: str | Path) -> bool:
    path = Path(path)
    parts = path.with_name(path.name + ".sha256").read_text().split()
    return len(parts) == 2 and parts[1] == path.name and parts[0] == _sha256(path)


def _sha256(path: Path) -> str:
    with path.open("rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def write_rows(df: DataFrame, path: str, columns: Iterable[str], order: list) -> None:
    """A large ordered CSV by Spark's own commit protocol; an existing one is an error."""
    df.select(*columns).orderBy(*order).write.mode("errorifexists").csv(path, header=True, lineSep="\n", emptyValue="", escape='"')
