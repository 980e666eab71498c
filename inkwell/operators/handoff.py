"""Checks before artefacts are handed on: positional and ordered equality, freshness, archives, guarded removal."""

from __future__ import annotations

import json
import os
import shutil
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.operators.catalog import child


def zipped(left: DataFrame, right: DataFrame, place: str, key: str) -> DataFrame:
    """(place, key, problem): two ordered tables that must hold the same keys at the same places,
    by one full outer join on the place; rows beyond the other's end are missing or extra."""
    a = left.select(F.col(place).alias("_p"), F.col(key).alias("_a"))
    b = right.select(F.col(place).alias("_q"), F.col(key).alias("_b"))
    both = a.join(b, F.col("_p") == F.col("_q"), "full_outer")
    problem = F.when(F.col("_q").isNull(), "missing").when(F.col("_p").isNull(), "extra").when(~F.col("_a").eqNullSafe(F.col("_b")), "different key")
    return both.select(F.coalesce("_p", "_q").alias(place), F.coalesce("_a", "_b").alias(key), problem.alias("problem")).where("problem IS NOT NULL")


def same_order(cached: DataFrame, expected: DataFrame, place: str, columns: list[str]) -> DataFrame:
    """(place, problem): rows of cached results that do not equal the expected ones in order."""
    side = lambda df, p, v: df.select(F.col(place).alias(p), F.struct(*columns).alias(v))
    both = side(cached, "_p", "_a").join(side(expected, "_q", "_b"), F.col("_p") == F.col("_q"), "full_outer")
    problem = F.when(F.col("_p").isNull(), "missing").when(F.col("_q").isNull(), "extra").when(~F.col("_a").eqNullSafe(F.col("_b")), "different row")
    return both.select(F.coalesce("_p", "_q").alias(place), problem.alias("problem")).where("problem IS NOT NULL")


def difference_report(differences: DataFrame, key: str, keep: int = 3) -> DataFrame:
    """(side, n, first): how many rows a view lacks or has beyond its projection, and the first ``keep`` keys of each side.

    Each task keeps its own first keys of a side before they meet, so a view that is wrong throughout costs no more."""
    from pyspark.sql import Window as W

    some = differences.groupBy("side", key).agg(F.count("*").alias("n"))
    some = some.withColumn("part", F.pmod(F.xxhash64(key), F.lit(256)))
    few = some.withColumn("r", F.row_number().over(W.partitionBy("side", "part").orderBy(key))).where(F.col("r") <= keep)
    first = few.groupBy("side").agg(F.array_join(F.slice(F.array_sort(F.collect_list(key)), 1, keep), ",").alias("first"))
    return some.groupBy("side").agg(F.sum("n").alias("n")).join(first, "side")


def archives(folder: str | Path) -> tuple[Path, Path]:
    """Where the archive of a data set and its checksum lie; either one there forbids changes."""
    folder = Path(folder)
    out = folder.with_name(f"{folder.name}.zip"), folder.with_name(f"{folder.name}.zip.sha256")
    for p in out:
        if os.path.lexists(p):
            raise FileExistsError(f"{p} is there already")
    return out


def remove(root: str | Path, name: str) -> bool:
    """Removes a direct child of a folder with all below it; links anywhere in it forbid that."""
    path = Path(root).resolve() / name
    if path.is_symlink():
        raise ValueError(f"{path} is a link")
    path = child(root, name)
    if not path.exists():
        return False
    if not path.is_dir():
        raise ValueError(f"{path} is no folder")
    if link := next((p for p in path.rglob("*") if p.is_symlink()), None):
        raise ValueError(f"{link} is a link")
    shutil.rmtree(path)
    return True


def fresh(report: str | Path, current: dict[str, str], others: tuple[str | Path, ...] = ()) -> list[str]:
    """Why a stored report does not belong to the current files, if so: it must be there, say that they are
    valid, and hold the digests in ``current``; other artefacts must be there."""
    out = [f"missing {Path(p).name}" for p in (report, *others) if not Path(p).is_file()]
    if out:
        return out
    try:
        saved = json.loads(Path(report).read_text(encoding="utf-8"))
    except (UnicodeError, json.JSONDecodeError):
        return ["unreadable report"]
    out = [] if saved.get("valid") is True else ["the report is not valid"]
    return out + [f"stale {k}" for k, v in sorted(current.items()) if saved.get(k) != v]


def once(path: str | Path, key: str, make: Callable[[], dict]) -> dict:
    """A result that is made once for a key and kept; a stored one of another key is refused."""
    from inkwell.sources.manifest import json_bytes, publish

    path = Path(path)
    if path.exists():
        saved = json.loads(path.read_text(encoding="utf-8"))
        if saved.get("key") != key:
            raise ValueError(f"{path} belongs to other settings")
        return saved["value"]
    value = make()
    publish(path, json_bytes({"key": key, "value": value}))
    return value
