"""Data set catalogue, reservations, locks and staged commits on the driver."""

from __future__ import annotations

import contextlib
import os
import shutil
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def claimed(names: DataFrame, column: str, prefix: str = "dataset_") -> DataFrame:
    """(id, name) of names like ``dataset_007``, of archives and of reservations of such names."""
    number = F.regexp_extract(column, rf"^\.?{prefix}([0-9]+)(\.zip|\.reserve)?$", 1)
    return names.select(F.col(column).alias("name"), number.alias("_n")).where("_n <> ''").select(F.col("_n").cast("long").alias("id"), "name")


def next_name(names: DataFrame, column: str, prefix: str = "dataset_") -> str:
    top = claimed(names, column, prefix).agg(F.max("id")).first()[0] or 0
    return f"{prefix}{top + 1:03d}"


def child(root: str | Path, name: str) -> Path:
    """A direct child of a folder; anything that leads elsewhere fails."""
    root = Path(root).resolve()
    path = (root / name).resolve()
    if path.parent != root or path.is_symlink():
        raise ValueError(f"{name!r} is not a direct child")
    return path


@contextlib.contextmanager
def exclusive(path: str | Path) -> Iterator[str]:
    """Holds a marker file that only one process can make; another's marker is never removed."""
    token = uuid.uuid4().hex
    with open(path, "x") as f:
        f.write(token)
    try:
        yield token
    finally:
        if Path(path).exists() and Path(path).read_text() == token:
            os.unlink(path)


def commit(staged: dict[str, Path], target: str | Path, check: Callable[[], None] = lambda: None) -> None:
    """Moves staged files into a folder; if a move or the check fails, all is as before."""
    target = Path(target)
    backup = target / f".backup-{uuid.uuid4().hex}"
    backup.mkdir()
    done: list[str] = []
    try:
        for name, source in staged.items():
            final = child(target, name)
            if final.exists():
                os.replace(final, backup / name)
            done.append(name)
            os.replace(source, final)
        check()
    except BaseException:
        for name in done:
            (target / name).unlink(missing_ok=True)
            if (backup / name).exists():
                os.replace(backup / name, target / name)
        raise
    finally:
        shutil.rmtree(backup, ignore_errors=True)


def same_run(old: DataFrame, new: DataFrame, columns: list[str]) -> Column:
    """Whether two runs' settings are equal, so that a repeat keeps its time stamp."""
    a, b = (df.select(*columns).first() for df in (old, new))
    return F.lit(a == b)
