"""Runs over partitions: batches that shrink when memory ends, progress, cancellation, remaining time."""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkwell.session import ship


def in_batches(rows: pd.DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Results of all rows in batches of at most ``size``; a batch that runs out of memory is done again
    in halves, and the smaller size stays.  A single row that runs out of memory fails."""
    at = 0
    while at < len(rows):
        part = rows.iloc[at : at + size]
        try:
            yield run(part)
        except MemoryError:
            if len(part) == 1:
                raise
            size = max(1, len(part) // 2)
            continue
        at += len(part)


def predicted(df: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str, size: int = 32) -> DataFrame:
    """``run`` over all rows of a table, batch by batch."""

    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in frames:
            yield from in_batches(rows, run, size)

    ship(df.sparkSession)
    return df.mapInPandas(parts, schema)


def watched(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The table and a count of the rows that have gone through it, known when the run ends."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


@contextlib.contextmanager
def cancellable(spark: SparkSession, tag: str) -> Iterator[Callable[[], object]]:
    """Jobs started inside bear a tag; the function given cancels all of them."""
    spark.addTag(tag)
    try:
        yield lambda: spark.interruptTag(tag)
    finally:
        spark.removeTag(tag)


def remaining(done: int, total: int, seconds: float) -> str:
    """Rate, time taken and time left, as h:mm:ss."""
    clock = lambda s: f"{int(s) // 3600}:{int(s) // 60 % 60:02d}:{int(s) % 60:02d}"
    rate = done / seconds if seconds > 0 else 0.0
    left = clock((total - done) / rate) if rate else "-"
    return f"{rate:.1f}/s, {clock(seconds)} taken, {left} left"
