"""Reconciliation of incoming real samples with the current rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions.text import fold


def plan(incoming: DataFrame, current: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, action) of a full outer join on the folded key: copied, unchanged, changed or removed."""
    side = lambda df, tag: df.select(fold(F.col(key)).alias("_k"), F.col(key).alias(f"_{tag}"), F.struct(*columns).alias(f"_{tag}_row"))
    both = side(incoming, "in").join(side(current, "cur"), "_k", "full_outer")
    action = (
        F.when(F.col("_cur").isNull(), "copied").when(F.col("_in").isNull(), "removed")
        .when(F.col("_in_row").eqNullSafe(F.col("_cur_row")), "unchanged").otherwise("changed")
    )
    return both.select(F.coalesce("_in", "_cur").alias(key), action.alias("action"))


def collisions(planned: DataFrame, existing: DataFrame, key: str, allowed: str, path: str) -> DataFrame:
    """Planned files whose folded name is taken at a path other than the allowed one."""
    taken = existing.select(fold(F.col(key)).alias("_k"), F.col(path).alias("taken_by"))
    return planned.withColumn("_k", fold(F.col(key))).join(taken, "_k").where(F.col("taken_by") != F.col(allowed)).drop("_k")


def combine(unified: DataFrame, legacy: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Unified rows and the legacy ones that are not in them; ``state`` marks legacy rows that
    contradict a unified one."""
    u = unified.select(key, *columns).withColumn("state", F.lit("unified"))
    new = legacy.join(unified.select(key), key, "left_anti").select(key, *columns).withColumn("state", F.lit("legacy"))
    other = unified.select(key, F.struct(*columns).alias("_row"))
    clash = legacy.join(other, key).where(~F.struct(*columns).eqNullSafe(F.col("_row"))).select(key, *columns).withColumn("state", F.lit("conflict"))
    return u.unionByName(new).unionByName(clash)


def view_difference(view: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows that a stored view lacks or has beyond the projection that it should equal."""
    return expected.exceptAll(view).withColumn("side", F.lit("missing")).unionByName(view.exceptAll(expected).withColumn("side", F.lit("extra")))
