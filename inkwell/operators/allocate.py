"""Exact allocation: quotas, exact shuffled assignment, writer-disjoint splits, global ranks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import ranges
from inkwell.functions.rand import SPAN, draw

SPLITS = ("train", "val", "test")


def quotas(total: int, fractions: tuple[float, ...]) -> list[int]:
    """Largest-remainder shares of ``total``; every positive fraction gets at least one.

    Remainders go to the largest fractional part, earlier first; an empty split takes one
    from the fullest that can spare it.
    """
    if total < 0 or any(f < 0 for f in fractions) or not math.isclose(sum(fractions), 1.0, abs_tol=1e-6):
        raise ValueError("a total of 0 or more and fractions that add up to 1 are needed")
    wanted = [k for k, f in enumerate(fractions) if f > 0]
    if 0 < total < len(wanted):
        raise ValueError(f"at least {len(wanted)} samples are needed")
    exact = [total * f for f in fractions]
    out = [math.floor(x + 1e-9) for x in exact]
    order = sorted(wanted, key=lambda k: (-(exact[k] - out[k]), k))
    for k in order[: total - sum(out)]:
        out[k] += 1
    for k in wanted:
        if total and out[k] == 0:
            donor = max(wanted, key=lambda j: (out[j], -j))
            out[donor] -= 1
            out[k] += 1
    return out


def rank_in_buckets(df: DataFrame, groups: list[str], bucket: Column, order: list, name: str) -> DataFrame:
    """Adds the rank (from 1) of every row among the rows of its groups, by ``bucket`` and then ``order``.

    ``bucket`` must never fall along ``order``.  Counts per bucket, summed over the buckets before,
    are added to ranks within a bucket, so no task sorts more than a bucket.
    """
    df = df.withColumn("_bucket", bucket)
    before = W.partitionBy(*groups).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = df.groupBy(*groups, "_bucket").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = F.row_number().over(W.partitionBy(*groups, "_bucket").orderBy(*order))
    keys = [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in (*groups, "_bucket")]
    starts = starts.select("_start", *[F.col(c).alias(f"_s_{c}") for c in (*groups, "_bucket")])
    out = df.withColumn("_within", within).join(starts, keys)
    return out.withColumn(name, (F.col("_start") + F.col("_within")).cast("long")).drop("_bucket", "_within", "_start", *[f"_s_{c}" for c in (*groups, "_bucket")])


def global_rank(df: DataFrame, key: Column, ties: list[str], name: str, bits: int = 10) -> DataFrame:
    """Adds the rank (from 1) of every row by ``key`` (a hash, evenly spread below 2**32), then ``ties``.
    The key's top bits deal rows to buckets."""
    df = df.withColumn("_key", key)
    return rank_in_buckets(df, [], F.shiftright("_key", 32 - bits), ["_key", *ties], name).drop("_key")


def ordered_rank(df: DataFrame, groups: list[str], key: str, ties: list[str], name: str) -> DataFrame:
    """Adds the rank (from 1) of every row among its groups by the numeric column ``key`` in
    ascending order, then ``ties``.  Buckets come from the key's own quantiles."""
    bucket = ranges.bucket(ranges.bounds(df, key), key, df.schema[key].dataType.simpleString())
    return rank_in_buckets(df, groups, bucket, [key, *ties], name)


def exact_assignment(df: DataFrame, key: str, counts: dict[str, int], namespace: str) -> DataFrame:
    """Adds ``split``: a random assignment with exactly ``counts`` rows of each."""
    ranked = global_rank(df, draw(namespace, F.col(key)), [key], "_rank")
    upto, out = 0, None
    for name, n in counts.items():
        upto += n
        hit = F.col("_rank") <= upto
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return ranked.withColumn("split", out).drop("_rank")


def assign_writers(writers: DataFrame, key: str, fractions: tuple[float, ...], namespace: str, existing: DataFrame | None = None) -> DataFrame:
    """(writer, split) of every writer; those in ``existing`` never move.

    Each new writer, in hash order, goes to the split that lacks most towards its quota, earlier
    first among equals.  That greedy order is the slots of all deficits by (slot's
    remaining deficit descending, split), matched by rank.
    """
    known = existing if existing is not None else writers.sparkSession.createDataFrame([], f"{key} {writers.schema[key].dataType.simpleString()}, split string")
    fresh = writers.select(key).distinct().join(known.select(key), key, "left_anti")
    total = fresh.count() + known.count()
    have = {r["split"]: r["n"] for r in known.groupBy("split").agg(F.count("*").alias("n")).collect()}
    lack = [max(0, q - have.get(s, 0)) for s, q in zip(SPLITS, quotas(total, fractions), strict=True)]
    # Deficit d holds slots d, d - 1, .. 1: the slots with the largest value come first.
    ranked = global_rank(fresh, draw(namespace, F.col(key)), [key], "_rank")
    spark = writers.sparkSession
    slots = None
    for k, (s, d) in enumerate(zip(SPLITS, lack, strict=True)):
        if d:
            part = spark.range(1, d + 1).select(F.col("id").alias("_slot"), F.lit(k).alias("_k"), F.lit(s).alias("split"))
            slots = part if slots is None else slots.union(part)
    if slots is None:
        return known.select(key, "split")
    # A slot's rank follows from the deficits alone: all greater slots of every split, and equal ones of earlier splits.
    rank = sum(
        (F.greatest(F.lit(d) - F.col("_slot"), F.lit(0)) + F.when((F.lit(d) >= F.col("_slot")) & (F.lit(j) < F.col("_k")), 1).otherwise(0) for j, d in enumerate(lack)),
        F.lit(1),
    )
    slots = slots.select(rank.cast("long").alias("_rank"), "split")
    return known.select(key, "split").union(ranked.join(slots, "_rank").select(key, "split"))


def pseudo_writers(df: DataFrame, split: str, order: str, per_writer: int) -> DataFrame:
    """Adds ``writer_id``: samples of a split in order, ``per_writer`` to each writer."""
    ranked = ordered_rank(df, [split], order, [], "_own")
    number = F.floor((F.col("_own") - 1) / per_writer) + 1
    return ranked.withColumn("writer_id", F.format_string("synthetic_%s_writer_%05d", F.col(split), number.cast("int"))).drop("_own")


def holdout(df: DataFrame, key: str, namespace: str, percent: int) -> DataFrame:
    """Adds ``held_out``: the first ceil(n * percent / 100) keys by hash, 1 at least, n - 1 at most."""
    n = df.select(key).distinct().count()
    k = max(1, min(n - 1, -(-n * percent // 100)))
    ranked = global_rank(df.select(key).distinct(), draw(namespace, F.col(key)), [key], "_rank", 4)
    return df.join(ranked.withColumn("held_out", F.col("_rank") <= k).drop("_rank"), key)


__all__ = ["SPAN", "SPLITS", "assign_writers", "exact_assignment", "global_rank", "holdout", "ordered_rank", "pseudo_writers", "quotas", "rank_in_buckets"]
