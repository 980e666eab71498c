"""Moments, percentiles and comparisons of metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import ranges

FLAT = 1e-12


def long_form(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """One row per metric: keys, metric, value."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    return df.select(*keys, F.inline(pairs))


def moments(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Count, mean, population deviation, least and greatest of each metric and group."""
    return long_form(df, keys, metrics).groupBy(*keys, "metric").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("sd"), F.min("value").alias("least"), F.max("value").alias("most")
    )


def percentiles(df: DataFrame, keys: list[str], metric: str, parts: list[float], names: list[str] | None = None) -> DataFrame:
    """Exact percentiles, linear between neighbours; 0 where there are no values.

    Values are dealt to buckets by their quantiles; counts per group and bucket tell which bucket holds a
    percentile's two neighbours, and only those buckets are ranked.  No task holds a group.
    """
    names = names or [f"p{round(100 * p)}" for p in parts]
    kind = df.schema[metric].dataType.simpleString()
    rows = df.select(*keys, F.col(metric).alias("_v")).withColumn("_bucket", ranges.bucket(ranges.bounds(df, metric), "_v", kind))
    rows = rows.groupBy(*keys, "_bucket", "_v").agg(F.count("_v").alias("_n"))  # equal values once
    upto = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = rows.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_m"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_m").over(upto), F.lit(0))).withColumn("_all", F.sum("_m").over(W.partitionBy(*keys)))
    # Places of the two neighbours of each percentile, from 0.
    places = F.array_distinct(F.flatten(F.array(*[F.array(F.floor((F.col("_all") - 1) * p), F.ceil((F.col("_all") - 1) * p)) for p in parts])))
    inside = F.filter(places, lambda k: (k >= F.col("_before")) & (k < F.col("_before") + F.col("_m")))
    held = counts.where((F.col("_m") > 0) & (F.size(inside) > 0)).select(*[F.col(c).alias(f"_k_{c}") for c in (*keys, "_bucket")], "_before")
    same = [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*keys, "_bucket")]
    ranked = rows.where("_n > 0").join(held, same)
    last = F.col("_before") + F.sum("_n").over(W.partitionBy(*keys, "_bucket").orderBy("_v"))
    ranked = ranked.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_n"))
    whole = counts.groupBy(*keys).agg(F.max("_all").alias("_all"), F.coalesce(F.min("_lo"), F.lit(0.0)).alias("least"), F.coalesce(F.max("_hi"), F.lit(0.0)).alias("most"))
    again = [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in keys]
    both = whole.select("_all", "least", "most", *[F.col(c).alias(f"_w_{c}") for c in keys]).join(ranked.select(*keys, "_v", "_first", "_last"), again, "left")

    def at(place):
        return F.max(F.when((F.col("_first") <= place) & (place < F.col("_last")), F.col("_v").cast("double")))

    spot = {n: (F.col("_all") - 1) * p for n, p in zip(names, parts, strict=True)}
    out = both.groupBy(*[F.col(f"_w_{c}").alias(c) for c in keys], "_all", "least", "most").agg(
        *[at(F.floor(s)).alias(f"_a_{n}") for n, s in spot.items()], *[at(F.ceil(s)).alias(f"_b_{n}") for n, s in spot.items()]
    )
    between = lambda n, s: F.coalesce(F.col(f"_a_{n}") + (F.col(f"_b_{n}") - F.col(f"_a_{n}")) * (s - F.floor(s)), F.lit(0.0))
    return out.select(*keys, *[between(n, s).alias(n) for n, s in spot.items()], "least", "most")


def pooled(a: Column, b: Column) -> Column:
    return F.sqrt((a * a + b * b) / 2)


def compare(df: DataFrame, group: str, left: str, right: str, metrics: list[str]) -> DataFrame:
    """Difference of the means of two groups, and the same in pooled deviations (null where flat)."""
    m = moments(df.where(F.col(group).isin(left, right)), [group], metrics)
    side = lambda v, tag: m.where(F.col(group) == v).select("metric", F.col("mean").alias(f"mean_{tag}"), F.col("sd").alias(f"sd_{tag}"))
    both = side(left, "a").join(side(right, "b"), "metric")
    gap, sd = F.col("mean_a") - F.col("mean_b"), pooled(F.col("sd_a"), F.col("sd_b"))
    return both.select("metric", gap.alias("difference"), F.when(sd > FLAT, gap / sd).alias("standardized"))


def crosstab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    return df.groupBy(rows).pivot(columns, values).count().na.fill(0)
