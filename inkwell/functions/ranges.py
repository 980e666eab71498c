"""Buckets of neighbouring values from quantiles, for ranks and running sums without a task that sorts all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bucket, about, and the most buckets of a table.
BUCKET_ROWS = 100_000
MOST_BUCKETS = 4096


def bounds(df: DataFrame, key: str, rows: int = BUCKET_ROWS, most: int = MOST_BUCKETS) -> list:
    """Distinct quantiles of a numeric column in ascending order, about one for ``rows`` rows, ``most`` at
    most.  They reach the driver, so every use of them is the same whatever the partitions."""
    parts = min(most, df.agg(F.count(key)).first()[0] // rows)
    if parts < 2:
        return []
    shares = F.expr(f"array({', '.join(f'{k / parts:.9f}D' for k in range(1, parts))})")
    return sorted(set(df.agg(F.percentile_approx(key, shares, 4 * parts)).first()[0]))


def bucket(found: list, key: str, kind: str) -> Column:
    """The number of bounds below a value of column ``key`` (of SQL type ``kind``): it never falls as the
    value grows, and equal values share one.  Two steps of about the square root of all bounds each."""
    if not found:
        return F.lit(0)
    step = max(1, math.isqrt(len(found)))
    runs = [found[k : k + step] for k in range(0, len(found), step)]
    listed = lambda xs: "array(" + ", ".join(f"CAST('{x!r}' AS {kind})" for x in xs) + ")"
    run = f"size(filter({listed([r[0] for r in runs])}, x -> x < {key}))"
    return F.expr(f"greatest({run} - 1, 0) * {step} + size(filter(element_at(array({', '.join(listed(r) for r in runs)}), greatest({run}, 1)), x -> x < {key}))")
