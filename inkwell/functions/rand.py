"""Counter-based randomness: a draw is a hash of (namespace, seed, key), never of a partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEED = 42
SPAN = 1 << 32


def draw(namespace: str, key: Column, seed: int = SEED) -> Column:
    """A whole number below 2**32: the first eight hexadecimal digits of sha256(ns|seed|key)."""
    text = F.concat_ws("|", F.lit(namespace), F.lit(str(seed)), key.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def pick(namespace: str, key: Column, n: int, seed: int = SEED) -> Column:
    """A whole number below n."""
    return F.floor(draw(namespace, key, seed) * n / F.lit(SPAN)).cast("int")


def chance(namespace: str, key: Column, percent: int, seed: int = SEED) -> Column:
    return draw(namespace, key, seed) * 100 < F.lit(percent * SPAN)


def weighted(namespace: str, key: Column, weights: dict[str, int], seed: int = SEED) -> Column:
    """A key of ``weights`` with a chance in proportion, by cumulative weights over the sorted keys."""
    total, upto, out = sum(weights.values()), 0, None
    u = draw(namespace, key, seed) * total
    for name in sorted(weights):
        if weights[name] <= 0:
            continue
        upto += weights[name]
        hit = u < F.lit(upto * SPAN)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def draw_sql(namespace: str, key: str, seed: int = SEED) -> str:
    return f"('0x' || substr(sha256('{namespace}|{seed}|' || ({key})), 1, 8))::BIGINT"


def pick_sql(namespace: str, key: str, n: int) -> str:
    return f"floor({draw_sql(namespace, key)} * {n} / {SPAN})::INT"


def chance_sql(namespace: str, key: str, percent: int) -> str:
    return f"({draw_sql(namespace, key)} * 100 < {percent * SPAN})"


def weighted_sql(namespace: str, key: str, weights: dict[str, int]) -> str:
    total, upto, arms = sum(weights.values()), 0, []
    for name in sorted(weights):
        if weights[name] > 0:
            upto += weights[name]
            arms.append(f"WHEN {draw_sql(namespace, key)} * {total} < {upto * SPAN} THEN '{name}'")
    return f"CASE {' '.join(arms)} END"
