"""Content digests for provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def framed(name: Column, content: Column) -> Column:
    """Length of the name in eight bytes, the name, the content; as hexadecimal digits."""
    raw = F.encode(name, "utf-8")
    return F.concat(F.lpad(F.hex(F.octet_length(raw).cast("long")), 16, "0"), F.hex(raw), F.hex(content))


def ordered_digest(df: DataFrame, groups: list[str], order: list[Column], name: Column, content: Column) -> DataFrame:
    """sha256 over all framed contents of a group in order.  The digest is defined over one byte
    stream, so a group's content meets in one row; use ``digest_of_digests`` for large groups."""
    rows = df.select(*groups, F.struct(*[o.alias(f"o{k}") for k, o in enumerate(order)]).alias("o"), framed(name, content).alias("x"))
    joined = rows.groupBy(*groups).agg(F.count("*").alias("files"), F.array_sort(F.collect_list(F.struct("o", "x"))).alias("all"))
    return joined.select(*groups, "files", F.sha2(F.unhex(F.array_join(F.transform("all", lambda r: r["x"]), "")), 256).alias("digest"))


def digest_of_digests(df: DataFrame, groups: list[str], name: Column, content: Column, buckets: int = 256) -> DataFrame:
    """A digest of a group of any size: 64 hexadecimal digits per file, sorted within buckets of
    their first digits, then over the buckets' digests."""
    one = df.select(*groups, F.sha2(F.unhex(framed(name, content)), 256).alias("d"))
    one = one.withColumn("b", F.conv(F.substring("d", 1, 4), 16, 10).cast("int") % buckets)
    part = one.groupBy(*groups, "b").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("d")), ""), 256).alias("p"), F.count("*").alias("n"))
    whole = part.groupBy(*groups).agg(F.sum("n").alias("files"), F.array_sort(F.collect_list(F.struct("b", "p"))).alias("all"))
    return whole.select(*groups, "files", F.sha2(F.array_join(F.transform("all", lambda r: r["p"]), ""), 256).alias("digest"))
