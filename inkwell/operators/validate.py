"""Integrity rules as data: every finding is a row (code, line_number, key, message)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions.text import fold, is_leaf, strip

SPLITS = ("train", "val", "test")
SOURCES = ("synthetic", "real")
#: Findings that a report keeps; the rest are only counted.
KEEP = 1000


def finding(df: DataFrame, when: Column, code: str, message: Column, line: str = "line_number", key: str = "filename") -> DataFrame:
    return df.where(when).select(F.lit(code).alias("code"), F.col(line).cast("long").alias("line_number"), F.col(key).cast("string").alias("key"), message.alias("message"))


def findings(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unreadable(label: Column) -> Column:
    return (strip(label) == "") | (F.upper(strip(label)) == "UNREADABLE")


def row_rules(rows: DataFrame) -> DataFrame:
    """Findings of single manifest rows (line_number and the nine manifest columns, all strings)."""
    real, made = F.col("source") == "real", F.col("source") == "synthetic"
    missing = F.array_compact(F.array(*[F.when(strip(F.col(c)) == "", F.lit(c)) for c in ("field_type", "font", "sample_mode")]))
    say = F.lit
    return findings([
        finding(rows, ~is_leaf(F.col("filename")) | ~F.lower("filename").endswith(".png"), "filename", say("not a plain .png file name")),
        finding(rows, ~F.col("split").isin(*SPLITS), "split", F.concat(say("unknown split "), F.col("split"))),
        finding(rows, ~F.col("source").isin(*SOURCES), "source", F.concat(say("unknown source "), F.col("source"))),
        finding(rows, unreadable(F.col("label")), "label", say("label is blank or unreadable")),
        finding(rows, F.col("schema_version") != "1", "schema_version", F.concat(say("unknown version "), F.col("schema_version"))),
        finding(rows, real & (strip(F.col("writer_id")) == ""), "writer_id", say("a real sample needs a writer")),
        finding(rows, made & (strip(F.col("writer_id")) != ""), "writer_id", say("a synthetic sample has no writer")),
        finding(rows.withColumn("_m", missing), made & (F.size("_m") > 0), "synthetic_fields", F.concat(say("missing "), F.array_join("_m", ", "))),
    ])


def eligible() -> Column:
    """Rows that count in breakdowns: a safe .png name and a known split."""
    return is_leaf(F.col("filename")) & F.lower("filename").endswith(".png") & F.col("split").isin(*SPLITS)


def later_duplicates(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """Rows whose folded key occurred earlier in file order, with the first occurrence's line."""
    own = W.partitionBy("_fold").orderBy(order)
    rows = rows.withColumn("_fold", key).withColumn("rank", F.row_number().over(own)).withColumn("first_line", F.first(order).over(own))
    return rows.where("rank > 1").drop("_fold")


def conflicts(rows: DataFrame, keys: list[str], order: str, columns: list[str]) -> DataFrame:
    """Later rows of a key with the columns in which they differ from the key's first row;
    ``verdict`` is "duplicate" where there are none."""
    own = W.partitionBy(*keys).orderBy(order)
    rows = rows.withColumn("_rank", F.row_number().over(own)).withColumns({f"_f_{c}": F.first(c).over(own) for c in columns})
    differ = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_f_{c}")), F.lit(c)) for c in columns]))
    rows = rows.where("_rank > 1").withColumn("differing", F.array_join(differ, ","))
    return rows.withColumn("verdict", F.when(F.col("differing") == "", "duplicate").otherwise("conflict")).drop("_rank", *[f"_f_{c}" for c in columns])


def crossing(rows: DataFrame, writer: str, split: str) -> DataFrame:
    """Writers found in more than one split, with the sorted splits."""
    out = rows.groupBy(writer).agg(F.sort_array(F.collect_set(split)).alias("_s"))
    return out.where(F.size("_s") > 1).select(writer, F.array_join("_s", ",").alias("splits"))


def report(found: DataFrame, keep: int = KEEP) -> DataFrame:
    """(code, findings, kept): how many findings of each code there are and are kept, the first ``keep``
    of all by (code, line)."""
    counts = found.groupBy("code").agg(F.count("*").alias("findings"))
    before = F.coalesce(F.sum("findings").over(W.orderBy("code").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return counts.withColumn("kept", F.greatest(F.lit(0), F.least(F.col("findings"), F.lit(keep) - before)).cast("long"))


def unmatched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` without a partner in ``right``."""
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def folded(rows: DataFrame, column: str, name: str = "filename_fold") -> DataFrame:
    return rows.withColumn(name, fold(F.col(column)))
