"""Character and word error rates over many groupings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions.text import edit_distance, token_distance, tokens


def with_edits(df: DataFrame, reference: str = "reference", prediction: str = "prediction", words: bool = True) -> DataFrame:
    """Adds char_edits, ref_chars, exact and, if asked for, word_edits and ref_words."""
    r, p = F.col(reference), F.col(prediction)
    out = df.withColumns({"char_edits": edit_distance(r, p).cast("long"), "ref_chars": F.length(r).cast("long"), "exact": (r == p).cast("long")})
    if words:
        out = out.withColumns({"_rw": tokens(r), "_pw": tokens(p)})
        out = out.withColumns({"word_edits": token_distance(F.col("_rw"), F.col("_pw")).cast("long"), "ref_words": F.size("_rw").cast("long")}).drop("_rw", "_pw")
    return out


def rate(a: str, b: str) -> Column:
    return F.when(F.sum(b) > 0, F.sum(a) / F.sum(b)).otherwise(0.0)


def summary(words: bool = True) -> list[Column]:
    out = [F.count("*").alias("total"), F.sum("exact").alias("exact"), F.avg("exact").alias("accuracy"), rate("char_edits", "ref_chars").alias("cer")]
    return [*out, rate("word_edits", "ref_words").alias("wer")] if words else out


def named(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")) == "", "unspecified").otherwise(c)


def grouped(df: DataFrame, column: str, explode: bool = False, words: bool = True) -> DataFrame:
    """Rates by a column, blanks as ``unspecified``; an array column counts under each entry."""
    group = F.explode_outer(column) if explode else F.col(column)
    return df.withColumn("_g", group).groupBy(named(F.col("_g")).alias("group")).agg(*summary(words))


def breakdowns(df: DataFrame, columns: list[str], exploded: list[str] = (), words: bool = False) -> DataFrame:
    """(breakdown, group, rates) overall and by each column, in one pass over the rows: every row
    is expanded once per grouping and aggregated partially before the shuffle."""
    sets = F.array(F.struct(F.lit("overall").alias("breakdown"), F.lit("all").alias("group")), *[F.struct(F.lit(c).alias("breakdown"), named(F.col(c)).alias("group")) for c in columns])
    measures = ["char_edits", "ref_chars", "exact", *(["word_edits", "ref_words"] if words else [])]
    parts = [df.select(*measures, F.inline(sets))]
    parts += [df.select(*measures, F.lit(c).alias("breakdown"), F.explode_outer(c).alias("g")).select(*measures, "breakdown", named(F.col("g")).alias("group")) for c in exploded]
    return reduce(DataFrame.unionByName, parts).groupBy("breakdown", "group").agg(*summary(words))


def verdict(base: Column, tuned: Column, lower_is_better: bool) -> Column:
    better = tuned < base if lower_is_better else tuned > base
    return F.when(tuned == base, "same").when(better, "better").otherwise("worse")


def early_stopping(df: DataFrame, order: str, metric: str, patience: int) -> DataFrame:
    """Adds the running best, whether a row improved, how many rows went by since, and whether
    training had already stopped (``patience`` rows without a better value).  One row per epoch."""
    upto = W.orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    before = W.orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    out = df.withColumn("best", F.min(metric).over(upto)).withColumn("_prev", F.min(metric).over(before))
    out = out.withColumn("improved", F.col("_prev").isNull() | (F.col(metric) < F.col("_prev")))
    out = out.withColumn("_run", F.sum(F.col("improved").cast("int")).over(upto))
    out = out.withColumn("stale", F.sum((~F.col("improved")).cast("int")).over(W.partitionBy("_run").orderBy(order)).cast("long"))
    return out.withColumn("stopped", F.coalesce(F.max(F.col("stale") >= patience).over(before), F.lit(False))).drop("_prev", "_run")
