"""Evaluation annotations: conditions, held-out domains, train leakage, the handoff gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

DATE_FIELDS = ("date_written", "date_numeric")
PREFIX = "synthetic_"


def format_profile(split: Column, field: Column) -> Column:
    """Held-out formats for the test split's dates, base formats otherwise."""
    return F.when((split == "test") & field.isin(*DATE_FIELDS), "held_out_historical_date_v1").otherwise("base")


def degradation_profile(split: Column) -> Column:
    """The held-out degradation for the test split, the base one otherwise."""
    return F.when(split == "test", "held_out_degradation_v1").otherwise("base")


def condition(split: Column, font_held_out: Column, field: Column, degraded: bool = True) -> Column:
    """``synthetic_`` and what a test sample holds out, joined by ``+``; ``in_domain`` elsewhere."""
    parts = F.concat_ws("+", F.when(font_held_out, "unseen_font"), F.when(F.lit(degraded), "held_out_degradation"), F.when(field.isin(*DATE_FIELDS), "held_out_format"))
    return F.when((split == "test") & (parts != ""), F.concat(F.lit(PREFIX), parts)).otherwise("synthetic_in_domain")


def tags(df: DataFrame) -> DataFrame:
    """Adds evaluation_domain, seen_unseen and held_out_conditions to annotated rows
    (source, split, evaluation_condition, label_seen_in_train)."""
    held = F.filter(F.split(F.regexp_replace("evaluation_condition", f"^{PREFIX}", ""), r"\+"), lambda x: ~x.isin("", "in_domain"))
    real = F.col("source") == "real"
    held = F.when(real, F.array(F.lit("real_handwriting"))).otherwise(held)
    domain = F.when(real, "real").when(F.size(held) > 0, "synthetic_held_out").otherwise("synthetic_in_domain")
    return df.withColumn("held_out_conditions", held).withColumn("evaluation_domain", domain).withColumn("seen_unseen", F.when(F.col("label_seen_in_train"), "seen_label").otherwise("unseen_label"))


def seen_in_train(df: DataFrame, column: str, name: str, split: str = "split") -> DataFrame:
    """Adds whether a value occurs in the train split, by a join with the distinct train values
    (a window would put all rows of a common value into one task)."""
    known = df.where(F.col(split) == "train").select(F.col(column).alias("_v")).distinct().withColumn("_seen", F.lit(True))
    return df.join(known, F.col(column) == F.col("_v"), "left").withColumn(name, F.coalesce("_seen", F.lit(False))).drop("_v", "_seen")


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once; empty where a one-to-one join is allowed."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def one_to_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join that fails while it runs if a key of either side repeats; blanks for missing strings."""
    def checked(df: DataFrame) -> DataFrame:
        own = F.count("*").over(W.partitionBy(*keys))
        return df.withColumn("_n", F.when(own > 1, F.raise_error(F.lit("a key repeats in a one-to-one join"))).otherwise(own)).where("_n IS NOT NULL").drop("_n")

    out = checked(left).join(checked(right), keys, "left")
    strings = [c for c, t in out.dtypes if t == "string"]
    return out.na.fill("", strings)


def gate(manifest: DataFrame, annotations: DataFrame, keys: list[str], expected: dict[str, Column]) -> DataFrame:
    """(keys, problem): rows missing on either side, and annotations that differ from what the
    policy expects, as one full outer join."""
    m = manifest.withColumn("_m", F.lit(1))
    a = annotations.withColumn("_a", F.lit(1))
    both = m.join(a, keys, "full_outer")
    problem = F.when(F.col("_a").isNull(), "missing annotation").when(F.col("_m").isNull(), "orphan annotation")
    for name, value in expected.items():
        problem = problem.when(~F.col(name).eqNullSafe(value), f"unexpected {name}")
    return both.select(*keys, problem.alias("problem")).where("problem IS NOT NULL")
