"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a hash-random key.  Within each source the rows are ordered by that key, the
key's top bits serving as range buckets: sums of words by (source, bucket) give the words
before each bucket, a window inside one bucket gives the words before each row.  A source
whose budget is ``k`` times its words and a rest takes every row ``k`` times and, in key
order, rows until the rest is used up; the row at the cut is taken up to the budget's last
word.  No window or task sees a whole source, so one source may hold most of all rows.

A null source is a source of its own, the last one.  A null or empty text has no words and is in no mix; a null id
is part of the key like any other.  Rows equal in id and text have equal keys: at the cut they share the rest
evenly.  An empty table gives an empty result.  Columns of any other name stay as they are, those that ``mix`` adds
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACE_RUN, checked_join, cut, partitions, shielded, text_of, trimmed, word_count

#: The production mix: weights of the sources in order, repeating; the most epochs of a source.
WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3


def targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source (source, source_size) in; adds ``target``.

    Sources by code point, null last, weigh ``weights`` in turn.  The total of all sizes is
    shared by weight; no target exceeds ``max_epochs`` times its source's size.  With the
    sources in order of cap/weight, the k-th is the first that keeps its share when
    (total - caps before) / (weights from k on) <= its cap/weight: all before it are at their
    cap.  That level falls with k from there on, so it is the largest one that fits.
    """
    one = W.partitionBy(F.lit(1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("_rank", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())) - 1)
    ranked = ranked.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * float(max_epochs))
    by_ratio = one.orderBy(F.col("_cap") / F.col("_w"), "_rank").rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(one) - F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0))) / (
        F.sum("_w").over(one) - F.coalesce(F.sum("_w").over(by_ratio), F.lit(0.0))
    )
    free = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    filled = ranked.withColumn("_level", level).withColumn("_fill", F.max(free).over(one))
    share = F.when(F.col("_fill").isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), F.col("_fill") * F.col("_w")))
    return filled.select("source", "source_size", share.cast("double").alias("target"))


def mix(docs: DataFrame, size: Column, key: Column, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds ``size``, ``source_size``, ``target``, ``copies`` (whole epochs), ``part`` (words of
    one further, cut copy) and ``taken`` (copies * size + part) to every row of ``docs``.

    ``docs`` needs a column ``source``; ``key`` is a 64-bit hash that decides the order.  A null
    source is a source of its own.  Rows with equal keys are peers: at the cut they share the
    rest evenly, so that reruns agree.  Rows without words take nothing; an empty table
    gives an empty result.  Existing columns of the added names are replaced.
    """
    spark = docs.sparkSession
    bits = max(4, (4 * partitions(spark) - 1).bit_length())
    added = ("size", "source_size", "target", "copies", "part", "taken")
    # Columns of other names wait under names that nothing here uses, and come back last.
    other = {c: f"_x{k}" for k, c in enumerate(docs.columns) if c != "source" and c not in added}
    rows = docs.select(size.alias("size"), key.alias("_key"), "source", *[F.col(c).alias(x) for c, x in other.items()])
    slim = cut(rows.select("source", "size", "_key").withColumn("_bucket", F.shiftright("_key", 64 - bits)))
    by_bucket = cut(slim.groupBy("source", "_bucket").agg(F.sum("size").alias("_words")))
    plan = cut(targets(by_bucket.groupBy("source").agg(F.sum("_words").alias("source_size")), weights, max_epochs))
    budget = F.floor(F.col("target"))
    plan = plan.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)))
    plan = plan.withColumn("_rest", budget - F.col("copies") * F.col("source_size"))
    before = W.partitionBy("source").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = by_bucket.withColumn("_before", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    # The cut lies in one bucket of each source: only that bucket's rows are ordered by key.
    here = (F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_words"))
    cut_at = cut(
        starts.join(plan.select(F.col("source").alias("_s"), "_rest"), F.col("source").eqNullSafe(F.col("_s")))
        .where(here).select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), "_before", "_rest")
    )
    inside = checked_join(slim.where(F.col("size") > 0), cut_at, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    peers = inside.groupBy("source", "_bucket", "_key", "_before", "_rest").agg(F.sum("size").alias("_sum"), F.count("*").alias("_peers"))
    upto = W.partitionBy("source", "_bucket").orderBy("_key")
    ends = peers.withColumn("_end", F.col("_before") + F.sum("_sum").over(upto))
    edge = ends.where((F.col("_end") > F.col("_rest")) & (F.col("_end") - F.col("_sum") <= F.col("_rest")))
    left = F.floor((F.col("_rest") - F.col("_end") + F.col("_sum")) / F.col("_peers"))
    edge = edge.select(F.col("source").alias("_s"), F.col("_key").alias("_edge"), left.alias("_left"))
    full = plan.join(edge, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s", "_rest")
    full = cut(full.withColumnRenamed("source", "_source"))
    part = (
        F.when(F.col("_edge").isNull(), F.lit(0))
        .when(F.col("_key") < F.col("_edge"), F.col("size"))
        .when(F.col("_key") == F.col("_edge"), F.least(F.col("_left"), F.col("size")))
        .otherwise(F.lit(0))
    )
    out = checked_join(rows, full, F.col("source").eqNullSafe(F.col("_source")))
    out = out.withColumn("part", part.cast("long")).withColumn("copies", F.col("copies").cast("long"))
    out = out.withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))
    return out.select(*[F.col(other.get(c, c)).alias(c) for c in docs.columns if c not in added], *added)


def row_key() -> Column:
    """The hash-random key of a document."""
    return F.xxhash64(F.lit(1), F.col("doc_id"), F.col("text"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix itself: each document as many times as it is taken, the copy at its source's
    cut only up to the budget's last word; columns as in ``docs``.

    ``n_chars`` of the cut copies is their new length.  Documents without words are in no mix.
    """
    docs, back = shielded(docs, ("doc_id", "text", "source", "n_chars"))
    got = mix(docs, word_count(F.col("text")), row_key())
    whole = F.when(F.col("copies") > 0, F.array_repeat(F.lit(-1).cast("long"), F.col("copies").cast("int"))).otherwise(F.array().cast("array<long>"))
    last = F.when(F.col("part") >= F.col("size"), F.array(F.lit(-1).cast("long"))).when(F.col("part") > 0, F.array("part")).otherwise(F.array().cast("array<long>"))
    got = got.where(F.col("taken") > 0).withColumn("_copy", F.explode(F.concat(whole, last)))
    head = F.array_join(F.slice(F.split(trimmed(F.col("text")), SPACE_RUN), 1, F.col("_copy").cast("int")), " ")
    text = F.when(F.col("_copy") < 0, F.col("text")).otherwise(head)
    got = got.withColumn("text", text)
    if "n_chars" in docs.columns:
        got = got.withColumn("n_chars", F.when(F.col("_copy") < 0, F.col("n_chars")).otherwise(F.length(text_of(F.col("text"))).cast(docs.schema["n_chars"].dataType)))
    return back(got)


def op1_mix_sources(spark, sf_dir) -> DataFrame:
    """Contract query: what the production mix takes of every document.

    One row for each row of the table, repeated rows included; a null or empty text has size 0 and takes nothing, a
    null source is the last source, an empty table gives no rows."""
    from .common import documents

    docs = documents(spark, sf_dir)
    slim = cut(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), row_key().alias("key")))
    return mix(slim, F.col("size"), F.col("key")).select("doc_id", "size", "source_size", "target", "taken", "copies", "part")
