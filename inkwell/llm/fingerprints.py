"""Document fingerprints as threshold-scaled sketches, with DataFrame functions only.

A text's shingles are its runs of five words (a shorter text is one shingle).  The sketch keeps every
distinct shingle hash below a fixed fraction of the hash range.  Sketches of two texts merge by
union, and the share of the smaller sketch found in the other estimates containment however unequal
the texts are.  A text of few shingles may have none below the threshold (one text of ten words in 64 at
the production scale); its sketch is then its smallest hash, which lies above the threshold, so that it is in no
other text's sketch but in one that holds it for the same reason: such a text is like its equals (1.0) and unlike all others (0.0).

A null or empty text, or one without words, has an empty sketch; two empty sketches are alike
(1.0), an empty and another are not (0.0).  An empty table gives an empty result, repeated rows have equal
sketches, other columns stay as they are.  Rows follow each other as ``with_next`` states.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import checked_join, cut, documents, text_of, word_array

#: One shingle hash in SCALE is kept.
SCALE = 2
WIDTH = 5
#: Rows in a bucket of neighbouring ids, about, and the most buckets that ids are dealt to.
BUCKET_ROWS = 1000
MOST_BUCKETS = 16_384
#: Bits of a hash that deal rows of one much repeated id, or without an id, to buckets.
TIE_BITS = 12


def _hashes(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds column ``name``: hashes of all shingles of column ``text``."""
    w = f"_w_{name}"
    df = df.withColumn(w, F.transform(word_array(F.col(text)), lambda x: F.xxhash64(x)))
    runs = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, WIDTH)]))
    many = F.greatest(F.size(w) - (WIDTH - 1), F.least(F.size(w), F.lit(1)))
    return df.withColumn(name, F.slice(runs, 1, many)).drop(w)


def with_sketch(df: DataFrame, text: str, name: str, scale: int = SCALE) -> DataFrame:
    """Adds the sorted sketch of column ``text`` as an array of 64-bit hashes."""
    top = -(1 << 63) + (1 << 64) // scale
    low = f"_l_{name}"
    df = _hashes(df, text, name)
    df = df.withColumn(low, F.array_sort(F.array_distinct(F.filter(name, lambda h: h < F.lit(top).cast("long")))))
    least = F.when(F.size(name) > 0, F.array(F.array_min(name))).otherwise(F.array().cast("array<long>"))
    return df.withColumn(name, F.when(F.size(low) > 0, F.col(low)).otherwise(least)).drop(low)


def containment(a: Column, b: Column) -> Column:
    """Share of the smaller sketch that is in the other one."""
    least = F.least(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(both / least).cast("double")


def jaccard(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the texts of two sketches."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either).cast("double")


def as_string(sketch: Column) -> Column:
    """The sketch as text: hashes in hexadecimal, joined by commas."""
    return F.array_join(F.transform(sketch, lambda h: F.hex(h)), ",")


def _bounds(docs: DataFrame) -> list[int]:
    """Quantiles of the ids, greatest first: about one for BUCKET_ROWS rows, MOST_BUCKETS at most."""
    n = docs.agg(F.count("doc_id")).first()[0]
    parts = min(MOST_BUCKETS, n // BUCKET_ROWS)
    if parts < 2:
        return []
    share = F.expr(f"array({', '.join(f'{k / parts:.9f}D' for k in range(1, parts))})")
    return sorted(docs.agg(F.percentile_approx("doc_id", share, 4 * parts)).first()[0], reverse=True)


def with_bucket(docs: DataFrame) -> DataFrame:
    """Adds ``_b``, which grows along descending ids, from quantiles of the ids; ``_h`` orders equal ids.

    The number of a row's bucket is the number of quantiles above its id, found in two steps of
    about the square root of all of them.  An id that several quantiles fall on, and null ids, which come
    last, are dealt further by the top bits of ``_h``.
    """
    bounds = _bounds(docs)
    step = max(1, math.isqrt(len(bounds)))
    runs = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    literal = lambda xs: "array(" + ", ".join(f"{x}L" for x in xs) + ")"
    by_hash = F.shiftright("_h", 64 - TIE_BITS) + (1 << (TIE_BITS - 1)) + 1
    if not runs:
        place, often = F.lit(0).cast("long"), []
    else:
        docs = docs.withColumn("_run", F.expr(f"size(filter({literal([r[0] for r in runs])}, x -> x > doc_id))"))
        inside = F.expr(f"size(filter(element_at(array({', '.join(literal(r) for r in runs)}), greatest(_run, 1)), x -> x > doc_id))")
        place = F.greatest(F.col("_run") - 1, F.lit(0)) * step + inside
        often = sorted({a for a, b in zip(bounds, bounds[1:], strict=False) if a == b})
    tie = F.when(F.col("doc_id").isin(often), by_hash).otherwise(F.lit(0)) if often else F.lit(0)
    key = F.when(F.col("doc_id").isNull(), F.lit((len(bounds) + 1) << TIE_BITS + 1) + by_hash).otherwise(place * (1 << TIE_BITS + 1) + tie)
    return docs.withColumn("_b", key.cast("long")).drop("_run")


def with_next(docs: DataFrame, columns: list[str], derive=lambda df: df) -> DataFrame:
    """Adds next_<c> for each column, from the next row in descending ``doc_id``.

    Rows are dealt to buckets of neighbouring ids, and the first row of each bucket is also put last into the
    bucket before it, so texts cross one shuffle and no window holds more than a bucket.
    ``derive`` adds columns after that shuffle.  After the last row comes the first.  Rows with the
    same id follow each other by a hash of the text, rows with equal text too are
    neighbours in any order; null ids come last, by that hash.  A table of one row
    is its own successor.
    """
    docs = with_bucket(docs.withColumn("_h", F.xxhash64(F.lit(7), F.col("text"))))
    key = F.struct(F.coalesce(F.bitwise_not("doc_id"), F.lit((1 << 63) - 1)).alias("a"), F.col("doc_id").isNull().alias("z"), F.col("_h").alias("h"))
    firsts = cut(docs.groupBy("_b").agg(F.min(key).alias("_first")))
    # The bucket before each bucket: neighbours within runs of buckets, then between the runs.
    run = W.partitionBy("_r").orderBy("_b")
    inner = firsts.withColumn("_r", F.expr(f"_b div {1 << TIE_BITS + 1}")).withColumn("_p", F.lag("_b").over(run))
    ends = inner.groupBy("_r").agg(F.max("_b").alias("_last")).withColumn("_e", F.lag("_last").over(W.partitionBy(F.lit(1)).orderBy("_r")))
    last = F.max("_last").over(W.partitionBy(F.lit(1)))
    ends = ends.select(F.col("_r").alias("_r2"), F.coalesce("_e", last).alias("_e"))
    before = inner.join(ends, F.col("_r") == F.col("_r2")).select(
        F.col("_b").alias("_fb"), F.col("_first").alias("_ff"), F.coalesce("_p", "_e").alias("_before")
    )
    out = checked_join(docs, cut(before), (F.col("_b") == F.col("_fb")) & (key == F.col("_ff")), "left")
    own = F.struct(F.col("_b").alias("b"), F.lit(False).alias("ghost"))
    ghost = F.struct(F.col("_before").alias("b"), F.lit(True).alias("ghost"))
    out = out.withColumn("_to", F.explode(F.when(F.col("_before").isNotNull(), F.array(own, ghost)).otherwise(F.array(own))))
    # Plain columns, and all leads in one step: one window over one exchange.
    out = out.withColumns({"_at": F.col("_to.b"), "_ghost": F.col("_to.ghost")}).drop("_to", "_b", "_fb", "_ff", "_before")
    out = derive(out.repartition("_at"))
    order = W.partitionBy("_at").orderBy("_ghost", F.col("doc_id").desc_nulls_last(), "_h")
    out = out.withColumns({f"next_{c}": F.lead(c).over(order) for c in columns})
    return out.where(~F.col("_ghost")).drop("_h", "_at", "_ghost")


def op7_fingerprints(spark, sf_dir) -> DataFrame:
    """Contract query: fingerprints of every text and of its edited text, and their likeness.

    One row for each row of the table; a null text is an empty one, rows of equal ids follow each other by a hash of
    their texts, null ids come last, a single row is its own next one, an empty table gives no rows."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    docs = docs.withColumn("text", text_of(F.col("text")))
    rows = with_next(docs, ["text", "_sketch"], lambda df: with_sketch(df, "text", "_sketch"))
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    cut_off = F.expr("cast(n_chars div 3 as int)")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - cut_off).cast("int")), F.substring(F.col("next_text"), F.lit(1), cut_off))
    rows = with_sketch(rows.withColumn("_edited", edited), "_edited", "_esketch")
    return rows.select(
        "doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
        as_string(F.col("_sketch")).alias("fingerprint"), as_string(F.col("_esketch")).alias("edited_fingerprint"),
        containment(F.col("_sketch"), F.col("_esketch")).alias("near_edited"),
        containment(F.col("_sketch"), F.col("next__sketch")).alias("near_next"),
        jaccard(F.col("_sketch"), F.col("_esketch")).alias("jaccard_edited"),
        jaccard(F.col("_sketch"), F.col("next__sketch")).alias("jaccard_next"),
    )
