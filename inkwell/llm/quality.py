"""Quality rules with adaptive thresholds, with DataFrame functions only.

Each document gets exact counts and three ratios in whole ten-thousandths: symbols and repeated lines a word,
both with PRIOR added to either count, and punctuation a word.  The prior makes the two rare counts a
continuous measure whose spread tells how much chance alone moves them in texts of a group's usual lengths.  Per language and
source a mergeable quantile sketch of each ratio is kept: a histogram of the ten-thousandths, whose last
bin, RATIO_TOP, takes all above.  Histograms add up, in any order, to the same histogram, so partial
sums cross the shuffle, reruns agree, and the sketch of a language or of the corpus is the
sum of those below it.  A ratio's threshold is the group's upper quartile plus FENCE times the widest
interquartile range of the group, its language and the corpus (many copies of one text narrow a group's
own); no fixed cutoff takes part.  Groups of fewer than GROUP_ROWS documents take the upper quartile of their language, and
languages of fewer the corpus's.  The thresholds are joined back and reject the documents whose ratio is above; a count of
zero rejects none.

A null or empty text has no words and fails the base.  A null lang or source is a value of its own.
Repeated rows count as often as they occur and get equal verdicts; null and equal ids do not matter.  An empty
table gives an empty result.  Other columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, checked_join, cut, documents, shielded, stored, text_of, trimmed, word_array

#: Ratios, with the count that must not be zero for one to reject.
RATIOS = {"symbols": "n_symbols", "dup_lines": "n_dup_lines", "punctuation": "n_punctuation"}
#: Added to rare counts and to the words they are divided by.
PRIOR = 3
FENCE = 6
RATIO_TOP = 40_000
GROUP_ROWS = 30
#: Fixed rules of the base: the fewest words, the largest share of repeated words in percent.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
PUNCTUATION = "!?.,;:\"'()[]{}-_/\\@^~`+=" + SYMBOLS


def _without(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def with_metrics(docs: DataFrame) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed and
    the three ratios (r_*) to every row; a null text counts as an empty one.  Columns of these names are replaced.

    Equal lines and equal windows are found by 64-bit hashes within one text.
    """
    text = text_of(F.col("text"))
    # Each step refers to the arrays of the step before more than once, so that Catalyst keeps
    # them as columns instead of computing them again for every element.
    one = docs.withColumn("_words", F.transform(word_array(F.col("text")), lambda w: F.xxhash64(w)))
    one = one.withColumn("_lines", F.transform(F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""), lambda x: F.xxhash64(x)))
    one = one.withColumn("n_words", F.size("_words").cast("long"))
    one = one.withColumn("n_lines", F.size("_lines").cast("long"))
    one = one.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    one = one.withColumn("word_chars", _without(text, SPACES).cast("long"))
    one = one.withColumn("n_symbols", (F.length(text) - _without(text, SYMBOLS)).cast("long"))
    one = one.withColumn("n_punctuation", (F.length(text) - _without(text, PUNCTUATION)).cast("long"))
    runs = F.transform("_words", lambda x, i: F.xxhash64(x, *[F.get("_words", i + k) for k in range(1, WINDOW)]))
    none = F.array().cast("array<long>")
    two = one.withColumn("_runs", F.when(F.col("n_words") >= WINDOW, F.slice(runs, 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(1)))).otherwise(none))
    two = two.withColumn("_again", F.size("_runs") > F.size(F.array_distinct("_runs")))
    ordered = F.array_sort(F.transform("_runs", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    three = two.withColumn("_sorted", F.when(F.col("_again"), ordered))
    same = lambda p, q: F.coalesce(p["h"] == q["h"], F.lit(False))
    twice = F.filter("_sorted", lambda p, k: same(p, F.get("_sorted", k - 1)) | same(p, F.get("_sorted", k + 1)))
    four = three.withColumn("_at", F.when(F.col("_again"), F.array_sort(F.transform(twice, lambda p: p["i"]))))
    covered = F.aggregate(
        "_at",
        F.struct(F.lit(-WINDOW).alias("p"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("p"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["p"])).alias("n")),
        lambda acc: acc["n"],
    )
    out = four.withColumn("n_repeat_words", F.coalesce(F.when(F.col("_again"), covered), F.lit(0)).cast("long"))
    out = out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    share = lambda a, prior: F.expr(f"(10000 * ({a} + {prior})) div greatest(n_words + {prior}, 1)").cast("long")
    out = out.withColumns({"r_symbols": share("n_symbols", PRIOR), "r_dup_lines": share("n_dup_lines", PRIOR), "r_punctuation": share("n_punctuation", 0)})
    return out.drop("_words", "_lines", "_runs", "_again", "_sorted", "_at")


def thresholds(metrics: DataFrame) -> DataFrame:
    """One row per language and source: t_<ratio> for each ratio, from the merged sketches.

    The quantile q of n values is the smallest bin at which ceil(q * n) values are reached.
    """
    ratios = F.array(*[F.struct(F.lit(k).alias("ratio"), F.least(F.lit(RATIO_TOP), F.col(f"r_{k}")).cast("int").alias("bin")) for k in RATIOS])
    bins = metrics.select("lang", "source", F.inline(ratios)).groupBy("lang", "source", "ratio", "bin").agg(F.count("*").alias("n"))
    bins = cut(bins)
    level = {"source": ["lang", "source"], "lang": ["lang"], "all": []}
    found = {}
    for name, keys in level.items():
        own = [*keys, "ratio"]
        merged = bins.groupBy(*own, "bin").agg(F.sum("n").alias("n"))
        upto = W.partitionBy(*own).orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
        merged = merged.withColumn("_upto", F.sum("n").over(upto)).withColumn("_all", F.sum("n").over(W.partitionBy(*own)))
        q = {k: F.min(F.when(4 * F.col("_upto") >= k * F.col("_all"), F.col("bin"))) for k in (1, 3)}
        quart = merged.groupBy(*own).agg(q[1].alias("q1"), q[3].alias("q3"), F.max("_all").alias("rows"))
        of = lambda k, c: F.max(F.when(F.col("ratio") == k, c))
        found[name] = quart.groupBy(*keys).agg(
            *[of(k, F.col("q3")).alias(f"{name}_{k}") for k in RATIOS], *[of(k, F.col("q3") - F.col("q1")).alias(f"{name}_{k}_wide") for k in RATIOS], F.max("rows").alias(f"{name}_rows")
        )
    langs = found["lang"].withColumnRenamed("lang", "_l")
    out = found["source"].join(langs, F.col("lang").eqNullSafe(F.col("_l"))).join(F.broadcast(found["all"]), F.lit(True))
    pick = lambda k: F.when(F.col("source_rows") >= GROUP_ROWS, F.col(f"source_{k}")).when(F.col("lang_rows") >= GROUP_ROWS, F.col(f"lang_{k}")).otherwise(F.col(f"all_{k}"))
    wide = lambda k: F.greatest(*[F.col(f"{n}_{k}_wide") for n in level])
    return out.select(F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[(pick(k) + FENCE * wide(k)).alias(f"t_{k}") for k in RATIOS])


def judged(metrics: DataFrame) -> DataFrame:
    """Adds ``kept``: false where the base failed or a ratio is above its group's threshold."""
    limits = cut(thresholds(metrics))
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    above = F.lit(False)
    for k, count in RATIOS.items():
        above = above | ((F.col(count) > 0) & (F.col(f"r_{k}") > F.col(f"t_{k}")))
    out = checked_join(metrics, limits, same, "left")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(above, F.lit(False))).drop("_lang", "_source")


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, columns as in ``docs``."""
    docs, back = shielded(docs, ("text", "lang", "source"))
    return back(judged(stored(with_metrics(docs), "quality")).where("kept"))


def op9_quality_rules(spark, sf_dir) -> DataFrame:
    """Contract query: counts, base verdict and adaptive verdict of every document.

    One row for each row of the table, repeated rows included; a null text has no words and fails the base, null languages
    and sources are groups of their own, an empty table gives no rows."""
    metrics = cut(with_metrics(documents(spark, sf_dir)).drop("text", "n_chars"))
    return judged(metrics).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        *[f"r_{k}" for k in RATIOS], *[f"t_{k}" for k in RATIOS],
    )


def op9_sql() -> str:
    ratio = lambda a, prior: f"((10000 * ({a} + {prior})) // greatest(n_words + {prior}, 1))::BIGINT"
    quote = lambda s: s.replace("'", "''")
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    levels = []
    for name, keys in (("source", "lang, source"), ("lang", "lang"), ("all", "")):
        comma = f"{keys}, " if keys else ""
        wide = ", ".join(f"max(CASE ratio WHEN '{k}' THEN q3 END) AS {name}_{k}, max(CASE ratio WHEN '{k}' THEN q3 - q1 END) AS {name}_{k}_wide" for k in RATIOS)
        levels.append(f"""
        {name}_m AS (SELECT {comma}ratio, bin, sum(n) AS n FROM bins GROUP BY ALL),
        {name}_c AS (SELECT *, sum(n) OVER (PARTITION BY {comma}ratio ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY {comma}ratio) AS tot FROM {name}_m),
        {name}_q AS (SELECT {comma}ratio, min(CASE WHEN 4 * upto >= tot THEN bin END) AS q1, min(CASE WHEN 4 * upto >= 3 * tot THEN bin END) AS q3, max(tot) AS rows_ FROM {name}_c GROUP BY ALL),
        {name}_w AS (SELECT {comma}{wide}, max(rows_) AS {name}_rows FROM {name}_q GROUP BY ALL)""")
    pick = ", ".join(
        f"CASE WHEN source_rows >= {GROUP_ROWS} THEN source_{k} WHEN lang_rows >= {GROUP_ROWS} THEN lang_{k} ELSE all_{k} END + {FENCE} * greatest(source_{k}_wide, lang_{k}_wide, all_{k}_wide) AS t_{k}" for k in RATIOS
    )
    above = " OR ".join(f"({count} > 0 AND r_{k} > t_{k})" for k, count in RATIOS.items())
    return f"""
    WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, row_number() OVER () AS rid FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^ \\x09-\\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: trim(x, {ws}) <> '') AS ls FROM d),
    runs AS (SELECT rid, i, ws[i] || chr(32) || ws[i+1] || chr(32) || ws[i+2] || chr(32) || ws[i+3] || chr(32) || ws[i+4] AS r
             FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
    twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, r) AS c FROM runs) WHERE c > 1),
    cover AS (SELECT rid, sum(least(5, i - coalesce(p, i - 5))) AS n FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM twice) GROUP BY rid),
    m AS (SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
            length(translate(t, {ws}, ''))::BIGINT AS word_chars, (length(t) - length(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
            (length(t) - length(translate(t, '{quote(PUNCTUATION)}', '')))::BIGINT AS n_punctuation, coalesce(n, 0)::BIGINT AS n_repeat_words
          FROM w LEFT JOIN cover USING (rid)),
    f AS (SELECT *, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
            {ratio('n_symbols', PRIOR)} AS r_symbols, {ratio('n_dup_lines', PRIOR)} AS r_dup_lines, {ratio('n_punctuation', 0)} AS r_punctuation FROM m),
    bins AS (SELECT lang, source, ratio, bin, count(*) AS n FROM (
        {' UNION ALL '.join(f"SELECT lang, source, '{k}' AS ratio, least({RATIO_TOP}, r_{k})::INT AS bin FROM f" for k in RATIOS)}) GROUP BY ALL),
    {', '.join(levels)},
    lim AS (SELECT s.lang, s.source, {pick} FROM source_w s JOIN lang_w l ON s.lang IS NOT DISTINCT FROM l.lang CROSS JOIN all_w)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND NOT coalesce({above}, false)) AS kept,
      {', '.join(f'r_{k}' for k in RATIOS)}, {', '.join(f't_{k}::INT AS t_{k}' for k in RATIOS)}
    FROM f JOIN lim ON f.lang IS NOT DISTINCT FROM lim.lang AND f.source IS NOT DISTINCT FROM lim.source"""
