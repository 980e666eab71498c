"""Queries: annotations, leakage, evaluation tags, error rates and training traces."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions.rand import chance, chance_sql
from inkwell.functions.text import tokens
from inkwell.operators import annotate, metrics, stats
from inkwell.operators.allocate import ordered_rank
from inkwell.plans.splits import SAMPLES_SQL, samples
from inkwell.registry import Registry, table

registry = Registry()
query = registry.query

HELD_FONT_SQL = chance_sql("unseen", "sample_mode || split || label", 30)
NOTES_SQL = f"""SELECT sample_id, split, source, field_type, label, CASE WHEN split = 'test' AND field_type IN ('date_written', 'date_numeric') THEN 'held_out_historical_date_v1' ELSE 'base' END AS format_profile,
 {HELD_FONT_SQL} AS font_held_out FROM ({SAMPLES_SQL})"""
PARTS_SQL = "concat_ws('+', CASE WHEN font_held_out THEN 'unseen_font' END, 'held_out_degradation', CASE WHEN field_type IN ('date_written', 'date_numeric') THEN 'held_out_format' END)"
CONDITION_SQL = f"CASE WHEN split = 'test' THEN 'synthetic_' || {PARTS_SQL} ELSE 'synthetic_in_domain' END"
SEEN_SQL = f"n AS ({NOTES_SQL}), c AS (SELECT *, {CONDITION_SQL} AS evaluation_condition, strftime(day, '%Y-%m-%d') || ' ' || label AS lab FROM n JOIN (SELECT sample_id, day FROM ({SAMPLES_SQL})) USING (sample_id)), t AS (SELECT DISTINCT lab FROM c WHERE split = 'train')"


def notes(spark, sf):
    rows = samples(spark, sf)
    held = chance("unseen", F.concat("sample_mode", "split", "label"), 30)
    rows = rows.select("sample_id", "split", "source", "field_type", "label", "day", annotate.format_profile(F.col("split"), F.col("field_type")).alias("format_profile"), held.alias("font_held_out"))
    return rows.withColumn("evaluation_condition", annotate.condition(F.col("split"), F.col("font_held_out"), F.col("field_type")))


@query(f"SELECT sample_id, split, format_profile, font_held_out, {CONDITION_SQL} AS evaluation_condition FROM ({NOTES_SQL})")
def evaluation_condition(spark, sf):
    return notes(spark, sf).select("sample_id", "split", "format_profile", "font_held_out", "evaluation_condition")


@query("SELECT o_orderkey, o_orderstatus, coalesce(quality, -1) AS quality, coalesce(lang, '') AS lang FROM orders LEFT JOIN documents ON o_orderkey = doc_id LEFT JOIN labels USING (doc_id)")
def annotation_join(spark, sf):
    notes_ = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    out = annotate.one_to_one(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), notes_.withColumnRenamed("doc_id", "o_orderkey"), ["o_orderkey"])
    return out.na.fill(-1, ["quality"]).select("o_orderkey", "o_orderstatus", "quality", "lang")


SEEN_DOCS_SQL = "SELECT doc_id, md5(text) AS h, source, CASE WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM documents"


@query(f"WITH d AS ({SEEN_DOCS_SQL}) SELECT doc_id, split, h IN (SELECT h FROM d WHERE split = 'train') AS label_seen_in_train, source IN (SELECT source FROM d WHERE split = 'train') AS font_seen_in_train FROM d")
def seen_in_train_flags(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"), "source", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("split"))
    d = annotate.seen_in_train(d, "h", "label_seen_in_train")
    return annotate.seen_in_train(d, "source", "font_seen_in_train").select("doc_id", "split", "label_seen_in_train", "font_seen_in_train")


@query(f"""WITH m AS (SELECT sample_id, split, field_type FROM ({SAMPLES_SQL}) WHERE price > 10000),
a AS (SELECT sample_id, CASE WHEN price > 480000 THEN 'base_v0' WHEN split = 'test' AND field_type IN ('date_written', 'date_numeric') THEN 'held_out_historical_date_v1' ELSE 'base' END AS format_profile FROM ({SAMPLES_SQL}) WHERE price < 490000)
SELECT sample_id, problem FROM (SELECT coalesce(m.sample_id, a.sample_id) AS sample_id, CASE WHEN a.sample_id IS NULL THEN 'missing annotation' WHEN m.sample_id IS NULL THEN 'orphan annotation'
 WHEN format_profile <> CASE WHEN split = 'test' AND field_type IN ('date_written', 'date_numeric') THEN 'held_out_historical_date_v1' ELSE 'base' END THEN 'unexpected format_profile' END AS problem FROM m FULL JOIN a ON m.sample_id = a.sample_id) WHERE problem IS NOT NULL""")
def annotation_gate(spark, sf):
    rows = samples(spark, sf)
    manifest = rows.where("price > 10000").select("sample_id", "split", "field_type")
    profile = annotate.format_profile(F.col("split"), F.col("field_type"))
    notes_ = rows.where("price < 490000").select("sample_id", F.when(F.col("price") > 480000, "base_v0").otherwise(profile).alias("format_profile"))
    return annotate.gate(manifest, notes_, ["sample_id"], {"format_profile": profile})


TAGS_SQL = f"""g AS (SELECT *, lab IN (SELECT lab FROM t) AS seen, CASE WHEN source = 'real' THEN ['real_handwriting'] WHEN split = 'test' THEN string_split(replace(evaluation_condition, 'synthetic_', ''), '+') ELSE [] END AS held FROM c)"""


def tagged(spark, sf):
    rows = notes(spark, sf).withColumn("lab", F.concat_ws(" ", F.date_format("day", "yyyy-MM-dd"), "label"))
    known = rows.where("split = 'train'").select("lab").distinct().withColumn("s", F.lit(True))
    return annotate.tags(rows.join(known, "lab", "left").withColumn("label_seen_in_train", F.coalesce("s", F.lit(False))).drop("s"))


@query(f"""WITH {SEEN_SQL}, {TAGS_SQL} SELECT sample_id, array_to_string(held, ',') AS held_out, CASE WHEN source = 'real' THEN 'real' WHEN len(held) > 0 THEN 'synthetic_held_out' ELSE 'synthetic_in_domain' END AS evaluation_domain,
 CASE WHEN seen THEN 'seen_label' ELSE 'unseen_label' END AS seen_unseen FROM g""")
def evaluation_tags(spark, sf):
    return tagged(spark, sf).select("sample_id", F.array_join("held_out_conditions", ",").alias("held_out"), "evaluation_domain", "seen_unseen")


@query(f"WITH {SEEN_SQL}, {TAGS_SQL}, x AS (SELECT unnest(CASE WHEN len(held) = 0 THEN [NULL] ELSE held END) AS h, seen FROM g) SELECT coalesce(h, 'unspecified') AS held_out_condition, count(*) AS n, sum(seen::INT)::BIGINT AS seen FROM x GROUP BY 1")
def held_out_condition_explode(spark, sf):
    rows = tagged(spark, sf).select(F.explode_outer("held_out_conditions").alias("h"), "label_seen_in_train")
    return rows.groupBy(metrics.named(F.col("h")).alias("held_out_condition")).agg(F.count("*").alias("n"), F.sum(F.col("label_seen_in_train").cast("long")).alias("seen"))


#: Benchmark passages against a disturbed copy, ASCII only, as the engines measure other letters differently.
PAIRS_SQL = r"""p AS (SELECT item_id, regexp_replace(text, '[^\x20-\x7e]', '', 'g') AS reference, CASE item_id % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'b' WHEN 2 THEN 'c' ELSE '' END AS grp, item_id % 3 AS style FROM benchmark),
q AS (SELECT *, CASE style WHEN 0 THEN reference WHEN 1 THEN replace(reference, 'e', 'c') ELSE substr(reference, 4) || 'xy' END AS prediction FROM p),
e AS (SELECT *, levenshtein(reference, prediction)::BIGINT AS ce, length(reference)::BIGINT AS rc, (reference = prediction)::INT::BIGINT AS ex, 's' || style AS domain FROM q)"""
RATES_SQL = "count(*) AS total, sum(ex)::BIGINT AS exact, round(avg(ex), 9) AS accuracy, round(CASE WHEN sum(rc) > 0 THEN sum(ce) / sum(rc) ELSE 0 END, 9) AS cer"


def pairs(spark, sf, words=False):
    b = table(spark, sf, "benchmark").select("item_id", F.regexp_replace("text", r"[^\x20-\x7e]", "").alias("reference"))
    style = F.col("item_id") % 3
    guess = F.when(style == 0, F.col("reference")).when(style == 1, F.replace("reference", F.lit("e"), F.lit("c"))).otherwise(F.concat(F.substr("reference", F.lit(4)), F.lit("xy")))
    group = F.element_at(F.array(*[F.lit(x) for x in ("a", "b", "c", "")]), (F.col("item_id") % 4 + 1).cast("int"))
    return metrics.with_edits(b.withColumns({"prediction": guess, "grp": group, "domain": F.concat(F.lit("s"), style.cast("string"))}), words=words)


def rounded(df, *names):
    return df.withColumns({n: F.round(n, 9) for n in names})


@query(f"WITH {PAIRS_SQL} SELECT CASE WHEN grp = '' THEN 'unspecified' ELSE grp END AS \"group\", {RATES_SQL} FROM e GROUP BY 1")
def cer_by_group(spark, sf):
    return rounded(metrics.grouped(pairs(spark, sf), "grp", words=False), "accuracy", "cer")


@query(f"""WITH {PAIRS_SQL}, s AS (SELECT 'overall' AS breakdown, 'all' AS "group", * FROM e UNION ALL SELECT 'grp', CASE WHEN grp = '' THEN 'unspecified' ELSE grp END, * FROM e UNION ALL SELECT 'domain', domain, * FROM e)
SELECT breakdown, "group", {RATES_SQL} FROM s GROUP BY ALL""")
def metric_breakdowns(spark, sf):
    return rounded(metrics.breakdowns(pairs(spark, sf), ["grp", "domain"]), "accuracy", "cer")


@query(f"WITH {PAIRS_SQL}, r AS (SELECT grp, sum(CASE WHEN style = 1 THEN ce ELSE 0 END) AS base, sum(CASE WHEN style = 2 THEN ce ELSE 0 END) AS tuned FROM e GROUP BY grp) SELECT grp, CASE WHEN base = tuned THEN 'same' WHEN tuned < base THEN 'better' ELSE 'worse' END AS cer_verdict, CASE WHEN base = tuned THEN 'same' WHEN tuned > base THEN 'better' ELSE 'worse' END AS accuracy_verdict FROM r")
def base_vs_tuned_verdict(spark, sf):
    both = pairs(spark, sf).groupBy("grp").agg(*[F.sum(F.when(F.col("domain") == d, F.col("char_edits")).otherwise(0)).alias(n) for d, n in (("s1", "base"), ("s2", "tuned"))])
    return both.select("grp", metrics.verdict(F.col("base"), F.col("tuned"), True).alias("cer_verdict"), metrics.verdict(F.col("base"), F.col("tuned"), False).alias("accuracy_verdict"))


@query()
def wer_by_group(spark, sf):
    """Word error rate of each whole reply against the turn before it, by role; no word-level distance in the oracle's SQL."""
    t = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    before = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    both = t.withColumnRenamed("text", "prediction").join(before, ["conv_id", "turn"])
    return rounded(metrics.grouped(metrics.with_edits(both), "role"), "accuracy", "cer", "wer")


@query("SELECT d.lang, count(*) AS pairs, sum((a.text = d.text)::INT)::BIGINT AS exact FROM documents d JOIN documents a ON a.doc_id = d.doc_id - 1 GROUP BY d.lang")
def exact_match_rate(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", F.xxhash64("text").alias("h"), F.length("text").alias("n"))
    prior = d.select((F.col("doc_id") + 1).alias("doc_id"), F.struct("h", "n").alias("p"))
    return d.join(prior, "doc_id").groupBy("lang").agg(F.count("*").alias("pairs"), F.sum((F.struct("h", "n") == F.col("p")).cast("long")).alias("exact"))


@query(r"""WITH n AS (SELECT doc_id, lang, len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''))::BIGINT AS n FROM documents)
SELECT lang, max(n) AS most, round(quantile_cont(n, 0.95), 6) AS p95, round(quantile_cont(n, 0.99), 6) AS p99, sum((n > 512)::INT)::BIGINT AS violations, string_agg(CASE WHEN r <= 5 AND n > 512 THEN doc_id::VARCHAR END, ',' ORDER BY doc_id) AS first_five
FROM (SELECT *, row_number() OVER (PARTITION BY lang, n > 512 ORDER BY doc_id) AS r FROM n) GROUP BY lang""")
def token_length_audit(spark, sf):
    """The first violations are a minimum per group and step of the window's limit, not a sort of all rows."""
    from pyspark.sql import Window as W

    n = table(spark, sf, "documents").select("doc_id", "lang", F.size(tokens(F.col("text"))).cast("long").alias("n"))
    over = n.where("n > 512").withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("doc_id"))).where("r <= 5")
    first = over.groupBy("lang").agg(F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("first_five"))
    sums = stats.percentiles(n, ["lang"], "n", [0.95, 0.99], ["p95", "p99"]).select("lang", F.col("most").cast("long").alias("most"), *[F.round(p, 6).alias(p) for p in ("p95", "p99")])
    over = n.groupBy("lang").agg(F.count_if(F.col("n") > 512).alias("violations"))
    same = F.col("lang").eqNullSafe(F.col("_lang"))
    out = sums.join(over.withColumnRenamed("lang", "_lang"), same).drop("_lang")
    return out.join(first.withColumnRenamed("lang", "_lang"), same, "left").drop("_lang")


@query("""WITH d AS (SELECT ts::DATE AS day, round(avg(value), 9) AS cer FROM events GROUP BY 1), a AS (SELECT *, min(cer) OVER (ORDER BY day) AS best, min(cer) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM d),
b AS (SELECT *, prev IS NULL OR cer < prev AS improved FROM a), c AS (SELECT *, sum(improved::INT) OVER (ORDER BY day) AS run FROM b), e AS (SELECT *, sum((NOT improved)::INT) OVER (PARTITION BY run ORDER BY day)::BIGINT AS stale FROM c)
SELECT day, cer, best, improved, stale, coalesce(max(stale >= 3) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stopped FROM e""")
def early_stopping_trace(spark, sf):
    days = table(spark, sf, "events").groupBy(F.to_date("ts").alias("day")).agg(F.round(F.avg("value"), 9).alias("cer"))
    return metrics.early_stopping(days, "day", "cer", 3)


@query("""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS step FROM orders) SELECT o_orderkey, step, (step - 1) // 16 AS grp, count(*) OVER (PARTITION BY (step - 1) // 16) AS size FROM r""")
def accumulation_groups(spark, sf):
    from pyspark.sql import Window as W

    rows = ordered_rank(table(spark, sf, "orders").select("o_orderkey"), [], "o_orderkey", [], "step")
    rows = rows.withColumn("grp", F.floor((F.col("step") - 1) / 16))
    return rows.withColumn("size", F.count("*").over(W.partitionBy("grp")))
