"""Queries: integrity rules, duplicates, anti-joins and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import stats, validate
from inkwell.plans.splits import SAMPLES_SQL, samples
from inkwell.registry import Registry, table

registry = Registry()
query = registry.query

LEAF_SQL = r"(f <> '' AND f NOT IN ('.', '..') AND NOT regexp_matches(f, '[/\\]') AND NOT regexp_matches(f, '^[A-Za-z]:'))"
STRIP = r"regexp_replace({0}, '^\s+|\s+$', '', 'g')"


@query(rf"""WITH x AS (SELECT page_id, regexp_replace(url, '^https?://[^/]+', '') AS f FROM pages UNION ALL SELECT page_id + 1000000, regexp_extract(url, '([^/]*)$', 1) || '.PNG' FROM pages)
SELECT page_id, f AS name, {LEAF_SQL} AS leaf, lower(f) LIKE '%.png' AS png, ({LEAF_SQL} AND f = {STRIP.format('f')} AND lower(f) LIKE '%.png') AS leaf_png FROM x""")
def leaf_filename_rules(spark, sf):
    pages = table(spark, sf, "pages")
    tail = pages.select("page_id", F.regexp_replace("url", "^https?://[^/]+", "").alias("name"))
    last = pages.select((F.col("page_id") + 1000000).alias("page_id"), F.concat(F.regexp_extract("url", "([^/]*)$", 1), F.lit(".PNG")).alias("name"))
    c = F.col("name")
    return tail.union(last).select("page_id", "name", text.is_leaf(c).alias("leaf"), F.lower(c).endswith(".png").alias("png"), text.is_leaf_png(c).alias("leaf_png"))


MANIFEST_SQL = """SELECT doc_id AS line_number, CASE WHEN doc_id % 17 = 0 THEN 'a/' || doc_id || '.png' WHEN doc_id % 19 = 0 THEN doc_id || '.jpg' ELSE doc_id || '.png' END AS filename,
 CASE WHEN doc_id % 23 = 0 THEN ' ' WHEN doc_id % 29 = 0 THEN 'Unreadable' ELSE text END AS label, CASE WHEN doc_id % 31 = 0 THEN 'dev' WHEN doc_id % 5 = 0 THEN 'test' ELSE 'train' END AS split,
 CASE WHEN doc_id % 37 = 0 THEN 'scan' WHEN doc_id % 4 = 0 THEN 'real' ELSE 'synthetic' END AS source, CASE WHEN doc_id % 13 = 0 THEN '' ELSE lang END AS field_type,
 CASE WHEN doc_id % 26 = 0 THEN '' ELSE source END AS font, CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'regular' END AS sample_mode,
 CASE WHEN doc_id % 4 = 0 AND doc_id % 3 > 0 OR doc_id % 41 = 0 THEN 'W' || (doc_id % 50) ELSE '' END AS writer_id, CASE WHEN doc_id % 43 = 0 THEN '2' ELSE '1' END AS schema_version FROM documents"""


def faulty_manifest(spark, sf):
    d, i = table(spark, sf, "documents"), F.col("doc_id")
    s = i.cast("string")
    every = lambda n: i % n == 0
    return d.select(
        i.alias("line_number"), F.when(every(17), F.concat(F.lit("a/"), s, F.lit(".png"))).when(every(19), F.concat(s, F.lit(".jpg"))).otherwise(F.concat(s, F.lit(".png"))).alias("filename"),
        F.when(every(23), " ").when(every(29), "Unreadable").otherwise(F.left(F.col("text"), F.lit(20))).alias("label"),
        F.when(every(31), "dev").when(every(5), "test").otherwise("train").alias("split"), F.when(every(37), "scan").when(every(4), "real").otherwise("synthetic").alias("source"),
        F.when(every(13), "").otherwise(F.col("lang")).alias("field_type"), F.when(every(26), "").otherwise(F.col("source")).alias("font"),
        F.when(every(11), "").otherwise("regular").alias("sample_mode"),
        F.when(every(4) & (i % 3 > 0) | every(41), F.concat(F.lit("W"), (i % 50).cast("string"))).otherwise("").alias("writer_id"), F.when(every(43), "2").otherwise("1").alias("schema_version"),
    )


RULES_SQL = rf"""m AS ({MANIFEST_SQL}), r AS (SELECT *, filename AS f FROM m), found AS (
 SELECT 'filename' AS code, line_number, filename AS key, 'not a plain .png file name' AS message FROM r WHERE NOT {LEAF_SQL} OR lower(f) NOT LIKE '%.png'
 UNION ALL SELECT 'split', line_number, filename, 'unknown split ' || split FROM r WHERE split NOT IN ('train', 'val', 'test')
 UNION ALL SELECT 'source', line_number, filename, 'unknown source ' || source FROM r WHERE source NOT IN ('synthetic', 'real')
 UNION ALL SELECT 'label', line_number, filename, 'label is blank or unreadable' FROM r WHERE {STRIP.format('label')} = '' OR upper({STRIP.format('label')}) = 'UNREADABLE'
 UNION ALL SELECT 'schema_version', line_number, filename, 'unknown version ' || schema_version FROM r WHERE schema_version <> '1'
 UNION ALL SELECT 'writer_id', line_number, filename, 'a real sample needs a writer' FROM r WHERE source = 'real' AND writer_id = ''
 UNION ALL SELECT 'writer_id', line_number, filename, 'a synthetic sample has no writer' FROM r WHERE source = 'synthetic' AND writer_id <> ''
 UNION ALL SELECT 'synthetic_fields', line_number, filename, 'missing ' || concat_ws(', ', CASE WHEN field_type = '' THEN 'field_type' END, CASE WHEN font = '' THEN 'font' END, CASE WHEN sample_mode = '' THEN 'sample_mode' END)
   FROM r WHERE source = 'synthetic' AND (field_type = '' OR font = '' OR sample_mode = ''))"""


@query(f"WITH {RULES_SQL} SELECT code, line_number, key, message FROM found")
def row_rule_diagnostics(spark, sf):
    return validate.row_rules(faulty_manifest(spark, sf))


@query(f"WITH {RULES_SQL}, c AS (SELECT code, count(*) AS findings FROM found GROUP BY code) SELECT code, findings, greatest(0, least(findings, 100 - coalesce(sum(findings) OVER (ORDER BY code ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)))::BIGINT AS kept FROM c")
def diagnostics_report(spark, sf):
    return validate.report(validate.row_rules(faulty_manifest(spark, sf)), 100)


@query(rf"WITH m AS ({MANIFEST_SQL}), r AS (SELECT *, filename AS f FROM m) SELECT split, source, count(*) AS n FROM r WHERE {LEAF_SQL} AND lower(f) LIKE '%.png' AND split IN ('train', 'val', 'test') GROUP BY split, source")
def eligible_counts(spark, sf):
    rows = faulty_manifest(spark, sf)
    return rows.where(validate.eligible()).groupBy("split", "source").agg(F.count("*").alias("n"))


@query("SELECT doc_id, rank::INT AS rank, first_line FROM (SELECT doc_id, row_number() OVER w AS rank, first(doc_id) OVER w AS first_line FROM documents WINDOW w AS (PARTITION BY md5(text) ORDER BY doc_id)) WHERE rank > 1")
def duplicate_filenames(spark, sf):
    return validate.later_duplicates(table(spark, sf, "documents").select("doc_id", F.md5("text").alias("h")), F.col("h"), "doc_id").select("doc_id", "rank", "first_line")


@query("""WITH f AS (SELECT *, row_number() OVER w AS r, first(l_returnflag) OVER w AS a, first(l_linestatus) OVER w AS b, first(l_quantity) OVER w AS c FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice)),
d AS (SELECT l_orderkey, l_linenumber, l_partkey, concat_ws(',', CASE WHEN l_returnflag <> a THEN 'l_returnflag' END, CASE WHEN l_linestatus <> b THEN 'l_linestatus' END, CASE WHEN l_quantity <> c THEN 'l_quantity' END) AS differing FROM f WHERE r > 1)
SELECT l_orderkey, l_linenumber, l_partkey, differing, CASE WHEN differing = '' THEN 'duplicate' ELSE 'conflict' END AS verdict FROM d""")
def duplicate_conflicts(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus", "l_quantity", F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("line"))
    out = validate.conflicts(rows, ["l_orderkey"], "line", ["l_returnflag", "l_linestatus", "l_quantity"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "differing", "verdict")


STATUS_SQL = "SELECT o_custkey AS writer, CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'test' END AS split FROM orders"


def status_splits(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("writer"), F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "val").otherwise("test").alias("split"))


@query(f"SELECT writer, string_agg(split, ',' ORDER BY split) AS splits FROM (SELECT DISTINCT writer, split FROM ({STATUS_SQL})) GROUP BY writer HAVING count(*) > 1")
def writer_cross_split(spark, sf):
    return validate.crossing(status_splits(spark, sf), "writer", "split")


@query(f"WITH d AS (SELECT DISTINCT writer, split FROM ({STATUS_SQL})) SELECT a.split AS split_a, b.split AS split_b, count(*) AS writers FROM d a JOIN d b ON a.writer = b.writer AND a.split < b.split GROUP BY ALL")
def writer_overlap_pairs(spark, sf):
    """A writer has three splits at most, so its pairs come from the sorted set of its splits."""
    sets = status_splits(spark, sf).groupBy("writer").agg(F.sort_array(F.collect_set("split")).alias("s"))
    pairs = F.flatten(F.transform("s", lambda a: F.transform(F.filter("s", lambda b: b > a), lambda b: F.struct(a.alias("split_a"), b.alias("split_b")))))
    return sets.select(F.inline(pairs)).groupBy("split_a", "split_b").agg(F.count("*").alias("writers"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_rows(spark, sf):
    return validate.unmatched(table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), ["doc_id"])


@query("SELECT doc_id, quality FROM (SELECT doc_id + CASE WHEN doc_id % 7 = 0 THEN 100000000 ELSE 0 END AS doc_id, quality FROM labels) WHERE doc_id NOT IN (SELECT doc_id FROM documents)")
def orphan_rows(spark, sf):
    moved = table(spark, sf, "labels").select((F.col("doc_id") + F.when(F.col("doc_id") % 7 == 0, 100000000).otherwise(0)).alias("doc_id"), "quality")
    return validate.unmatched(moved, table(spark, sf, "documents"), ["doc_id"])


@query(f"SELECT split, source, count(*) AS n, count(DISTINCT writer) AS writers FROM ({SAMPLES_SQL}) GROUP BY split, source")
def split_source_counts(spark, sf):
    return samples(spark, sf).groupBy("split", "source").agg(F.count("*").alias("n"), F.count_distinct("writer").alias("writers"))


@query(f"SELECT split, sum((source = 'real')::INT)::BIGINT AS real, sum((source = 'synthetic')::INT)::BIGINT AS synthetic FROM ({SAMPLES_SQL}) GROUP BY split")
def split_source_crosstab(spark, sf):
    return stats.crosstab(samples(spark, sf), "split", "source", ["real", "synthetic"])


@query("SELECT CASE WHEN coalesce(lang, '') = '' THEN 'unspecified' ELSE lang END AS field_type, count(*) AS n, min(doc_id) AS first_seen FROM documents GROUP BY 1")
def field_type_counts(spark, sf):
    from inkwell.operators.metrics import named

    out = table(spark, sf, "documents").groupBy(named(F.col("lang")).alias("field_type")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_seen"))
    return out.orderBy(F.desc("n"), "first_seen")


@query("SELECT event_type AS mode, count(*) AS n FROM events GROUP BY event_type")
def mode_counts(spark, sf):
    return table(spark, sf, "events").groupBy(F.col("event_type").alias("mode")).agg(F.count("*").alias("n"))


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS p5, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, min(l_extendedprice) AS least, max(l_extendedprice) AS most FROM lineitem GROUP BY l_returnflag""")
def metric_percentiles(spark, sf):
    out = stats.percentiles(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.95])
    return out.select("l_returnflag", *[F.round(p, 6).alias(p) for p in ("p5", "p50", "p95")], "least", "most")


@query("""SELECT l_linestatus, metric, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS sd, min(value) AS least, max(value) AS most
FROM (UNPIVOT (SELECT l_linestatus, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem) ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME metric VALUE value) GROUP BY l_linestatus, metric""")
def metric_moments(spark, sf):
    out = stats.moments(table(spark, sf, "lineitem"), ["l_linestatus"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return out.select("l_linestatus", "metric", "n", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"), "least", "most")


@query("""WITH m AS (SELECT l_returnflag AS g, metric, avg(value) AS mean, stddev_pop(value) AS sd FROM (UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount FROM lineitem) ON l_quantity, l_extendedprice, l_discount INTO NAME metric VALUE value) GROUP BY ALL)
SELECT a.metric, round(a.mean - b.mean, 6) AS difference, round(CASE WHEN sqrt((a.sd * a.sd + b.sd * b.sd) / 2) > 1e-12 THEN (a.mean - b.mean) / sqrt((a.sd * a.sd + b.sd * b.sd) / 2) END, 6) AS standardized FROM m a JOIN m b USING (metric) WHERE a.g = 'A' AND b.g = 'R'""")
def group_standardized_difference(spark, sf):
    out = stats.compare(table(spark, sf, "lineitem"), "l_returnflag", "A", "R", ["l_quantity", "l_extendedprice", "l_discount"])
    return out.select("metric", F.round("difference", 6).alias("difference"), F.round("standardized", 6).alias("standardized"))
