"""Queries: reconciliation, ordering, sampling caps, catalogue, digests and word lists."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from inkwell.functions import text
from inkwell.operators import digest, reconcile
from inkwell.plans.splits import SAMPLES_SQL, samples
from inkwell.registry import Registry, table

registry = Registry()
query = registry.query

CURRENT_SQL = f"SELECT upper(filename) AS filename, label, writer FROM ({SAMPLES_SQL}) WHERE day < DATE '2000-07-01'"
INCOMING_SQL = f"SELECT filename, CASE WHEN price > 450000 THEN 'changed' ELSE label END AS label, writer FROM ({SAMPLES_SQL}) WHERE day >= DATE '1996-01-01'"


def snapshots(spark, sf):
    rows = samples(spark, sf)
    current = rows.where("day < DATE '2000-07-01'").select(F.upper("filename").alias("filename"), "label", "writer")
    incoming = rows.where("day >= DATE '1996-01-01'").select("filename", F.when(F.col("price") > 450000, "changed").otherwise(F.col("label")).alias("label"), "writer")
    return incoming, current


@query(f"""SELECT coalesce(i.filename, c.filename) AS filename, CASE WHEN c.filename IS NULL THEN 'copied' WHEN i.filename IS NULL THEN 'removed' WHEN i.label = c.label AND i.writer = c.writer THEN 'unchanged' ELSE 'changed' END AS action
FROM ({INCOMING_SQL}) i FULL JOIN ({CURRENT_SQL}) c ON lower(i.filename) = lower(c.filename)""")
def reconcile_plan(spark, sf):
    incoming, current = snapshots(spark, sf)
    return reconcile.plan(incoming, current, "filename", ["label", "writer"])


@query(f"""SELECT i.filename, c.filename AS taken_by FROM ({INCOMING_SQL}) i JOIN ({CURRENT_SQL}) c ON lower(i.filename) = lower(c.filename) AND i.filename <> c.filename WHERE i.label = 'changed'""")
def destination_collisions(spark, sf):
    incoming, current = snapshots(spark, sf)
    planned = incoming.where("label = 'changed'").select("filename", F.col("filename").alias("own"))
    return reconcile.collisions(planned, current.select("filename", F.col("filename").alias("path")), "filename", "own", "path").select("filename", "taken_by")


@query(f"""WITH u AS ({CURRENT_SQL}), l AS (SELECT upper(filename) AS filename, CASE WHEN price > 450000 THEN 'changed' ELSE label END AS label, writer FROM ({SAMPLES_SQL}) WHERE day >= DATE '1996-01-01')
SELECT filename, label, writer, 'unified' AS state FROM u UNION ALL SELECT filename, label, writer, 'legacy' FROM l WHERE filename NOT IN (SELECT filename FROM u)
UNION ALL SELECT l.filename, l.label, l.writer, 'conflict' FROM l JOIN u USING (filename) WHERE l.label <> u.label OR l.writer <> u.writer""")
def legacy_combine(spark, sf):
    incoming, current = snapshots(spark, sf)
    return reconcile.combine(current, incoming.withColumn("filename", F.upper("filename")), "filename", ["label", "writer"])


@query(f"""WITH e AS (SELECT filename, label, split FROM ({SAMPLES_SQL})), v AS (SELECT filename, CASE WHEN price > 499000 THEN 'x' ELSE label END AS label, split FROM ({SAMPLES_SQL}) WHERE price > 3000)
(SELECT *, 'missing' AS side FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM v)) UNION ALL (SELECT *, 'extra' FROM (SELECT * FROM v EXCEPT ALL SELECT * FROM e))""")
def labels_view_diff(spark, sf):
    rows = samples(spark, sf)
    view = rows.where("price > 3000").select("filename", F.when(F.col("price") > 499000, "x").otherwise(F.col("label")).alias("label"), "split")
    return reconcile.view_difference(view, rows.select("filename", "label", "split"))


@query(f"SELECT split, source, count(*) AS n FROM ({SAMPLES_SQL}) GROUP BY ALL UNION ALL SELECT split, 'all', count(*) FROM ({SAMPLES_SQL}) GROUP BY split")
def manifest_union(spark, sf):
    rows = samples(spark, sf).select("split", "source")
    return rows.unionByName(rows.withColumn("source", F.lit("all"))).groupBy("split", "source").agg(F.count("*").alias("n"))


@query(f"""WITH o AS (SELECT filename, split, source, sample_id, CASE split WHEN 'train' THEN 0 WHEN 'val' THEN 1 ELSE 2 END AS k FROM ({SAMPLES_SQL}))
SELECT filename, row_number() OVER (ORDER BY CASE source WHEN 'synthetic' THEN 0 ELSE 1 END, CASE WHEN source = 'synthetic' THEN sample_id END, CASE WHEN source = 'real' THEN k END, lower(filename), filename) AS place FROM o""")
def manifest_order(spark, sf):
    """Synthetic rows in their order, then real ones by split and name.  A rank within each of the
    four blocks and the blocks' sizes give the place, so no block waits for another."""
    rows = samples(spark, sf).select("filename", "source", "split", "sample_id")
    block = F.when(F.col("source") == "synthetic", 0).when(F.col("split") == "train", 1).when(F.col("split") == "val", 2).otherwise(3)
    rows = rows.withColumn("block", block).withColumn("bucket", F.expr("sample_id div 4096"))
    counts = rows.groupBy("block", "bucket").agg(F.count("*").alias("n"))
    starts = counts.withColumn("start", F.coalesce(F.sum("n").over(W.orderBy("block", "bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("n")
    inside = F.row_number().over(W.partitionBy("block", "bucket").orderBy("sample_id"))
    return rows.withColumn("r", inside).join(starts, ["block", "bucket"]).select("filename", (F.col("start") + F.col("r")).alias("place"))


@query("SELECT event_id, event_type, user_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id % 10 ORDER BY event_id) AS r FROM events) WHERE r = 1 ORDER BY event_id LIMIT 24")
def montage_pick(spark, sf):
    """The first row of each kind in file order, 24 at most (the montage's size)."""
    rows = table(spark, sf, "events").groupBy("event_type", (F.col("user_id") % 10).alias("g")).agg(F.min(F.struct("event_id", "user_id")).alias("x"))
    return rows.select("x.event_id", "event_type", "x.user_id").orderBy("event_id").limit(24)


@query(f"SELECT split, filename FROM (SELECT split, filename, row_number() OVER (PARTITION BY split ORDER BY filename) AS r FROM ({SAMPLES_SQL})) WHERE r <= 170 ORDER BY split, filename LIMIT 512")
def stats_sample_cap(spark, sf):
    """The statistics artefact reads 170 files of each split, 512 in all."""
    rows = samples(spark, sf).select("split", "filename", F.row_number().over(W.partitionBy("split").orderBy("filename")).alias("r"))
    return rows.where("r <= 170").orderBy("split", "filename").limit(512).select("split", "filename")


@query("SELECT max(x) AS latest, max(x) + 1 AS next_id, count(DISTINCT x) AS claimed FROM (SELECT regexp_extract(p_brand, '#([0-9]+)$', 1)::BIGINT AS x FROM part)")
def latest_and_next_id(spark, sf):
    x = F.regexp_extract("p_brand", "#([0-9]+)$", 1).cast("long")
    return table(spark, sf, "part").select(x.alias("x")).agg(F.max("x").alias("latest"), (F.max("x") + 1).alias("next_id"), F.count_distinct("x").alias("claimed"))


RESERVED_SQL = ", ".join(f"'{r}'" for r in text.RESERVED)
NAMES_SQL = "SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS s FROM pages UNION ALL SELECT * FROM (VALUES ('7'), (' 42 '), ('0012'), ('12345'), ('con'), ('Aux.txt'), ('a/b'), ('trailing.'), ('fine name'), (''))"


@query(rf"""WITH n AS (SELECT DISTINCT s, trim(s) AS t FROM ({NAMES_SQL})), w AS (SELECT s, CASE WHEN regexp_matches(t, '^[0-9]{{1,9}}$') THEN 'dataset_' || CASE WHEN length(t::INT::VARCHAR) < 3 THEN lpad(t::INT::VARCHAR, 3, '0') ELSE t::INT::VARCHAR END ELSE t END AS d FROM n)
SELECT s AS requested, CASE WHEN length(d) <= 200 AND regexp_matches(d, '^[A-Za-z0-9][A-Za-z0-9._ -]*$') AND NOT regexp_matches(d, '[. ]$') AND lower(string_split(d, '.')[1]) NOT IN ({RESERVED_SQL}) THEN d END AS name FROM w""")
def dataset_name_normalise(spark, sf):
    hosts = table(spark, sf, "pages").select(F.regexp_extract("url", "^https?://([^/]+)", 1).alias("requested"))
    more = spark.createDataFrame([(x,) for x in ("7", " 42 ", "0012", "12345", "con", "Aux.txt", "a/b", "trailing.", "fine name", "")], "requested string")
    return hosts.union(more).distinct().select("requested", text.dataset_name(F.col("requested")).alias("name"))


@query("SELECT doc_id, sha256(text) AS digest, strlen(text)::BIGINT AS bytes FROM documents")
def content_digest_per_row(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), F.octet_length("text").cast("long").alias("bytes"))


FRAME_SQL = "unhex(string_agg(lpad(hex(strlen({n})), 16, '0') || hex({n}) || hex({c}), '' ORDER BY {o}))"


@query(f"WITH x AS (SELECT printf('%05d.txt', item_id) AS n, text AS c, CASE item_id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS k FROM benchmark) SELECT count(*) AS files, sha256({FRAME_SQL.format(n='n', c='c', o='k, n')}) AS digest FROM x")
def content_digest_ordered(spark, sf):
    b = table(spark, sf, "benchmark").select(F.format_string("%05d.txt", "item_id").alias("n"), F.encode("text", "utf-8").alias("c"), (F.col("item_id") % 3).alias("k"))
    return digest.ordered_digest(b, [], [F.col("k"), F.encode("n", "utf-8")], F.col("n"), F.col("c"))


@query("WITH w AS (SELECT conv_id * 1000 + turn AS pos, trim(word) AS word FROM (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word FROM conversations)) SELECT word, min(pos) AS first_pos, count(*) AS n FROM w WHERE word <> '' GROUP BY word")
def word_list_dedup(spark, sf):
    words = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("pos"), F.explode(F.split("text", " ")).alias("word"))
    words = words.withColumn("word", F.btrim("word", F.lit(" "))).where("word <> ''")
    return words.groupBy("word").agg(F.min("pos").alias("first_pos"), F.count("*").alias("n"))


@query("SELECT DISTINCT c AS character FROM (SELECT unnest(string_split(regexp_replace(text, '\\s', '', 'g'), '')) AS c FROM benchmark) WHERE c <> '' UNION SELECT unnest(string_split('0123456789/-.,''', ''))")
def character_vocabulary(spark, sf):
    chars = table(spark, sf, "benchmark").select(F.explode(F.split(F.regexp_replace("text", r"\s", ""), "")).alias("character"))
    fixed = spark.createDataFrame([(c,) for c in "0123456789/-.,'"], "character string")
    return chars.where("character <> ''").union(fixed).distinct()


@query("SELECT doc_id, lower(source) AS name FROM documents WHERE n_chars < 300 OR lower(source) NOT IN (SELECT DISTINCT 'src' || (s_suppkey % 5) FROM supplier)")
def blocklist_exclusion(spark, sf):
    """Names on the list go, whatever their case; seeds stay."""
    blocked = table(spark, sf, "supplier").select(F.concat(F.lit("src"), (F.col("s_suppkey") % 5).cast("string")).alias("name")).distinct()
    d = table(spark, sf, "documents").select("doc_id", "n_chars", F.lower("source").alias("name"))
    return d.where("n_chars < 300").select("doc_id", "name").unionByName(d.where("n_chars >= 300").join(blocked, "name", "left_anti").select("doc_id", "name"))
