"""Queries: order and zip checks, view reports, vocabularies, names, nine breakdowns, ink boxes, bucketed digests."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from inkwell.functions import text, words
from inkwell.functions.rand import pick, pick_sql
from inkwell.operators import annotate, digest, handoff, images, metrics, policy, reconcile
from inkwell.plans.evaluation import PAIRS_SQL, RATES_SQL, SEEN_SQL, TAGS_SQL, pairs, rounded, tagged
from inkwell.plans.generation import TRAITS, _trait_sql, gray
from inkwell.plans.splits import SAMPLES_SQL, samples
from inkwell.registry import Registry, table

registry = Registry()
query = registry.query


@query(f"""WITH m AS (SELECT sample_id AS place, filename FROM ({SAMPLES_SQL})), f AS (SELECT o_orderkey AS place, CASE WHEN o_totalprice > 400000 THEN 'other.png' ELSE printf('syn_%08d.png', o_orderkey) END AS filename FROM orders WHERE o_orderstatus <> 'P'
 UNION ALL SELECT max(o_orderkey) + 1, 'beyond.png' FROM orders), j AS (SELECT coalesce(m.place, f.place) AS place, coalesce(m.filename, f.filename) AS filename, CASE WHEN f.place IS NULL THEN 'missing' WHEN m.place IS NULL THEN 'extra' WHEN m.filename <> f.filename THEN 'different key' END AS problem FROM m FULL JOIN f ON m.place = f.place)
SELECT * FROM j WHERE problem IS NOT NULL""")
def positional_zip(spark, sf):
    """Manifest and format source must hold the same names at the same places; the source here lacks pending orders."""
    manifest = samples(spark, sf).select(F.col("sample_id").alias("place"), "filename")
    orders = table(spark, sf, "orders")
    name = F.when(F.col("o_totalprice") > 400000, "other.png").otherwise(F.format_string("syn_%08d.png", "o_orderkey"))
    formats = orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("place"), name.alias("filename"))
    beyond = orders.agg((F.max("o_orderkey") + 1).alias("place")).select("place", F.lit("beyond.png").alias("filename"))
    return handoff.zipped(manifest, formats.unionByName(beyond), "place", "filename")


@query(f"""WITH e AS (SELECT sample_id AS place, filename, label FROM ({SAMPLES_SQL})), c AS (SELECT o_orderkey AS place, printf('syn_%08d.png', o_orderkey) AS filename, CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice > 200000 THEN 'changed' ELSE o_orderpriority END AS label FROM orders WHERE o_totalprice > 2000),
j AS (SELECT coalesce(c.place, e.place) AS place, CASE WHEN c.place IS NULL THEN 'missing' WHEN e.place IS NULL THEN 'extra' WHEN c.filename <> e.filename OR c.label <> e.label THEN 'different row' END AS problem FROM c FULL JOIN e ON c.place = e.place) SELECT * FROM j WHERE problem IS NOT NULL""")
def prediction_order(spark, sf):
    """Cached predictions must be those of the current rows, in order."""
    expected = samples(spark, sf).select(F.col("sample_id").alias("place"), "filename", "label")
    o = table(spark, sf, "orders").where("o_totalprice > 2000")
    label = F.when((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") > 200000), "changed").otherwise(F.col("o_orderpriority"))
    cached = o.select(F.col("o_orderkey").alias("place"), F.format_string("syn_%08d.png", "o_orderkey").alias("filename"), label.alias("label"))
    return handoff.same_order(cached, expected, "place", ["filename", "label"])


VIEW_SQL = f"""e AS (SELECT filename, label FROM ({SAMPLES_SQL})), v AS (SELECT filename, CASE WHEN price > 300000 AND source = 'real' THEN 'x' ELSE label END AS label FROM ({SAMPLES_SQL}) WHERE price > 3000),
d AS ((SELECT *, 'missing' AS side FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM v)) UNION ALL (SELECT *, 'extra' FROM (SELECT * FROM v EXCEPT ALL SELECT * FROM e)))"""


@query(f"WITH {VIEW_SQL} SELECT side, count(*) AS n, array_to_string(list_sort(list(DISTINCT filename))[1:3], ',') AS first FROM d GROUP BY side")
def labels_view_report(spark, sf):
    """How far a stored view is from its projection, with up to three names a side."""
    rows = samples(spark, sf)
    changed = F.when((F.col("price") > 300000) & (F.col("source") == "real"), "x").otherwise(F.col("label"))
    view = rows.where("price > 3000").select("filename", changed.alias("label"))
    return handoff.difference_report(reconcile.view_difference(view, rows.select("filename", "label")), "filename")


@query(f"WITH {VIEW_SQL} SELECT (SELECT count(*) FROM d) = 0 AS equal, (SELECT count(*) FROM d WHERE side = 'missing') AS missing, (SELECT count(*) FROM d WHERE side = 'extra') AS extra")
def set_equality_gate(spark, sf):
    rows = samples(spark, sf)
    changed = F.when((F.col("price") > 300000) & (F.col("source") == "real"), "x").otherwise(F.col("label"))
    found = reconcile.view_difference(rows.where("price > 3000").select("filename", changed.alias("label")), rows.select("filename", "label"))
    return found.agg((F.count("*") == 0).alias("equal"), F.count_if(F.col("side") == "missing").alias("missing"), F.count_if(F.col("side") == "extra").alias("extra"))


IDS = [(f, p, i) for f, base, held in (("date_written", words.WRITTEN_BASE, words.WRITTEN_HELD_OUT), ("date_numeric", words.NUMERIC_BASE, words.NUMERIC_HELD_OUT)) for p, ids in (("base", base), ("held_out", held)) for i in ids]
IDS_SQL = ", ".join(f"('{f}', '{p}', '{i}')" for f, p, i in IDS)


@query(f"WITH p(field_type, profile, id) AS (VALUES {IDS_SQL}) SELECT b.field_type, count(DISTINCT b.id) AS base, count(DISTINCT h.id) AS held_out, count(*) FILTER (b.id = h.id) = 0 AS disjoint FROM p b JOIN p h ON b.field_type = h.field_type AND b.profile = 'base' AND h.profile = 'held_out' GROUP BY 1")
def pattern_disjointness(spark, sf):
    """Base and held-out patterns of a field must not share an id."""
    p = spark.createDataFrame(IDS, "field_type string, profile string, id string")
    side = lambda k: F.collect_set(F.when(F.col("profile") == k, F.col("id")))
    sets = p.groupBy("field_type").agg(side("base").alias("b"), side("held_out").alias("h"))
    return sets.select("field_type", F.size("b").cast("long").alias("base"), F.size("h").cast("long").alias("held_out"), (~F.arrays_overlap("b", "h")).alias("disjoint"))


@query("SELECT sample_id, CASE WHEN split = 'test' THEN 'held_out_degradation_v1' ELSE 'base' END AS degradation_profile, CASE WHEN split = 'test' AND field_type IN ('date_written', 'date_numeric') THEN 'held_out_historical_date_v1' ELSE 'base' END AS format_profile FROM (" + SAMPLES_SQL + ")")
def split_profiles(spark, sf):
    rows = samples(spark, sf)
    return rows.select("sample_id", annotate.degradation_profile(F.col("split")).alias("degradation_profile"), annotate.format_profile(F.col("split"), F.col("field_type")).alias("format_profile"))


@query(f"WITH v AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS k FROM nation) SELECT c_custkey, n_name AS citizenship FROM customer JOIN v ON k = {pick_sql('citizenship', 'c_custkey', 25)}")
def vocabulary_draw(spark, sf):
    """A word list as a table: every row takes the entry at its own draw."""
    from pyspark.sql import Window as W

    listed = table(spark, sf, "nation").select(F.col("n_name").alias("citizenship"), (F.row_number().over(W.orderBy("n_nationkey")) - 1).alias("k"))
    n = listed.count()
    return table(spark, sf, "customer").select("c_custkey", pick("citizenship", F.col("c_custkey"), n).alias("k")).join(listed, "k").select("c_custkey", "citizenship")


@query(r"""WITH w AS (SELECT DISTINCT unnest(string_split(regexp_replace(text, '\s+', ' ', 'g'), '. ')) AS name FROM benchmark), c AS (SELECT name, strip_accents(trim(regexp_replace(name, '\s+', ' ', 'g'))) AS s FROM w)
SELECT name, CASE WHEN regexp_matches(s, '[0-9,.]') THEN '' ELSE s END AS cleaned FROM c""")
def clean_names(spark, sf):
    """Names without accents, odd entries blank."""
    parts = table(spark, sf, "benchmark").select(F.explode(F.split(F.regexp_replace("text", r"\s+", " "), r"\. ")).alias("name")).distinct()
    return parts.select("name", text.clean_name(F.col("name")).alias("cleaned"))


@query(f"SELECT sample_id, left(split || '/' || source || '/' || field_type || ': ' || label, 76) AS caption FROM ({SAMPLES_SQL})")
def montage_captions(spark, sf):
    return samples(spark, sf).select("sample_id", F.left(F.concat("split", F.lit("/"), "source", F.lit("/"), "field_type", F.lit(": "), "label"), F.lit(76)).alias("caption"))


BASE_SQL = ", ".join(f"{_trait_sql(t, *TRAITS[t])}" for t in ("baseline_amplitude", "baseline_period", "baseline_phase", "glyph_width_scale", "spacing", "pressure_bias"))


@query(f"""WITH s AS (SELECT c_custkey, c_acctbal, {BASE_SQL} FROM customer) SELECT c_custkey, round(sin(baseline_phase + {2 * math.pi!r}::DOUBLE * (c_custkey % 20) / baseline_period) * baseline_amplitude, 6) AS below,
 greatest(0, least(180, round_even(c_acctbal / 50 + pressure_bias, 0)::INT)) AS ink, round(greatest(0.70::DOUBLE, least(1.30::DOUBLE, glyph_width_scale + spacing / greatest(c_custkey % 9, 1))), 6) AS scale FROM s""")
def baseline_physics(spark, sf):
    """Baseline, ink and horizontal scale of a character of every writer."""
    rows = policy.writer_styles(table(spark, sf, "customer"), "c_custkey").join(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_custkey")
    rows = rows.withColumns({t: F.round(t, 6) for t in ("baseline_amplitude", "baseline_period", "baseline_phase", "glyph_width_scale", "spacing")})
    below = images.baseline(F.col("c_custkey") % 20, F.col("baseline_amplitude"), F.col("baseline_period"), F.col("baseline_phase"))
    ink = images.clamped_ink(F.col("c_acctbal") / 50 + F.col("pressure_bias"))
    scale = images.horizontal_scale(F.col("glyph_width_scale"), F.col("spacing"), F.col("c_custkey") % 9)
    return rows.select("c_custkey", F.round(below, 6).alias("below"), ink.alias("ink"), F.round(scale, 6).alias("scale"))


BREAKDOWNS = ("evaluation_domain", "evaluation_condition", "source", "field_type", "format_profile", "format_id", "seen_unseen")
ID_SQL = "CASE WHEN field_type = 'date_written' THEN 'written_' || format_profile WHEN field_type = 'date_numeric' THEN 'numeric_' || format_profile ELSE 'default' END"


@query(f"""WITH {PAIRS_SQL}, {SEEN_SQL}, {TAGS_SQL}, r AS (SELECT e.*, CASE WHEN source = 'real' THEN 'real' WHEN len(held) > 0 THEN 'synthetic_held_out' ELSE 'synthetic_in_domain' END AS evaluation_domain, evaluation_condition, source, field_type, format_profile, {ID_SQL} AS format_id,
 CASE WHEN seen THEN 'seen_label' ELSE 'unseen_label' END AS seen_unseen, held FROM e JOIN g ON sample_id = item_id + 1),
s AS (SELECT 'overall' AS breakdown, 'all' AS "group", ce, rc, ex FROM r {' '.join(f"UNION ALL SELECT '{b}', {b}, ce, rc, ex FROM r" for b in BREAKDOWNS)} UNION ALL SELECT 'held_out_conditions', coalesce(h, 'unspecified'), ce, rc, ex FROM (SELECT unnest(CASE WHEN len(held) = 0 THEN [NULL] ELSE held END) AS h, ce, rc, ex FROM r))
SELECT breakdown, "group", {RATES_SQL} FROM s GROUP BY ALL""")
def nine_breakdowns(spark, sf):
    """Error rates overall, by seven columns, and by each held-out condition."""
    kind = F.when(F.col("field_type") == "date_written", F.concat(F.lit("written_"), "format_profile")).when(F.col("field_type") == "date_numeric", F.concat(F.lit("numeric_"), "format_profile")).otherwise("default")
    notes = tagged(spark, sf).withColumn("format_id", kind).withColumn("item_id", F.col("sample_id") - 1)
    rows = pairs(spark, sf).drop("grp", "domain").join(notes.select("item_id", *BREAKDOWNS, "held_out_conditions"), "item_id")
    return rounded(metrics.breakdowns(rows, list(BREAKDOWNS), ["held_out_conditions"]), "accuracy", "cer")


@query("""WITH p AS (SELECT vec_id, list_transform(embedding, lambda v: greatest(0, least(255, floor(128 + v::DOUBLE * 400)))::DOUBLE) AS px FROM embeddings),
i AS (SELECT vec_id, list_filter(range(0, 64), lambda k: px[k + 1] < 90) AS ks FROM p)
SELECT vec_id, CASE WHEN len(ks) = 0 THEN 0 ELSE greatest(0, list_min(list_transform(ks, lambda k: k % 8)) - 2) END::INT AS x0, CASE WHEN len(ks) = 0 THEN 0 ELSE greatest(0, list_min(list_transform(ks, lambda k: k // 8)) - 2) END::INT AS y0,
 CASE WHEN len(ks) = 0 THEN 8 ELSE least(8, list_max(list_transform(ks, lambda k: k % 8)) + 2) END::INT AS x1, CASE WHEN len(ks) = 0 THEN 8 ELSE least(8, list_max(list_transform(ks, lambda k: k // 8)) + 2) END::INT AS y1 FROM i""")
def ink_bounding_box(spark, sf):
    """The padded box around pixels darker than 90 (these pictures are darker than scans)."""
    return gray(spark, sf).select("vec_id", images.ink_box(F.col("pixels"), 8, below=90).alias("b")).select("vec_id", *[F.col(f"b.{c}").cast("int").alias(c) for c in ("x0", "y0", "x1", "y1")])


@query(f"SELECT 'split' AS map, split AS key, count(*) AS n FROM ({SAMPLES_SQL}) GROUP BY split UNION ALL SELECT 'source', source, count(*) FROM ({SAMPLES_SQL}) GROUP BY source UNION ALL SELECT 'split/source', split || '/' || source, count(*) FROM ({SAMPLES_SQL}) GROUP BY split, source UNION ALL SELECT 'writers', split, count(DISTINCT writer) FROM ({SAMPLES_SQL}) GROUP BY split")
def frequency_maps(spark, sf):
    """Counts by split, source and both, and writers by split, as one long table."""
    rows = samples(spark, sf)
    entry = lambda m, c: F.struct(F.lit(m).alias("map"), c.alias("key"))
    both = F.concat("split", F.lit("/"), "source")
    counts = rows.select(F.inline(F.array(entry("split", F.col("split")), entry("source", F.col("source")), entry("split/source", both)))).groupBy("map", "key").agg(F.count("*").alias("n"))
    writers = rows.groupBy(F.col("split").alias("key")).agg(F.count_distinct("writer").alias("n")).select(F.lit("writers").alias("map"), "key", "n")
    return counts.unionByName(writers)


@query("""WITH d AS (SELECT lang, sha256(unhex(lpad(hex(strlen(n)), 16, '0') || hex(n) || hex(text))) AS d FROM (SELECT lang, printf('%08d.txt', doc_id) AS n, text FROM documents)),
p AS (SELECT lang, ('0x' || substr(d, 1, 4))::INT % 256 AS b, sha256(string_agg(d, '' ORDER BY d)) AS p, count(*) AS n FROM d GROUP BY ALL) SELECT lang, sum(n)::BIGINT AS files, sha256(string_agg(p, '' ORDER BY b)) AS digest FROM p GROUP BY lang""")
def content_digest_bucketed(spark, sf):
    """A digest of a group of any size: no row holds more than a bucket's digests."""
    d = table(spark, sf, "documents").select("lang", F.format_string("%08d.txt", "doc_id").alias("n"), F.encode("text", "utf-8").alias("c"))
    return digest.digest_of_digests(d, ["lang"], F.col("n"), F.col("c"))


@query("SELECT writer, split, row_number() OVER (ORDER BY lower(c_name), c_name) AS place FROM (SELECT o_custkey AS writer, min(CASE o_orderstatus WHEN 'F' THEN 'train' WHEN 'O' THEN 'val' ELSE 'test' END) AS split FROM orders GROUP BY 1) JOIN customer ON c_custkey = writer")
def assignment_order(spark, sf):
    """Assignments by folded writer name, then name: a rank in buckets of the name's end, which orders these names alike."""
    from inkwell.operators.allocate import rank_in_buckets

    split = F.when(F.col("o_orderstatus") == "F", "train").when(F.col("o_orderstatus") == "O", "val").otherwise("test")
    rows = table(spark, sf, "orders").select(F.col("o_custkey").alias("writer"), split.alias("split")).groupBy("writer").agg(F.min("split").alias("split"))
    named = rows.join(table(spark, sf, "customer").select(F.col("c_custkey").alias("writer"), "c_name"), "writer")
    ranked = rank_in_buckets(named.withColumn("k", F.lower("c_name")), [], F.substring("k", 1, 15), ["k", "c_name"], "place")
    return ranked.select("writer", "split", "place")
