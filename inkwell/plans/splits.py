"""Queries: sample plans and split allocation.  Orders are samples, customers writers, brands fonts."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions.rand import SPAN, draw, draw_sql, weighted, weighted_sql
from inkwell.operators import allocate
from inkwell.registry import Registry, table

registry = Registry()
query = registry.query

FRACTIONS = (0.6, 0.2, 0.2)
FIELD_WEIGHTS = {"full_name": 30, "place": 20, "date_written": 15, "date_numeric": 15, "age": 10, "sex": 5, "occupation": 5}

#: The manifest that several queries derive from orders, for both engines.
SPLIT_SQL = f"CASE WHEN {draw_sql('split', 'o_custkey')} * 10 < {6 * SPAN} THEN 'train' WHEN {draw_sql('split', 'o_custkey')} * 10 < {8 * SPAN} THEN 'val' ELSE 'test' END"
SAMPLES_SQL = f"""SELECT o_orderkey AS sample_id, o_custkey AS writer, printf('syn_%08d.png', o_orderkey) AS filename, o_orderpriority AS label,
  {SPLIT_SQL} AS split, CASE WHEN o_orderkey % 3 = 0 THEN 'real' ELSE 'synthetic' END AS source,
  {weighted_sql('field', 'o_orderkey', FIELD_WEIGHTS)} AS field_type, o_orderstatus AS sample_mode, o_totalprice AS price, o_orderdate::DATE AS day FROM orders"""


def samples(spark, sf):
    u = draw("split", F.col("o_custkey")) * 10
    split = F.when(u < 6 * SPAN, "train").when(u < 8 * SPAN, "val").otherwise("test")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("sample_id"), F.col("o_custkey").alias("writer"), F.format_string("syn_%08d.png", "o_orderkey").alias("filename"),
        F.col("o_orderpriority").alias("label"), split.alias("split"), F.when(F.col("o_orderkey") % 3 == 0, "real").otherwise("synthetic").alias("source"),
        weighted("field", F.col("o_orderkey"), FIELD_WEIGHTS).alias("field_type"), F.col("o_orderstatus").alias("sample_mode"),
        F.col("o_totalprice").alias("price"), F.to_date("o_orderdate").alias("day"),
    )


@query(f"SELECT filename, label, split, source, field_type, sample_mode, CASE WHEN source = 'real' THEN 'W' || writer ELSE '' END AS writer_id, '1' AS schema_version FROM ({SAMPLES_SQL})")
def manifest_project(spark, sf):
    writer = F.when(F.col("source") == "real", F.concat(F.lit("W"), F.col("writer").cast("string"))).otherwise("")
    return samples(spark, sf).select("filename", "label", "split", "source", "field_type", "sample_mode", writer.alias("writer_id"), F.lit("1").alias("schema_version"))


@query(f"""WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {draw_sql('assign', 'o_orderkey')}, o_orderkey) AS k, count(*) OVER () AS n FROM orders)
SELECT o_orderkey AS sample_id, CASE WHEN k <= n - 2 * (n // 10) THEN 'train' WHEN k <= n - n // 10 THEN 'val' ELSE 'test' END AS split FROM r""")
def split_exact_assignment(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_id"))
    n = orders.count()
    return allocate.exact_assignment(orders, "sample_id", {"train": n - 2 * (n // 10), "val": n // 10, "test": n // 10}, "assign").select("sample_id", "split")


WRITER_SQL = f"""t AS (SELECT count(*) AS n FROM customer), q AS (SELECT * FROM (SELECT 'train' AS split, 0 AS k, n - 2 * (n // 5) AS d FROM t UNION ALL SELECT 'val', 1, n // 5 FROM t UNION ALL SELECT 'test', 2, n // 5 FROM t)),
slots AS (SELECT split, row_number() OVER (ORDER BY slot DESC, k) AS r FROM (SELECT split, k, unnest(range(1, d + 1)) AS slot FROM q)),
w AS (SELECT c_custkey, row_number() OVER (ORDER BY {draw_sql('w', 'c_custkey')}, c_custkey) AS r FROM customer),
a AS (SELECT c_custkey AS writer, split FROM w JOIN slots USING (r))"""


def writer_splits(spark, sf):
    writers = table(spark, sf, "customer").select(F.col("c_custkey").alias("writer"))
    return allocate.assign_writers(writers, "writer", FRACTIONS, "w")


@query(f"""WITH {WRITER_SQL} SELECT split, count(DISTINCT writer) AS writers, count(o_orderkey) AS samples, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM a LEFT JOIN orders ON o_custkey = writer GROUP BY split""")
def split_writer_held_out(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("s"), F.sum("o_totalprice").alias("p"))
    joined = writer_splits(spark, sf).join(orders, F.col("writer") == F.col("o_custkey"), "left")
    return joined.groupBy("split").agg(F.count("writer").alias("writers"), F.coalesce(F.sum("s"), F.lit(0)).alias("samples"), F.round(F.coalesce(F.sum("p"), F.lit(0.0)), 2).alias("total"))


QUOTA_CASES = [(10, (0.34, 0.33, 0.33)), (11, (0.8, 0.1, 0.1)), (3, (0.8, 0.1, 0.1)), (2, (0.5, 0.5, 0.0)), (5, (0.8, 0.1, 0.1)), (20, (0.7, 0.15, 0.15))]
QUOTA_ROWS = ", ".join(f"({t}, {k}, {f}::DOUBLE)" for t, fs in QUOTA_CASES for k, f in enumerate(fs))


@query(f"""WITH c(total, k, f) AS (VALUES {QUOTA_ROWS}), fl AS (SELECT *, floor(total * f + 1e-9)::BIGINT AS b, total * f - floor(total * f + 1e-9) AS rest FROM c),
s AS (SELECT *, row_number() OVER (PARTITION BY total ORDER BY CASE WHEN f > 0 THEN 0 ELSE 1 END, rest DESC, k) AS r, total - sum(b) OVER (PARTITION BY total) AS more FROM fl),
g AS (SELECT total, k, f, b + CASE WHEN r <= more THEN 1 ELSE 0 END AS n FROM s),
z AS (SELECT *, sum(CASE WHEN f > 0 AND n = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY total) AS need, row_number() OVER (PARTITION BY total ORDER BY n DESC, k) AS rich FROM g)
SELECT total::BIGINT AS total, k::INT AS split_no, (CASE WHEN f > 0 AND n = 0 THEN 1 WHEN rich = 1 THEN n - need ELSE n END)::BIGINT AS quota FROM z""")
def split_quota_table(spark, sf):
    rows = [(t, k, q) for t, fs in QUOTA_CASES for k, q in enumerate(allocate.quotas(t, fs))]
    return spark.createDataFrame(rows, "total long, split_no int, quota long")


@query(f"SELECT field_type, count(*) AS n, min(sample_id) AS first_id FROM ({SAMPLES_SQL}) GROUP BY field_type")
def weighted_field_choice(spark, sf):
    return samples(spark, sf).groupBy("field_type").agg(F.count("*").alias("n"), F.min("sample_id").alias("first_id"))


@query(f"""WITH s AS ({SAMPLES_SQL}), w AS (SELECT sample_id, split, printf('synthetic_%s_writer_%05d', split, (row_number() OVER (PARTITION BY split ORDER BY sample_id) - 1) // 5 + 1) AS writer_id FROM s WHERE source = 'synthetic')
SELECT sample_id, split, writer_id FROM w""")
def pseudo_writer_ids(spark, sf):
    made = samples(spark, sf).where("source = 'synthetic'").select("sample_id", "split")
    return allocate.pseudo_writers(made, "split", "sample_id", 5)


@query(f"""WITH b AS (SELECT DISTINCT p_brand FROM part), r AS (SELECT p_brand, row_number() OVER (ORDER BY {draw_sql('font', 'p_brand')}, p_brand) AS k, count(*) OVER () AS n FROM b)
SELECT p_brand AS font, k <= greatest(1, least(n - 1, ceil(n * 25 / 100.0))) AS held_out FROM r""")
def font_holdout(spark, sf):
    fonts = table(spark, sf, "part").select(F.col("p_brand").alias("font")).distinct()
    return allocate.holdout(fonts, "font", "font", 25)


@query("SELECT o_orderkey AS sample_id, ((42 + o_orderkey * 1000003) & 2147483647)::BIGINT AS seed FROM orders")
def per_sample_seed(spark, sf):
    seed = (F.lit(42).cast("long") + F.col("o_orderkey") * 1000003).bitwiseAND(0x7FFFFFFF)
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("sample_id"), seed.alias("seed"))


@query(f"""WITH s AS ({SAMPLES_SQL}) SELECT row_number() OVER (ORDER BY sample_id) AS idx, field_type, split FROM s""")
def generation_plan(spark, sf):
    rows = allocate.ordered_rank(samples(spark, sf), [], "sample_id", [], "idx")
    return rows.select("idx", "field_type", "split")


@query(f"SELECT split, field_type, count(*) AS n FROM ({SAMPLES_SQL}) GROUP BY GROUPING SETS ((), (split), (field_type))")
def generation_counters(spark, sf):
    rows = samples(spark, sf)
    rows.createOrReplaceTempView("inkwell_samples")
    return spark.sql("SELECT split, field_type, count(*) AS n FROM inkwell_samples GROUP BY GROUPING SETS ((), (split), (field_type))")
