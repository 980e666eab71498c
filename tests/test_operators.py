import datetime
import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F

from inkwell.functions import text, words
from inkwell.operators import allocate, annotate, catalog, digest, images, metrics, reconcile, validate
from inkwell.sources import files, manifest
from inkwell.streaming import counters


@pytest.mark.parametrize(
    ("total", "fractions", "want"),
    [(10, (0.34, 0.33, 0.33), [4, 3, 3]), (11, (0.8, 0.1, 0.1), [9, 1, 1]), (3, (0.8, 0.1, 0.1), [1, 1, 1]), (2, (0.5, 0.5, 0.0), [1, 1, 0]), (5, (0.8, 0.1, 0.1), [3, 1, 1]), (20, (0.7, 0.15, 0.15), [14, 3, 3])],
)
def test_quotas(total, fractions, want):
    assert allocate.quotas(total, fractions) == want


def test_quotas_need_a_sample_for_each_split():
    with pytest.raises(ValueError, match="at least 3"):
        allocate.quotas(2, (0.8, 0.1, 0.1))


def test_writers_keep_their_split(spark):
    ten = spark.range(10).select(F.col("id").alias("w"))
    first = allocate.assign_writers(ten, "w", (0.6, 0.2, 0.2), "t")
    before = {r["w"]: r["split"] for r in first.collect()}
    after = {r["w"]: r["split"] for r in allocate.assign_writers(spark.range(15).select(F.col("id").alias("w")), "w", (0.6, 0.2, 0.2), "t", first).collect()}
    assert {k: after[k] for k in before} == before
    assert sorted(after.values()).count("train") == 9 and len(after) == 15


def test_words():
    assert words.ordinal_words()[28:] == ["Twenty-Ninth", "Thirtieth", "Thirty-First"]
    assert words.number_words()[42] == "Forty-Two" and len(words.number_words()) == 100


def test_dates(spark):
    df = spark.createDataFrame([(datetime.date(1999, 12, 31),), (datetime.date(2000, 2, 29),)], "d date")
    written = words.written_date(F.col("d"), F.lit(0), F.lit(False))[0]
    numeric = words.numeric_date(F.col("d"), F.lit(0), F.lit(0))[0]
    got = df.select(written.alias("w"), numeric.alias("n"), words.year_words(F.year("d"), F.lit(False)).alias("y")).collect()
    assert got[0]["w"] == "31 December 1999" and got[1]["n"] == "02/29/2000"
    assert [r["y"] for r in got] == ["Nineteen Hundred Ninety-Nine", "Two Thousand"]


def test_token_distance(spark):
    cases = [("a b c d", "a x c", 2), ("", "p q", 2), ("q w e r", "w e r q", 2), ("a", "", 1), ("", "", 0)]
    df = spark.createDataFrame(cases, "r string, p string, want int")
    got = df.withColumns({"rw": text.tokens(F.col("r")), "pw": text.tokens(F.col("p"))}).select("want", text.token_distance(F.col("rw"), F.col("pw")).alias("d"))
    assert all(r["d"] == r["want"] for r in got.collect())


def test_error_rates_of_nothing_are_zero(spark):
    df = spark.createDataFrame([("", "x", "")], "reference string, prediction string, g string")
    row = metrics.grouped(metrics.with_edits(df), "g").first()
    assert row["group"] == "unspecified" and row["cer"] == 0.0 and row["wer"] == 0.0


def test_manifest_scan(spark, tmp_path):
    head = ",".join(manifest.MANIFEST)
    good = 'a.png,"x, ""y""",train,real,,,,W1,1'
    p = tmp_path / "m.csv"
    p.write_text(f"{head}\n{good}\na.png,short,train\n")
    rows = manifest.scan(spark, str(p), manifest.MANIFEST).cache()
    assert rows.where("_corrupt IS NULL").first()["label"] == 'x, "y"'
    assert rows.where("_corrupt IS NOT NULL").count() == 1
    p.write_text("label," + head + "\n")
    with pytest.raises(ValueError, match="expected the columns"):
        manifest.scan(spark, str(p), manifest.MANIFEST)


def test_tolerant_scan_and_conflicts(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("filename,label,writer_id\nA.png,one,W1\na.png,two,W1\nb.png,x\n,,\nB.PNG,x,\n")
    rows = manifest.scan_tolerant(spark, str(p), manifest.REAL).withColumn("line_number", F.monotonically_increasing_id())
    assert rows.count() == 4
    assert sorted(r["problem"] for r in manifest.real_conflicts(rows).collect()) == ["conflicting label", "duplicate"]


def test_row_rules(spark):
    rows = [(1, "../x.png", "l", "train", "synthetic", "f", "t", "m", "", "1"), (2, "a.png", " ", "dev", "real", "", "", "", "", "2"), (3, "b.png", "l", "val", "synthetic", "", "t", "", "W1", "1")]
    df = spark.createDataFrame(rows, "line_number long, " + ", ".join(f"{c} string" for c in manifest.MANIFEST))
    got = {(r["line_number"], r["code"]) for r in validate.row_rules(df).collect()}
    assert got == {(1, "filename"), (2, "label"), (2, "split"), (2, "schema_version"), (2, "writer_id"), (3, "writer_id"), (3, "synthetic_fields")}


def test_reconcile_is_idempotent(spark):
    a = spark.createDataFrame([("A.png", "1"), ("b.png", "2")], "filename string, label string")
    assert {r["action"] for r in reconcile.plan(a, a, "filename", ["label"]).collect()} == {"unchanged"}


def test_one_to_one_refuses_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y")], "k int, v string")
    with pytest.raises(Exception, match="one-to-one"):
        annotate.one_to_one(a, spark.createDataFrame([(1, "z")], "k int, w string"), ["k"]).collect()


def test_digest_equals_hashlib(spark):
    content = [("b", b"2"), ("a", b"1"), ("é", b"")]
    df = spark.createDataFrame([(n, bytearray(c)) for n, c in content], "n string, c binary")
    want = hashlib.sha256()
    for n, c in sorted(content, key=lambda x: x[0].encode()):
        want.update(len(n.encode()).to_bytes(8, "big") + n.encode() + c)
    assert digest.ordered_digest(df, [], [F.encode("n", "utf-8")], F.col("n"), F.col("c")).first()["digest"] == want.hexdigest()
    assert digest.digest_of_digests(df, [], F.col("n"), F.col("c")).first()["files"] == 3


def test_archive(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.writestr("d/a.txt", "one")
        z.writestr("../out.txt", "two")
    got = {r["member"]: (r["sha256"], r["problem"]) for r in files.archive(spark, str(tmp_path / "x.zip")).collect()}
    assert got == {"d/a.txt": (hashlib.sha256(b"one").hexdigest(), None), "../out.txt": (None, "path leads out")}


def test_snapshot_and_word_list(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/w.txt").write_text(" one \n\ntwo\n")
    assert [r["path"] for r in files.snapshot(spark, str(tmp_path)).collect()] == ["in/w.txt"]
    assert [r["value"] for r in files.word_list(spark, str(tmp_path / "in/w.txt")).collect()] == ["one", "two"]


def test_publish_and_sidecar(tmp_path):
    p = tmp_path / "a.csv"
    manifest.publish(p, manifest.csv_bytes([{"filename": "a", "label": "b"}], manifest.LABELS))
    assert p.read_bytes() == b"filename,label,split\na,b,\n"
    with pytest.raises(FileExistsError):
        manifest.publish(p, b"")
    manifest.write_sidecar(p)
    assert manifest.verify_sidecar(p)
    p.write_bytes(b"other")
    assert not manifest.verify_sidecar(p)


def test_commit_rolls_back(tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a").write_text("old")
    (tmp_path / "new").write_text("new")

    def fail():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        catalog.commit({"a": tmp_path / "new"}, tmp_path / "t", fail)
    assert (tmp_path / "t/a").read_text() == "old"


def test_catalogue(spark):
    df = spark.createDataFrame([("dataset_007",), (".dataset_009.reserve",), ("dataset_008.zip",), ("other",)], "name string")
    assert catalog.next_name(df, "name") == "dataset_010"
    with pytest.raises(ValueError):
        catalog.child("/tmp", "../etc")


def test_image_metrics():
    import numpy as np

    page = np.full((20, 100), 255)
    page[5:16, 20:81] = 0
    m = images.measure(page)
    assert m["aspect_ratio"] == 5.0 and 0 < m["ink_coverage"] < 1
    assert images.quality(np.full((20, 20), 255))["contrast"] == 0
    r = np.random.default_rng(1)
    assert images.degrade(page.astype(float), r).shape == page.shape


def test_stream_counts_equal_batch_counts(spark, tmp_path):
    src = "/root/testdata/sf0.001/events.parquet"
    schema = spark.read.parquet(src).schema
    (tmp_path / "in").mkdir()
    spark.read.parquet(src).write.mode("overwrite").parquet(str(tmp_path / "in"))
    got = counters.run_counters(spark, str(tmp_path / "in"), schema, "counted_events", str(tmp_path / "ck"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, counters.counted(spark.read.parquet(src)).collect()))


def test_text_rules(spark):
    df = spark.createDataFrame([(x,) for x in ("a.png", "a/b.png", "..", "C:x.png", "", " a.png")], "f string")
    got = {r["f"]: (r["a"], r["b"]) for r in df.select("f", text.is_leaf(F.col("f")).alias("a"), text.is_leaf_png(F.col("f")).alias("b")).collect()}
    assert got == {"a.png": (True, True), "a/b.png": (False, False), "..": (False, False), "C:x.png": (False, False), "": (False, False), " a.png": (True, False)}


def test_generate_and_validate(spark, tmp_path):
    from inkwell.operators import generate

    out = generate.generate(spark, tmp_path / "d", 200)
    assert out == {"train": 160, "val": 20, "test": 20}
    rows = manifest.load(spark, str(tmp_path / "d/manifest"))
    assert rows.count() == 200 and rows.columns == list(manifest.MANIFEST)
    a, b = (generate.plan(spark, 50).orderBy("idx").collect() for _ in range(2))
    assert a == b
    test = [r for r in generate.plan(spark, 2000).where("split = 'test' AND field_type LIKE 'date%'").collect()]
    assert test and all(r["format_id"] in words.WRITTEN_HELD_OUT + words.NUMERIC_HELD_OUT for r in test)


def test_policy(spark):
    from inkwell.operators import policy

    with pytest.raises(ValueError, match="unknown profile"):
        policy.profile("none")
    assert policy.scaled(policy.profile("heavy"), 10).stains == 100
    assert policy.field_weights("snippet", {"numeric": 1, "age": 2}) == {"numeric": 1}
    assert policy.schedule(100, 8, 4, 2, 0.1) == {"batches": 13, "steps": 8, "warmup": 0}
    fonts = spark.createDataFrame([("x/A.ttf", "serif", "g"), ("y/a.TTF", "serif", "h"), ("b.ttf", "script", "g")], "path string, style string, grp string")
    assert policy.font_pool(fonts, "serif").count() == 1 and policy.font_pool(fonts, "any", "none").count() == 2


def test_provenance(tmp_path):
    from inkwell.operators import provenance

    assert provenance.fingerprint({"b": {2, 1}, "a": 1}) == provenance.fingerprint({"a": 1, "b": {1, 2}})
    (tmp_path / "d").mkdir()
    (tmp_path / "d/x").write_text("1")
    assert provenance.package(tmp_path / "d", tmp_path / "d.zip") == provenance.tree(tmp_path / "d")
    with pytest.raises(FileExistsError):
        provenance.package(tmp_path / "d", tmp_path / "d.zip")
    (tmp_path / "d/l").symlink_to("x")
    with pytest.raises(ValueError):
        provenance.tree(tmp_path / "d")
    assert provenance.matches_contract({"a": 1}, {"a": 1, "b": 2}) == ["b"]


def test_pixel_kernels():
    import numpy as np

    page = np.full((20, 40), 255.0)
    page[8:12, 10:30] = 0
    r = np.random.default_rng(1)
    for step in (images.rotate, images.tint, images.low_resolution, images.stains, images.scratches, images.ink_gaps):
        assert step(page, r).shape == page.shape
    assert images.clip_edges(page, (0.9, 0.9, 0.1, 0.1)).shape == (10, 32)
    padded = images.resize_and_pad(page, 384)
    assert padded.shape == (384, 384) and padded[0, 0] == 255 and padded.min() == 0
    assert images.accepted(lambda k: np.full((20, 40), 255.0) if k < 3 else page)[1] == 3
    with pytest.raises(RuntimeError):
        images.accepted(lambda k: np.full((20, 40), 255.0), 2)


def distance(a, b):
    row = list(range(len(b) + 1))
    for k, x in enumerate(a, 1):
        last, row[0] = row[0], k
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_word_error_rate_of_whole_texts(spark, tmp_path):
    import random

    from inkwell.plans import evaluation

    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(3000)] + ["é", "\U0001f600", "名前"]
    rows = []
    for c in range(6):
        text = [r.choice(vocabulary) for _ in range(400)]
        for turn in range(3):
            rows.append((c, turn, "user" if turn % 2 else "assistant", " ".join(text)))
            text = [r.choice(vocabulary) if r.random() < 0.1 else w for w in text if r.random() > 0.05]
    rows += [(9, 0, "user", None), (9, 1, "user", "a b"), (9, 2, "user", ""), (9, 3, "user", "c")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {x["group"]: x for x in evaluation.wer_by_group(spark, str(tmp_path)).collect()}
    text = {(c, t): x for c, t, _, x in rows}
    for role in ("user", "assistant"):
        pairs = [(text[c, t - 1], x) for c, t, who, x in rows if who == role and t]
        words = [((a or "").split(), (b or "").split()) for a, b in pairs]
        assert got[role]["total"] == len(pairs)
        assert got[role]["wer"] == round(sum(distance(a, b) for a, b in words) / sum(len(a) for a, _ in words), 9)
        full = [(a, b) for a, b in pairs if a is not None and b is not None]
        assert got[role]["cer"] == round(sum(distance(a, b) for a, b in full) / sum(len(a) for a, _ in full), 9)


def test_sizes_beyond_a_terabyte_equal_their_sql(spark, tmp_path):
    from inkwell.plans import generation
    from tests.compare import oracle, rows

    keys = [*range(40), 262143, 262144, 262145, 900_001, 8_999_999, 30_000_000, 123_456_789]
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").toPandas().to_parquet(tmp_path / "orders.parquet")
    assert rows(generation.human_sizes(spark, str(tmp_path))) == oracle(generation.registry.sql["human_sizes"], tmp_path)
    shown = spark.range(1).select(text.human_bytes(F.lit(3 * 1024**4)).alias("tb"), text.human_bytes(F.lit(3 * 1024**4), ("KB", "MB")).alias("mb")).first()
    assert (shown["tb"], shown["mb"]) == ("3.0 TB", "3145728.0 MB")
