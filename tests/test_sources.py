"""Files, strict manifests, pictures, checks before hand-over, batch runs."""

import json
import struct
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from inkwell.operators import handoff, running
from inkwell.sources import files, pictures, strict
from inkwell.sources.manifest import MANIFEST

HEAD = ",".join(MANIFEST)
ROW = "a.png,{},train,synthetic,place,f.ttf,regular,,1"


def test_strict_manifest_keeps_physical_lines(spark, tmp_path):
    p = tmp_path / "manifest.csv"
    p.write_text("\n".join([HEAD, ROW.format("one"), ROW.format('"two\nlines"'), "b.png,short", ROW.format("after")]) + "\n")
    got = {r["line_number"]: r for r in strict.numbered(spark, str(p)).collect()}
    assert sorted(got) == [2, 3, 5, 6] and got[3]["label"] == "two\nlines" and got[6]["label"] == "after"
    assert got[5]["problem"] == "2 cells in place of 9" and got[2]["problem"] is None


def test_strict_manifest_reports_header_quoting_and_emptiness(spark, tmp_path):
    def problems(text):
        p = tmp_path / "m.csv"
        p.write_bytes(text)
        return [(r["line_number"], r["problem"].split(":")[0].split(",")[0]) for r in strict.numbered(spark, str(p)).where("problem IS NOT NULL").orderBy("line_number").collect()]

    assert problems(b"") == [(1, "the manifest is empty")]
    assert problems(b"filename,label\nx,y\n") == [(1, "expected the columns filename"), (2, "2 cells in place of 9")]
    assert problems(f'{HEAD}\n"a"b,c\n{ROW}\n'.encode()) == [(2, "unreadable quoting")]
    assert problems(b"\xff\xfe") == [(1, "not UTF-8")]


def filtered(pixels, kinds):
    """A PNG whose rows use the given filters, written from the definition of each."""
    height, width, each = pixels.shape
    rows, flat = b"", pixels.reshape(height, -1).astype(int)
    for y in range(height):
        line = []
        for x in range(width * each):
            a = flat[y, x - each] if x >= each else 0
            b = flat[y - 1, x] if y else 0
            c = flat[y - 1, x - each] if y and x >= each else 0
            p = a + b - c
            paeth = min((abs(p - v), k, v) for k, v in enumerate((a, b, c)))[2]
            line.append((flat[y, x] - (0, a, b, (a + b) // 2, paeth)[kinds[y]]) & 255)
        rows += bytes([kinds[y], *line])
    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 2: 4, 3: 2, 4: 6}[each], 0, 0, 0)
    return pictures.SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("each", [1, 2, 3, 4])
def test_png_filters(each):
    pixels = np.random.default_rng(each).integers(0, 256, (5, 7, each)).astype(np.uint8)
    got, mode = pictures.decode(filtered(pixels, [0, 1, 2, 3, 4]))
    assert (got == pixels).all() and mode == {1: "L", 2: "LA", 3: "RGB", 4: "RGBA"}[each]


def test_png_files_are_verified(spark, tmp_path):
    g = np.random.default_rng(0).integers(0, 256, (20, 30)).astype(np.uint8)
    good = pictures.encode(g)
    assert (pictures.decode(good)[0][..., 0] == g).all() and (pictures.decode(pictures.encode(np.dstack([g] * 3)))[0] == g[..., None]).all()
    for name, content in {"a.png": good, "cut.png": good[:-20], "bent.png": good[:60] + b"\x00" + good[61:], "no.PNG": b"text", "skip.txt": good}.items():
        (tmp_path / name).write_bytes(content)
    got = {r["path"].rsplit("/", 1)[1]: r for r in pictures.verified(pictures.pictures(spark, str(tmp_path))).collect()}
    assert set(got) == {"a.png", "cut.png", "bent.png", "no.PNG"}
    assert got["a.png"]["problem"] is None and (got["a.png"]["width"], got["a.png"]["height"], got["a.png"]["mode"]) == (30, 20, "L")
    assert all(got[n]["problem"].startswith("unreadable picture") for n in ("cut.png", "bent.png", "no.PNG"))
    assert pictures.sheet([g, g, g]).shape == (300, 960)


def test_split_folders(spark, tmp_path):
    for s in ("train", "val"):
        (tmp_path / s).mkdir()
    (tmp_path / "train" / "a.png").write_bytes(b"12345")
    (tmp_path / "train" / "notes.txt").write_bytes(b"1")
    (tmp_path / "val" / "B.PNG").write_bytes(b"12")
    (tmp_path / "val" / "inner").mkdir()
    got = {(r["split"], r["name"]): r["problem"] for r in pictures.split_entries(spark, str(tmp_path)).collect()}
    assert got == {("train", "a.png"): None, ("train", "notes.txt"): "unexpected entry", ("val", "B.PNG"): None, ("val", "inner"): "unexpected entry", ("test", None): "missing split directory"}
    assert pictures.folder_size(spark, str(tmp_path)) == 8
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    assert pictures.newest_first(listed).count() == 3


def test_name_versions_and_presets(spark, tmp_path):
    for v, names in {"name1": ("first", "middle", "last"), "name2": ("first", "last")}.items():
        (tmp_path / v).mkdir()
        for n in names:
            (tmp_path / v / f"{n}_names.txt").write_text("x\n")
    assert [r["version"] for r in files.name_versions(spark, str(tmp_path)).collect()] == ["name1"]
    (tmp_path / "presets").mkdir()
    (tmp_path / "presets" / "fast.json").write_text(json.dumps({"count": 5}))
    assert [tuple(r) for r in files.presets(spark, str(tmp_path / "presets"), "count long").collect()] == [("fast", 5)]


def test_order_and_zip(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "place long, key string")
    b = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d")], "place long, key string")
    assert {(r["place"], r["problem"]) for r in handoff.zipped(a, b, "place", "key").collect()} == {(2, "different key"), (3, "missing"), (4, "extra")}
    assert handoff.same_order(a, a, "place", ["key"]).count() == 0
    assert {(r["place"], r["problem"]) for r in handoff.same_order(b, a, "place", ["key"]).collect()} == {(2, "different row"), (3, "missing"), (4, "extra")}


def test_archives_removal_and_freshness(tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "f").write_text("1")
    handoff.archives(tmp_path / "d")
    (tmp_path / "d.zip").write_text("")
    with pytest.raises(FileExistsError):
        handoff.archives(tmp_path / "d")
    (tmp_path / "d" / "link").symlink_to(tmp_path)
    with pytest.raises(ValueError):
        handoff.remove(tmp_path, "d")
    (tmp_path / "d" / "link").unlink()
    for bad in ("..", "d/f", "d.zip"):
        with pytest.raises(ValueError):
            handoff.remove(tmp_path, bad)
    assert handoff.remove(tmp_path, "d") and not handoff.remove(tmp_path, "d")
    report = tmp_path / "report.json"
    assert handoff.fresh(report, {}) == ["missing report.json"]
    report.write_text(json.dumps({"valid": True, "manifest": "1"}))
    assert handoff.fresh(report, {"manifest": "1"}) == [] and handoff.fresh(report, {"manifest": "2"}) == ["stale manifest"]
    made = []
    for _ in range(2):
        assert handoff.once(tmp_path / "locked.json", "k", lambda: made.append(1) or {"x": 1}) == {"x": 1}
    assert made == [1]
    with pytest.raises(ValueError):
        handoff.once(tmp_path / "locked.json", "other", dict)


def test_batches_shrink_when_memory_ends(spark):
    sizes = []

    def run(part):
        if len(part) > 3:
            raise MemoryError
        sizes.append(len(part))
        return part

    out = pd.concat(running.in_batches(pd.DataFrame({"x": range(20)}), run, 16))
    assert out["x"].tolist() == list(range(20)) and max(sizes) <= 3
    df = running.predicted(spark.range(50), lambda p: p.assign(y=p["id"] * 2), "id long, y long")
    watched, seen = running.watched(df, "rows")
    assert watched.agg(F.sum("y")).first()[0] == 2450 and seen.get["rows"] == 50
    with running.cancellable(spark, "some-run") as cancel:
        assert spark.range(3).count() == 3
    cancel()
    assert running.remaining(50, 200, 25.0) == "2.0/s, 0:00:25 taken, 0:01:15 left"


def test_percentiles_and_ranks_in_many_buckets(spark, monkeypatch):
    from inkwell.functions import ranges
    from inkwell.operators import allocate, stats

    monkeypatch.setattr(ranges.bounds, "__defaults__", (50, 64))
    r = np.random.default_rng(1)
    data = pd.DataFrame({"g": r.choice(["a", "b", None], 3000, p=[0.6, 0.39, 0.01]), "v": np.where(r.random(3000) < 0.3, 7.0, r.normal(size=3000).round(2) * 100), "k": r.permutation(3000)})
    df = spark.createDataFrame(data.astype(object).where(data.notna(), None).values.tolist(), "g string, v double, k long")
    got = {x["g"]: x for x in stats.percentiles(df, ["g"], "v", [0.0, 0.05, 0.5, 0.95, 1.0]).collect()}
    for g, part in data.groupby("g", dropna=False):
        x = got[g if isinstance(g, str) else None]
        assert np.allclose([x["p0"], x["p5"], x["p50"], x["p95"], x["p100"]], np.percentile(part["v"], [0, 5, 50, 95, 100]))
    ranked = allocate.ordered_rank(df, ["g"], "k", [], "n").toPandas()
    ranked["want"] = ranked.groupby("g", dropna=False)["k"].rank().astype(int)
    assert (ranked["n"] == ranked["want"]).all()


def test_rows_of_bytes():
    assert strict.rows_of(b'a,b\n1,"x\ny"\n', ["a", "b"]) == [{"a": "1", "b": "x\ny"}]
    for bad in (b"a\n1\n", b"a,b\n1\n", b'a,b\n"1"x,2\n', b"\xff"):
        with pytest.raises(ValueError):
            strict.rows_of(bad, ["a", "b"])


def test_statistics_and_review_sheet(spark, tmp_path):
    r = np.random.default_rng(0)
    for s in ("train", "val", "test"):
        (tmp_path / s).mkdir()
        for k in range(3):
            (tmp_path / s / f"{k}.png").write_bytes(pictures.encode(r.integers(0, 256, (20, 40)).astype(np.uint8)))
    found = pictures.pictures(spark, str(tmp_path))
    out = pictures.statistics(found)
    assert out["generated"]["width"] == {"n": 9, "mean": 40.0, "sd": 0.0, "least": 40.0, "most": 40.0} and out["real"] is None
    assert pictures.statistics(found, found)["comparison_available"]
    sheet = pictures.review_sheet(found.withColumn("kind", F.element_at(F.split("path", "/"), -2)), ["kind"])
    assert pictures.decode(sheet)[0].shape == (300, 960, 1)


def test_command_line(spark, tmp_path, capsys):
    from inkwell import __main__ as cli

    assert cli.main(["generate", "--count", "40", "--out", str(tmp_path / "plan"), "--mode", "snippet", "--fractions", "0.5", "0.25", "0.25"]) == 0
    assert json.loads(capsys.readouterr().out) == {"train": 20, "val": 10, "test": 10}
    made = spark.read.csv(str(tmp_path / "plan" / "manifest"), header=True)
    assert {r["field_type"] for r in made.select("field_type").distinct().collect()} <= {"character", "numeric"}
    p = tmp_path / "m.csv"
    p.write_text(f"{HEAD}\n{ROW.format('fine')}\nb.jpg,x,dev,synthetic,place,f.ttf,regular,,1\nshort\n")
    assert cli.main(["validate", str(p)]) == 1
    assert [x.split("\t")[:2] for x in capsys.readouterr().out.splitlines()] == [["3", "filename"], ["3", "split"], ["4", "manifest"]]
    q = tmp_path / "p.csv"
    q.write_text("reference,prediction,kind\nabcd,abcx,a\nef,ef,b\n")
    assert cli.main(["evaluate", str(q), "--by", "kind"]) == 0
    rows = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    assert {r["group"]: r["cer"] for r in rows} == {"a": 0.25, "b": 0.0, "all": 1 / 6}
    files.write_word_list(str(tmp_path / "words.txt"), ["one", "two"])
    assert [r["value"] for r in files.word_list(spark, str(tmp_path / "words.txt")).collect()] == ["one", "two"]
    (tmp_path / "set").mkdir()
    (tmp_path / "set" / "f").write_text("1")
    assert cli.main(["package", str(tmp_path / "set")]) == 0 and (tmp_path / "set.zip.sha256").exists()
    with pytest.raises(FileExistsError):
        cli.main(["package", str(tmp_path / "set")])
