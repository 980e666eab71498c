"""Command line: generate a plan, validate a manifest, plan a merge, pack a data set, evaluate predictions."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import functions as F

from inkwell import session
from inkwell.operators import allocate, generate, handoff, metrics, provenance, reconcile, validate
from inkwell.sources import manifest, strict


def arguments() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="inkwell")
    sub = p.add_subparsers(dest="what", required=True)
    g = sub.add_parser("generate", help="write manifest, labels and annotations of a new plan")
    g.add_argument("--count", type=int, required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--fractions", type=float, nargs=3, default=generate.FRACTIONS, metavar=("TRAIN", "VAL", "TEST"))
    g.add_argument("--weights", type=json.loads, help="JSON object of field weights")
    g.add_argument("--per-writer", type=int, default=5)
    g.add_argument("--mode", choices=("regular", "snippet"), default="regular")
    v = sub.add_parser("validate", help="list findings of a manifest")
    v.add_argument("manifest")
    m = sub.add_parser("merge", help="show what merging real samples would do")
    m.add_argument("manifest")
    m.add_argument("real")
    e = sub.add_parser("evaluate", help="error rates of a CSV file of predictions (reference, prediction and columns to group by)")
    e.add_argument("predictions")
    e.add_argument("--by", nargs="*", default=[])
    z = sub.add_parser("package", help="pack a data set folder and write the archive's checksum")
    z.add_argument("folder")
    for s in (g, v, m, e):
        s.add_argument("--master")
    return p


def main(argv: list[str] | None = None) -> int:
    a = arguments().parse_args(argv)
    if a.what == "package":
        target, _ = handoff.archives(a.folder)
        files = provenance.package(a.folder, target)
        manifest.write_sidecar(target)
        print(json.dumps({"archive": str(target), "files": len(files)}))
        return 0
    spark = session.build(master=a.master)
    if a.what == "generate":
        print(json.dumps(generate.generate(spark, a.out, a.count, tuple(a.fractions), a.weights, a.per_writer, a.mode), sort_keys=True))
        return 0
    if a.what == "validate":
        rows = strict.numbered(spark, a.manifest)
        broken = validate.finding(rows, F.col("problem").isNotNull(), "manifest", F.col("problem"))
        found = broken.unionByName(validate.row_rules(rows.where("problem IS NULL"))).orderBy("line_number", "code").limit(validate.KEEP).collect()
        for r in found:
            print(f"{r['line_number']}\t{r['code']}\t{r['key']}\t{r['message']}")
        return int(bool(found))
    if a.what == "evaluate":
        rows = metrics.with_edits(manifest.scan_tolerant(spark, a.predictions, ["reference", "prediction", *a.by]))
        for r in metrics.breakdowns(rows, a.by, words=True).orderBy("breakdown", "group").collect():
            print(json.dumps(r.asDict(), sort_keys=True))
        return 0
    rows = manifest.load(spark, a.manifest)
    real = manifest.scan_tolerant(spark, a.real, manifest.REAL)
    known = rows.where("source = 'real'")
    splits = allocate.assign_writers(real, "writer_id", generate.FRACTIONS, "merge", known.select("writer_id", "split").distinct())
    print(json.dumps({r["action"]: r["n"] for r in reconcile.plan(real, known, "filename", ["label", "writer_id"]).groupBy("action").agg(F.count("*").alias("n")).collect()}, sort_keys=True))
    print(json.dumps({r["split"]: r["n"] for r in splits.groupBy("split").agg(F.count("*").alias("n")).collect()}, sort_keys=True))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
