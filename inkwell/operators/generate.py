"""A sample plan with text labels, and its publication as CSV files.

Rendering needs fonts, which neither this package nor its inputs have; ``images.mapped`` takes a
caller's kernel instead.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions import words
from inkwell.functions.rand import chance, draw, pick, weighted
from inkwell.operators import allocate, annotate, policy, validate
from inkwell.sources import manifest

#: Weights of a regular plan, fixed values; ``character`` and ``numeric`` take part in snippets only.
WEIGHTS = {"full_name": 30, "place": 16, "date_written": 13, "date_numeric": 11, "cause_of_death": 8, "age": 5, "civil_status": 5, "sex": 4, "religion": 3, "citizenship": 3, "occupation": 2}
FRACTIONS = (0.8, 0.1, 0.1)
#: Vocabularies of our own; ``label`` takes others.
LISTS = {
    "place": ["Manila", "Cebu", "Davao", "Iloilo", "Bacolod", "Baguio", "Zamboanga", "Vigan"],
    "sex": ["Male", "Female"],
    "civil_status": ["Single", "Married", "Widowed", "Separated"],
    "religion": ["Catholic", "Protestant", "Islam", "Aglipayan", "None"],
    "citizenship": ["Filipino", "American", "Chinese", "Spanish", "Japanese"],
    "occupation": ["Farmer", "Fisherman", "Teacher", "Carpenter", "Seamstress", "Merchant", "Nurse", "Driver", "Clerk", "Student"],
    "cause_of_death": ["Pneumonia", "Heart failure", "Tuberculosis", "Malaria", "Stroke", "Old age", "Accident"],
}
NAMES = (["Maria", "Jose", "Ana", "Juan"], ["Cruz", "Reyes", "Santos", "Ramos"])


def entry(namespace: str, key: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), pick(namespace, key, len(values)) + 1)


def random_date(key: Column, first: int = 1920, last: int = 2000) -> Column:
    """A valid day: year, month and day of the month uniform."""
    start = F.make_date(first + pick("year", key, last - first + 1), 1 + pick("month", key, 12), F.lit(1))
    days = F.dayofmonth(F.last_day(start))
    return F.date_add(start, F.floor(draw("day", key) * days / F.lit(1 << 32)).cast("int"))


def label(field: Column, split: Column, key: Column, lists: dict[str, list[str]] | None = None) -> tuple[Column, Column]:
    """(text, format id) of every field type."""
    lists = LISTS | (lists or {})
    day, roll = random_date(key), pick("roll", key, 1000)
    held = annotate.format_profile(split, field) != "base"
    out, ids = F.concat_ws(" ", entry("first", key, NAMES[0]), entry("last", key, NAMES[1])), F.lit("default")
    for name, make, extra in (("date_written", words.written_date, chance("and", key, 50)), ("date_numeric", words.numeric_date, pick("sign", key, 3))):
        base, other = make(day, roll, extra), make(day, roll, extra, held_out=True)
        out = F.when(field == name, F.when(held, other[0]).otherwise(base[0])).otherwise(out)
        ids = F.when(field == name, F.when(held, other[1]).otherwise(base[1])).otherwise(ids)
    for name, values in lists.items():
        out = F.when(field == name, entry(name, key, values)).otherwise(out)
    out = F.when(field == "age", pick("age", key, 111).cast("string")).otherwise(out)
    digits = F.array_join(F.transform(F.sequence(F.lit(1), 1 + pick("size", key, 6)), lambda i: pick("digit", F.concat_ws(".", key, i), 10).cast("string")), "")
    letters = F.array(*[F.lit(x) for x in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"])
    some = F.when(pick("few", key, 100) < 70, 1).otherwise(2 + pick("many", key, 3))
    signs = F.array_join(F.transform(F.sequence(F.lit(1), some), lambda i: F.element_at(letters, pick("sign", F.concat_ws(".", key, i), 62) + 1)), "")
    out = F.when(field == "character", signs).otherwise(out)
    return F.when(field == "numeric", digits).otherwise(out), ids


def plan(spark: SparkSession, count: int, fractions=FRACTIONS, weights: dict[str, int] | None = None, per_writer: int = 5) -> DataFrame:
    """Manifest rows with idx, format_profile, format_id and pseudo_writer: exact split sizes, weighted fields."""
    sizes = dict(zip(allocate.SPLITS, allocate.quotas(count, fractions), strict=True))
    rows = spark.range(1, count + 1).withColumnRenamed("id", "idx")
    rows = allocate.exact_assignment(rows, "idx", sizes, "plan.split")
    rows = rows.withColumn("field_type", weighted("plan.field", F.col("idx"), weights or WEIGHTS))
    text, ids = label(F.col("field_type"), F.col("split"), F.col("idx"))
    rows = rows.withColumns({"label": text, "format_id": ids, "format_profile": annotate.format_profile(F.col("split"), F.col("field_type"))})
    rows = allocate.pseudo_writers(rows, "split", "idx", per_writer).withColumnRenamed("writer_id", "pseudo_writer")
    fixed = {"filename": F.format_string("syn_%06d.png", "idx"), "source": F.lit("synthetic"), "font": entry("plan.font", F.col("idx"), ["Serif.ttf", "Script.ttf"]), "sample_mode": F.lit("regular"), "writer_id": F.lit(""), "schema_version": F.lit(manifest.VERSION)}
    return rows.withColumns(fixed)


def annotated(rows: DataFrame, held_fonts: list[str]) -> DataFrame:
    """Evaluation annotations of a plan."""
    held = F.col("font").isin(*held_fonts) if held_fonts else F.lit(False)
    out = rows.withColumn("evaluation_condition", annotate.condition(F.col("split"), held, F.col("field_type")))
    for column in ("label", "font", "format_id"):
        out = annotate.seen_in_train(out, column, f"{column.removesuffix('_id')}_seen_in_train")
    return out.select("filename", "split", "format_profile", "format_id", "evaluation_condition", "label_seen_in_train", "font_seen_in_train", "format_seen_in_train")


def generate(spark: SparkSession, folder: str | Path, count: int, fractions=FRACTIONS, weights: dict[str, int] | None = None, per_writer: int = 5, mode: str = "regular") -> dict[str, int]:
    """Writes manifest, labels and annotations of a plan below a new folder after they passed the rules.

    In mode ``snippet`` the fields are characters and numbers, otherwise all others; ``weights`` decides over it."""
    chosen = policy.field_weights(mode, WEIGHTS | {"character": 50, "numeric": 50}, weights)
    rows = plan(spark, count, fractions, chosen, per_writer).withColumn("sample_mode", F.lit(mode)).cache()
    lined = rows.withColumn("line_number", F.col("idx") + 1)
    if found := validate.row_rules(lined).limit(5).collect():
        raise ValueError("; ".join(f"line {r['line_number']}: {r['message']}" for r in found))
    folder = Path(folder)
    folder.mkdir(parents=True)
    for name, df, columns, order in (
        ("manifest", rows, manifest.MANIFEST, "filename"), ("labels", rows, manifest.LABELS, "filename"),
        ("annotations", annotated(rows, ["Script.ttf"]), annotated(rows, []).columns, "filename"),
    ):
        manifest.write_rows(df, str(folder / name), columns, [order])
    out = {r["split"]: r["n"] for r in rows.groupBy("split").agg(F.count("*").alias("n")).collect()}
    rows.unpersist()
    return out
