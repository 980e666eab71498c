"""Manifests with physical line numbers: every record of a CSV file, its line and what is wrong with it.

Quoted cells may hold line breaks, so lines follow from reading a file in order: one file is one task.  A
manifest is one file of at most some million rows; many files are read side by side.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from inkwell.session import ship
from inkwell.sources.manifest import MANIFEST


def parsed(content: bytes) -> Iterator[tuple[int, list[str] | None, str | None]]:
    """(line where it starts, cells, problem) of every record; unreadable quoting ends the file."""
    try:
        text = bytes(content).decode("utf-8")
    except UnicodeDecodeError:
        yield 1, None, "not UTF-8"
        return
    reader = csv.reader(io.StringIO(text, newline=""), strict=True)
    while True:
        line = reader.line_num + 1
        try:
            cells = next(reader)
        except StopIteration:
            return
        except csv.Error as e:
            yield line, None, f"unreadable quoting: {e}"
            return
        yield line, cells, None


def rows_of(content: bytes, columns: Iterable[str]) -> list[dict[str, str]]:
    """The rows of a CSV file given as bytes, whose header and widths must be exact."""
    columns, out = list(columns), []
    for k, (line, cells, problem) in enumerate(parsed(content)):
        if problem:
            raise ValueError(f"line {line}: {problem}")
        if k == 0:
            if cells != columns:
                raise ValueError(f"expected the columns {columns}, found {cells}")
        elif len(cells) != len(columns):
            raise ValueError(f"line {line}: {len(cells)} cells in place of {len(columns)}")
        else:
            out.append(dict(zip(columns, cells, strict=True)))
    return out


@udtf(returnType="line_number: bigint, cells: array<string>, problem: string")
class Records:
    """One row per record of a CSV file."""

    def eval(self, content: bytes) -> Iterator[tuple]:
        yield from parsed(content)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_number, cells, problem) of every record of the files at a path, headers included."""
    ship(spark)
    spark.udtf.register("csv_records", Records)
    spark.read.format("binaryFile").load(path).createOrReplaceTempView("inkwell_csv_files")
    return spark.sql("SELECT path, r.* FROM inkwell_csv_files, LATERAL csv_records(content) r")


def numbered(spark: SparkSession, path: str, columns: Iterable[str] = MANIFEST) -> DataFrame:
    """(path, line_number, columns, problem): rows whose cells fit the columns, and a row with a problem and
    empty cells for the header if it differs, an empty file, each row of another width, and unreadable quoting."""
    columns = list(columns)
    rows = records(spark, path)
    head = (F.col("line_number") == 1) & F.col("problem").isNull()
    exact = F.array(*[F.lit(c) for c in columns])
    n = F.size("cells")
    problem = F.coalesce(
        "problem", F.when(head & (F.col("cells") != exact), F.concat(F.lit("expected the columns "), F.array_join(exact, ","), F.lit(", found "), F.array_join("cells", ","))),
        F.when(~head & (n != len(columns)), F.concat(n.cast("string"), F.lit(" cells in place of "), F.lit(str(len(columns))))),
    )
    rows = rows.withColumn("problem", problem).where(~head | F.col("problem").isNotNull())
    sound = F.col("problem").isNull()
    # Empty files make no rows, so they come from the listing.
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    none = [(x.getPath().toString(), 1, *[""] * len(columns), "the manifest is empty") for x in listed if x.isFile() and x.getLen() == 0]
    empty = spark.createDataFrame(none, ", ".join(["path string", "line_number long", *[f"`{c}` string" for c in columns], "problem string"]))
    out = rows.select("path", "line_number", *[F.when(sound, F.get("cells", F.lit(k))).otherwise("").alias(c) for k, c in enumerate(columns)], "problem")
    return out.unionByName(empty)
