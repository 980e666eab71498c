"""File sources: image listings, content snapshots, archive members, word lists, JSON objects."""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from inkwell.functions.text import base_name, fold, strip

IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "bmp", "tif", "tiff", "webp")


def listing(spark: SparkSession, root: str, suffixes=IMAGE_SUFFIXES) -> DataFrame:
    """(path, name, length, modificationTime) of all images below a folder, contents unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "modificationTime")
    wanted = F.lower("path").rlike(rf"\.({'|'.join(suffixes)})$")
    return files.where(wanted).select("path", base_name(F.col("path")).alias("name"), "length", "modificationTime")


def ordered(files: DataFrame) -> DataFrame:
    return files.orderBy(fold(F.col("path")), "path")


def snapshot(spark: SparkSession, root: str) -> DataFrame:
    """(path below the folder, sha256) of every file."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    inner = F.regexp_replace("path", "^[a-z]+:/*", "/")
    return files.select(F.replace(inner, F.lit(root.rstrip("/") + "/"), F.lit("")).alias("path"), F.sha2("content", 256).alias("sha256"))


def destinations(files: DataFrame) -> DataFrame:
    """Folded file name and the sorted paths that have it."""
    return files.groupBy(fold(F.col("name")).alias("name")).agg(F.sort_array(F.collect_list("path")).alias("paths"))


def unsafe(member: str) -> str | None:
    """Why an archive member must not be unpacked, if so."""
    path = PurePosixPath(member.replace("\\", "/"))
    if path.is_absolute() or (len(member) > 1 and member[1] == ":"):
        return "absolute path"
    return "path leads out" if ".." in path.parts else None


@udtf(returnType="member: string, sha256: string, bytes: bigint, problem: string")
class ArchiveMembers:
    """One row per member of a ZIP archive: digest of its content, or why it is refused."""

    def eval(self, content: bytes) -> Iterator[tuple]:
        seen: set[str] = set()
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for info in z.infolist():
                if info.is_dir():
                    continue
                problem = unsafe(info.filename)
                if (info.external_attr >> 16) & 0o170000 == 0o120000:
                    problem = "link"
                if info.filename.casefold() in seen:
                    problem = "repeated member"
                seen.add(info.filename.casefold())
                if problem:
                    yield info.filename, None, info.file_size, problem
                    continue
                digest = hashlib.sha256()
                with z.open(info) as f:
                    while block := f.read(1 << 20):
                        digest.update(block)
                yield info.filename, digest.hexdigest(), info.file_size, None


def archive(spark: SparkSession, path: str) -> DataFrame:
    """Members of all archives at a path."""
    from inkwell.session import ship

    ship(spark)
    spark.udtf.register("archive_members", ArchiveMembers)
    spark.read.format("binaryFile").load(path).createOrReplaceTempView("inkwell_archives")
    return spark.sql("SELECT path AS archive, m.* FROM inkwell_archives, LATERAL archive_members(content) m")


def archive_differences(members: DataFrame, expected: DataFrame) -> DataFrame:
    """(path, problem): members and snapshot compared by one full outer join."""
    a = members.select(F.col("member").alias("path"), F.col("sha256").alias("got"), F.col("problem").alias("refused"))
    both = a.join(expected.select("path", F.col("sha256").alias("want")), "path", "full_outer")
    problem = F.coalesce("refused", F.when(F.col("got").isNull(), "missing").when(F.col("want").isNull(), "unexpected").when(F.col("got") != F.col("want"), "different content"))
    return both.select("path", problem.alias("problem")).where("problem IS NOT NULL")


def word_list(spark: SparkSession, path: str) -> DataFrame:
    """(idx, value) of a list's lines in order, stripped, blanks left out; an empty list fails.

    Word lists are small files of one split each, so a single read keeps their order.
    """
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("idx", "value"))
    out = lines.select("idx", strip(F.col("value")).alias("value")).where("value <> ''")
    if not out.limit(1).count():
        raise ValueError(f"no words in {path}")
    return out


def write_word_list(path: str, words: list[str]) -> None:
    """A word list as a file of one word a line; an existing one stays."""
    from inkwell.sources.manifest import publish

    publish(path, ("\n".join(words) + "\n").encode())


def word_lists(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(src_order, idx, value) of several lists, repeats kept."""
    out = None
    for k, path in enumerate(paths):
        part = word_list(spark, path).select(F.lit(k).alias("src_order"), "idx", "value")
        out = part if out is None else out.unionByName(part)
    return out


def name_versions(spark: SparkSession, root: str, required: tuple[str, ...] = ("first_names.txt", "middle_names.txt", "last_names.txt")) -> DataFrame:
    """(version): the direct child folders that hold all required files, contents unread."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path")
    parts = F.split(F.regexp_replace("path", "^[a-z]+:/*", "/"), "/")
    inside = files.select(F.element_at(parts, -1).alias("name"), F.element_at(parts, -2).alias("version"), F.size(parts).alias("depth"))
    depth = len([p for p in root.split("://")[-1].rstrip("/").split("/") if p]) + 3
    own = inside.where((F.col("depth") == depth) & F.col("name").isin(*required))
    return own.groupBy("version").agg(F.count_distinct("name").alias("n")).where(F.col("n") == len(required)).select("version").orderBy("version")


def presets(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(name, fields) of every preset file at a path; the file's name without its suffix is the preset's."""
    rows = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")
    stem = F.regexp_replace(base_name(F.col("_metadata.file_path")), r"\.json$", "")
    return rows.select(stem.alias("name"), *rows.columns)


def json_object(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One JSON object as one row; anything else fails."""
    rows = spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST")
    if rows.limit(2).count() != 1:
        raise ValueError(f"{path} does not hold one object")
    return rows
