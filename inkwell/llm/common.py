"""Helpers shared by the operators: the shared folder, stored tables, checked joins, words."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell.session import ship

#: The bytes that separate words: 0x20 and 0x09-0x0D.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \x09-\x0D]+"
WORD = r"[^ \x09-\x0D]+"

#: A table is broadcast only if it has at most so many rows and bytes.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 64 << 20

_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one set here if unset in a local session."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="inkwell-shared-")
        spark.sparkContext.setCheckpointDir(where)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Removes a table or folder that this module made."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        try:
            delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may be gone
            return


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/inkwell-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends here."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """Works a table out and keeps it on the executors' own disks; what is lost is worked out again.

    Of a file in the shared folder a local file system without Hadoop's native library has the executor start
    up to three commands (chmod).  The literal is the table's name: an equal plan over changed input must not find it.
    """
    out = df.where(F.lit(uuid.uuid4().hex) != F.lit("")).persist(StorageLevel.DISK_ONLY)
    out.count()
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes stored or kept tables whose readers have all been cut, stored or kept themselves."""
    for t in tables:
        if t.is_cached:
            t.unpersist()
            continue
        for path in {p.rsplit("/", 1)[0] for p in t.inputFiles()}:
            if any(path.endswith(made.rsplit("/", 1)[1]) for _, made in _made):
                delete(t.sparkSession, path)


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint, for small tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_bytes(kind: T.DataType, value: Column) -> Column:
    """About how many bytes a value takes in a row."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        inside = F.lit(8) * F.size(value) if not isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType)) else F.octet_length(F.to_json(value))
        return F.coalesce(inside, F.lit(0)) + 16
    if isinstance(kind, T.StructType):
        return sum((_row_bytes(f.dataType, value[f.name]) for f in kind.fields), F.lit(8))
    return F.lit(8)


def few_enough(small: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a table may be broadcast, by its counted rows and, for those, the bytes they take."""
    n = small.limit(rows + 1).count()
    if n > rows:
        return False
    if not any(isinstance(f.dataType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)) for f in small.schema.fields):
        return n * (8 + 8 * len(small.columns)) <= size
    each = sum((_row_bytes(f.dataType, F.col(f"`{f.name}`")) for f in small.schema.fields), F.lit(8))
    return (small.agg(F.sum(each.cast("long"))).first()[0] or 0) <= size


def checked_join(big: DataFrame, small: DataFrame, on, how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """Joins with a table that has already been stored or cut: by broadcast only if its
    counted rows and bytes are few enough, else by a shuffled join whose skewed sides AQE splits."""
    return big.join(F.broadcast(small) if few_enough(small, most) else small.hint("merge"), on, how)


def text_of(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def trimmed(text: Column) -> Column:
    return F.btrim(text_of(text), F.lit(SPACES))


def word_array(text: Column) -> Column:
    """Words of a text in order; an empty array where there are none."""
    inner = trimmed(text)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def word_count(text: Column) -> Column:
    inner = trimmed(text)
    return F.when(inner == "", F.lit(0)).otherwise(F.size(F.split(inner, SPACE_RUN))).cast("long")


def shielded(docs: DataFrame, needed: tuple[str, ...]):
    """(docs, back): with the columns that are not ``needed`` under names that no operator uses, and
    the function that gives a result its columns back."""
    other = {c: f"_x{k}" for k, c in enumerate(docs.columns) if c not in needed}
    names = docs.columns

    def back(out: DataFrame) -> DataFrame:
        return out.select(*[F.col(other.get(c, c)).alias(c) for c in names])

    return docs.select(*[F.col(c).alias(other.get(c, c)) for c in names]), back


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
