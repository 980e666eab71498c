"""Sessions, and sending this package to Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def build(app: str = "inkwell", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session in UTC with adaptive execution; master and partitions only where a caller sets them."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    b = b.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    b = b.config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        b = b.master(master)
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


#: Rows and bytes of a batch that the JVM hands to a Python worker; a session's own settings decide over them.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2500", "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's modules to the Python workers, once per application, and bounds the batches they get."""
    for key, value in BATCH.items():
        if not spark.sparkContext.getConf().contains(key):
            spark.conf.set(key, value)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="inkwell-code-")) / "inkwell-code.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(target))
        _shipped.add(app)
    return spark
