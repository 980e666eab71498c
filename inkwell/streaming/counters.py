"""Generation counters over a stream: an extension of this engine, equal to the batch counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def counted(events: DataFrame) -> DataFrame:
    """Events and their values by type, for a batch or a stream."""
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))


def windowed(events: DataFrame, time: str = "ts", window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts per window; rows later than ``late`` behind the newest time are left out of a stream."""
    rows = events.withColumn(time, F.col(time).cast("timestamp"))
    return rows.withWatermark(time, late).groupBy(F.window(time, window), "event_type").agg(F.count("*").alias("n"))


def run_counters(spark: SparkSession, folder: str, schema, name: str, checkpoint: str) -> DataFrame:
    """Reads all Parquet files of a folder as a stream, once, and returns the final counts."""
    stream = spark.readStream.schema(schema).parquet(folder)
    q = counted(stream).writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)
