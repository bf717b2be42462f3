"""Structured Streaming over event folders: windows, sessions, quarantine, throttling.  The same plans run as batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def stream(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """New files of a folder, each once."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(df: DataFrame, size: str, late: str | None = None, slide: str | None = None) -> DataFrame:
    """Count and sum of each event type and window; with ``late`` a watermark bounds the state."""
    if late and df.isStreaming:
        df = df.withWatermark("ts", late)
    w = F.window("ts", size, slide) if slide else F.window("ts", size)
    return df.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def sessions(df: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    if late and df.isStreaming:
        df = df.withWatermark("ts", late)
    g = df.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def quarantine(df: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Rows within [start, end), and those outside, which the caller must look at: none is dropped silently."""
    inside = F.coalesce((F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp")), F.lit(False))
    return df.where(inside), df.where(~inside)


def run_to_memory(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Runs a stream over what there is and returns its table."""
    q = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.table(name)
