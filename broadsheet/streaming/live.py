"""Live windows over events, and logs that are read as they come. Extensions: batch jobs give the same numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def windowed(events: DataFrame, width: str = "3 hours", late: str = "1 hour") -> DataFrame:
    """Counts and sums by window and type; rows later than `late` are dropped, and so is the state of closed windows."""
    return (
        events.withColumn("ts", F.col("ts").cast("timestamp"))
        .withWatermark("ts", late)
        .groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total"))
        .select("w.start", "w.end", "event_type", "n", "total")
    )


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """New log files' lines; a line's number isn't known in a stream, so marks are told apart by their time."""
    return spark.readStream.text(path).select(F.col("_metadata.file_name").alias("file"), F.lit(0).alias("line"), "value")


def available(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what came since the last call, then stop: the incremental form of a batch job."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_events(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(path)
