"""New manifest lines and sites as they arrive (an addition; the batch operators stay the reference)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, folder: str, schema, files_per_batch: int = 64) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per key and window of event time; rows later than ``late`` are left out."""
    timed = stream.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    counts = timed.groupBy(F.window("_time", width), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.col("window.start").alias("start"), *keys, "n")


def run_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process all that is there, append the result to ``path`` and stop; a later call goes on from there."""
    query = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
