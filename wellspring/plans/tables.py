"""Loading of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: tables whose rows take much work each
WORKED = ("cells", "image_qc", "profiles", "documents", "manifest_files")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table; one of ``WORKED`` in so few row groups that most cores would idle is spread over them."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if name in WORKED and 2 * df.rdd.getNumPartitions() <= cores else df
