"""Writers: delimited text, Parquet, JSON, grouped files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _flat(df: DataFrame, digits: int | None) -> DataFrame:
    """Arrays as ``|``-joined text, maps and structs as JSON, floating numbers rounded."""

    def one(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(c.cast("array<string>"), "|").alias(f.name)
        if isinstance(f.dataType, (T.MapType, T.StructType)):
            return F.to_json(c).alias(f.name)
        if digits is not None and isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return F.round(c, digits).alias(f.name)
        return c

    return df.select(*[one(f) for f in df.schema])


def write_csv(df: DataFrame, path: str, digits: int | None = None, by: list[str] | None = None, single: bool = False) -> None:
    """Delimited text with a header; ``by`` writes a folder per value, ``single`` one file (small reports only)."""
    out = _flat(df, digits)
    writer = (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True)
    (writer.partitionBy(*by) if by else writer).csv(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_json(df: DataFrame, path: str, digits: int = 3) -> None:
    """JSON lines with every field present; NaN becomes null, numbers are rounded."""
    number = lambda f: F.round(F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)), digits).alias(f.name)
    cols = [number(f) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`") for f in df.schema]
    df.select(*cols).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def split_by_group(df: DataFrame, group: str, parts: int, seed: int = 0) -> DataFrame:
    """``df`` with ``part`` 0 .. parts-1, equal within a group."""
    return df.withColumn("part", F.pmod(F.xxhash64(F.col(group), F.lit(seed)), F.lit(parts)).cast("int"))


def write_similarity_matrix(pairs: DataFrame, path: str, labels: list[str]) -> None:
    """A square matrix, one row per label and ``rep_0`` .. ``rep_n`` in the labels' order, the diagonal 1 (a report of one cohort)."""
    both = pairs.select("label_a", "label_b", "similarity").unionByName(pairs.select(F.col("label_b").alias("label_a"), F.col("label_a").alias("label_b"), "similarity"))
    wide = both.filter("label_a <> label_b").groupBy("label_a").pivot("label_b", labels).agg(F.first("similarity"))
    cols = [F.when(F.col("label_a") == x, 1.0).otherwise(F.col(f"`{x}`")).cast("float").alias(f"rep_{i}") for i, x in enumerate(labels)]
    wide.select(F.col("label_a").alias("compound"), *cols).write.mode("overwrite").parquet(path)
