"""Readers: image listings, object tables, platemaps, profiles, similarity matrices."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.functions.keys import CHANNELS, channel_name, clean_number, image_name_part, plate_from_path, well_label, well_name

OBJECT_KEYS = T.StructType([
    T.StructField("ImageNumber", T.IntegerType()), T.StructField("ObjectNumber", T.IntegerType()), T.StructField("Metadata_Field", T.IntegerType()),
    T.StructField("Metadata_Plate", T.StringType()), T.StructField("Metadata_Well", T.StringType()),
])
PLATEMAP = T.StructType([T.StructField(n, T.StringType()) for n in ("Metadata_Plate", "Metadata_Well", "Metadata_Perturbation")])
OBJECTS = ("Cells", "Cytoplasm", "Nuclei")


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return sorted(set(required) - set(df.columns))


def require(df: DataFrame, columns: Iterable[str], what: str) -> DataFrame:
    if gone := missing_columns(df, columns):
        raise ValueError(f"{what} lacks {', '.join(gone)}")
    return df


def feature_columns(df: DataFrame, labels: Iterable[str] = ()) -> list[str]:
    """Numeric columns that are no ``Metadata_`` keys, object keys or ``labels``."""
    keys = {f.name for f in OBJECT_KEYS} | set(labels)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and not f.name.startswith("Metadata_") and f.name not in keys]


def clean(df: DataFrame) -> DataFrame:
    """NaN becomes null in every floating column."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[clean_number(F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns])


def image_files(spark: SparkSession, root: str, plates: Iterable[str] | None = None, skip: str = "/Output/") -> DataFrame:
    """``path`` of every TIFF below ``root``, outside folders named Output; only names are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.tif*").load(root).select("path")
    files = files.filter(~F.contains("path", F.lit(skip)))
    return files if plates is None else files.filter(plate_from_path(F.col("path")).isin(list(plates)))


def manifest(files: DataFrame, illum: str | None = None, masks: str | None = None, plane: int = 2) -> DataFrame:
    """The long manifest: one row per image of ``plane`` with keys and derived paths; other names are dropped."""
    name = F.element_at(F.split("path", "/"), -1)
    named = files.withColumn("Image_FileName", name).withColumn("Image_PathName", F.regexp_replace("path", r"/[^/]*$", ""))
    part = lambda p: image_name_part(F.col("Image_FileName"), p)
    rows = named.filter(part("plane") == plane)
    plate = F.lpad(plate_from_path(F.col("path")), 2, "0")
    out = rows.select(
        "Image_FileName", "Image_PathName", plate.alias("Metadata_Plate"), well_label(part("row"), part("column")).alias("Metadata_Well"),
        part("field").alias("Metadata_Field"), part("channel").alias("Metadata_Channel"), channel_name(part("channel")).alias("Metadata_Channel_name"),
    ).filter("Metadata_Plate is not null")
    if illum:
        out = out.withColumn("FileName_Illum", F.concat(F.lit("Illum_"), "Metadata_Channel_name", F.lit(".npy"))).withColumn("PathName_Illum", F.concat_ws("/", F.lit(illum), F.concat(F.lit("P"), "Metadata_Plate")))
    out = out.withColumn("Image_FileName_RNA_mask", F.lit(None).cast("string"))
    return out.withColumn("Image_PathName_RNA_mask", F.concat_ws("/", F.lit(masks), F.concat(F.lit("P"), "Metadata_Plate"))) if masks else out


def wide_manifest(long: DataFrame) -> DataFrame:
    """One row per plate, well and field; a column for every channel's file, path and illumination file, in one pivot."""
    keys = ["Metadata_Plate", "Metadata_Well", "Metadata_Field"]
    values = [c for c in ("Image_FileName", "Image_PathName", "FileName_Illum", "PathName_Illum") if c in long.columns]
    wide = long.groupBy(*keys).pivot("Metadata_Channel_name", list(CHANNELS.values())).agg(*[F.min(c).alias(c) for c in values])
    cols = [(f"{ch}_{v}" if len(values) > 1 else ch, f"{v.replace('Image_', '')}_{ch}" if "Illum" not in v else f"{v}{ch}") for ch in CHANNELS.values() for v in values]
    mask = F.coalesce(F.min("Image_FileName_RNA_mask"), F.regexp_replace(F.min(F.when(F.col("Metadata_Channel_name") == "Syto", F.col("Image_FileName"))), r"\.tiff?$", ".png"))
    return wide.select(*keys, *[F.col(a).alias(b) for a, b in cols]).join(long.groupBy(*keys).agg(mask.alias("Image_FileName_RNA_mask")), keys)


def headers(spark: SparkSession, paths: str | list[str], mark: str, glob: str | None = None) -> list[tuple[str, list[str]]]:
    """The different header lines of text tables, those lines that hold ``mark``, each with its files."""
    reader = spark.read.option("recursiveFileLookup", True)
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).text(paths)
    found = lines.filter(F.contains("value", F.lit(mark))).select("value", F.col("_metadata.file_path").alias("path")).distinct()
    by_header = found.groupBy("value").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("value")
    return [(r["value"], r["paths"]) for r in by_header.collect()]  # paths of the files to read


def object_table(spark: SparkSession, paths: str | list[str], features: list[str]) -> DataFrame:
    """Tab-separated object tables of all batches under each other; only wanted columns are kept.

    Files are read together with those of equal header and columns taken by name,
    so batches may order their columns differently.
    """
    schema = T.StructType([*OBJECT_KEYS, *[T.StructField(f, T.DoubleType()) for f in features]])
    parts = []
    for _, files in headers(spark, paths, "ObjectNumber"):
        found = require(spark.read.csv(files, sep="\t", header=True, nullValue="NaN"), schema.names, "object table")
        parts.append(found.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema]))
    if not parts:
        raise FileNotFoundError(f"no object tables in {paths}")
    typed = reduce(DataFrame.unionByName, parts)
    return clean(typed).withColumn("Metadata_Well", F.upper(F.trim("Metadata_Well"))).withColumn("Metadata_Plate", F.trim("Metadata_Plate"))


def object_sets(spark: SparkSession, root: str, features: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Cells, Cytoplasm and Nuclei tables below ``root``."""
    if gone := [o for o in OBJECTS if o not in features]:
        raise ValueError(f"missing object tables: {', '.join(gone)}")
    return {o: object_table(spark, f"{root}/*/{o}.txt", features[o]) for o in OBJECTS}


def image_table(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tab-separated site table; ``Metadata_Field`` serves where ``Metadata_Site`` is missing."""
    found = spark.read.csv(path, sep="\t", header=True)
    if "Metadata_Site" not in found.columns and "Metadata_Field" in found.columns:
        found = found.withColumn("Metadata_Site", F.col("Metadata_Field"))
    require(found, ["Metadata_Plate", "Metadata_Well"], "image table")
    numbers = [c for c in found.columns if c.startswith(("ImageQuality_", "Count_"))]
    return clean(found.select("Metadata_Plate", well_name(F.col("Metadata_Well")).alias("Metadata_Well"), *[c for c in ("Metadata_Site",) if c in found.columns], *[F.col(f"`{c}`").try_cast("double").alias(c) for c in numbers]))


def platemap(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    """Plate, well and perturbation; columns are found by name parts unless ``strict``. Plates get a leading P if they have none."""
    found = spark.read.csv(path, header=True)
    if strict:
        return require(found, PLATEMAP.names, "platemap")
    pick = lambda *parts: next((c for c in found.columns if any(p in c.lower() for p in parts)), None)
    names = pick("plate"), pick("well"), pick("compound", "perturbation")
    if None in names:
        raise ValueError("platemap needs plate, well and perturbation columns")
    plate = F.trim(F.col(f"`{names[0]}`"))
    return found.select(F.when(plate.startswith("P"), plate).otherwise(F.concat(F.lit("P"), plate)).alias("Metadata_Plate"), F.upper(F.trim(F.col(f"`{names[1]}`"))).alias("Metadata_Well"), F.trim(F.col(f"`{names[2]}`")).alias("Metadata_Perturbation"))


def profiles(spark: SparkSession, root: str, patterns: tuple[str, ...] = ("*_normalized*.csv", "*_cohort_norm*.csv", "*_red*.csv")) -> DataFrame:
    """Profile tables below ``root``: those of the first pattern that matches any, joined by column name.

    Files of equal header are read together.
    """
    for pattern in patterns:
        groups = headers(spark, root, "Metadata_Plate", pattern)
        if groups:
            out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.csv(files, header=True) for _, files in groups])
            keys = [c for c in out.columns if c.startswith("Metadata_")]
            return clean(out.select(*keys, *[F.col(f"`{c}`").try_cast("double").alias(c) for c in out.columns if c not in keys]))
    raise FileNotFoundError(f"no profiles below {root}")


def similarity_matrix(spark: SparkSession, path: str) -> DataFrame:
    """``label, place, similarity`` from a square matrix: a label column and ``rep_0`` .. ``rep_n``, whose numbers are the places."""
    wide = spark.read.parquet(path)
    label = next((c for c in wide.columns if c in ("compound", "__index_level_0__")), wide.columns[0])
    values = [c for c in wide.columns if c != label and c.startswith("rep_")]
    order = F.posexplode(F.array(*[F.col(f"`{c}`").cast("double") for c in values])).alias("place", "similarity")
    return wide.select(F.col(f"`{label}`").alias("label"), order)


def compound_list(spark: SparkSession, path: str | None = None, generate: int = 0) -> DataFrame:
    """``label``: the first field of each line of a file, or ``Cmpd_1`` .. ``Cmpd_n``."""
    if path is None:
        return spark.range(1, generate + 1).select(F.concat(F.lit("Cmpd_"), F.col("id")).alias("label"))
    return spark.read.text(path).select(F.trim(F.split("value", "[,;\t]")[0]).alias("label")).filter("label <> ''")
