"""Queries for implausible readings (3), drifting schemas (5) and orphan references (6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.keys import CHANNELS, perturbation_key, plate_number, well_name
from wellspring.operators.drift import consistent_names, count_lines, fuse, read_entries, schema_changes, union_types
from wellspring.operators.orphans import count_by_month, find_orphans
from wellspring.operators.spikes import flag_readings
from wellspring.plans.tables import table

INF = float("inf")
#: physical range of each kind of reading
RANGES = {"PowerLogLogSlope": (-INF, 0.0), "FocusScore": (0.0, INF), "MedianIntensity": (0.0, 1.0)}
QC_BOUNDS = {f"ImageQuality_{m}_{c}": r for m, r in RANGES.items() for c in ("Hoechst", "Syto", "Golgi", "ER", "Mito", "Brightfield")}

#: fields of the consistent table; the keys they go by follow from the renames found
MANIFEST_FIELDS = [
    "Image_FileName", "Image_PathName", "Metadata_Plate", "Metadata_Well", "Metadata_Field", "Metadata_Channel", "Metadata_Channel_name",
    "Image_FileName_RNA_mask", "Image_PathName_RNA_mask", "FileName_Illum", "PathName_Illum",
]
#: channels are given by name or number
CHANNEL_CODES = {name.lower(): float(number) for number, name in CHANNELS.items()}


def p3_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Every implausible reading with its kind and the model's probability."""
    df = table(spark, folder, "image_qc")
    found = flag_readings(df, "qc_id", plate_number(F.col("Metadata_Plate")), "acquired_at", QC_BOUNDS)
    return found.withColumnRenamed("row_id", "qc_id").withColumn("probability", F.round("probability", 6))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_flags(spark, folder).select("qc_id", "measurement")


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    return read_entries(table(spark, folder, "manifest_files"), "record", "Image_FileName", CHANNEL_CODES)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return schema_changes(_entries(spark, folder)).select("feed", "file_seq", "field", "change")


def p5_changes(spark: SparkSession, folder: str) -> DataFrame:
    return schema_changes(_entries(spark, folder))


def p5_types(spark: SparkSession, folder: str) -> DataFrame:
    """Every alternative type of every path of every feed, inside objects and arrays too."""
    return union_types(read_entries(table(spark, folder, "manifest_files"), "record", "Image_FileName", CHANNEL_CODES, nested=True))


def p5_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and unreadable lines per feed and file."""
    return count_lines(table(spark, folder, "manifest_files"), "record")


def p5_table(spark: SparkSession, folder: str) -> DataFrame:
    """All manifests as one table, flattened to canonical values and the tags of the two main fields; ``other`` has all further fields by name."""
    entries = _entries(spark, folder)
    names = {name: [name] for name in MANIFEST_FIELDS}
    fused = fuse(entries, names, consistent_names(entries, schema_changes(entries), names))
    number = lambda c: F.col(f"{c}.value").try_cast("double").cast("int")
    names = F.create_map(*[F.lit(x) for k, v in CHANNELS.items() for x in (k, v)])
    mask = F.col("Image_FileName_RNA_mask")
    return fused.select(
        "raw_id", "feed", "file_seq", F.col("Image_FileName.value").alias("Image_FileName"), F.col("Image_PathName.value").alias("Image_PathName"),
        number("Metadata_Plate").alias("Metadata_Plate"), F.col("Metadata_Well.value").alias("Metadata_Well"), number("Metadata_Field").alias("Metadata_Field"), number("Metadata_Channel").alias("Metadata_Channel"),
        F.coalesce(F.try_element_at(names, number("Metadata_Channel_name")), F.col("Metadata_Channel_name.value")).alias("Metadata_Channel_name"), F.col("Metadata_Channel_name.tag").alias("channel_name_tag"),
        F.when(mask.tag == "boolean", F.when(mask.as_boolean, F.regexp_replace("Image_FileName.value", r"\.tiff?$", ".png"))).otherwise(mask.value).alias("Image_FileName_RNA_mask"), mask.tag.alias("mask_tag"),
        F.col("Image_PathName_RNA_mask.value").alias("Image_PathName_RNA_mask"), F.col("FileName_Illum.value").alias("FileName_Illum"), F.col("PathName_Illum.value").alias("PathName_Illum"),
        F.transform_values("other", lambda _, c: F.struct(c["value"].alias("value"), c["tag"].alias("tag"))).alias("other"),
    )


#: no plate or well that exists has this key
NOWHERE = "?"


def _place(plate: str = "Metadata_Plate", well: str = "Metadata_Well"):
    there = F.concat_ws("|", plate_number(F.col(plate)).cast("string"), well_name(F.col(well)))
    valid = plate_number(F.col(plate)).isNotNull() & well_name(F.col(well)).isNotNull()
    return F.when(F.col(plate).isNotNull() & F.col(well).isNotNull(), F.when(valid, there).otherwise(F.lit(NOWHERE)))


def _references(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame]]:
    cells, qc, plates = (table(spark, folder, t) for t in ("cells", "image_qc", "platemap"))
    return [
        ("cells", cells.select(F.col("cell_id").alias("row_id"), _place().alias("key"), F.col("exported_at").alias("time"))),
        ("image_qc", qc.select(F.col("qc_id").alias("row_id"), _place().alias("key"), F.col("acquired_at").alias("time"))),
        ("platemap", plates.select(F.col("platemap_id").alias("row_id"), perturbation_key(F.col("Metadata_Perturbation")).alias("key"), F.col("registered_at").alias("time"))),
    ]


def _orphans(spark: SparkSession, folder: str) -> list[tuple[str, DataFrame, DataFrame]]:
    wells = table(spark, folder, "platemap").withColumn("key", _place()).filter(F.col("key") != NOWHERE)
    known = table(spark, folder, "perturbations").withColumn("key", perturbation_key(F.col("Metadata_Perturbation")))
    parents = {"cells": (wells, "deleted_at"), "image_qc": (wells, "deleted_at"), "platemap": (known, "retired_at")}
    return [(t, find_orphans(refs, parents[t][0], "row_id", "key", "time", "registered_at", parents[t][1]), refs) for t, refs in _references(spark, folder)]


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    (t, first, _), *rest = _orphans(spark, folder)
    out = first.select(F.lit(t).alias("source_table"), "row_id")
    for t, orphans, _ in rest:
        out = out.unionByName(orphans.select(F.lit(t).alias("source_table"), "row_id"))
    return out


def p6_by_month(spark: SparkSession, folder: str) -> DataFrame:
    out = None
    for t, orphans, refs in _orphans(spark, folder):
        part = count_by_month(orphans.withColumn("source_table", F.lit(t)), refs.filter("key is not null and time is not null").withColumn("source_table", F.lit(t)), ["source_table"], "time")
        out = part if out is None else out.unionByName(part)
    return out


QUERIES = {f.__name__: f for f in (p3_found, p3_flags, p5_found, p5_changes, p5_types, p5_lines, p5_table, p6_found, p6_by_month)}

_READINGS = ", ".join(QC_BOUNDS)
_P3 = f"""
WITH rows AS (SELECT qc_id, acquired_at, TRY_CAST(NULLIF(regexp_extract(upper(trim(Metadata_Plate)), '^P?0*([0-9]{{1,18}})$', 1), '') AS BIGINT) AS plate, {_READINGS} FROM image_qc),
long AS (SELECT * FROM (UNPIVOT rows ON {_READINGS} INTO NAME measurement VALUE v) WHERE NOT isnan(v)),
center AS (SELECT plate, measurement, median(v) AS m, count(*) AS n FROM long WHERE plate IS NOT NULL AND isfinite(v) GROUP BY ALL),
spread AS (SELECT l.plate, l.measurement, median(abs(v - m)) AS mad FROM long l JOIN center c USING (plate, measurement) WHERE isfinite(v) GROUP BY ALL),
step AS (SELECT *, CASE WHEN v = lag(v) OVER w THEN 0 ELSE 1 END AS fresh FROM long WHERE plate IS NOT NULL WINDOW w AS (PARTITION BY plate, measurement ORDER BY acquired_at, qc_id)),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY plate, measurement ORDER BY acquired_at, qc_id) AS run FROM step),
stuck AS (SELECT qc_id, measurement, count(*) OVER (PARTITION BY plate, measurement, run) AS len FROM runs)
SELECT l.qc_id, l.measurement FROM long l LEFT JOIN center c ON l.plate = c.plate AND l.measurement = c.measurement AND c.n >= 20
LEFT JOIN spread s ON c.plate = s.plate AND c.measurement = s.measurement LEFT JOIN stuck k ON l.qc_id = k.qc_id AND l.measurement = k.measurement
WHERE isinf(v) OR (l.measurement LIKE '%Slope%' AND v > 0) OR (l.measurement LIKE '%Focus%' AND v < 0) OR (l.measurement LIKE '%MedianInt%' AND (v < 0 OR v > 1))
OR (c.n IS NOT NULL AND (abs(v - m) > 6 * 1.4826 * mad OR len >= 8))
"""

_PLATE = "regexp_extract(upper(trim(Metadata_Plate)), '^P?0*([0-9]{1,18})$', 1)"
_WELL = "regexp_extract(upper(trim(Metadata_Well)), '^[A-H](0[1-9]|1[0-2])$', 0)"
_P6_CTES = f"""
wells AS (SELECT {_PLATE} AS p, {_WELL} AS w, registered_at, deleted_at FROM platemap WHERE Metadata_Plate IS NOT NULL AND Metadata_Well IS NOT NULL AND {_PLATE} <> '' AND {_WELL} <> ''),
refs AS (SELECT 'cells' AS source_table, cell_id AS row_id, exported_at AS t, {_PLATE} AS p, {_WELL} AS w FROM cells WHERE Metadata_Plate IS NOT NULL AND Metadata_Well IS NOT NULL AND exported_at IS NOT NULL
UNION ALL SELECT 'image_qc', qc_id, acquired_at, {_PLATE}, {_WELL} FROM image_qc WHERE Metadata_Plate IS NOT NULL AND Metadata_Well IS NOT NULL AND acquired_at IS NOT NULL),
perts AS (SELECT upper(trim(Metadata_Perturbation)) AS k, registered_at, retired_at FROM perturbations),
alls AS (SELECT source_table, row_id, t, EXISTS (SELECT 1 FROM wells x WHERE x.p = refs.p AND x.w = refs.w AND x.registered_at <= t AND (x.deleted_at IS NULL OR t < x.deleted_at)) AS ok FROM refs
UNION ALL SELECT 'platemap', platemap_id, m.registered_at, EXISTS (SELECT 1 FROM perts x WHERE x.k = upper(trim(m.Metadata_Perturbation)) AND x.registered_at <= m.registered_at AND (x.retired_at IS NULL OR m.registered_at < x.retired_at))
FROM platemap m WHERE Metadata_Perturbation IS NOT NULL AND m.registered_at IS NOT NULL)"""

_TAG = "CASE json_type(j, '$.\"' || k || '\"') WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DOUBLE' THEN 'number' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'integer' END"
_KEYS = "lines AS (SELECT feed, file_seq, record::JSON AS j FROM manifest_files WHERE feed IS NOT NULL AND file_seq IS NOT NULL AND json_valid(record) AND json_type(record) = 'OBJECT'), keys AS (SELECT feed, file_seq, j, unnest(list_distinct(json_keys(j))) AS k FROM lines)"
_TYPES = f"""{_KEYS}, top AS (SELECT feed, file_seq, k AS field, {_TAG} AS tag, json_extract(j, '$."' || k || '"') AS v FROM keys),
parts AS (SELECT feed, file_seq, field, tag FROM top UNION ALL SELECT feed, file_seq, field || '[]', CASE json_type(e) WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'DOUBLE' THEN 'number' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'integer' END
FROM (SELECT feed, file_seq, field, unnest(v::JSON[]) AS e FROM top WHERE tag = 'array'))"""

ORACLES = {
    "p3_found": _P3,
    "p5_types": f"WITH {_TYPES} SELECT feed, field, tag, count(*) AS n, min(file_seq) AS first_file, max(file_seq) AS last_file FROM parts GROUP BY 1, 2, 3",
    "p5_lines": "SELECT feed, file_seq, count(*) AS n_lines, count(*) FILTER (CASE WHEN record IS NULL OR NOT json_valid(record) THEN true ELSE json_type(record) <> 'OBJECT' END) AS n_unreadable FROM manifest_files GROUP BY 1, 2",
    "p6_found": f"WITH {_P6_CTES} SELECT source_table, row_id FROM alls WHERE NOT ok",
    "p6_by_month": f"""WITH {_P6_CTES} SELECT source_table, strftime(t, '%Y-%m') AS month, count(*) AS n_rows, count(*) FILTER (NOT ok) AS n_orphans,
round(count(*) FILTER (NOT ok) / count(*), 6) AS orphan_rate FROM alls GROUP BY ALL""",
}
