import os

import pytest
from pyspark.sql import functions as F

from wellspring.functions import keys as K
from wellspring.sources import scan, sink
from wellspring.streaming.manifests import run_available, stream_table, windowed_counts


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_manifest_from_file_names(spark, tmp_path):
    good = "x/Plate_P01_/raw/001003-1-001002004.tif"
    for name in (good, "x/Plate_P01_/raw/001003-1-001001004.tif", "x/Plate_P01_/raw/notes.tif", "x/Plate_P01_/raw/001003-1-001002004.png", "x/Plate_P01_/Output/001003-1-001002004.tif", "x/Plate_P01_/raw/001003-1-001002001.tif"):
        write(str(tmp_path / name), "II*")  # Spark lists no empty files
    long = scan.manifest(scan.image_files(spark, str(tmp_path)), illum="/illum")
    rows = {r.Metadata_Channel: r for r in long.collect()}
    assert set(rows) == {1, 4} and rows[4].Metadata_Well == "A03" and rows[4].Metadata_Plate == "01" and rows[4].Metadata_Channel_name == "Syto"
    wide = scan.wide_manifest(long).collect()
    assert len(wide) == 1 and wide[0].FileName_Syto == "001003-1-001002004.tif" and wide[0].FileName_ER is None and wide[0].Image_FileName_RNA_mask == "001003-1-001002004.png"
    assert scan.image_files(spark, str(tmp_path), plates=["02"]).count() == 0


def test_object_tables_of_all_batches(spark, tmp_path):
    head = "ImageNumber\tObjectNumber\tMetadata_Field\tMetadata_Plate\tMetadata_Well\tArea\tDropped\n"
    for b in (1, 2):
        write(str(tmp_path / f"batch_{b}" / "Cells.txt"), head + f"{b}\t1\t1\t01\t a01 \tNaN\tz\n{b}\t2\t1\t01\tA02\t5.5\tz\n")
    df = scan.object_table(spark, f"{tmp_path}/*/Cells.txt", ["Area"])
    assert df.count() == 4 and df.filter("Area is null").count() == 2 and {r.Metadata_Plate for r in df.collect()} == {"01"} and scan.feature_columns(df) == ["Area"]
    with pytest.raises(ValueError):
        scan.object_table(spark, f"{tmp_path}/*/Cells.txt", ["Missing"])


def test_platemap_and_image_table(spark, tmp_path):
    write(str(tmp_path / "map.csv"), "Plate_Name,Well,Compound\n1,a01,X\nP02,B02,Y\n")
    assert sorted(scan.platemap(spark, str(tmp_path / "map.csv")).collect()) == [("P02", "B02", "Y"), ("P1", "A01", "X")]
    with pytest.raises(ValueError):
        scan.platemap(spark, str(tmp_path / "map.csv"), strict=True)
    write(str(tmp_path / "Image.txt"), "Metadata_Plate\tMetadata_Well\tMetadata_Field\tCount_Cells\n01\tA01\t3\tNaN\n")
    row = scan.image_table(spark, str(tmp_path / "Image.txt")).first()
    assert row.Metadata_Site == "3" and row.Count_Cells is None


def test_profiles_fall_back_and_union(spark, tmp_path):
    write(str(tmp_path / "a" / "x_reduced.csv"), "Metadata_Plate,f1\n01,1.5\n")
    write(str(tmp_path / "b" / "y_reduced.csv"), "Metadata_Plate,f2\n02,2.5\n")
    got = {r.Metadata_Plate: (r.f1, r.f2) for r in scan.profiles(spark, str(tmp_path)).collect()}
    assert got == {"01": (1.5, None), "02": (None, 2.5)}
    with pytest.raises(FileNotFoundError):
        scan.profiles(spark, str(tmp_path / "a"), ("none*.csv",))


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, [1, 2], 0.123456789, float("nan"))], "k int, a array<int>, x double, y double")
    sink.write_csv(df, str(tmp_path / "c"), digits=6, single=True)
    assert spark.read.csv(str(tmp_path / "c"), header=True).first()[:3] == ("1", "1|2", "0.123457")
    sink.write_json(df, str(tmp_path / "j"))
    assert '"y":null' in spark.read.text(str(tmp_path / "j")).first()[0]
    pairs = spark.createDataFrame([("a", "b", 0.5)], "label_a string, label_b string, similarity double")
    sink.write_similarity_matrix(pairs, str(tmp_path / "m"), ["a", "b"])
    cells = {(r.label, r.place): r.similarity for r in scan.similarity_matrix(spark, str(tmp_path / "m")).collect()}
    assert cells == {("a", 0): 1.0, ("a", 1): 0.5, ("b", 0): 0.5, ("b", 1): 1.0}
    assert sink.split_by_group(df, "k", 3).first().part in range(3)


def test_keys(spark):
    df = spark.createDataFrame([(p,) for p in ("P01", "01", "P1", " p001 ", "1", "P", "PP1", "x", None, "")], "p string")
    assert [r[0] for r in df.select(K.plate_number(F.col("p"))).collect()] == [1, 1, 1, 1, 1, None, None, None, None, None]
    wells = spark.createDataFrame([(w,) for w in ("A01", " h12 ", "A1", "I01", "A13", None)], "w string")
    assert [r[0] for r in wells.select(K.well_name(F.col("w"))).collect()] == ["A01", "H12", None, None, None, None]
    assert spark.range(1).select(K.well_label(F.lit(27), F.lit(3)), K.channel_name(F.lit(9)), K.plate_text(F.lit("P00"))).first()[:] == ("AA03", "9", "0")


def test_stream_of_available_files(spark, tmp_path):
    spark.sql("select timestamp'2024-01-01 00:10:00' as t, 'f' as feed union all select timestamp'2024-01-01 09:00:00', 'f'").write.parquet(str(tmp_path / "in"))
    schema = spark.read.parquet(str(tmp_path / "in")).schema
    stream = windowed_counts(stream_table(spark, str(tmp_path / "in"), schema), "t", ["feed"])
    run_available(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    run_available(windowed_counts(stream_table(spark, str(tmp_path / "in"), schema), "t", ["feed"]), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert [(r.feed, r.n) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("f", 1)]
