import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.operators import tables
from martwright.operators.curve import clustered_by_curve, curve_place, range_borders


def written(df, path):
    df.write.parquet(path)
    back = df.sparkSession.read.parquet(path)
    files = back.groupBy(F.input_file_name()).agg(F.min("a"), F.max("a"), F.min("b"), F.max("b")).collect()
    return back, [tuple(r)[1:] for r in files]


def skipped(files, column, value):
    at = 2 * column
    return sum(not f[at] <= value <= f[at + 1] for f in files)


def test_a_filter_on_either_column_skips_most_files(spark, tmp_path):
    df = spark.range(40_000).select("id", F.pmod(F.xxhash64("id"), F.lit(997)).alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(991)).alias("b"))
    back, files = written(clustered_by_curve(df, ["a", "b"], ["id"], files=64), str(tmp_path / "curve"))
    assert back.count() == 40_000 and back.columns == df.columns and len(files) == 64
    _, plain = written(tables.clustered(df.repartition(8), ["a", "b"]), str(tmp_path / "plain"))
    for value in (10, 500, 900):
        assert skipped(files, 0, value) >= 0.7 * len(files)
        assert skipped(files, 1, value) >= 0.7 * len(files)
        assert skipped(plain, 1, value) < 0.2 * len(plain)


def test_skewed_values_nulls_and_other_types(spark, tmp_path):
    """A third of the rows hold one value of both columns; texts and days have ranges too."""
    day = F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int"))
    df = spark.range(12_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.xxhash64("id") % 100)).alias("a"),
        F.when(F.col("id") % 3 == 0, dt.date(2024, 5, 5)).otherwise(day).alias("b"),
    )
    back, files = written(clustered_by_curve(df, ["a", "b"], ["id"], files=16), str(tmp_path / "skew"))
    assert rows(back.agg(F.count("id"), F.sum("id"), F.count("a"))) == rows(df.agg(F.count("id"), F.sum("id"), F.count("a")))
    sizes = [r[1] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 3 * 12_000 / len(files)


def test_places_take_bits_in_turn(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 1), (1, 1), (2, 3), (None, 3)], "a int, b int")
    place = curve_place(df, ["a", "b"], {"a": [1, 2, 3], "b": [1, 2, 3]}, bits=2)
    assert [r[0] for r in df.select(place).collect()] == [0, 1, 2, 3, 14, 10]
    assert range_borders(df.limit(0), ["a"]) == {"a": []}
    with pytest.raises(ValueError):
        curve_place(df, ["a"] * 11, {"a": []}, bits=6)
