import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from martwright.operators.rank import Ranking, global_row_numbers


def expected(df, tiles):
    up = Window.orderBy(F.col("a").asc_nulls_last(), "id")
    down = Window.orderBy(F.col("b").desc_nulls_first(), "id")
    return rows(
        df.select(
            "id",
            F.row_number().over(up).alias("up"),
            F.row_number().over(down).alias("down"),
            F.ntile(tiles).over(up).alias("tile"),
        )
    )


def actual(df, tiles):
    ranked = global_row_numbers(
        df, "id", [Ranking("up", F.col("a")), Ranking("down", F.col("b"), descending=True)]
    )
    return rows(ranked.frame.select("id", "up", "down", ranked.tile("up", tiles).alias("tile")))


@pytest.mark.parametrize("count", [0, 1, 4, 5, 7, 23, 500])
def test_numbers_and_tiles_equal_windows(spark, count):
    chance = random.Random(count)
    data = [
        (i, chance.choice([None, 1, 2, 3]), chance.choice([None, "0.10", "7.25"]))
        for i in range(count)
    ]
    df = spark.createDataFrame(data, "id long, a int, b string").withColumn(
        "b", F.col("b").cast("decimal(12,2)")
    )
    assert actual(df, 5) == expected(df, 5)


def test_all_keys_equal(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("a"), F.lit(None).cast("int").alias("b"))
    assert actual(df, 3) == expected(df, 3)


def test_one_value_spreads_over_tasks(spark):
    """Nine tenths of the rows share a key; no range partition gets more than its share."""
    df = spark.range(80_000).select(
        "id", F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(0).alias("a"), F.lit(0).alias("b")
    )
    order = [F.col("a"), F.col("id")]
    sizes = (
        df.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().collect()
    )
    assert max(s["count"] for s in sizes) < 3 * 10_000
    assert actual(df, 5) == expected(df, 5)


def test_no_task_holds_the_whole_table(spark):
    df = spark.range(1000).select("id", F.col("id").alias("a"))
    ranked = global_row_numbers(df, "id", [Ranking("up", F.col("a"))])
    plan = ranked.frame._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
