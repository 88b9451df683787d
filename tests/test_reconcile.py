from conftest import rows
from pyspark.sql import functions as F

from martwright.operators.reconcile import differing_buckets, reconcile

SCHEMA = "id int, v string, w double"


def found(left, right, **options):
    return dict(rows(reconcile(left, right, "id", **options)))


def test_differences_are_counted_by_column(spark):
    left = spark.createDataFrame(
        [(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (4, None, None), (5, "e", 5.0), (None, "n", 1.0)], SCHEMA
    )
    right = spark.createDataFrame(
        [(1, "a", 1.0), (2, "B", 2.0), (3, "c", 3.5), (4, None, None), (6, "f", 6.0), (None, "N", 1.0)], SCHEMA
    )
    want = {"only_left": 1, "only_right": 1, "repeated": 0, "v": 2, "w": 2}
    for buckets in (1, 3, 4096):
        assert found(left, right, buckets=buckets) == want
    assert found(left, right, columns=["v"]) == {"only_left": 1, "only_right": 1, "repeated": 0, "v": 2}
    assert set(found(left, left).values()) == {0}


def test_repeated_keys_and_moved_nulls(spark):
    left = spark.createDataFrame([(1, "a", 1.0)] * 3 + [(2, "x", None), (3, "y", None)], SCHEMA)
    assert found(left, left.orderBy(F.desc("id")))["repeated"] == 0
    fewer = spark.createDataFrame([(1, "a", 1.0)] * 2 + [(2, "x", None), (3, "y", None)], SCHEMA)
    assert found(left, fewer) == {"only_left": 0, "only_right": 0, "repeated": 1, "v": 0, "w": 0}
    # The same values in other columns are another row.
    one = spark.createDataFrame([(1, "a", None)], "id int, v string, w string")
    two = spark.createDataFrame([(1, None, "a")], "id int, v string, w string")
    assert found(one, two) == {"only_left": 0, "only_right": 0, "repeated": 0, "v": 1, "w": 1}


def test_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], SCHEMA)
    assert found(left, left.limit(0)) == {"only_left": 2, "only_right": 0, "repeated": 0, "v": 0, "w": 0}
    assert set(found(left.limit(0), left.limit(0)).values()) == {0}


def test_only_digests_are_shuffled_and_only_differing_buckets_are_read_again(spark):
    left = spark.range(5000).select(F.col("id"), F.concat(F.lit("v"), "id").alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 77, "other").otherwise(F.col("v")))
    assert differing_buckets(left, left.repartition(3), "id", ["v"], 64) == []
    assert len(differing_buckets(left, right, "id", ["v"], 64)) == 1
    assert dict(rows(reconcile(left, right, "id", buckets=64)))["v"] == 1
