from conftest import same
from pyspark.sql import functions as F

from martwright.operators.skew import HotKeys, find_hot_keys, fits_broadcast, size_in_bytes, skew_join


def skewed(spark):
    """A third of the rows on key 7, a third on NULL, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
    return spark.range(30_000).select("id", key.alias("k"))


def test_sketch_names_heavy_keys_and_nulls(spark):
    hot = find_hot_keys(skewed(spark), "k", "id", partitions=30, small_rows=0)
    assert hot["k"].salts == {7: 10}
    assert hot["k"].null_salts == 10
    assert not hot["id"]


def test_small_and_empty_tables_have_no_heavy_keys(spark):
    assert not find_hot_keys(skewed(spark), "k")["k"]
    assert not find_hot_keys(skewed(spark).limit(0), "k", small_rows=0)["k"]


def test_salted_joins_equal_plain_joins(spark):
    left = skewed(spark)
    right = spark.range(0, 30_000, 5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = right.unionByName(spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "k long, v long"))
    hot = HotKeys({7: 10}, 10)
    for how in ("inner", "left"):
        same(skew_join(left, right, "k", how, hot, spread="id"), left.join(right, "k", how))


def test_salt_splits_the_heavy_key(spark):
    hot = HotKeys({7: 10}, 10)
    salt = hot.salt(F.col("k"), "id")
    sizes = skewed(spark).where("k = 7").groupBy(salt.alias("s")).count().collect()
    assert len(sizes) == 10 and max(s["count"] for s in sizes) < 1_300


def test_string_keys(spark):
    df = skewed(spark).withColumn("k", F.col("k").cast("string"))
    hot = find_hot_keys(df, "k", partitions=30, small_rows=0)["k"]
    right = spark.createDataFrame([("7", 1), ("2", 2)], "k string, v int")
    same(skew_join(df, right, "k", "left", hot, spread="id"), df.join(right, "k", "left"))


def test_broadcast_looks_at_measured_bytes(spark):
    df = spark.range(100).select("id", F.repeat(F.lit("x"), 50).alias("t"), F.lit(None).cast("string").alias("n"))
    assert size_in_bytes(df) == 100 * (3 * 16 + 50)
    assert size_in_bytes(df.limit(0)) == 0
    assert fits_broadcast(df, 9_800) and not fits_broadcast(df, 9_799)


def test_every_heavy_key_is_named_and_looked_up(spark):
    """400 equal keys at 2,000 partitions: all are heavy, and joins by the looked-up salts hold."""
    df = spark.range(40_000).select("id", (F.col("id") % 400).alias("k"))
    hot = find_hot_keys(df, "k", partitions=2_000, small_rows=0)["k"]
    assert len(hot.salts) == 400 and set(hot.salts.values()) == {5}
    right = spark.range(0, 500, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left"):
        same(skew_join(df, right, "k", how, hot, spread="id"), df.join(right, "k", how))
