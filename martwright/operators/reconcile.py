"""Reconciliation of two builds of a table: digests first, rows only where these differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key buckets with a digest each; so many rows, at most, are compared and sent to the driver.
BUCKETS = 4096
_SECOND_SEED = "reconcile"


def _digests(df: DataFrame, key: str, columns: Sequence[str], buckets: int) -> DataFrame:
    """Per bucket of keys the number of rows, and two sums over the rows that no order changes."""
    row = [F.col(c) for c in (key, *columns)]
    # Which values are NULL is hashed too: hashing alone passes over them.
    blanks = F.concat_ws("", *[F.when(c.isNull(), "1").otherwise("0") for c in row])
    one = F.xxhash64(blanks, *row)
    two = F.xxhash64(F.lit(_SECOND_SEED), blanks, *row)
    return df.select(_bucket(key, buckets), one.alias("one"), two.alias("two")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("one").cast("decimal(20,0)")).alias("one"),
        F.sum(F.col("two").cast("decimal(20,0)")).alias("two"),
    )


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")


def differing_buckets(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str], buckets: int = BUCKETS
) -> list[int]:
    """Buckets of keys whose rows are not the same on both sides. Only digests are shuffled."""
    one, two = (_digests(df, key, columns, buckets) for df in (left, right))
    names = ("rows", "one", "two")
    both = one.withColumnsRenamed({c: f"left_{c}" for c in names}).join(
        two.withColumnsRenamed({c: f"right_{c}" for c in names}), "bucket", "full"
    )
    same = [F.col(f"left_{c}").eqNullSafe(F.col(f"right_{c}")) for c in names]
    return [r["bucket"] for r in both.where(~(same[0] & same[1] & same[2])).select("bucket").collect()]


def reconcile(
    left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """What differs between two tables, and for how many keys: rows (difference, keys), also where it is 0.

    `only_left` and `only_right` count keys that one side lacks, `repeated` keys that occur more than
    once on a side and not alike, and a row per column the keys, once on either side, whose values
    differ there; NULL equals NULL.

    Digests of key buckets are compared first, and rows are only looked at where a digest differs: equal
    tables shuffle nothing but digests. Of differing buckets the values of a key meet in an aggregate
    that combines before the shuffle, so a key with very many rows is one row there.
    """
    columns = list(columns or [c for c in left.columns if c != key])
    names = ["only_left", "only_right", "repeated", *columns]
    spark = left.sparkSession
    differ = differing_buckets(left, right, key, columns, buckets)
    if not differ:
        return spark.createDataFrame([(name, 0) for name in names], "difference string, keys bigint")
    wanted = F.broadcast(spark.createDataFrame([(b,) for b in differ], "_bucket int"))
    bucket = _bucket(key, buckets).alias("_bucket")

    def rows(df: DataFrame, side: int) -> DataFrame:
        part = df.select(bucket, key, *columns).join(wanted, "_bucket", "left_semi")
        values = F.struct(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
        return part.select(F.col(key).alias("_key"), values.alias("_row"), F.lit(side).alias("_side"))

    versions = rows(left, 0).unionByName(rows(right, 1)).groupBy("_key", "_row").agg(
        F.count_if(F.col("_side") == 0).alias("_left"), F.count_if(F.col("_side") == 1).alias("_right")
    )
    keys = versions.groupBy("_key").agg(
        F.sum("_left").alias("_left"),
        F.sum("_right").alias("_right"),
        F.bool_and(F.col("_left") == F.col("_right")).alias("_same"),
        # Of a key that is once on either side, these are its two rows.
        F.max(F.when(F.col("_left") > 0, F.col("_row"))).alias("_one"),
        F.max(F.when(F.col("_right") > 0, F.col("_row"))).alias("_two"),
    )
    n_left, n_right = F.col("_left"), F.col("_right")
    once = (n_left == 1) & (n_right == 1)
    counts = {
        "only_left": n_right == 0,
        "only_right": n_left == 0,
        "repeated": (n_left > 0) & (n_right > 0) & ~once & ~F.col("_same"),
    }
    found = [F.count_if(condition) for condition in counts.values()]
    found += [F.count_if(once & ~F.col(f"_one.v{i}").eqNullSafe(F.col(f"_two.v{i}"))) for i in range(len(columns))]
    totals = keys.agg(*[value.alias(f"n{i}") for i, value in enumerate(found)])
    lines = [
        F.struct(F.lit(name).alias("difference"), F.col(f"n{i}").alias("keys")) for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*lines)))
