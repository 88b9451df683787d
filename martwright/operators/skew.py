"""Joins that stay balanced when one key holds a large share of the rows.

A bounded sketch names the heavy keys; their rows are spread over several tasks by a salt, and only
the few matching rows of the other side are repeated. All other keys join as usual. The choice of
heavy keys changes the speed and never the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default of `small_rows`: in a table of fewer rows one task can hold all rows of a key, so nothing is
# spread. It is a parameter of the search; results are the same with any value.
SMALL_ROWS = 5_000_000
# Largest frame that is copied to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024
# A sketch keeps this many counters for each key that can be heavy. Only partitions / 2 keys can, so
# its size grows with the partitions and not with the data.
COUNTERS_PER_KEY = 8
LEAST_COUNTERS, MOST_COUNTERS = 4_000, 1_000_000
# Up to this many heavy keys are told apart by an expression, more by a small table.
EXPRESSION_KEYS = 64
# Sketches of the scan tasks are merged in this many groups first, and then once more.
MERGE_GROUPS = 256


@dataclass(frozen=True)
class HotKeys:
    """Salt counts of the heavy keys of one column, and of its NULLs."""

    salts: dict = field(default_factory=dict)
    null_salts: int = 1

    def __bool__(self) -> bool:
        return bool(self.salts) or self.null_salts > 1

    def salt_count(self, key: Column) -> Column:
        """How many salts the key's rows are spread over; 1 for an ordinary key."""
        count = F.when(key.isNull(), self.null_salts)
        for value, salts in self.salts.items():
            count = count.when(key == F.lit(value), salts)
        return count.otherwise(1)

    def salt(self, key: Column, spread: str) -> Column:
        """Salt of a row. Only rows of heavy keys are hashed; never NULL, so nothing checks for it."""
        return _salt(self.salt_count(key), spread)

    def with_salt_count(self, df: DataFrame, key: str, column: str) -> DataFrame:
        """Adds the salt count of each row. A long list is looked up in a table, which is broadcast:
        it has at most half as many rows as there are shuffle partitions."""
        if len(self.salts) <= EXPRESSION_KEYS:
            return df.withColumn(column, self.salt_count(F.col(key)))
        kind = df.schema[key].dataType
        schema = T.StructType([T.StructField(key, kind), T.StructField(column, T.IntegerType())])
        known = df.sparkSession.createDataFrame(list(self.salts.items()), schema)
        other = F.when(F.col(key).isNull(), self.null_salts).otherwise(1)
        found = df.join(F.broadcast(known), key, "left")
        return found.select(*df.columns, F.coalesce(column, other).alias(column))


def _salt(count: Column, spread: str) -> Column:
    return F.coalesce(F.when(count > 1, F.pmod(F.xxhash64(spread), count).cast("int")), F.lit(0))


NO_HOT_KEYS = HotKeys()


def find_hot_keys(
    df: DataFrame, *columns: str, partitions: int | None = None, small_rows: int = SMALL_ROWS
) -> dict[str, HotKeys]:
    """Heavy keys of several columns in one pass that reads only these columns.

    A key is heavy when its rows would fill at least two average shuffle partitions, so at most half as
    many keys as partitions are. It gets one salt per partition's worth of rows. Small tables, which a count of the file footers tells apart,
    have no heavy keys.
    """
    if df.count() < max(small_rows, 1):
        return dict.fromkeys(columns, NO_HOT_KEYS)
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = list(enumerate(columns))
    top_keys = max(1, partitions // 2)
    counters = min(max(COUNTERS_PER_KEY * top_keys, LEAST_COUNTERS), MOST_COUNTERS)
    top_keys = min(top_keys, counters)

    def sketch(function: str, argument: str) -> Column:
        return F.expr(f"{function}({argument}, {counters})")

    group = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS))
    partial = df.groupBy(group.alias("_group")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"known_{i}") for i, c in numbered],
        *[sketch("approx_top_k_accumulate", f"`{c}`").alias(f"top_{i}") for i, c in numbered],
    )
    merged = partial.agg(
        F.sum("rows").alias("rows"),
        *[F.sum(f"known_{i}").alias(f"known_{i}") for i, _ in numbered],
        *[sketch("approx_top_k_combine", f"top_{i}").alias(f"top_{i}") for i, _ in numbered],
    )
    row = merged.select(
        "rows",
        *[f"known_{i}" for i, _ in numbered],
        *[F.expr(f"approx_top_k_estimate(top_{i}, {top_keys})").alias(f"top_{i}") for i, _ in numbered],
    ).first()

    def salts_for(rows: int) -> int:
        share = rows / row["rows"] if row["rows"] else 0.0
        return math.ceil(share * partitions) if share * partitions >= 2 else 1

    found = {}
    for i, column in numbered:
        salts = {e["item"]: salts_for(e["count"]) for e in row[f"top_{i}"] or []}
        found[column] = HotKeys(
            {key: n for key, n in salts.items() if n > 1 and key is not None},
            salts_for(row["rows"] - row[f"known_{i}"]),
        )
    return found


def size_in_bytes(df: DataFrame) -> int:
    """Bytes of the rows: the text as it is, 16 for every other column. One pass, one row back."""
    text = [c for c, kind in df.dtypes if kind == "string"]
    fixed = 16 * len(df.columns)
    row_size = F.lit(fixed).cast("bigint")
    for column in text:
        row_size = row_size + F.coalesce(F.octet_length(column), F.lit(0))
    return df.agg(F.sum(row_size).alias("bytes")).first()["bytes"] or 0


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether every executor can hold the whole frame, by its measured size."""
    return size_in_bytes(df) <= limit


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "inner",
    hot: HotKeys = NO_HOT_KEYS,
    *,
    spread: str,
) -> DataFrame:
    """Equi-join on one key; the left side may be skewed. `how` is inner or left.

    `spread` is a left column with many values inside a heavy group. Its hash picks the salt, so a
    retried task puts every row where it was before.
    """
    if how not in ("inner", "left"):
        raise ValueError("only inner and left joins can repeat rows of the right side")
    if not hot:
        return left.join(right, key, how)
    salted_left = hot.with_salt_count(left, key, "_salts")
    salted_left = salted_left.withColumn("_salt", _salt(F.col("_salts"), spread)).drop("_salts")
    salted_right = hot.with_salt_count(right, key, "_salts")
    salted_right = salted_right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    salted_right = salted_right.drop("_salts")
    return salted_left.join(salted_right, [key, "_salt"], how).drop("_salt")
