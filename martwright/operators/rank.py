"""Row numbers and tiles over a whole table without one task holding the whole table.

A window without PARTITION BY runs in a single task. Here the keys are range-partitioned and sorted,
every row takes its place within its range, and the sizes of the ranges before it complete the
number. All rankings of a table share one range shuffle. The unique id breaks ties, so one value
shared by a third of the rows still spreads over many ranges.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.materialize import materialize

# Documented layout of monotonically_increasing_id: partition above bit 33, row number below.
ROW_BITS = 33


@dataclass(frozen=True)
class Ranking:
    """One order over the table. NULL counts as the largest key, as in the source warehouse."""

    name: str
    key: Column
    descending: bool = False

    def order(self, column: str) -> Column:
        key = F.col(column)
        return key.desc_nulls_first() if self.descending else key.asc_nulls_last()


@dataclass(frozen=True)
class Ranked:
    """The id with one row-number column per ranking, and the number of rows ranked."""

    frame: DataFrame
    rows: int

    def tile(self, name: str, tiles: int) -> Column:
        """ntile(tiles): the first rows % tiles tiles hold one row more than the others."""
        size, larger = divmod(self.rows, tiles)
        place = F.col(name) - 1
        in_larger = F.floor(place / F.lit(size + 1)) + 1
        if size == 0:
            return in_larger.cast("int")
        border = larger * (size + 1)
        in_smaller = F.floor((place - border) / F.lit(size)) + 1 + larger
        return F.when(place < border, in_larger).otherwise(in_smaller).cast("int")


def global_row_numbers(df: DataFrame, id_column: str, rankings: Sequence[Ranking]) -> Ranked:
    """row_number() over (order by key, id) for every ranking; id must be unique and not NULL."""
    spark = df.sparkSession
    slots = range(len(rankings))
    keyed = df.select(
        F.col(id_column).alias("_id"),
        *[r.key.alias(f"_key_{i}") for i, r in zip(slots, rankings)],
        F.explode(F.array(*[F.lit(i) for i in slots])).alias("_slot"),
    ).select(
        "_id",
        "_slot",
        *[F.when(F.col("_slot") == i, F.col(f"_key_{i}")).alias(f"_key_{i}") for i in slots],
    )
    order = [F.col("_slot"), *[r.order(f"_key_{i}") for i, r in zip(slots, rankings)], F.col("_id")]
    placed = materialize(
        keyed.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("_id", "_slot", F.monotonically_increasing_id().alias("_place"))
    )

    part = F.shiftright("_place", ROW_BITS)
    # One row per range partition, so the driver holds a few thousand numbers at most.
    sizes = sorted(
        placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()
    )
    starts = [0, *accumulate(size["rows"] for size in sizes)]
    rows = starts[-1] // len(rankings)
    offsets = spark.createDataFrame(
        [(size["part"], start) for size, start in zip(sizes, starts)], "_part bigint, _start bigint"
    )

    # Every ranking fills `rows` places in a row, so its own count starts at slot * rows.
    number = (
        F.col("_place").bitwiseAND((1 << ROW_BITS) - 1)
        + F.col("_start")
        - F.col("_slot") * F.lit(rows)
        + 1
    )
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    wide = numbered.groupBy(F.col("_id").alias(id_column)).agg(
        *[F.max(F.when(F.col("_slot") == i, number)).alias(r.name) for i, r in zip(slots, rankings)]
    )
    return Ranked(wide, rows)
