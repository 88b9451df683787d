"""Versions of rows over time, and a comparison of two builds of one table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martwright.operators import merge, tables
from martwright.operators.skew import NO_HOT_KEYS, HotKeys, skew_join

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def start_history(source: DataFrame, updated_at: str = "updated_at") -> DataFrame:
    """First version of every row, open-ended."""
    changed = F.col(updated_at)
    never = F.lit(None).cast(source.schema[updated_at].dataType)
    return source.withColumns({VALID_FROM: changed, VALID_TO: never})


def extend_history(
    history: DataFrame, source: DataFrame, key: str, updated_at: str = "updated_at"
) -> DataFrame:
    """History with the source's newer rows: each version ends where the next one of its key begins.

    The source may hold several versions of a key; they follow each other by time, and of rows with
    one key and time the one that is largest by its other columns counts. Ended versions pass through
    without a join. Rows missing from the source stay as they are.
    """
    ended = history.where(F.col(VALID_TO).isNotNull())
    still_open = history.where(F.col(VALID_TO).isNull())
    known = still_open.select(key, F.col(VALID_FROM).alias("_since"))
    newer = source.join(known, key, "left").where(
        F.col("_since").isNull() | (F.col(updated_at) > F.col("_since"))
    )
    others = [F.desc(c) for c in source.columns if c not in (key, updated_at)]
    same_time = Window.partitionBy(key, updated_at).orderBy(*others or [key])
    newer = newer.withColumn("_place", F.row_number().over(same_time)).where("_place = 1")
    following = F.lead(updated_at).over(Window.partitionBy(key).orderBy(updated_at))
    added = start_history(newer.drop("_since", "_place"), updated_at).withColumn(VALID_TO, following)
    first = newer.groupBy(key).agg(F.min(updated_at).alias("_next"))
    carried = still_open.join(first, key, "left").withColumn(VALID_TO, F.col("_next")).drop("_next")
    return ended.unionByName(carried).unionByName(added).select(*history.columns)


# Versions that still hold are in the partition without a day, ended ones in that of the run that ended them.
ENDED_ON = "ended_on"


def snapshot_into_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    key: str,
    run_at: dt.datetime,
    updated_at: str = "updated_at",
    close_missing: bool = True,
) -> DataFrame:
    """Bring a history table up to date with a source and return it.

    New and changed rows of the source start versions; a version whose key is no longer in the source
    ends at `run_at` where `close_missing` says so. Only versions that hold are read and written anew,
    beside those that this run ends: ended versions of other days stay where they are. A key that comes
    back starts a new version. A run that is repeated changes nothing. One writer at a time.
    """
    day = run_at.date()
    moment = F.lit(run_at.isoformat(sep=" ")).cast(source.schema[updated_at].dataType)
    table = tables.full_name(spark, table)
    started = start_history(source.limit(0), updated_at)
    exists = spark.catalog.tableExists(table)
    if exists:
        tables.finish_switch(spark, table)
        known = spark.table(table)
        merge.check_same_columns(known.drop(ENDED_ON), started)
        holding = known.where(F.col(ENDED_ON).isNull()).select(*started.columns)
    else:
        holding = started
    extended = extend_history(holding, source, key, updated_at)
    if close_missing:
        present = source.select(key, F.lit(True).alias("_present")).distinct()
        missing = F.col(VALID_TO).isNull() & F.col("_present").isNull()
        extended = (
            extended.join(present, key, "left")
            # A version cannot end before it starts.
            .withColumn(VALID_TO, F.when(missing, F.greatest(moment, F.col(VALID_FROM))).otherwise(F.col(VALID_TO)))
            .drop("_present")
        )
    ended = F.when(F.col(VALID_TO).isNotNull(), F.lit(day)).alias(ENDED_ON)
    rows = extended.select(*started.columns, ended)
    if not exists:
        return tables.replace_table(rows, table, partition_by=ENDED_ON)
    # Versions that an earlier run of this day ended share the partition with this run's.
    rows = rows.unionByName(known.where(F.col(ENDED_ON) == F.lit(day)).select(*rows.columns))
    path = tables.new_location(spark, table)
    try:
        rows.hint("rebalance", ENDED_ON).write.partitionBy(ENDED_ON).parquet(path)
    except BaseException:
        tables.remove_folder(spark, path)
        raise
    values = spark.read.schema(rows.schema).parquet(path).select(F.col(ENDED_ON).cast("string")).distinct()
    emptied = set() if None in {r[0] for r in values.collect()} else {None}
    tables.switch_partitions(spark, table, ENDED_ON, path, emptied & tables.known_partitions(spark, table, ENDED_ON))
    return spark.table(table)


def versions_at(history: DataFrame, moment) -> DataFrame:
    """The versions that hold at a moment (a Column or a value): from their start on, and before their end."""
    at = moment if isinstance(moment, Column) else F.lit(moment)
    return history.where(_holds(at))


def _holds(at: Column) -> Column:
    return (F.col(VALID_FROM) <= at) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > at))


def join_as_of(
    left: DataFrame,
    history: DataFrame,
    key: str,
    moment: str,
    hot: HotKeys = NO_HOT_KEYS,
    *,
    spread: str,
) -> DataFrame:
    """Every row of the left side with the version of its key that held at its moment, NULLs where none did.

    At most one version of a key holds at a time, so no row is repeated. Versions of a key are gathered
    first, into a list in order of time, so that a key is one row of the right side; the left row looks
    up its version in the list. Heavy keys of the left side are salted. History columns must not be
    among the left ones, but for the key.
    """
    names = [c for c in history.columns if c != key]
    shared = sorted(set(names) & set(left.columns))
    if shared:
        raise ValueError(f"both sides have the columns {', '.join(shared)}")
    starts_first = [VALID_FROM, *[c for c in names if c != VALID_FROM]]
    lists = history.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(*starts_first))).alias("_versions")
    )
    at = F.col(moment)
    holding = F.filter(
        "_versions", lambda v: (v[VALID_FROM] <= at) & (v[VALID_TO].isNull() | (v[VALID_TO] > at))
    )
    joined = skew_join(left, lists, key, "left", hot, spread=spread)
    return joined.withColumn("_version", F.get(holding, F.lit(0))).select(
        *left.columns, *[F.col(f"_version.{c}").alias(c) for c in names]
    )


def compare_tables(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] = ()) -> DataFrame:
    """Number of keys that are identical, different, or on one side only.

    Rows of both sides are counted together and not joined, so a repeated key costs nothing extra;
    its copies must occur equally often on both sides to be identical.
    """
    shown = [key, *(columns or [c for c in left.columns if c != key])]
    left_rows, right_rows = F.col("_left"), F.col("_right")
    both = left.select(*shown, F.lit(1).alias("_left"), F.lit(0).alias("_right")).unionByName(
        right.select(*shown, F.lit(0).alias("_left"), F.lit(1).alias("_right"))
    )
    versions = both.groupBy(*shown).agg(F.sum("_left").alias("_left"), F.sum("_right").alias("_right"))
    keys = versions.groupBy(key).agg(
        F.sum("_left").alias("_left"),
        F.sum("_right").alias("_right"),
        F.bool_and(left_rows == right_rows).alias("_same"),
    )
    status = (
        F.when(F.col("_same"), "identical")
        .when(right_rows == 0, "only_left")
        .when(left_rows == 0, "only_right")
        .otherwise("different")
    )
    return keys.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("keys"))
