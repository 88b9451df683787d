"""Keyed upserts into a table, and the filters that find what to merge."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators import tables
from martwright.operators.materialize import shared_folder
from martwright.operators.tables import clustered


class SchemaChanged(ValueError):
    """The updates do not have the columns of the target."""


class DuplicateKeys(ValueError):
    """The updates hold more than one row for a key."""


def changed_since(
    updated_at: Column, target_latest: dt.datetime | None, run_at: dt.datetime, lookback_days: int = 3
) -> Column:
    """Rows newer than the target's newest, or changed within the lookback before the run.

    Both bounds are literals, so the earlier one reaches the scan as a pushed filter.
    """
    recent = run_at - dt.timedelta(days=lookback_days)
    bound = recent if target_latest is None else min(recent, target_latest)
    # As text: a datetime literal would be read in the time zone of this process.
    return updated_at > F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")


def days_to_rebuild(day: Column, target_latest: dt.date, lookback_days: int = 3) -> Column:
    """The target's last day, the lookback days before it, and everything later."""
    return day >= F.lit(target_latest - dt.timedelta(days=lookback_days))


def latest(df: DataFrame, column: str):
    """Largest value of a column, one row to the driver; NULL for an empty frame."""
    return df.agg(F.max(column).alias("latest")).first()["latest"]


def check_same_columns(target: DataFrame, updates: DataFrame) -> None:
    """Fail when the updates add, drop or retype a column."""
    have = {f.name: f.dataType for f in target.schema.fields}
    got = {f.name: f.dataType for f in updates.schema.fields}
    if have != got:
        names = sorted(n for n in have.keys() | got.keys() if have.get(n) != got.get(n))
        raise SchemaChanged(f"columns differ between target and updates: {', '.join(names)}")


def check_unique_key(updates: DataFrame, key: str) -> None:
    """Fail when a key occurs twice; a merge could not tell which row wins."""
    twice = updates.groupBy(key).count().where("count > 1").limit(5).collect()
    if twice:
        raise DuplicateKeys(f"{key} is not unique in the updates, e.g. {[r[key] for r in twice]}")


def upserted(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """Target rows without an update, and every update. Only the keys of the updates are shuffled."""
    check_same_columns(target, updates)
    keep = target.join(updates.select(key), key, "left_anti")
    return keep.select(*target.columns).unionByName(updates)


def latest_of_table(spark: SparkSession, table: str, column: str):
    """Largest value of a column as noted on the table, without reading rows; NULL for an empty table.

    A table without a note, written by others, is read once and gets one.
    """
    tables.finish_switch(spark, table)
    noted = tables.properties(spark, table).get(tables.LATEST + column)
    if noted is None:
        noted = tables.largest(spark.table(table), [column])[column]
        if noted is None:
            return None
        tables.set_properties(spark, table, {tables.LATEST + column: noted})
    kind = spark.table(table).schema[column].dataType.simpleString()
    return spark.sql(f"SELECT CAST('{noted}' AS {kind}) AS latest").first()["latest"]


def _latest_after(
    noted: dict[str, str], written: DataFrame, replaced: DataFrame, schema: T.StructType
) -> dict[str, str | None]:
    """Largest values after `written` rows take the place of `replaced` ones; None where a full look is needed.

    A value that the new rows reach is the largest. If they stay below, the noted one stands unless a
    replaced row held it.
    """
    if not noted:
        return {}
    spark = written.sparkSession
    after, before = tables.largest(written, list(noted)), tables.largest(replaced, list(noted))

    def ordered(low: str | None, high: str, column: str) -> bool:
        if low is None:
            return True
        kind = schema[column].dataType.simpleString()
        return spark.sql(f"SELECT CAST('{low}' AS {kind}) < CAST('{high}' AS {kind})").first()[0]

    out: dict[str, str | None] = {}
    for column, value in noted.items():
        if not ordered(after[column], value, column):
            out[column] = after[column]
        else:
            out[column] = value if ordered(before[column], value, column) else None
    return out


def merge_into_table(
    spark: SparkSession,
    table: str,
    updates: DataFrame,
    key: str,
    partition_column: str | None = None,
    cluster_by: Sequence[str] = (),
    fixed_partition: bool = False,
    notes: dict[str, str] | None = None,
) -> None:
    """Upsert into a Parquet table; with a partition column only the partitions concerned are written.

    These are the partitions the updates fall in and the ones that hold an older row of an updated key;
    `fixed_partition` says that a key never changes its partition, so that they need not be looked for.
    Updates are written first, into the folder that the partitions will point to, and their keys are read
    back from there; then the rows that stay join them. So each row is written once, and a row outside
    these partitions not at all. The old files serve readers until the catalog points to the new ones;
    a note on the table lets the next merge finish after a kill. `cluster_by` keeps the layout of
    a table that was written clustered; its updates are laid out with the other rows, so they are also
    stored by themselves. `notes` are properties that the table gets with the new rows. One writer at a time.
    """
    table = tables.full_name(spark, table)
    tables.finish_switch(spark, table)
    target = spark.table(table)
    check_same_columns(target, updates)
    updates = updates.select(*target.columns)
    noted = tables.noted_columns(spark, table)
    path = tables.new_location(spark, table)
    aside = f"{shared_folder(spark).rstrip('/')}/merge-{uuid.uuid4().hex}" if cluster_by else path
    try:
        if partition_column is None:
            updates.write.parquet(aside)
        else:
            updates.hint("rebalance", partition_column).write.partitionBy(partition_column).parquet(path)
        written = spark.read.schema(target.schema).parquet(aside).select(*target.columns)
        check_unique_key(written, key)
        if written.isEmpty():
            tables.remove_folder(spark, path)
            tables.set_properties(spark, table, notes or {})
            return
        if partition_column is None:
            kept = target.join(written.select(key), key, "left_anti").select(*target.columns)
            if cluster_by:
                clustered(kept.unionByName(written), cluster_by).write.parquet(path)
            else:
                kept.write.mode("append").parquet(path)
            written = spark.read.schema(target.schema).parquet(path)
            latest = tables.largest(written, list(noted))
        else:
            concerned = _distinct_values(written, partition_column)
            if not fixed_partition:
                before = target.select(key, partition_column).join(written.select(key), key, "left_semi")
                concerned |= _distinct_values(before, partition_column)
            scope = target.where(_in(F.col(partition_column), concerned))
            kept = scope.join(written.select(key), key, "left_anti").select(*target.columns)
            kept.hint("rebalance", partition_column).write.mode("append").partitionBy(partition_column).parquet(path)
            written = spark.read.schema(target.schema).parquet(path)
            emptied = concerned - _distinct_values(written, partition_column)
            latest = _latest_after(noted, written, scope, target.schema)
    except BaseException:
        tables.remove_folder(spark, path)
        raise
    finally:
        if cluster_by:
            tables.remove_folder(spark, aside)
    if partition_column is None:
        tables.switch_table(spark, table, path, latest, notes)
        return
    tables.switch_partitions(spark, table, partition_column, path, emptied, latest, notes)


def _in(column: Column, values: set[str | None]) -> Column:
    """Whether a partition column has one of the values, given as text."""
    found = column.cast("string").isin([v for v in values if v is not None])
    return found | column.isNull() if None in values else found


def _distinct_values(df: DataFrame, column: str) -> set[str | None]:
    """Values of a partition column, as text: one row per directory, so few."""
    return {row[0] for row in df.select(F.col(column).cast("string")).distinct().collect()}
