"""Keyed upserts from a stream of changes."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from martwright.operators import merge, tables

# Where a table notes the last batch of a stream, and the folder of a checkpoint that names it.
BATCH, ORIGIN = "martwright.batch.", "martwright-origin"


def last_changes(changes: DataFrame, key: str, updated_at: str) -> DataFrame:
    """The last change of every key; of changes at one time the one that is largest by its other columns."""
    others = [F.desc(c) for c in changes.columns if c not in (key, updated_at)]
    order = Window.partitionBy(key).orderBy(F.col(updated_at).desc_nulls_last(), *others)
    return changes.withColumn("_place", F.row_number().over(order)).where("_place = 1").drop("_place")


def merge_batch(
    spark: SparkSession,
    table: str,
    name: str,
    changes: DataFrame,
    batch: int,
    key: str,
    updated_at: str,
    partition_column: str | None = None,
    origin: str = "",
) -> bool:
    """Merge one batch of a stream unless the table has it already; whether it was merged.

    The number of the batch is noted on the table together with its rows: where a run dies after the rows
    are in place, the switch that the next run finishes sets the number too. Numbers of another `origin`
    were counted anew and say nothing.
    """
    table = tables.full_name(spark, table)
    tables.finish_switch(spark, table)
    counted, _, done = tables.properties(spark, table).get(BATCH + name, "").rpartition(":")
    if done and counted == origin and batch <= int(done):
        return False
    newest = last_changes(changes, key, updated_at)
    merge.merge_into_table(spark, table, newest, key, partition_column, notes={BATCH + name: f"{origin}:{batch}"})
    return True


def _origin(spark: SparkSession, checkpoint: str) -> str:
    """A name that a checkpoint folder keeps as long as it is there."""
    path = f"{checkpoint.rstrip('/')}/{ORIGIN}"
    try:
        return spark.read.schema("origin string").parquet(path).first()["origin"]
    except AnalysisException:
        origin = uuid.uuid4().hex
        spark.createDataFrame([(origin,)], "origin string").coalesce(1).write.parquet(path)
        return origin


def merge_stream(
    changes: DataFrame,
    table: str,
    name: str,
    checkpoint: str,
    key: str,
    updated_at: str,
    partition_column: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge all changes that are there into a table, batch by batch, then end.

    `changes` is a streaming frame, of files for example; `name` tells streams into one table apart, and
    `checkpoint` is the folder where Spark keeps how far it got. Spark repeats a batch that it does not know to be
    finished; the table knows, so each batch changes it once. Without its checkpoint a stream begins
    anew, and the last change of each key is merged again. `prepare` turns changes into rows of the
    table. A change that is older than the table's row of its key is merged like any other.
    """
    spark = changes.sparkSession
    origin = _origin(spark, checkpoint)

    def one(batch: DataFrame, number: int) -> None:
        rows = batch if prepare is None else prepare(batch)
        merge_batch(spark, table, name, rows, number, key, updated_at, partition_column, origin)

    return (
        changes.writeStream.queryName(name)
        .foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
