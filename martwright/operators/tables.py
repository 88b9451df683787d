"""Where results go: views, replaced tables, clustered layout, audit columns, layer names."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.operators.materialize import remove_folder

AUDIT_COLUMNS = ("loaded_at", "invocation_id")


def layer_schema(layer: str | None, default: str, target: str = "dev") -> str:
    """Database of a layer: the default without one, the bare layer in production, else prefixed."""
    if layer is None:
        return default
    return layer.strip() if target == "prod" else f"{default}_{layer.strip()}"


def with_audit(
    df: DataFrame, run_at: dt.datetime, run_id: str, names: Sequence[str] = AUDIT_COLUMNS
) -> DataFrame:
    """Add when and by which run the rows were loaded; consumers may want other column names."""
    loaded_at, invocation_id = names
    moment = F.lit(run_at.isoformat(sep=" ")).cast("timestamp")
    return df.withColumns({loaded_at: moment, invocation_id: F.lit(run_id)})


def clustered(df: DataFrame, columns: Sequence[str], spread: Sequence[str] = ()) -> DataFrame:
    """Lay rows out by ranges of the cluster columns, so file statistics let readers skip files.

    `spread` continues the range key. A cluster column with a handful of values, one of them holding
    most rows, then still gives many files of even size.
    """
    keys = [*columns, *spread]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def create_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    """A query stored in the catalog, without rows of its own; every session reads it by its name.

    Replacing it is one step of the catalog. A table of that name has to be dropped first.
    """
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
    return spark.table(name)


# ---- stored tables: files are written once, then the catalog points to them --------------------

# What a table notes about itself: files it is about to take over, and the largest values of columns.
PENDING, LATEST = "martwright.pending", "martwright.latest."
# Under the folder of new files: which partitions to point there. Readers skip names with this mark.
SWITCH = "_switch"
SWITCH_SCHEMA = "value string, folder string, before string"


def full_name(spark: SparkSession, table: str) -> str:
    return table if "." in table else f"{spark.catalog.currentDatabase()}.{table}"


def new_location(spark: SparkSession, table: str) -> str:
    """A folder of its own beside the tables of the database, where all executors write."""
    database, name = full_name(spark, table).rsplit(".", 1)
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}__{uuid.uuid4().hex}"


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def set_properties(spark: SparkSession, table: str, values: dict[str, str | None]) -> None:
    """Set notes of a table in one step; None takes one away, after the others are set."""
    kept = ", ".join(f"'{k}' = '{v}'" for k, v in values.items() if v is not None)
    gone = ", ".join(f"'{k}'" for k, v in values.items() if v is None)
    if kept:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({kept})")
    if gone:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({gone})")


def noted_columns(spark: SparkSession, table: str) -> dict[str, str]:
    """Columns whose largest value is noted on a table, and the values."""
    return {k.removeprefix(LATEST): v for k, v in properties(spark, table).items() if k.startswith(LATEST)}


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _described(spark: SparkSession, table: str, partition: str = "") -> str | None:
    """Where the rows of a table, or of one of its partitions, are."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").collect()
    return next((r["data_type"] for r in rows if r["col_name"] == "Location"), None)


def _partition(column: str, value: str | None) -> str:
    literal = "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"PARTITION (`{column}` = {literal})"


def known_partitions(spark: SparkSession, table: str, column: str) -> set[str | None]:
    """Values of the partitions the catalog lists, as text: one row per folder, so few."""
    return {r[0] for r in spark.table(table).select(F.col(column).cast("string")).distinct().collect()}


def stage_switch(
    spark: SparkSession, table: str, column: str, path: str, emptied: set[str | None] = frozenset()
) -> None:
    """Note under `path` where each partition written there is, and which ones will have no rows."""
    found = spark.read.schema(spark.table(table).schema).parquet(path)
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "")
    filled = found.select(F.col(column).cast("string").alias("value"), folder.alias("folder")).distinct().collect()
    # File paths are shown as URIs, locations are plain paths.
    rows = [(r["value"], unquote(r["folder"])) for r in filled] + [(value, None) for value in emptied]
    known = known_partitions(spark, table, column)
    noted = [
        (value, folder, _described(spark, table, _partition(column, value)) if value in known else None)
        for value, folder in rows
    ]
    spark.createDataFrame(noted, SWITCH_SCHEMA).coalesce(1).write.parquet(f"{path}/{SWITCH}")


def finish_switch(spark: SparkSession, table: str) -> None:
    """Point a table to the files it has a note of. Safe to repeat after a kill at any step.

    Partitions change one by one, each from all old to all new rows. Old files go last.
    """
    notes = properties(spark, table)
    path = notes.get(PENDING)
    if path is None:
        return
    (column,) = partition_columns(spark, table)
    rows = spark.read.schema(SWITCH_SCHEMA).parquet(f"{path}/{SWITCH}").collect()
    for row in rows:
        at = _partition(column, row["value"])
        if row["folder"] is None:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {at}")
            continue
        # Paths in SQL text are unescaped once.
        folder = row["folder"].replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {at} LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} {at} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    following = {k.removeprefix("next."): v for k, v in notes.items() if k.startswith("next.")}
    done = dict.fromkeys([PENDING, *(f"next.{k}" for k in following)])
    set_properties(spark, table, following | done)
    for row in rows:
        if row["before"] is not None and row["before"] != row["folder"]:
            remove_folder(spark, row["before"])
    remove_folder(spark, f"{path}/{SWITCH}")


def switch_partitions(
    spark: SparkSession,
    table: str,
    column: str,
    path: str,
    emptied: set[str | None] = frozenset(),
    latest: dict[str, str | None] | None = None,
    notes: dict[str, str] | None = None,
) -> None:
    """Let the partitions written under `path` take the place of the table's; `emptied` ones go.

    `notes` are further properties, set when the partitions are in place.
    """
    stage_switch(spark, table, column, path, emptied)
    noted = {f"next.{LATEST}{k}": v for k, v in (latest or {}).items() if v is not None}
    noted |= {f"next.{k}": v for k, v in (notes or {}).items()}
    # A note that no longer holds goes before the switch; whoever needs it looks at the rows.
    gone = {LATEST + k: None for k, v in (latest or {}).items() if v is None}
    set_properties(spark, table, noted | {PENDING: path} | gone)
    finish_switch(spark, table)


def switch_table(
    spark: SparkSession,
    table: str,
    path: str,
    latest: dict[str, str | None] | None = None,
    notes: dict[str, str] | None = None,
) -> None:
    """Let the files under `path` take the place of an unpartitioned table's rows, in one step of the catalog."""
    before = _described(spark, table)
    # Notes go before the switch and come back after it, so that a kill in between leaves none that is wrong.
    set_properties(spark, table, {LATEST + k: None for k in noted_columns(spark, table)})
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    noted = {LATEST + k: v for k, v in (latest or {}).items() if v is not None}
    set_properties(spark, table, noted | (notes or {}))
    if before and before != path:
        remove_folder(spark, before)


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo a replacement by a table of other columns that died between its two renames."""
    database, name = table.rsplit(".", 1)
    if not spark.catalog.tableExists(table):
        for found in spark.sql(f"SHOW TABLES IN {database}").collect():
            if found["tableName"].startswith(f"{name}__old_"):
                spark.sql(f"ALTER TABLE {database}.{found['tableName']} RENAME TO {table}")
                return


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table with all its files."""
    table = full_name(spark, table)
    if not spark.catalog.tableExists(table):
        return
    columns = partition_columns(spark, table)
    folders = [_described(spark, table)]
    for column in columns:
        values = known_partitions(spark, table, column)
        folders += [_described(spark, table, _partition(column, value)) for value in values]
    spark.sql(f"DROP TABLE {table}")
    for folder in filter(None, folders):
        remove_folder(spark, folder)


def _create_over(spark: SparkSession, table: str, schema: T.StructType, path: str, partition_by: str | None) -> None:
    """A table over files that are already there. Its columns are those of the files, the partition column last."""
    fields = sorted(schema.fields, key=lambda f: f.name == partition_by)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    by = f"PARTITIONED BY (`{partition_by}`)" if partition_by else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def largest(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """The largest value of each column as text, one row to the driver."""
    if not columns:
        return {}
    row = df.agg(*[F.max(c).cast("string").alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def replace_table(
    df: DataFrame,
    table: str,
    cluster_by: Sequence[str] = (),
    spread: Sequence[str] = (),
    partition_by: str | None = None,
    latest: Sequence[str] = (),
) -> DataFrame:
    """Write the whole table anew and return it as read back; the old rows stay until all new ones are written.

    Rows are written once, into a folder of their own beside the database's tables; then the catalog
    points there: a plain table in one step, a partitioned one partition by partition, with a note on the
    table by which the next write finishes after a kill. A table of other columns is put in place by
    two renames, and `recover_table` undoes the first where the second is missing. The largest values of
    the columns `latest` are noted on the table, so that an incremental run need not look for them.
    """
    spark = df.sparkSession
    table = full_name(spark, table)
    recover_table(spark, table)
    if spark.catalog.tableExists(table):
        latest = sorted({*latest, *noted_columns(spark, table)} & set(df.columns))
    path = new_location(spark, table)
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    elif cluster_by:
        df = clustered(df, cluster_by, spread)
    try:
        writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
        writer.parquet(path)
        noted = largest(spark.read.schema(df.schema).parquet(path), latest)
    except BaseException:
        remove_folder(spark, path)
        raise
    if not spark.catalog.tableExists(table):
        _create_over(spark, table, df.schema, path, partition_by)
        set_properties(spark, table, {LATEST + k: v for k, v in noted.items() if v is not None})
        return spark.table(table)
    kinds = {f.name: f.dataType for f in spark.table(table).schema.fields}
    same = list(kinds) == [f.name for f in sorted(df.schema.fields, key=lambda f: f.name == partition_by)]
    same = same and kinds == {f.name: f.dataType for f in df.schema.fields}
    if same and partition_columns(spark, table) == ([partition_by] if partition_by else []):
        if partition_by is None:
            switch_table(spark, table, path, noted)
        else:
            finish_switch(spark, table)
            values = spark.read.schema(df.schema).parquet(path).select(F.col(partition_by).cast("string"))
            filled = {r[0] for r in values.distinct().collect()}
            emptied = known_partitions(spark, table, partition_by) - filled
            switch_partitions(spark, table, partition_by, path, emptied, noted)
        return spark.table(table)
    old, fresh = f"{table}__old_{uuid.uuid4().hex}", f"{table}__new_{uuid.uuid4().hex}"
    _create_over(spark, fresh, df.schema, path, partition_by)
    set_properties(spark, fresh, {LATEST + k: v for k, v in noted.items() if v is not None})
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {table}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        raise
    drop_table(spark, old)
    return spark.table(table)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
