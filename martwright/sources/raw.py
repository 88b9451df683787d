"""The four raw tables as one bundle, from CSV files or from named tables."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from martwright.operators.tables import ensure_database, replace_table
from martwright.schemas import RAW_SCHEMAS


class RawTables(NamedTuple):
    customers: DataFrame
    orders: DataFrame
    products: DataFrame
    order_items: DataFrame


def read_csv(spark: SparkSession, folder: str) -> RawTables:
    """Read `raw_<name>.csv` files with a header; a value that does not fit its type is an error."""

    def one(name: str) -> DataFrame:
        return spark.read.schema(RAW_SCHEMAS[f"raw_{name}"]).csv(
            f"{folder}/raw_{name}.csv", header=True, mode="FAILFAST"
        )

    return RawTables(*[one(name) for name in RawTables._fields])


def load_csv(spark: SparkSession, folder: str, database: str) -> RawTables:
    """Read the CSV files and store them as the tables `raw_<name>`, in full each time."""
    ensure_database(spark, database)
    for name, df in read_csv(spark, folder)._asdict().items():
        replace_table(df, f"{database}.raw_{name}")
    return read_tables(spark, database)


def read_tables(spark: SparkSession, database: str) -> RawTables:
    """Read the tables `raw_<name>` of a database."""
    return RawTables(*[spark.table(f"{database}.raw_{name}") for name in RawTables._fields])
