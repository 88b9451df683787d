"""Data checks. Each one is a frame of failing rows; an empty frame means it passed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WARN, ERROR = "warn", "error"


@dataclass(frozen=True)
class Unique:
    column: str
    kind = "unique"


@dataclass(frozen=True)
class NotNull:
    column: str
    kind = "not_null"


@dataclass(frozen=True)
class AcceptedValues:
    column: str
    values: tuple
    kind = "accepted_values"


@dataclass(frozen=True)
class Relationship:
    column: str
    parent: str
    parent_column: str
    kind = "relationships"


Check = Unique | NotNull | AcceptedValues | Relationship


class ChecksFailed(AssertionError):
    """A check of severity error found rows."""


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with the number of rows; NULLs are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def repeated_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of values that occur more than once, for several columns: one row (i, n) per column that has any.

    Each row gives a value per column from one scan, and all are counted together: one shuffle whatever
    the number of columns. Values combine before it, so one with very many rows is no problem.
    """
    texts = [
        F.hex(c) if isinstance(df.schema[c].dataType, T.BinaryType) else F.col(c).cast("string") for c in columns
    ]
    values = F.posexplode(F.array(*texts)).alias("i", "value")
    counted = df.select(values).where(F.col("value").isNotNull()).groupBy("i", "value").count()
    return counted.where(F.col("count") > 1).groupBy("i").agg(F.count(F.lit(1)).alias("n"))


def _all_unique(table: str, df: DataFrame, checks: Sequence[Check], severity: str) -> DataFrame:
    """The report lines of all uniqueness checks of a table."""
    found = repeated_values(df, [c.column for c in checks])
    counts = found.agg(*[F.max(F.when(F.col("i") == i, F.col("n"))).alias(f"n_{i}") for i in range(len(checks))])
    lines = [_line(table, c, F.col(f"n_{i}"), severity) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*lines)))


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unaccepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with the number of rows; NULL is accepted."""
    return (
        df.where(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child keys without a parent row, with the number of rows; NULL keys are not looked up.

    Keys are counted before the join, so a key with very many rows is one row there.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_records"))
    )
    parents = parent.select(F.col(parent_column).alias("value"))
    return keys.join(parents, "value", "left_anti")


def violations(df: DataFrame, failing: Column, columns: Sequence[str], message: str) -> DataFrame:
    """Rows that break a business rule, with a message."""
    return df.where(failing).select(*columns, F.lit(message).alias("validation_error"))


def failing_rows(check: Check, table: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """What to store for a look at a failed check."""
    df = frames[table]
    if isinstance(check, Unique):
        return duplicates(df, check.column)
    if isinstance(check, NotNull):
        return nulls(df, check.column)
    if isinstance(check, AcceptedValues):
        return unaccepted(df, check.column, check.values)
    return orphans(df, check.column, frames[check.parent], check.parent_column)


def _line(table: str, check: Check, failures: Column, severity: str) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(check.column).alias("column"),
        F.lit(check.kind).alias("check"),
        F.coalesce(failures, F.lit(0)).cast("bigint").alias("failures"),
        F.lit(severity).alias("severity"),
    )


def _row_level(table: str, df: DataFrame, checks: Sequence[Check], severity: str) -> DataFrame:
    """All checks that look at one row at a time, in a single scan of their columns."""

    def bad(check: Check) -> Column:
        value = F.col(check.column)
        return value.isNull() if isinstance(check, NotNull) else ~value.isin(*check.values)

    counts = df.agg(*[F.count_if(bad(c)).alias(f"n_{i}") for i, c in enumerate(checks)])
    lines = [_line(table, c, F.col(f"n_{i}"), severity) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*lines)))


def report(
    checks: dict[str, Sequence[Check]], frames: Mapping[str, DataFrame], severity: str = WARN
) -> DataFrame:
    """One line per check: table, column, check, failures, severity.

    Failures count values for `unique` and rows for the others.
    """
    parts = []
    for table, listed in checks.items():
        df = frames[table]
        simple = [c for c in listed if isinstance(c, NotNull | AcceptedValues)]
        if simple:
            parts.append(_row_level(table, df, simple, severity))
        unique = [c for c in listed if isinstance(c, Unique)]
        if unique:
            parts.append(_all_unique(table, df, unique, severity))
        for check in listed:
            if not isinstance(check, Relationship):
                continue
            found = failing_rows(check, table, frames).agg(F.sum("n_records").alias("n"))
            parts.append(found.select(F.inline(F.array(_line(table, check, F.col("n"), severity)))))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def enforce(result: DataFrame) -> DataFrame:
    """Raise when a check of severity error failed; warnings stay in the report."""
    failed = result.where((F.col("failures") > 0) & (F.col("severity") == ERROR)).collect()
    if failed:
        names = ", ".join(f"{r['table']}.{r['column']} {r['check']}: {r['failures']}" for r in failed)
        raise ChecksFailed(names)
    return result


def store_failures(failing: DataFrame, table: str) -> None:
    """Keep the failing rows of a check in a table of their own."""
    failing.write.mode("overwrite").format("parquet").saveAsTable(table)
