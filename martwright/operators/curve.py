"""Layout by several columns at once: rows along a space-filling curve."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows that the borders of ranges are taken from, about; and bits of a column's range number.
SAMPLE_ROWS = 20_000
BITS = 6


def range_borders(df: DataFrame, columns: Sequence[str], bits: int = BITS, seed: int = 7) -> dict[str, list]:
    """Values that cut each column into at most 2**bits ranges of like size, from a sample of bounded size."""
    rows = df.count()
    fraction = min(1.0, SAMPLE_ROWS / rows) if rows else 1.0
    sample = df.select(*columns).sample(fraction=fraction, seed=seed).collect()
    borders = {}
    for column in columns:
        values = sorted(r[column] for r in sample if r[column] is not None)
        cuts = [values[len(values) * k // (1 << bits)] for k in range(1, 1 << bits)] if values else []
        borders[column] = sorted(set(cuts))
    return borders


def _range_number(column: str, borders: list, df: DataFrame) -> Column:
    """How many borders a value reaches; NULL is in the first range."""
    kind = df.schema[column].dataType
    number = F.lit(0)
    for border in borders:
        number = number + (F.col(column) >= F.lit(border).cast(kind)).cast("int")
    return F.coalesce(number, F.lit(0))


def curve_place(df: DataFrame, columns: Sequence[str], borders: dict[str, list], bits: int = BITS) -> Column:
    """Place on the curve: the bits of the columns' range numbers, taken in turn."""
    if bits * len(columns) > 62:
        raise ValueError("too many columns for so many bits")
    place = F.lit(0).cast("long")
    for k, column in enumerate(columns):
        number = _range_number(column, borders[column], df).cast("long")
        for bit in range(bits):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, bit * len(columns) + k))
    return place


def clustered_by_curve(
    df: DataFrame, columns: Sequence[str], spread: Sequence[str] = (), files: int | None = None, bits: int = BITS
) -> DataFrame:
    """Lay rows out so that files are narrow in every one of the columns, and a filter on any skips files.

    A layout by the columns in order is narrow in the first only. Each column's range numbers follow its
    own distribution, so skewed values spread. `spread` continues the range key where many rows share
    a place. The borders come from a sample of about SAMPLE_ROWS rows and decide the layout only.
    """
    borders = range_borders(df, columns, bits)
    placed = df.withColumn("_place", curve_place(df, columns, borders, bits))
    keys = ["_place", *columns, *spread]
    dealt = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    return dealt.sortWithinPartitions(*keys).drop("_place")
