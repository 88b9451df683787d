"""Helpers shared by the text operators: stored intermediate tables and byte-level views of text."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators.materialize import shared_folder

# Bytes that separate words: space, and tab to carriage return.
SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, *range(0x09, 0x0E)]] = True
# Texts are worked on in pieces of about this many bytes; a longer text is a piece of its own.
CHUNK_BYTES = 1 << 20

# Longest range hashed by sums.
SUMMED = 64

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def bucketed(df: DataFrame, name: str, key: str) -> Iterator[DataFrame]:
    """The frame stored in buckets of a key, one per shuffle partition: joins on the key leave it in place.

    A frame that is dealt by `partitions` and the key already makes one file a bucket. Spark knows the buckets by the catalog, from which the table is taken at the end; its files stay, like
    those of `stored`.
    """
    spark = df.sparkSession
    n, table_name = partitions(spark), f"llm_{name}_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark).rstrip('/')}/{table_name}"
    try:
        df.write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(table_name)
        yield spark.table(table_name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table_name}")


# How to free what the operators of this worker process remember, by module.
_remembered: dict[str, Callable[[], None]] = {}


def remembers(module: str, forget: Callable[[], None]) -> None:
    """Tell how to free what a module keeps in its process from task to task."""
    _remembered[module] = forget


def only_mine(module: str) -> None:
    """Free what other modules keep in this process.

    Spark hands a worker process from stage to stage; without this it would hold the words of all the
    operators that ran in it.
    """
    for owner, forget in _remembered.items():
        if owner != module:
            forget()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0..n-1 of the hash base (or of its inverse) modulo 2**64; kept up to the chunk size."""
    key = "inverse" if inverse else "base"
    known = _powers.get(key)
    if known is None or len(known) < n:
        known = np.full(max(n, CHUNK_BYTES), _INVERSE if inverse else _BASE, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if len(known) <= 4 * CHUNK_BYTES:
            _powers[key] = known
    return known[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums h with which `range_hash` hashes any range of the bytes in constant time."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the ranges [start, end); equal bytes have equal hashes wherever they stand."""
    return mix((sums[end] - sums[start]) * powers(len(sums), inverse=True)[start])


def byte_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end); equal bytes have equal hashes wherever they stand.

    The sums of `range_hash` are modulo a power of two, under which some long strings of two symbols collide
    whatever the base. They hash only ranges up to SUMMED bytes, where powers do not cancel; a longer
    range is hashed by itself.
    """
    out = range_hash(prefix_hash(data), start, end)
    long = np.flatnonzero(end - start > SUMMED)
    if len(long):
        view = memoryview(np.ascontiguousarray(data))
        places = zip(start[long].tolist(), end[long].tolist())
        out[long] = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in places]
    return out


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front where a column of the frame has one of them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null rows are empty."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    rows = rows.astype(np.int64) if len(column) else np.zeros(1, np.int64)
    if data is None or rows[-1] == rows[0]:
        return np.zeros(0, np.uint8), rows - rows[0]
    return np.frombuffer(data, np.uint8)[rows[0] : rows[-1]], rows - rows[0]


def chunks(data: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive runs of rows of about CHUNK_BYTES: first row, row after the last, bytes, offsets."""
    first, n = 0, len(rows) - 1
    while first < n:
        last = int(np.searchsorted(rows, rows[first] + CHUNK_BYTES, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, data[rows[first] : rows[last]], rows[first : last + 1] - rows[first]
        first = last


def row_of(rows: np.ndarray) -> np.ndarray:
    """For each byte, the number of its row."""
    return np.repeat(np.arange(len(rows) - 1, dtype=np.int32), np.diff(rows))


def words_of(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs without separators); a row's end also ends a word."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SEPARATORS[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    filled = rows[:-1][np.diff(rows) > 0]
    starts[filled] = inside[filled + 1]
    last = filled[1:] - 1
    ends[last[last >= 0]] = inside[last[last >= 0] + 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1
