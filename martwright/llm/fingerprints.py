"""Order MinHash: document fingerprints whose likeness follows the edit distance."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import mix, partitions

# Texts up to this many k-mers try all orders in one step; longer ones take them one by one.
AT_ONCE = 1 << 14


@dataclass(frozen=True)
class OrderMinHash:
    """`coordinates` tuples of two k-mers of `k` code points, 16 bits kept of each."""

    k: int = 5
    coordinates: int = 32

    @property
    def multipliers(self) -> np.ndarray:
        return mix(np.arange(101, 101 + self.coordinates, dtype=np.uint64)) | np.uint64(1)

    def sketch(self, text: str) -> np.ndarray:
        """The hashed tuples of a text, as 16-bit numbers.

        Each coordinate orders the pairs (k-mer, occurrence number) by its own hash, takes the two
        smallest and hashes their k-mers in the order in which they stand in the text. A text shorter
        than k code points is one k-mer; an empty one has the fingerprint of zeros.
        """
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        n = max(0, len(points) - self.k + 1) or min(1, len(points))
        if not n:
            return np.zeros(self.coordinates, np.uint16)
        kmer = np.zeros(n, np.uint64)
        for j in range(min(self.k, len(points))):
            kmer = kmer * np.uint64(0x100000001B3) + points[j : j + n] + np.uint64(1)
        # One sort puts equal k-mers together in text order: high bits of the hash, then the place.
        bits = np.uint64(max(1, n.bit_length()))
        keys = np.sort(mix(kmer) >> bits << bits | np.arange(n, dtype=np.uint64))
        place = keys & ((np.uint64(1) << bits) - np.uint64(1))
        kmer = keys >> bits
        index = np.arange(n)
        new = np.ones(n, bool)
        new[1:] = kmer[1:] != kmer[:-1]
        nth = index - np.maximum.accumulate(np.where(new, index, 0))
        numbered = mix(kmer * np.uint64(0x9E3779B97F4A7C15) + nth.astype(np.uint64))
        if n == 1:
            one = two = np.zeros(self.coordinates, np.int64)
        elif n <= AT_ONCE:
            order = self.multipliers[:, None] * numbered
            one = order.argmin(axis=1)
            order[np.arange(self.coordinates), one] = ~np.uint64(0)
            two = order.argmin(axis=1)
        else:
            found = []
            for m in self.multipliers:
                order = m * numbered
                first = int(order.argmin())
                order[first] = ~np.uint64(0)
                found.append((first, int(order.argmin())))
            one, two = np.array(found).T
        swap = place[one] > place[two]
        first, second = np.where(swap, two, one), np.where(swap, one, two)
        tuples = mix(mix(kmer[first] + self.multipliers) * np.uint64(3) + kmer[second])
        return (tuples >> np.uint64(48)).astype(np.uint16)


def likeness(one: np.ndarray, two: np.ndarray) -> float:
    """Share of equal coordinates."""
    return float((one == two).mean())


def _hex(sketch: np.ndarray) -> str:
    return sketch.astype(">u2").tobytes().hex()


def fingerprints(
    docs: DataFrame, method: OrderMinHash | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document with its fingerprint, as `coordinates` * 4 hex digits."""
    method = method or OrderMinHash()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_hex(method.sketch(x.as_py() or "")) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], names=["id", "fingerprint"])

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)]).add("fingerprint", "string")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(describe, schema).withColumnRenamed("id", id_column)


def with_next(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Documents in blocks of descending id, each sorted, with the first row of the next block behind.

    Blocks are ranges of the id between approximate quantiles, one per shuffle partition. The last row
    of a block needs the first one of the block below it, and the lowest block that of the highest:
    these rows, one id per block, are sent to both blocks. Null ids come last, equal ids by text.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    read = docs.select(
        F.col(id_column).alias("id"),
        F.col(text_column).alias("text"),
        F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("key"),
    )
    keys = read.select("key", F.col("key").cast("double").alias("at"))
    cuts = keys.agg(F.percentile_approx("at", [i / n for i in range(1, n)] or [0.5])).head()[0] or [0.0]
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    part = Bucketizer(splits=splits, inputCol="at", outputCol="block")
    first = part.transform(keys).groupBy("block").agg(F.max("key").alias("key")).orderBy("block").collect()
    # The first row of each block goes to the block above it, that of the highest to the lowest.
    above = [r["block"] for r in first[1:]] + [r["block"] for r in first[:1]]
    behind = spark.createDataFrame(
        [(r["key"], b) for r, b in zip(first, above, strict=True)], "key long, behind double"
    )
    placed = part.transform(read.withColumn("at", F.col("key").cast("double"))).join(
        F.broadcast(behind), "key", "left"
    )
    here = F.struct(F.col("block").cast("int").alias("block"), F.lit(False).alias("extra"))
    there = F.struct(F.col("behind").cast("int").alias("block"), F.lit(True).alias("extra"))
    both = F.when(F.col("behind").isNull(), F.array(here)).otherwise(F.array(here, there))
    rows = placed.select("id", "text", "key", F.explode(both).alias("to")).select("id", "text", "key", "to.*")
    sent = rows.repartitionById(n, F.col("block"))
    return sent.sortWithinPartitions("block", "extra", F.desc("key"), "text").select("id", "text", "block", "extra")


def edited_fingerprints(
    docs: DataFrame, method: OrderMinHash | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its fingerprint, that of an edited text, and likenesses.

    The edited text keeps the first half and replaces the last floor(n_chars / 2) code points by the
    first as many (or all) of the next document, by descending id; after the last one comes the
    first. Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next (likeness to the edited text's and the next document's fingerprint, 0 to 1).

    A null text is empty. Ids are whole numbers; a null id comes after all others, equal ids are
    ordered by text. A lone document is its own next. An empty table gives no rows. Each task
    reads its block row by row, whatever the block's size. Only the two named columns are read.
    """
    method = method or OrderMinHash()

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # the row that waits for its next one
        for batch in batches:
            out: list[tuple] = []
            for at, (text, block, extra) in enumerate(
                zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            ):
                if extra and held is None:
                    continue
                text = text.as_py() or ""
                sketch = method.sketch(text)
                if held is not None:
                    old, old_text, old_sketch, old_block = held
                    if old_block != block:
                        raise RuntimeError(f"block {old_block} ended without the row behind it")
                    half = len(old_text) // 2
                    edited = old_text[: len(old_text) - half] + text[:half]
                    new = method.sketch(edited)
                    out.append(
                        (
                            old,
                            len(old_text),
                            hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                            _hex(old_sketch),
                            _hex(new),
                            likeness(old_sketch, new),
                            likeness(old_sketch, sketch),
                        )
                    )
                held = None if extra else (batch.column(0)[at].as_py(), text, sketch, block)
            columns = list(zip(*out, strict=True)) or [()] * len(schema)
            yield pa.record_batch(
                [pa.array(c, t) for c, t in zip(columns, arrow, strict=True)], names=schema.fieldNames()
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)]).add("n_chars", "long")
    schema = schema.add("edited_sha256", "string").add("fingerprint", "string").add("edited_fingerprint", "string")
    schema = schema.add("near_edited", "double").add("near_next", "double")
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.StringType: pa.string(), T.DoubleType: pa.float64()}
    arrow = [kinds[type(f.dataType)] for f in schema.fields]
    rows = with_next(docs, id_column, text_column)
    return rows.mapInArrow(walk, schema).withColumnRenamed("id", id_column)
