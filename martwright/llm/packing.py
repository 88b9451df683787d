"""Pack token sequences into as few sequences of bounded length as it can."""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import only_mine, remembers, stored
from martwright.llm.tokens import Remembered, vocabulary

# Pieces packed in one task; each group of so many fills all but a few of its sequences.
GROUP_PIECES = 20_000


# ---- pieces of documents --------------------------------------------------------------------


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes; one per worker process."""

    def __init__(self, path: str):
        self.vocabulary = vocabulary(path)
        self.words = Remembered(self.word)

    def word(self, word: str) -> bytes:
        v = self.vocabulary
        return np.array(
            [i for x in v.pattern.findall(word) for i in v.merge(x)], np.dtype("<u4")
        ).tobytes()

    def ids(self, text: str) -> bytes:
        v = self.vocabulary
        if v.lower and v.plain(text):
            # This tokenizer drops white space, so each word of a plain text stands on its own.
            return b"".join(map(self.words.__getitem__, text.lower().split()))
        return np.array(v.encode(text), np.dtype("<u4")).tobytes()


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _forget() -> None:
    encoder.cache_clear()
    vocabulary.cache_clear()


remembers(__name__, _forget)


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Token ids of every text with `end_id` behind, cut only where longer than `capacity`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_mine(__name__)
        code, end = encoder(path), np.array([end_id], np.dtype("<u4")).tobytes()
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = code.ids(text.as_py() or "") + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.record_batch(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["id", "piece", "start", "length", "ids_crc32"],
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)])
    schema = schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(cut, schema)


# ---- packing one group ----------------------------------------------------------------------


class Bins:
    """Bins of items of whole lengths, with the free bins found by their gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []  # (length, item) of each bin
        self.gap: list[int] = []

    def best_fit(self, lengths: np.ndarray) -> None:
        """Longest first, each into the fullest bin that has room."""
        by_gap: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        free = 0  # bit g is set where a bin with gap g > 0 exists
        for item in np.argsort(-lengths, kind="stable").tolist():
            length = int(lengths[item])
            above = free >> length
            if above:
                gap = length + (above & -above).bit_length() - 1
                at = by_gap[gap].pop()
                if not by_gap[gap]:
                    free &= ~(1 << gap)
                self.items[at].append((length, item))
            else:
                gap, at = self.capacity, len(self.items)
                self.items.append([(length, item)])
                self.gap.append(gap)
            self.gap[at] = rest = gap - length
            if rest:
                by_gap[rest].append(at)
                free |= 1 << rest

    def change(self, give: int, take: int, out: list, back: list) -> None:
        """Bin `give` hands over the items `out` for the items `back` of bin `take`."""
        moved = sum(x for x, _ in out) - sum(x for x, _ in back)
        for x in out:
            self.items[give].remove(x)
            self.items[take].append(x)
        for x in back:
            self.items[take].remove(x)
            self.items[give].append(x)
        self.gap[give] += moved
        self.gap[take] -= moved

    def step(self, give: int, others: list[int]) -> int | None:
        """The change that leaves some bin fullest at the cost of the emptier `give`; its bin, if any.

        A move hands over an item, an exchange one item for a shorter one, or one for two that are
        shorter together. The other bin is at least as full, so its gain raises the squared fill.
        """
        best: tuple[int, int, list, list] | None = None
        for take in others:
            gap = self.gap[take]
            theirs = sorted(self.items[take])
            sizes = np.array([x for x, _ in theirs], np.int64)
            for mine in self.items[give]:
                found: tuple[int, list] | None = None
                if mine[0] <= gap:
                    found = (mine[0], [])
                # One for one: the shortest of theirs that still fits gains most.
                k = int(np.searchsorted(sizes, mine[0] - gap))
                if k < len(sizes) and 0 < mine[0] - sizes[k] > (found[0] if found else 0):
                    found = (int(mine[0] - sizes[k]), [theirs[k]])
                # One for two: for each first, the shortest second that still fits.
                if len(sizes) > 1:
                    second = np.searchsorted(sizes, mine[0] - gap - sizes)
                    second = np.maximum(second, np.arange(len(sizes)) + 1)
                    ok = second < len(sizes)
                    gain = np.where(ok, mine[0] - sizes - sizes[np.minimum(second, len(sizes) - 1)], 0)
                    i = int(np.argmax(gain))
                    if 0 < gain[i] <= gap and gain[i] > (found[0] if found else 0):
                        found = (int(gain[i]), [theirs[i], theirs[int(second[i])]])
                if found and (best is None or gap - found[0] < best[0]):
                    best = (gap - found[0], take, [mine], found[1])
                    if best[0] == 0:
                        break
            if best and best[0] == 0:
                break
        if best is None:
            return None
        self.change(give, best[1], best[2], best[3])
        return best[1]

    def improve(self, reach: int = 64) -> None:
        """Empty the least full bins by moves and exchanges with the `reach` bins of largest gap.

        All gaps together hold the content of so many bins at most, so no more than that many, the
        least full, are worth emptying. Every change raises the squared fill by a whole number, so
        the search ends; it is repeated as long as it empties a bin.
        """
        emptied = True
        while emptied:
            emptied = False
            under = [b for b, g in enumerate(self.gap) if g and self.items[b]]
            spare = sum(self.gap[b] for b in under) // self.capacity
            under.sort(key=lambda b: self.gap[b], reverse=True)
            for give in under[:spare]:
                while self.items[give]:
                    others = (b for b in under if b != give and 0 < self.gap[b] <= self.gap[give])
                    if self.step(give, heapq.nlargest(reach, others, key=self.gap.__getitem__)) is None:
                        break
                emptied |= not self.items[give]


def pack(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin of each item, its place there, and the gap of its bin."""
    bins = Bins(capacity)
    bins.best_fit(lengths)
    bins.improve()
    where = np.zeros(len(lengths), np.int64)
    place = np.zeros(len(lengths), np.int64)
    gap = np.zeros(len(lengths), np.int64)
    number = 0
    for items, rest in zip(bins.items, bins.gap, strict=True):
        at = 0
        for length, item in items:
            where[item], place[item], gap[item] = number, at, rest
            at += length
        number += bool(items)
    return where, place, gap


# ---- packing all groups ---------------------------------------------------------------------


def pack_sequences(
    docs: DataFrame,
    path: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids without special ones, then `end_id`. Only documents longer than
    `capacity` are cut. Pieces that fill a sequence alone get one; all others are dealt into groups of
    about GROUP_PIECES by their place in the stored piece table, so that no key is hot, and each group
    is packed by best fit and then a local search of moves and one-for-one and two-for-one exchanges
    that raises the squared fill. Pieces of sequences that are not full go to a next round with
    groups of the same size, until one group holds them all or they no longer become fewer.

    A null text is empty: one piece of length 1. Repeated rows and null ids are packed like others.
    An empty table gives no rows. Only the two named columns are read.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, path, capacity, end_id, id_column, text_column), "pieces")
    full = F.col("length") == capacity
    row = F.monotonically_increasing_id()
    whole = cut.withColumn("row", row).where(full)
    done = [whole.select("*", F.col("row").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    rest = cut.withColumn("row", row).where(~full)
    schema = T.StructType(rest.schema.fields).add("sequence_id", "long").add("offset", "long").add("gap", "long")

    def pack_group(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop(columns="task").sort_values("row")
        where, group["offset"], group["gap"] = pack(group["length"].to_numpy(), capacity)
        # A sequence is named after the row of its first piece, which no other sequence has.
        first = pd.Series(group["row"].to_numpy()).groupby(where).min().to_numpy()
        group["sequence_id"] = first[where]
        return group[schema.fieldNames()]

    n = rest.count()
    while n:
        groups = -(-n // GROUP_PIECES)
        dealt = rest.withColumn("task", F.pmod(F.xxhash64("row"), F.lit(groups)))
        packed = stored(dealt.groupBy("task").applyInPandas(pack_group, schema), "packed")
        under = packed.where("gap > 0").count() if groups > 1 else 0
        again = 0 < under < 0.9 * n
        done.append((packed.where("gap = 0") if again else packed).drop("gap"))
        rest, n = packed.where("gap > 0").select(rest.columns), under if again else 0
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.drop("row").withColumnRenamed("id", id_column)
