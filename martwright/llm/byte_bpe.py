"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the others by a heap over linked bytes."""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import mix
from martwright.llm.pretokens import Splitter, gathered, runs_of_texts, token_ids

# Vocabulary strings a bucket of the perfect hash holds on average.
BUCKET = 4
# Characters of text encoded, and bytes of ids decoded, at a time.
RUN = 1 << 22
# Pre-tokens whose merges a process remembers, the longest of them in bytes, and strings whose rank it remembers.
REMEMBERED, SHORT, PAIRS = 1 << 19, 64, 1 << 20
_STEP = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _mix(h: int) -> int:
    """`common.mix` for one whole number."""
    h = ((h ^ (h >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    h = ((h ^ (h >> 27)) * 0x94D049BB133111EB) & _MASK
    return h ^ (h >> 31)


@dataclass(frozen=True)
class PerfectHash:
    """Byte strings at the slots 0..n-1, one each; a string's slot follows from its hash.

    The strings are dealt into buckets by their hash. Each bucket has a displacement under which all
    of its strings fall on slots of their own; a bucket of one string may name its slot outright, as a
    negative number, so that no slot stays empty.
    """

    seed: int
    displacement: list[int]
    strings: list[bytes]

    @classmethod
    def build(cls, strings: Sequence[bytes]) -> PerfectHash:
        n, seed = len(strings), 0
        if len(set(strings)) < n:
            raise ValueError("a string occurs twice")
        while True:  # until no two strings have the same 64 bits
            hashes = [xxhash.xxh3_64_intdigest(x, seed) for x in strings]
            if len(set(hashes)) == n:
                break
            seed += 1
        buckets: list[list[int]] = [[] for _ in range(-(-n // BUCKET))]
        for k, h in enumerate(hashes):
            buckets[h % len(buckets)].append(k)
        displacement, slots = [0] * len(buckets), [-1] * n
        free = np.ones(n, bool)
        tries = np.arange(64, dtype=np.uint64)[:, None] * np.uint64(_STEP)
        order = sorted(range(len(buckets)), key=lambda b: -len(buckets[b]))
        for at, b in enumerate(order):
            if len(buckets[b]) < 2:
                break
            own = np.array([hashes[k] for k in buckets[b]], np.uint64)[None, :]
            first = 0
            while True:
                step = np.uint64(first * _STEP & _MASK)
                where = (mix(own + tries + step) % np.uint64(n)).astype(np.int64)
                ordered = np.sort(where, axis=1)
                good = free[where].all(1) & (ordered[:, 1:] != ordered[:, :-1]).all(1)
                if good.any():
                    pick = int(good.argmax())
                    break
                first += len(tries)
            displacement[b] = first + pick
            for k, slot in zip(buckets[b], where[pick].tolist()):
                slots[slot] = k
            free[where[pick]] = False
        else:
            at = len(order)
        left = iter(np.flatnonzero(free).tolist())
        for b in order[at:]:
            for k in buckets[b]:
                slot = next(left)
                slots[slot], displacement[b] = k, -1 - slot
        return cls(seed, displacement, [strings[k] for k in slots])

    def slot(self, string: bytes) -> int | None:
        """The slot of a string, None where it is not among the strings; the bytes decide."""
        if not self.strings:
            return None
        h = xxhash.xxh3_64_intdigest(string, self.seed)
        d = self.displacement[h % len(self.displacement)]
        slot = -1 - d if d < 0 else _mix((h + d * _STEP) & _MASK) % len(self.strings)
        return slot if self.strings[slot] == string else None


@dataclass(frozen=True)
class Ranks:
    """A vocabulary: its strings under a perfect hash, the rank at each slot, and the longest string."""

    table: PerfectHash
    rank: list[int]
    longest: int
    pattern: str
    others: str

    @classmethod
    def build(cls, ranks: dict[bytes, int], pattern: str) -> Ranks:
        table = PerfectHash.build(list(ranks))
        longest = max(map(len, ranks), default=0)
        return cls(table, [ranks[x] for x in table.strings], longest, pattern, others(ranks, pattern))

    @classmethod
    def read(cls, spark: SparkSession, path: str, pattern: str) -> Ranks:
        """From a file of lines `base64 rank`; it is read by Spark or, without a scheme, from this machine."""
        if "://" in path:
            lines = [r[0].encode() for r in spark.read.text(path).collect()]
        else:
            with open(path, "rb") as file:
                lines = file.read().splitlines()
        return cls.build({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(None, lines))}, pattern)

    def of(self, string: bytes) -> int | None:
        if len(string) > self.longest:
            return None
        slot = self.table.slot(string)
        return None if slot is None else self.rank[slot]

    def strings_by_rank(self) -> tuple[np.ndarray, np.ndarray]:
        """All strings by rank as bytes and ends; ranks without a string are empty."""
        own = dict(zip(self.rank, self.table.strings))
        ordered = [own.get(k, b"") for k in range(max(own, default=-1) + 1)]
        ends = np.zeros(len(ordered) + 1, np.int64)
        np.cumsum([len(x) for x in ordered], out=ends[1:])
        return np.frombuffer(b"".join(ordered), np.uint8), ends


def others(ranks: dict[bytes, int], pattern: str) -> str:
    """Characters that the tokenizer's library does not take for letters or digits, but the pattern's does.

    Only the newest letters and digits can be such, those that this Python does not know yet. In front
    of "'s" the library's ids tell which they are.
    """
    kind = regex.compile(r"[\p{L}\p{N}]")
    new = [c for c in map(chr, range(0x110000)) if unicodedata.category(c) == "Cn" and kind.match(c)]
    if any(bytes([b]) not in ranks for b in range(256)):
        return ""
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    cut = regex.compile(pattern)

    def differs(text: str) -> bool:
        return library.encode_ordinary(text) != [i for x in cut.findall(text) for i in library.encode_ordinary(x)]

    return "".join(c for c in new if differs(c + "'s"))


def merged(piece: bytes, rank_of: Callable[[bytes], int | None]) -> list[int]:
    """Token ids of one pre-token that is no token itself.

    The bytes are a linked list; a heap gives the neighbours whose joint string has the lowest rank,
    the leftmost of these first. An entry whose parts have changed since is passed over. So n bytes
    take n log n steps.
    """
    n = len(piece)
    after = list(range(1, n + 1))  # where the part that starts here ends, and the next one starts
    before = list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def push(i: int) -> None:
        j = after[i]
        if j < n:
            rank = rank_of(piece[i : after[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, j, after[j]))

    for i in range(n):
        push(i)
    while heap:
        _, i, j, end = heapq.heappop(heap)
        if after[i] != j or after[j] != end:
            continue
        after[i], after[j] = end, -1
        if end < n:
            before[end] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    out, i = [], 0
    while i < n:
        rank = rank_of(piece[i : after[i]])
        if rank is None:
            raise ValueError(f"the vocabulary lacks the byte {piece[i]}")
        out.append(rank)
        i = after[i]
    return out


class Encoder:
    """Encodes texts; one per worker process, so that merges met in earlier tasks are known."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.splitter = Splitter(ranks.pattern, ranks.others)
        self.known: dict[bytes, bytes] = {}
        self.pairs: dict[bytes, int | None] = {}

    def rank(self, string: bytes) -> int | None:
        """Rank of a string met in merging; the same few are asked for over and over."""
        try:
            return self.pairs[string]
        except KeyError:
            rank = self.ranks.of(string)
            if len(string) <= self.ranks.longest and len(self.pairs) < PAIRS:
                self.pairs[string] = rank
            return rank

    def resolve(self, pieces: list[str]) -> list[bytes]:
        out = []
        for text in pieces:
            piece = text.encode()
            rank = self.ranks.of(piece)
            out.append(self.missed(piece) if rank is None else rank.to_bytes(4, "little"))
        return out

    def missed(self, piece: bytes) -> bytes:
        ids = self.known.get(piece)
        if ids is None:
            ids = np.array(merged(piece, self.rank), "<u4").tobytes()
            if len(piece) <= SHORT and len(self.known) < REMEMBERED:
                self.known[piece] = ids
        return ids

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        return token_ids(self.splitter, texts, self.resolve)


class Decoder:
    """Turns token ids back into bytes."""

    def __init__(self, ranks: Ranks):
        self.data, self.ends = ranks.strings_by_rank()

    def decode(self, ids: Sequence[np.ndarray]) -> list[bytes]:
        flat = np.concatenate(ids) if len(ids) else np.zeros(0, np.uint32)
        if len(flat) and int(flat.max()) >= len(self.ends) - 1:
            raise ValueError(f"id {int(flat.max())} is not in the vocabulary")
        data, after = gathered(self.data, self.ends, flat)
        after = np.concatenate([[0], after])
        cuts = after[np.cumsum([0, *map(len, ids)])]
        return [data[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]


# One encoder and decoder per worker process and vocabulary.
_own: dict[tuple[type, str], Encoder | Decoder] = {}


def _of_process(kind: type, key: str, ranks) -> Encoder | Decoder:
    if (kind, key) not in _own:
        _own[kind, key] = kind(ranks.value)
    return _own[kind, key]


def encode(
    docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, n_tokens, and ids: little-endian unsigned 32-bit numbers, one per token.

    `path` has the ranks of the byte strings, one `base64 rank` a line; `pattern` cuts a text into
    pre-tokens, each encoded by itself. There are no special tokens. A pre-token in the vocabulary is
    found by a minimal perfect hash of the vocabulary, which is built once on the driver (its size is
    that of the vocabulary) and broadcast; any other is merged from its bytes.

    A null text is empty and has no tokens. A text of any length is cut by and by; its ids must fit
    one binary value (2 GB, 500 million tokens). Repeated rows and null ids each give their own row;
    an empty table gives no rows. Only the two named columns are read, so others never clash.
    """
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(Ranks.read(spark, path, pattern))
    key = f"{path} {pattern}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _of_process(Encoder, key, ranks)
        for batch in batches:
            for first, texts in runs_of_texts(batch.column(1), RUN):
                found = encoder.encode(texts)
                ids = pa.array([x.astype("<u4", copy=False).tobytes() for x in found], pa.binary())
                n = pa.array([len(x) for x in found], pa.int64())
                yield pa.record_batch([batch.column(0).slice(first, len(texts)), n, ids], names=["id", "n", "ids"])

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)]).add("n", "long").add("ids", "binary")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(run, schema).select(
        F.col("id").alias(id_column), F.col("n").alias("n_tokens"), F.col("ids").alias("ids")
    )


def decode(encoded: DataFrame, path: str, pattern: str, ids_column: str = "ids", into: str = "decoded") -> DataFrame:
    """The rows with one more column `into`: the bytes that the ids stand for; null ids give null.

    An id outside the vocabulary is an error. All other columns stay as they are; `into` must not be
    one of them. Repeated rows, null ids of documents and an empty table pass through.
    """
    if into in encoded.columns:
        raise ValueError(f"the rows already have a column {into}")
    spark = encoded.sparkSession
    ranks = spark.sparkContext.broadcast(Ranks.read(spark, path, pattern))
    key, at = f"{path} {pattern}", encoded.columns.index(ids_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _of_process(Decoder, key, ranks)
        for batch in batches:
            column = batch.column(at)
            first = 0
            while first < len(column):
                own, size, end = [], 0, first
                while end < len(column) and (size < RUN or end == first):
                    own.append(np.frombuffer(column[end].as_py() or b"", "<u4"))
                    size += 4 * len(own[-1])
                    end += 1
                data = pa.array(decoder.decode(own), pa.binary(), mask=column.slice(first, len(own)).is_null().to_numpy(False))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(first, len(own)).columns, data], names=[*batch.schema.names, into]
                )
                first = end

    return encoded.mapInArrow(run, T.StructType([*encoded.schema.fields, T.StructField(into, T.BinaryType())]))
