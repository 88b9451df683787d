"""Alignment of two tokenizers' tokens over the same bytes, by galloping through the ends of tokens."""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import stored
from martwright.llm.pretokens import Splitter, gathered, runs_of_texts, token_ids
from martwright.llm.tokens import BYTES, UNUSUAL, Remembered, Vocabulary

# Characters of text worked on at a time.
RUN = 1 << 21
# Pairs of ids whose counts are looked up in a broadcast table; the rest meets by a shuffle.
FREQUENT = 1 << 18
# Pre-tokens of either side whose ids a process remembers.
REMEMBERED = 1 << 19
# The character that stands for a space in pieces, and a text that files with rules of their own change.
SPACE, _PROBE = "\u2581", "\ufb01  \uff21 \u2460\te\u0301\r\n\u3000\u00a0 "
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


# ---- the two sides --------------------------------------------------------------------------


class Strings:
    """The byte strings of a vocabulary, one behind the other."""

    def __init__(self, strings: Sequence[bytes]):
        self.data = np.frombuffer(b"".join(strings), np.uint8)
        self.ends = np.concatenate([[0], np.cumsum([len(x) for x in strings], dtype=np.int64)])

    def ends_of(self, ids: np.ndarray, whole: bytes) -> list[int] | None:
        """Byte offsets where the tokens end; None unless their bytes joined are the whole."""
        data, ends = gathered(self.data, self.ends, ids)
        return ends.tolist() if data.tobytes() == whole else None


class ByteLevelSide:
    """Ids by a byte-level tokenizer file of a space and the text; special strings are plain text."""

    def __init__(self, path: str):
        v = self.vocabulary = Vocabulary(path)
        v.tokenizer.encode_special_tokens = True
        self.splitter = Splitter(v.pattern.pattern)
        self.known = Remembered(lambda piece: np.array(v.merge(piece), "<u4").tobytes(), REMEMBERED)
        numbers = v.tokenizer.get_vocab(with_added_tokens=True)
        strings = [b""] * (max(numbers.values(), default=-1) + 1)
        for token, number in numbers.items():
            if all(c in BYTES for c in token):
                strings[number] = bytes(BYTES[c] for c in token)
        self.strings = Strings(strings)

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        usual = [not self.vocabulary.lower and not UNUSUAL.search(x) for x in texts]
        cut = token_ids(
            self.splitter,
            [" " + x if plain else "" for x, plain in zip(texts, usual)],
            lambda pieces: list(map(self.known.__getitem__, pieces)),
        )
        return [
            x if plain else np.array(self.vocabulary.encode(" " + t), np.uint32) for x, plain, t in zip(cut, usual, texts)
        ]


class PieceSide:
    """Ids by a sentencepiece file, which puts a space in front of the text itself.

    Where no piece holds a space behind another character, no merge reaches over the front of a run of
    spaces, and a file that leaves texts as they are encodes each such part alone; so each distinct
    one is encoded once. Other files, and texts with the character that stands for a space, are
    encoded whole.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        self.strings = Strings([self._bytes(x) for x in pieces])
        as_it_is = self.model.normalize(_PROBE) == SPACE + _PROBE.replace(" ", SPACE)
        self.apart = as_it_is and not any(SPACE in x.lstrip(SPACE) for x in pieces)
        self.splitter = Splitter(" +[^ ]*")
        self.known = Remembered(self._part, REMEMBERED)

    @staticmethod
    def _bytes(piece: str) -> bytes:
        byte = _BYTE.fullmatch(piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode()

    def _part(self, part: str) -> bytes:
        """Ids of a run of spaces and what follows it; the model adds the first space, but not to nothing."""
        ids = self.model.encode(part[1:]) if len(part) > 1 else [self.model.piece_to_id(SPACE)]
        return np.array(ids, "<u4").tobytes()

    def ids(self, texts: Sequence[str]) -> list[np.ndarray]:
        cut = [bool(x) and self.apart and SPACE not in x for x in texts]
        found = token_ids(
            self.splitter,
            [" " + x if parts else "" for x, parts in zip(texts, cut)],
            lambda pieces: list(map(self.known.__getitem__, pieces)),
        )
        whole = iter(self.model.encode([x for x, parts in zip(texts, cut) if not parts], num_threads=1))
        return [x if parts else np.array(next(whole), np.uint32) for x, parts in zip(found, cut)]


@cache
def _side(path: str) -> ByteLevelSide | PieceSide:
    """The side for a file, one per worker process: sentencepiece for .model, else a byte-level tokenizer."""
    return PieceSide(path) if path.endswith(".model") else ByteLevelSide(path)


# ---- one document ---------------------------------------------------------------------------


def gallop(values: Sequence[int], start: int, wanted: int) -> int:
    """First place from `start` on whose value is at least `wanted`: doubling steps, then halving ones."""
    n, step, low, high = len(values), 1, start, start
    while high < n and values[high] < wanted:
        low, high = high + 1, high + step
        step *= 2
    return bisect_left(values, wanted, low, min(high, n))


def common_places(short: Sequence[int], long: Sequence[int]) -> tuple[list[int], list[int]]:
    """Places of the values that two ascending lists share; the shorter list drives the search."""
    if len(short) > len(long):
        there, here = common_places(long, short)
        return here, there
    here, there, at, n = [], [], 0, len(long)
    for place, value in enumerate(short):
        if at < n and long[at] < value:
            at += 1  # the first step; most often it is enough
            if at < n and long[at] < value:
                at = gallop(long, at, value)
        if at == n:
            break
        if long[at] == value:
            here.append(place)
            there.append(at)
            at += 1
    return here, there


@dataclass(frozen=True)
class Groups:
    """Smallest runs of tokens of both sides over the same bytes.

    Group k has the a-tokens from a_cuts[k - 1] (0 at first) up to a_cuts[k], and likewise the b-tokens.
    """

    a: np.ndarray
    b: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray


NONE = np.zeros(0, np.int32)


def groups(text: str, a: np.ndarray, b: np.ndarray, a_strings: Strings, b_strings: Strings) -> Groups:
    """The groups of one text; none where a side does not give back the bytes of a space and the text."""
    whole = b" " + text.encode()
    a_ends = a_strings.ends_of(a, whole) if text else None
    b_ends = b_strings.ends_of(b, whole) if text else None
    if a_ends is None or b_ends is None:
        return Groups(NONE, NONE, NONE, NONE)
    a_at, b_at = common_places(a_ends, b_ends)
    return Groups(a, b, np.array(a_at, np.int32) + 1, np.array(b_at, np.int32) + 1)


# ---- all documents --------------------------------------------------------------------------


def _aligned(
    batches: Iterator[pa.RecordBatch], a_path: str, b_path: str
) -> Iterator[tuple[pa.Array, list[Groups]]]:
    """Ids and groups of the texts of batches (id, text), about RUN characters a time."""
    a_side, b_side = _side(a_path), _side(b_path)
    for batch in batches:
        for first, texts in runs_of_texts(batch.column(1), RUN):
            found = [
                groups(text, a, b, a_side.strings, b_side.strings)
                for text, a, b in zip(texts, a_side.ids(texts), b_side.ids(texts))
            ]
            yield batch.column(0).slice(first, len(texts)), found


def align(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, the token ids a and b of the two files, and a_cuts, b_cuts.

    a is that of a byte-level tokenizer file for a space and the text, b that of a sentencepiece file
    for the text, which adds the space; special strings are plain text on both sides. Offsets where a
    token of either side ends cut the tokens into groups: a_cuts[k] and b_cuts[k] are the numbers of
    tokens up to the end of group k. The last tokens of a group end together, and no others do. As a
    group's tokens are those between two cuts, the tokens of one side that overlap a token of the
    other are found by ranks alone.

    A null or empty text has no tokens, nor has one whose bytes a side does not give back whole (a
    character that a side replaces). Texts of any length are worked on whole, in linear memory.
    Repeated rows and null ids each give their own row; an empty table gives no rows. Only the two
    named columns are read, so others never clash.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _aligned(batches, a_path, b_path):
            columns = [_lists([getattr(g, name) for g in found]) for name in ("a", "b", "a_cuts", "b_cuts")]
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["id", "a", "b", "a_cuts", "b_cuts"])

    lists = T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)])
    for name in ("a", "b", "a_cuts", "b_cuts"):
        schema = schema.add(name, lists)
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    found = read.mapInArrow(run, schema)
    return found.select(F.col("id").alias(id_column), *(F.col(c).alias(c) for c in ("a", "b", "a_cuts", "b_cuts")))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(x) for x in values], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([NONE, *values]).astype(np.int32, copy=False)))


# Ids as decimal numbers, each with room for the mark behind it; a table per process and bound.
_decimals = cache(lambda bound: Strings([b"%d," % k for k in range(bound)]))


def _digest(own: Groups) -> str:
    """Lowercase hex of the groups written as `a1,a2|b1;a3|b2,b3`; empty without tokens."""
    if not len(own.a_cuts):
        return ""
    in_a, in_b = (np.diff(x, prepend=0) for x in (own.a_cuts, own.b_cuts))
    # A token stands behind those of its own side and those of the other side's groups before its own.
    a_at = np.arange(len(own.a)) + np.repeat(own.b_cuts - in_b, in_a)
    b_at = np.arange(len(own.b)) + np.repeat(own.a_cuts, in_b)
    ids = np.empty(len(own.a) + len(own.b), np.int64)
    ids[a_at], ids[b_at] = own.a, own.b
    marks = np.full(len(ids), ord(","), np.uint8)
    marks[a_at[own.a_cuts - 1]] = ord("|")
    marks[b_at[own.b_cuts - 1]] = ord(";")
    decimals = _decimals(1 << int(ids.max()).bit_length())
    data, ends = gathered(decimals.data, decimals.ends, ids)
    data[ends - 1] = marks
    return hashlib.sha256(data[:-1]).hexdigest()


def link_statistics(
    docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per document, aligned as by `align`: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A link is an occurrence of an a-token and one of a b-token that end at the same byte, so each
    group's last two. The count of an id pair is how many links of all documents hold it; n_best are
    the links whose count is the highest of their b id, ties included, and count_sum adds the counts
    over the links. groups_sha256 is the digest of the groups written as `a1,a2|b1;a3|b2,b3`.

    Counts are added up per task before they are shuffled. The most frequent pairs, at most FREQUENT,
    are joined as a broadcast table, all others by a shuffle in which no pair is frequent. Rows without
    tokens have zeros and an empty digest; all other cases are those of `align`.
    """
    pairs = T.ArrayType(T.StructType().add("pair", "long").add("n", "long"), False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _aligned(batches, a_path, b_path):
            own = [_pairs(g) for g in found]
            ends = np.zeros(len(own) + 1, np.int32)
            np.cumsum([len(x) for x, _ in own], out=ends[1:])
            flat = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([x[k] for x in own]) if own else np.zeros(0, np.int64), pa.int64())
                    for k in (0, 1)
                ],
                names=["pair", "n"],
            )
            sizes = [pa.array([len(getattr(g, name)) for g in found], pa.int64()) for name in ("a", "b", "a_cuts")]
            digests = pa.array([_digest(g) for g in found], pa.string())
            yield pa.RecordBatch.from_arrays(
                [ids, *sizes, digests, pa.ListArray.from_arrays(pa.array(ends), flat)],
                names=["id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"],
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)])
    schema = schema.add("n_a", "long").add("n_b", "long").add("n_groups", "long")
    schema = schema.add("groups_sha256", "string").add("pairs", pairs)
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = stored(read.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id()), "aligned")
    held = rows.select("row", F.inline("pairs"))
    counts = held.groupBy("pair").agg(F.sum("n").alias("links"))
    # A pair's b id is its lower half. Only distinct pairs meet here, and each b id has few partners.
    most = counts.groupBy(_b_of("pair").alias("b")).agg(F.max("links").alias("most"))
    counts = stored(
        counts.withColumn("b", _b_of("pair")).join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best")),
        "pairs",
    )
    least = _frequent_from(counts)
    frequent, others = counts.where(F.col("links") >= least), counts.where(F.col("links") < least)
    joined = held.join(F.broadcast(frequent), "pair", "left")
    sums = joined.where("links IS NOT NULL").transform(_sums)
    if not others.isEmpty():
        # Each of these pairs has fewer than `least` links in all, so none of them is hot.
        rest = joined.where("links IS NULL").select("row", "pair", "n").join(others.hint("shuffle_hash"), "pair")
        sums = sums.unionByName(rest.transform(_sums)).groupBy("row").agg(
            F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")
        )
    zero = F.lit(0).cast("long")
    return (
        rows.drop("pairs")
        .join(sums, "row", "left")
        .select(
            F.col("id").alias(id_column),
            "n_a",
            "n_b",
            "n_groups",
            F.col("n_groups").alias("n_links"),
            F.coalesce("n_best", zero).alias("n_best"),
            F.coalesce("count_sum", zero).alias("count_sum"),
            "groups_sha256",
        )
    )


def _pairs(own: Groups) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs of a document's links, a * 2**32 + b, and how many links hold each."""
    a, b = own.a[own.a_cuts - 1].astype(np.int64), own.b[own.b_cuts - 1].astype(np.int64)
    return np.unique((a << 32) | b, return_counts=True)


def _b_of(pair: str) -> Column:
    return F.col(pair).bitwiseAND(F.lit((1 << 32) - 1))


def _sums(joined: DataFrame) -> DataFrame:
    return joined.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("links")).alias("count_sum"),
    )


def _frequent_from(counts: DataFrame) -> int:
    """The number of links from which on pairs are frequent: at most FREQUENT pairs have so many.

    Pairs are counted by the power of two below their links, some sixty rows to the driver.
    """
    by_power = counts.groupBy(F.floor(F.log2("links")).cast("int").alias("power")).count().collect()
    total, least = 0, math.inf
    for power, n in sorted(((r["power"], r["count"]) for r in by_power), reverse=True):
        total += n
        if total > FREQUENT:
            break
        least = 1 << power
    return (1 << 62) if least is math.inf else least
