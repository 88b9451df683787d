"""Merging Burrows-Wheeler transforms of string collections by iterative interleave refinement.

Each shard sorts only its own suffixes. To merge shards, the interleave of their sorted suffixes is
refined: after a round it is right for STEP more symbols, because a suffix follows its first symbols and
the place that the rest of it already has. Suffixes in one block of the interleave share a prefix;
a boundary appears in the round that reaches its common prefix length. No suffixes are compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Symbols by which a round refines the interleave.
STEP = 4


@dataclass(frozen=True)
class Shard:
    """A collection of byte strings: its symbols (byte + 1, each string ended by 0) and sorted suffixes."""

    symbols: np.ndarray
    left: np.ndarray  # symbols from a place to the end of its string
    string: np.ndarray  # the string each place is in
    suffixes: np.ndarray  # places, in the order of their suffixes

    @property
    def bwt(self) -> np.ndarray:
        """The symbol in front of each sorted suffix; 0 in front of a whole string."""
        before = self.symbols[self.suffixes - 1]
        return np.where(self.suffixes == 0, 0, before).astype(np.uint8)


def shard(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Shard:
    """Sort the suffixes of the strings data[starts:ends]; ends are smaller than all symbols, in order."""
    size = ends - starts + 1
    place = np.cumsum(size) - size
    n = int(size.sum())
    string = np.repeat(np.arange(len(size), dtype=np.int32), size)
    offset = np.arange(n) - place[string]
    left = (size[string] - 1 - offset).astype(np.int64)
    at = np.minimum(starts[string] + offset, max(len(data) - 1, 0))
    symbols = np.where(left > 0, data[at] + np.uint8(1), 0).astype(np.uint8) if n else np.zeros(0, np.uint8)
    padded = np.append(symbols, np.zeros(8, np.uint8)).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for j in range(8):
        key = key << np.uint64(8) | np.where(left > j, padded[j : j + n], np.uint64(0))
    # A suffix ranks by the first row of its group, those that are equal as far as they were compared. Only
    # groups of two or more are sorted again, by what follows.
    order = np.argsort(key)
    rows = np.arange(n)
    opens = np.ones(n, bool)
    opens[1:] = key[order][1:] != key[order][:-1]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(opens, rows, 0)) if n else 0
    rows = rows[~(opens & np.append(opens[1:], True))]
    depth, longest = 8, int(left.max()) if n else 0
    while depth < longest and len(rows):
        at = order[rows]
        rest = np.zeros(len(at), np.int64)
        more = np.flatnonzero(left[at] > depth)
        rest[more] = rank[at[more] + depth] + 1
        both = rank[at] * (n + 2) + rest
        by = np.argsort(both)
        at, both = at[by], both[by]
        opens = np.ones(len(at), bool)
        opens[1:] = both[1:] != both[:-1]
        order[rows] = at
        rank[at] = rows[np.maximum.accumulate(np.where(opens, np.arange(len(at)), 0))]
        rows = rows[~(opens & np.append(opens[1:], True))]
        depth *= 2
    # Equal suffixes stand in the order of their strings.
    at = order[rows]
    order[rows] = at[np.lexsort((at, rank[at]))]
    return Shard(symbols, left, string, order)


@dataclass(frozen=True)
class Merged:
    """All suffixes in merged order, and the blocks of those that share `depth` symbols.

    shard and place name a suffix. begins marks the first suffix of each block. common is the length
    of the prefix shared with the suffix before, rounded down to STEP, at most depth.
    """

    shard: np.ndarray
    place: np.ndarray
    begins: np.ndarray
    common: np.ndarray

    def intervals(self) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one rows of the blocks of two suffixes or more."""
        first = np.flatnonzero(self.begins)
        last = np.append(first[1:], len(self.begins))
        many = last - first > 1
        return first[many], last[many]


def _grams(s: Shard) -> np.ndarray:
    """The STEP symbols at each place as one number, zeros behind the end of the string."""
    padded = np.append(s.symbols, np.zeros(STEP, np.uint8)).astype(np.uint32)
    n, gram = len(s.symbols), np.zeros(len(s.symbols), np.uint32)
    for j in range(STEP):
        gram = gram << np.uint32(8) | np.where(s.left > j, padded[j : j + n], np.uint32(0))
    return gram


def _order(codes: np.ndarray) -> np.ndarray:
    """Stable order of codes below 2**32, by counting sorts of 16 bits."""
    order = np.argsort((codes & 0xFFFF).astype(np.uint16), kind="stable")
    if len(codes) and int(codes.max()) > 0xFFFF:
        order = order[np.argsort((codes >> 16)[order].astype(np.uint16), kind="stable")]
    return order


def merge(shards: list[Shard], depth: int) -> Merged:
    """Interleave the shards' sorted suffixes; `depth` is a multiple of STEP. Strings have STEP symbols or more."""
    n = sum(len(s.symbols) for s in shards)
    owner = np.repeat(np.arange(len(shards), dtype=np.uint8), [len(s.symbols) for s in shards])
    place = np.concatenate([s.suffixes for s in shards])
    grams = [_grams(s) for s in shards]
    # Where a suffix leads to: the one STEP symbols longer. The first places of a string have none; they
    # stand in for its last places, which no suffix leads to and whose order never changes.
    leads = []
    for s in shards:
        offset = np.empty(len(s.symbols), np.int64)
        offset[:] = np.arange(len(s.symbols)) - (np.flatnonzero(s.left == 0) + 1 - np.bincount(s.string))[s.string]
        to = np.where(offset >= STEP, np.arange(len(offset)) - STEP, np.arange(len(offset)) + s.left - offset)
        leads.append(to[s.suffixes])
    gram = np.concatenate([g[to] for g, to in zip(grams, leads, strict=True)])
    code = np.unique(gram, return_inverse=True)[1].astype(np.uint32)
    whole = np.concatenate([(s.left >= STEP)[to] for s, to in zip(shards, leads, strict=True)])
    # The order of codes is the same in every round, and so are the rows of suffixes shorter than STEP.
    first_order = _order(code)
    sorted_code = code[first_order]
    short = np.flatnonzero(~whole[first_order])
    short_owner = owner[first_order][short]
    starts = np.ones(n, bool)
    starts[1:] = sorted_code[1:] != sorted_code[:-1]
    starts[short] = True
    starts[short[short + 1 < n] + 1] = True

    z = owner.copy()
    block = np.zeros(n, np.int32)
    common = np.full(n, depth, np.int32)
    begins = np.zeros(n, bool)
    for reached in range(0, depth, STEP):
        # The k-th row of a shard in the interleave is its k-th sorted suffix.
        rows = np.argsort(z, kind="stable")
        now = np.empty(n, np.uint32)
        now[rows] = code
        order = _order(now)
        z, block = z[order], block[order]
        z[short] = short_owner
        new = starts.copy()
        new[1:] |= block[1:] != block[:-1]
        common[new & ~begins] = reached
        begins = new
        block = np.cumsum(begins, dtype=np.int32)
    rows = np.argsort(z, kind="stable")
    merged_place = np.empty(n, np.int64)
    merged_place[rows] = place
    return Merged(z, merged_place, begins, common)
