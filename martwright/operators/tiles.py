"""ntile over a whole table by selecting the borders: no sort of the table, no shuffle, no join back.

The border of a tile is the row at a known rank. Samples bracket it, counts of the rows up to the
ends of the bracket tell how far it is off, and the bracket is refined until its rows fit the driver.
Each round is two passes over the keys that combine to few rows. A row then finds its tile by
comparing itself with the borders.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from martwright.operators.rank import Ranking

# Rows of a bracket that the driver holds: all of them, or a sample of that size.
SAMPLE = 20_000
# How many standard deviations of a sampled rank a bracket reaches to either side.
DEVIATIONS = 5
_HASHES = 1 << 30


@dataclass(frozen=True)
class Border:
    """A row of an order: its key and its id."""

    key: object
    id: object


@dataclass
class Bracket:
    """Rows behind `low` up to `high` (None: from the first, to the last) hold the rows at these ranks."""

    low: Border | None
    high: Border | None
    low_rank: int
    high_rank: int
    targets: list[int] = field(default_factory=list)

    @property
    def rows(self) -> int:
        return self.high_rank - self.low_rank


def behind(ranking: Ranking, id_column: str, border: Border) -> Column:
    """Whether a row comes after a border in the ranking's order; never NULL."""
    key, own = ranking.key, F.col(id_column)
    later_id = own > F.lit(border.id)
    if border.key is None:
        # NULL is the largest key.
        return key.isNotNull() | later_id if ranking.descending else key.isNull() & later_id
    same = key.eqNullSafe(F.lit(border.key)) & later_id
    if ranking.descending:
        return F.coalesce(key < F.lit(border.key), F.lit(False)) | same
    return F.coalesce(key > F.lit(border.key), F.lit(True)) | same


def _in_order(ranking: Ranking, rows: list[Border]) -> list[Border]:
    by_id = sorted(rows, key=lambda r: r.id)
    present = sorted((r for r in by_id if r.key is not None), key=lambda r: r.key, reverse=ranking.descending)
    absent = [r for r in by_id if r.key is None]
    return absent + present if ranking.descending else present + absent


def _within(ranking: Ranking, id_column: str, bracket: Bracket) -> Column:
    found = F.lit(True)
    if bracket.low is not None:
        found = found & behind(ranking, id_column, bracket.low)
    if bracket.high is not None:
        found = found & ~behind(ranking, id_column, bracket.high)
    return found


def _sampled(
    df: DataFrame, id_column: str, brackets: list[tuple[Ranking, Bracket]], sample: int
) -> list[list[Border]]:
    """About `sample` rows of each bracket, all of them where it has no more; one pass."""
    draw = F.pmod(F.xxhash64(id_column), F.lit(_HASHES))
    parts = []
    for ranking, bracket in brackets:
        wanted = _within(ranking, id_column, bracket)
        if bracket.rows > sample:
            wanted = wanted & (draw < math.ceil(sample / bracket.rows * _HASHES))
        parts.append(F.when(wanted, F.struct(ranking.key.alias("key"), F.col(id_column).alias("id"))))
    out = []
    # Keys of different rankings have types of their own, so each bracket has a column.
    names = [f"b{i}" for i in range(len(parts))]
    picked = df.select(*[p.alias(n) for p, n in zip(parts, names)])
    rows: list[Row] = picked.where(" OR ".join(f"{n} IS NOT NULL" for n in names)).collect()
    for name in names:
        out.append([Border(r[name]["key"], r[name]["id"]) for r in rows if r[name] is not None])
    return out


def _ranks(
    df: DataFrame, id_column: str, asked: list[tuple[Ranking, Border]]
) -> list[int]:
    """How many rows come no later than each border: one pass, one row back."""
    counts = [F.count_if(~behind(ranking, id_column, b)).alias(f"n{i}") for i, (ranking, b) in enumerate(asked)]
    return list(df.agg(*counts).first())


def select_ranks(
    df: DataFrame, id_column: str, asked: Sequence[tuple[Ranking, Sequence[int]]], rows: int, sample: int = SAMPLE
) -> list[dict[int, Border]]:
    """The rows at the given ranks (from 1) of each ranking; ids are unique and not NULL."""
    found: list[dict[int, Border]] = [{} for _ in asked]
    open_ = [
        (slot, Bracket(None, None, 0, rows, sorted(set(ranks)))) for slot, (_, ranks) in enumerate(asked) if ranks
    ]
    while open_:
        samples = _sampled(df, id_column, [(asked[slot][0], b) for slot, b in open_], sample)
        splitters: list[tuple[int, Border]] = []
        following: list[tuple[int, Bracket]] = []
        for (slot, bracket), picked in zip(open_, samples):
            ordered = _in_order(asked[slot][0], picked)
            if bracket.rows <= sample:
                for rank in bracket.targets:
                    found[slot][rank] = ordered[rank - bracket.low_rank - 1]
                continue
            following.append((slot, bracket))
            reach = DEVIATIONS * math.sqrt(len(ordered)) / 2 + 1
            places = set()
            for rank in bracket.targets:
                middle = (rank - bracket.low_rank) / bracket.rows * len(ordered)
                # The middle halves a bracket that the sample is too small to narrow.
                places |= {math.floor(middle - reach), math.floor(middle), math.ceil(middle + reach)}
            splitters += [(slot, ordered[p]) for p in sorted(places) if 0 <= p < len(ordered)]
        if not following:
            break
        ranks = _ranks(df, id_column, [(asked[slot][0], b) for slot, b in splitters]) if splitters else []
        open_ = []
        for slot, bracket in following:
            ends = [(bracket.low_rank, bracket.low), (bracket.high_rank, bracket.high)]
            ends += [
                (rank, b)
                for rank, (at, b) in zip(ranks, splitters)
                if at == slot and bracket.low_rank < rank < bracket.high_rank
            ]
            ends = sorted(dict(reversed(ends)).items())
            for (low_rank, low), (high_rank, high) in zip(ends[:-1], ends[1:]):
                inside = [t for t in bracket.targets if low_rank < t <= high_rank]
                for rank in [t for t in inside if t == high_rank and high is not None]:
                    found[slot][rank] = high
                    inside.remove(rank)
                if inside:
                    open_.append((slot, Bracket(low, high, low_rank, high_rank, inside)))
        if open_ and max(b.rows for _, b in open_) >= max(b.rows for _, b in following):
            sample *= 2  # too few rows were drawn to cut the largest bracket
    return found


def with_tiles(
    df: DataFrame, id_column: str, rankings: Sequence[Ranking], tiles: int, sample: int = SAMPLE
) -> DataFrame:
    """The rows with one column per ranking: ntile(tiles) over its order, the smaller id first among equal keys.

    `df` is read several times and should be stored. Ids are unique and not NULL. The first
    rows % tiles tiles have a row more than the others, as with the window function.
    """
    rows = df.count()
    size, larger = divmod(rows, tiles)
    last = [k * size + min(k, larger) for k in range(1, tiles)]
    # Without rows in a tile, those behind it are empty too.
    ranks = [rank for rank in last if 0 < rank < rows]
    found = select_ranks(df, id_column, [(r, ranks) for r in rankings], rows, sample)
    columns = {}
    for ranking, borders in zip(rankings, found):
        tile = F.lit(1)
        for rank in ranks:
            tile = tile + behind(ranking, id_column, borders[rank]).cast("int")
        columns[ranking.name] = tile
    return df.withColumns(columns)
