"""Places of regular expression matches, by DataFrame expressions.

Matches are marked by two characters, the text is cut in front of each, and places are running sums of the
lengths of the cuts. The two characters are first replaced by a third wherever a text holds them; no
pattern used here can match any of the three.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import whole_text

OPEN, CLOSE, NEITHER = "\u0001", "\u0002", "\u0003"
# Characters kept on either side of a match.
AROUND = 64
_CUT = "array<struct<kind:string,i:int,size:bigint,match:string,before:string,after:string>>"


def _edges(parts: Column) -> tuple[Column, Column]:
    """The last and the first AROUND characters of each part, without marks."""
    plain = lambda part: F.translate(part, CLOSE, "")
    last = F.transform(parts, lambda part: F.right(plain(part), F.lit(AROUND)))
    return last, F.transform(parts, lambda part: F.left(plain(part), F.lit(AROUND)))


def _cuts(kind: str, parts: Column, last: Column, first: Column) -> Column:
    """Of each part of a text that begins with a match: place, length, match, and what stands around it.

    What stands around goes on through other matches. Parts but the first hold a character or more, so
    AROUND parts are enough.
    """
    rest = lambda part: F.left(F.substring_index(part, CLOSE, -1), F.lit(AROUND))

    def before(i: Column) -> Column:
        near = F.get(last, i - 1)
        begin = F.greatest(i - AROUND, F.lit(0))
        more = F.right(F.array_join(F.slice(last, begin + 1, i - begin), ""), F.lit(AROUND))
        return F.when(F.length(near) >= AROUND, near).otherwise(more)

    def after(part: Column, i: Column) -> Column:
        near = rest(part)
        more = F.left(F.concat(near, F.array_join(F.slice(first, i + 2, F.lit(AROUND)), "")), F.lit(AROUND))
        return F.when(F.length(near) >= AROUND, near).otherwise(more)

    def cut(part: Column, i: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("i"),
            (F.length(part) - F.when(i > 0, 1).otherwise(0)).cast("long").alias("size"),
            F.when(i > 0, F.substring_index(part, CLOSE, 1)).alias("match"),
            F.when(i > 0, before(i)).alias("before"),
            F.when(i > 0, after(part, i)).alias("after"),
        )

    return F.when(F.size(parts) > 1, F.transform(parts, cut))


def matches(
    docs: DataFrame,
    patterns: dict[str, str],
    hints: dict[str, str | Column],
    any_of: str | Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    marked: tuple[str, ...] = (),
) -> DataFrame:
    """id, h, kind, start, end, match, before, after of every match of every pattern.

    Places are code points, the end is exclusive. h is the hash of the text and tells texts of one id
    apart; matches of repeated rows are given once. A pattern is only tried where the text contains its
    hint, and all only where the text matches `any_of`; either may be a condition on the column text
    instead, which holds wherever a pattern matches and costs less. Null texts are empty.
    `marked` names kinds whose match is the second group of the pattern; the first group is what stands
    in front of it, and the pattern has nothing else.
    """
    some = F.col("text").rlike(any_of) if isinstance(any_of, str) else any_of
    read = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text")).where(some)
    read = read.select("id", F.xxhash64("text").alias("h"), F.translate("text", OPEN + CLOSE, NEITHER + NEITHER).alias("text"))
    # The row number only holds the cuts of one row together, within this one shuffle.
    parts = {"row": F.monotonically_increasing_id()}
    for kind, pattern in patterns.items():
        shown = f"$1{OPEN}$2{CLOSE}" if kind in marked else f"{OPEN}$0{CLOSE}"
        cut = F.split(F.regexp_replace("text", pattern, shown), OPEN, -1)
        hint = hints.get(kind)
        hint = F.contains("text", F.lit(hint)) if isinstance(hint, str) else hint
        parts[kind] = cut if hint is None else F.when(hint, cut)
    none = F.array().cast(_CUT)
    around = {f"{kind}_{k}": edge for kind in patterns for k, edge in enumerate(_edges(F.col(kind)))}
    lists = [F.coalesce(_cuts(kind, *map(F.col, (kind, f"{kind}_0", f"{kind}_1"))), none) for kind in patterns]
    cuts = read.withColumns(parts).withColumns(around).select("id", "h", "row", F.explode(F.concat(*lists)).alias("cut"))
    order = Window.partitionBy("row", "cut.kind").orderBy("cut.i")
    start = F.sum("cut.size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    found = cuts.withColumn("start", start).where("cut.i > 0").select("id", "h", "start", "cut.*")
    end = (F.col("start") + F.length("match")).alias("end")
    return found.select("id", "h", "kind", "start", end, "match", "before", "after").dropDuplicates(
        ["id", "h", "kind", "start"]
    )
