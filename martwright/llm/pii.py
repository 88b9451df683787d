"""Personal data: base patterns with exact places, and identifiers found by the contexts these stand in.

Everything here is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm.common import free_names, stored, whole_text
from martwright.llm.spans import matches

# In the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone")
# The base patterns. A match cannot begin inside a run of its first class unless a match
# ended there (\G), and nothing behind a possessive part could use what it gives back; so these find
# the same matches as the plain forms, in linear time and without deep recursion.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Tokens that may be identifiers: runs of these characters with a digit or an at sign.
_TOKEN = "[A-Za-z0-9@._%+#/-]"
CANDIDATE = rf"(?<!{_TOKEN})[A-Za-z._%+#/-]*+[0-9@]{_TOKEN}*+"
# Needed for a match: a cheap look saves the marking of most texts.
_HINT = {"email": "@", "phone": "+"}


@dataclass(frozen=True)
class Bootstrap:
    """How contexts become patterns and patterns find identifiers.

    A pattern needs `support` different instances of its kind among the trusted ones and a confidence
    of `confidence`: trusted instances over all identifier-like ones in that context plus two.
    """

    rounds: int = 3
    support: int = 8
    confidence: float = 0.8
    digits: int = 4


def _words(found: DataFrame) -> DataFrame:
    """Adds left, the last two words before a match, and right, the first one behind it, lower-cased."""
    left = F.regexp_replace(F.regexp_extract("before", r"(\S*\s*+\S*)\s++\z", 1), r"\s++", " ")
    right = F.regexp_extract("after", r"^\s++(\S++)", 1)
    return found.withColumns({"left": F.lower(F.ltrim(left)), "right": F.lower(right)})


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(
        F.split(match, r"\."),
        lambda x: F.length(F.ltrim(x, F.lit("0"))).between(0, 3)
        & (F.coalesce(F.ltrim(x, F.lit("0")).try_cast("int"), F.lit(0)) <= 255),
    )
    # Luhn: from the right, every second digit counts double, as the sum of its digits.
    value = lambda i: F.substring(F.reverse(digits), i + 1, F.lit(1)).try_cast("int")
    doubled = lambda i: F.when(i % 2 == 0, value(i)).otherwise(value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0))
    luhn = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda total, i: total + doubled(i)) % 10 == 0
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", small)
        .when(kind == "card", n.between(16, 19) & F.when(n.between(16, 19), luhn))
        .when(kind == "phone", n.between(8, 15))
        .otherwise(True)
    )


# ---- patterns and instances ---------------------------------------------------------------------


def _contexts(found: DataFrame) -> DataFrame:
    """One row per occurrence and lexical pattern: the words before it, and before and behind it."""
    two = F.col("left")
    last = F.substring_index(two, " ", -1)
    patterns = F.array(
        F.when(last != "", F.concat(F.lit("l "), last)),
        F.when(two.contains(" "), F.concat(F.lit("ll "), two)),
        F.when((last != "") & (F.col("right") != ""), F.concat(F.lit("lr "), last, F.lit(" _ "), F.col("right"))),
    )
    return found.select("*", F.explode(F.array_compact(patterns)).alias("pattern"))


def discovered(base: DataFrame, others: DataFrame, method: Bootstrap) -> DataFrame:
    """The occurrences among `others` that confident patterns name, with the kind of their pattern.

    Trusted instances (at first the seeds) vouch for the patterns they occur in; a pattern's
    confidence is the weight of its trusted instances of one kind over all instances in it, plus two.
    Confident patterns in turn give their other instances that weight, for the next round.
    """
    seen = _contexts(base.select("kind", "match", "left", "right")).select("pattern", "kind", F.col("match").alias("instance"))
    open_ = _contexts(others).select("pattern", F.lit(None).cast("string").alias("kind"), F.col("match").alias("instance"))
    edges = stored(seen.unionByName(open_).distinct(), "contexts")
    total = edges.groupBy("pattern").agg(F.count_distinct("instance").alias("all"))
    seeds = edges.where("kind is not null").select("instance", "kind").distinct().withColumn("weight", F.lit(1.0))
    trusted = seeds
    confident = None
    for _ in range(method.rounds):
        held = edges.select("pattern", "instance").distinct().join(trusted, "instance")
        scored = (
            held.groupBy("pattern", "kind")
            .agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("support"))
            .where(F.col("support") >= method.support)
            .join(total, "pattern")
            .withColumn("confidence", F.col("weight") / (F.col("all") + 2))
            .where(F.col("confidence") >= method.confidence)
        )
        best = F.max_by("kind", F.struct("confidence", "kind"))
        scored = scored.groupBy("pattern").agg(best.alias("kind"), F.max("confidence").alias("confidence"))
        confident = stored(scored, "patterns")
        named = edges.where("kind is null").join(confident.drop("kind").join(confident.select("pattern", F.col("kind").alias("to")), "pattern"), "pattern")
        # Independent patterns: an instance fails only if all of them do.
        miss = F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))
        new = named.groupBy("instance", F.col("to").alias("kind")).agg((1 - miss).alias("weight"))
        new = new.join(seeds.select("instance").distinct(), "instance", "left_anti")
        trusted = stored(seeds.unionByName(new), "trusted")
    kinds = confident.select("pattern", F.col("kind").alias("to"), "confidence")
    hits = _contexts(others).join(kinds, "pattern")
    best = F.max_by("to", F.struct("confidence", "to"))
    return hits.groupBy("id", "h", "start", "end").agg(best.alias("kind"))


def personal_spans(
    docs: DataFrame, method: Bootstrap | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """id, h, kind, start, end (code points, end exclusive), base: all spans of personal data.

    Base spans are the leftmost matches of each kind that pass its check. Discovered spans (base is
    false) are identifier-like tokens with at least `method.digits` digits (or an at sign) that overlap
    no base span and stand in a context which the bootstrap trusts. h is the hash of the text.
    """
    method = method or Bootstrap()
    base = matches(docs, PATTERNS, _HINT, "[0-9@]", id_column, text_column)
    base = stored(_words(base.where(_valid(F.col("kind"), F.col("match")))), "base")
    tokens = _words(matches(docs, {"token": CANDIDATE}, {}, "[0-9@]", id_column, text_column))
    tokens = tokens.where((F.length(F.regexp_replace("match", "[^0-9]", "")) >= method.digits) | F.contains("match", F.lit("@")))
    # Overlaps: with both kinds of spans in order, a token overlaps if a base span reaches into it.
    both = base.select("id", "h", "start", "end", F.lit(True).alias("known"), "match", "left", "right").unionByName(
        tokens.select("id", "h", "start", "end", F.lit(False).alias("known"), "match", "left", "right")
    )
    place = Window.partitionBy("id", "h").orderBy("start")
    reach = F.max(F.when(F.col("known"), F.col("end"))).over(place.rangeBetween(Window.unboundedPreceding, 0))
    ahead = F.min(F.when(F.col("known"), F.col("start"))).over(place.rangeBetween(0, Window.unboundedFollowing))
    free = (F.coalesce(F.col("reach"), F.lit(0)) <= F.col("start")) & (
        F.coalesce(F.col("ahead"), F.col("end")) >= F.col("end")
    )
    others = both.withColumns({"reach": reach, "ahead": ahead}).where(~F.col("known") & free)
    others = stored(others.select("id", "h", "start", "end", "match", "left", "right"), "tokens")
    new = discovered(base, others, method)
    return base.select("id", "h", "kind", "start", "end", F.lit(True).alias("base")).unionByName(
        new.select("id", "h", "kind", "start", "end", F.lit(False).alias("base"))
    )


def _listed(base_only: bool) -> Column:
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    item = F.struct(rank.alias("rank"), "start", "end", "kind")
    items = F.array_sort(F.collect_list(F.when(F.col("base") | F.lit(not base_only), item)))
    return F.array_join(F.transform(items, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def personal_data(
    docs: DataFrame, method: Bootstrap | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: counts of base matches per kind, base_sha256, and all spans.

    Spans are listed as kind:start:end by kind, then start; a discovered span has the kind of its pattern. A
    null text is empty; repeated rows and null ids each give their own row; an empty table gives no
    rows. Only the two named columns are read.
    """
    spans = personal_spans(docs, method, id_column, text_column)
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS]
    listed = spans.groupBy("id", "h").agg(*counts, _listed(True).alias("listed"), _listed(False).alias("spans"))
    rows = docs.select(F.col(id_column).alias("id"), F.xxhash64(whole_text(text_column)).alias("h"))
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.h") == F.col("r.h"))
    out = rows.alias("l").join(listed.alias("r"), same, "left")
    return out.select(
        F.col("l.id").alias(id_column),
        *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.coalesce("listed", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(
    docs: DataFrame, method: Bootstrap | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents with each span of personal data replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. All columns and rows stay, whatever the columns'
    names; texts without a span stay as they are, nulls included. An empty table gives no rows.
    """
    spans = personal_spans(docs, method, id_column, text_column)
    place = Window.partitionBy("id", "h").orderBy("start", "end", "kind")
    before = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= before, F.lit(True)).cast("int")
    runs = spans.withColumn("opens", opens).withColumn("run", F.sum("opens").over(place))
    merged = runs.groupBy("id", "h", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "end", "kind")).alias("kind")
    )
    item = F.struct("start", "end", "kind")
    own_id, own_hash, own_spans = free_names(docs, "__id", "__h", "__spans")
    lists = merged.groupBy(F.col("id").alias(own_id), F.col("h").alias(own_hash)).agg(
        F.array_sort(F.collect_list(item)).alias(own_spans)
    )
    text = F.col(text_column)
    same = docs[id_column].eqNullSafe(F.col(own_id)) & (F.xxhash64(whole_text(text_column)) == F.col(own_hash))
    joined = docs.join(lists, same, "left")
    list_ = F.col(own_spans)

    def piece(x: Column, i: Column) -> Column:
        start = F.when(i > 0, F.get(list_, i - 1)["end"]).otherwise(F.lit(0))
        gap = F.substring(text, start.cast("int") + 1, (x["start"] - start).cast("int"))
        return F.concat(gap, F.lit("<"), x["kind"], F.lit(">"))

    last = F.element_at(list_, -1)["end"].cast("int")
    new = F.concat(F.array_join(F.transform(list_, piece), ""), F.substring(text, last + 1, F.length(text)))
    new = F.when(list_.isNull(), text).otherwise(new)
    return joined.withColumn(text_column, new).select(docs.columns)
