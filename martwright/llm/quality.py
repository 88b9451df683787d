"""Quality rules: text statistics, and a likelihood ratio between trusted text and the whole corpus."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import byte_hash, chunks, mix, only_mine, row_of, stored, utf8, words_of

# n-grams are windows of four bytes, hashed into this many buckets.
GRAM = 4
BUCKETS = 1 << 16
# Weights are whole multiples of this, so that a document's sum does not depend on the order of adding.
UNIT = 2.0**-20
# Good ids small enough in number for every executor to hold.
GOOD_IDS = 1 << 20
MIN_WORDS = 50
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeats(key: np.ndarray) -> np.ndarray:
    """Whether a value occurs twice or more."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    found = np.zeros(len(key), bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    return found


def _statistics(data: np.ndarray, rows: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of STATISTICS for each row of a chunk."""
    n = len(rows) - 1
    row = row_of(rows)
    start, end = words_of(data, rows)
    word_row = row[start] if len(start) else np.zeros(0, np.int32)
    heads = np.zeros(len(data) + 1, np.int64)  # a code point starts at every byte but 10xxxxxx
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    out = {
        "n_words": np.bincount(word_row, minlength=n),
        "word_chars": np.bincount(word_row, heads[end] - heads[start], minlength=n),
        "n_symbols": np.bincount(row, SYMBOLS[data], minlength=n),
    }
    # Three-word windows inside a row; the row is part of the key.
    word = byte_hash(data, start, end)
    repeated = np.zeros(len(word), bool)
    if len(word) > 2:
        key = word[:-2] + np.uint64(3) * mix(word[1:-1]) + np.uint64(5) * mix(mix(word[2:]))
        key = mix(key + word_row[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = np.flatnonzero(word_row[2:] == word_row[:-2])
        twice = at[_repeats(key[at])]
        for k in range(3):
            repeated[twice + k] = True
    out["n_repeat_words"] = np.bincount(word_row, repeated, minlength=n)
    # Lines that hold a word; a row's end also ends a line.
    breaks = np.flatnonzero(data == 0x0A)
    line_start = np.union1d(rows[:-1], breaks + 1)
    line_start = line_start[line_start < len(data)]
    line_end = np.append(line_start[1:], len(data))
    broken = data[line_end - 1] == 0x0A if len(line_end) else np.zeros(0, bool)
    # An end that follows a line break belongs to it, unless the break is this very line.
    line_end = line_end - broken
    words_before = np.searchsorted(start, np.append(line_start, len(data)))
    full = np.flatnonzero(np.diff(words_before) > 0)
    if len(full):
        s, e, line_row = line_start[full], line_end[full], row[line_start[full]]
        key = byte_hash(data, s, e) + mix(line_row.astype(np.uint64) + np.uint64(1))
        first = np.zeros(len(key), bool)
        first[np.unique(key, return_index=True)[1]] = True
        out["n_dup_lines"] = np.bincount(line_row, ~first, minlength=n)
    else:
        out["n_dup_lines"] = np.zeros(n)
    return {k: out[k].astype(np.int64) for k in STATISTICS}


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of STATISTICS for each text of a column; nulls have no words."""
    data, rows = utf8(texts)
    parts = [_statistics(d, r) for _, _, d, r in chunks(data, rows)]
    empty = np.zeros(0, np.int64)
    return {k: np.concatenate([p[k] for p in parts]) if parts else empty for k in STATISTICS}


def grams(data: np.ndarray) -> np.ndarray:
    """The bucket of the n-gram that starts at each byte but the last three."""
    d = data.astype(np.uint32)
    g = d[:-3] | d[1:-2] << np.uint32(8) | d[2:-1] << np.uint32(16) | d[3:] << np.uint32(24)
    return (g * np.uint32(2654435761)) >> np.uint32(16)


def _sums(data: np.ndarray, rows: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the weights and number of the n-grams of each row."""
    sums = np.zeros(len(data) + 1, np.int64)
    if len(data) >= GRAM:
        np.cumsum(weights[grams(data)], out=sums[1 : len(data) - GRAM + 2])
    count = np.maximum(np.diff(rows) - GRAM + 1, 0)
    return sums[rows[:-1] + count] - sums[rows[:-1]], count


@dataclass(frozen=True)
class QualityModel:
    """Weight of each n-gram bucket, in multiples of UNIT, and the lowest accepted mean weight."""

    weights: np.ndarray
    threshold: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Mean log-likelihood ratio per n-gram; 0 for texts shorter than an n-gram."""
        data, rows = utf8(texts)
        out = np.zeros(len(rows) - 1)
        for first, last, d, r in chunks(data, rows):
            total, count = _sums(d, r, self.weights)
            out[first:last] = total / np.maximum(count, 1) * UNIT
        return out

    def judge(self, texts: pa.Array) -> dict[str, np.ndarray]:
        out = statistics(texts)
        n = out["n_words"]
        out["base_failed"] = (n < MIN_WORDS) | (100 * out["n_repeat_words"] > 50 * n)
        out["score"] = self.scores(texts)
        out["kept"] = ~out["base_failed"] & (out["score"] >= self.threshold)
        return out


def best_threshold(scores: np.ndarray, good: np.ndarray) -> float:
    """The middle of the gap at which good and bad scores are told apart best; -inf without both.

    Best is the highest sum of the shares of good scores above and bad ones below; of equal cuts the lowest.
    """
    if good.all() or not good.any():
        return -np.inf
    values = np.unique(scores)
    above = 1 - np.searchsorted(np.sort(scores[good]), values) / good.sum()
    below = np.searchsorted(np.sort(scores[~good]), values) / (~good).sum()
    k = int(np.argmax(above + below))
    return float(values[k] if k == 0 else (values[k - 1] + values[k]) / 2)


def fit_threshold(scored: DataFrame) -> float:
    """`best_threshold` over the rows (score, good) of a frame of any size.

    Scores are dealt out by ranges; a range looks at its own with the totals of the ranges before it. One
    row a range and one for the best cut come back.
    """
    by_score = scored.groupBy("score").agg(
        F.count_if("good").alias("n_good"), F.count_if(~F.col("good")).alias("n_bad")
    )
    dealt = by_score.repartitionByRange("score").withColumn("part", F.spark_partition_id())
    dealt = stored(dealt, "scores")
    totals = dealt.groupBy("part").agg(
        F.sum("n_good").alias("good"), F.sum("n_bad").alias("bad"), F.max("score").alias("highest")
    )
    totals = sorted(totals.collect(), key=lambda r: r["part"])
    all_good, all_bad = sum(r["good"] for r in totals), sum(r["bad"] for r in totals)
    if not all_good or not all_bad:
        return -np.inf
    before, good, bad, highest = [], 0, 0, None
    for r in totals:
        before.append((r["part"], good, bad, highest))
        good, bad, highest = good + r["good"], bad + r["bad"], r["highest"]
    known = scored.sparkSession.createDataFrame(before, "part int, good long, bad long, highest double")
    lower = Window.partitionBy("part").orderBy("score")
    below = lower.rowsBetween(Window.unboundedPreceding, -1)

    def share(name: str, total: int) -> Column:
        return (F.col(name) + F.coalesce(F.sum(f"n_{name}").over(below), F.lit(0))) / F.lit(total)

    cuts = dealt.join(F.broadcast(known), "part").select(
        "score",
        F.coalesce(F.lag("score").over(lower), "highest").alias("previous"),
        ((1 - share("good", all_good)) + share("bad", all_bad)).alias("apart"),
    )
    best = cuts.orderBy(F.desc("apart"), "score").first()
    return best["score"] if best["previous"] is None else (best["previous"] + best["score"]) / 2


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> QualityModel:
    """Bucket weights log p(trusted) - log p(corpus), and the threshold that parts the labelled texts.

    The corpus multinomial counts the n-grams of all documents. The trusted one counts those of
    all documents labelled quality 1; an id labelled both ways counts as 0. Both get one pseudo-count per
    bucket. The threshold is fitted on all labelled ids. Null ids and labels are no labels. Counts come
    back as BUCKETS rows, whatever the size of the corpus.
    Up to GOOD_IDS good ids, by count, are broadcast to the documents; more meet them by a shuffle.
    """
    judged = labels.select(F.col("doc_id").alias("id"), "quality").dropna().groupBy("id")
    judged = judged.agg(F.min("quality").alias("quality"))
    good_ids = judged.where("quality = 1").select("id", F.lit(True).alias("good"))
    good_ids = F.broadcast(good_ids) if good_ids.count() <= GOOD_IDS else good_ids
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    flagged = read.join(good_ids, "id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_mine(__name__)
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, rows = utf8(batch.column(0))
            good = batch.column(1).to_numpy(zero_copy_only=False)
            for first, last, d, r in chunks(data, rows):
                if len(d) < GRAM:
                    continue
                row = row_of(r)
                inside = row[GRAM - 1 :] == row[: -GRAM + 1]
                bucket = grams(d)
                raw += np.bincount(bucket[inside], minlength=BUCKETS)
                inside &= good[first:last][row[: -GRAM + 1]]
                target += np.bincount(bucket[inside], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.record_batch(
            [pa.array(x) for x in (seen.astype(np.int32), raw[seen], target[seen])],
            names=["bucket", "raw", "target"],
        )

    counted = (
        flagged.mapInArrow(count, "bucket int, raw long, target long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .collect()
    )
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in counted:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    weights = np.rint(ratio / UNIT).astype(np.int64)
    model = QualityModel(weights, -np.inf)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array(model.scores(batch.column(1)))], names=["id", "score"])

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)]).add("score", "double")
    # Texts are scored where they are; ids and scores meet the labels. One score an id, however often it is repeated.
    scored = read.mapInArrow(score, schema).groupBy("id").agg(F.min("score").alias("score"))
    scored = scored.join(judged, "id").select("score", (F.col("quality") == 1).alias("good"))
    return QualityModel(weights, fit_threshold(scored))


def judge_quality(
    docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, STATISTICS, base_failed, score and kept.

    Words are runs without space, tab, line feed, vertical tab, form feed and carriage return. A null
    text has no words and fails the base. Every document is judged alike, whatever its length: kept
    if the base holds and the mean log-likelihood ratio of its n-grams reaches the threshold. Repeated
    rows and null ids each give their own row; further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.judge(batch.column(1))
            yield pa.record_batch(
                [batch.column(0), *[pa.array(x) for x in found.values()]], names=["id", *found]
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)])
    for name in STATISTICS:
        schema = schema.add(name, "long")
    schema = schema.add("base_failed", "boolean").add("score", "double").add("kept", "boolean")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(judge, schema).withColumnRenamed("id", id_column)


def keep_quality(docs: DataFrame, model: QualityModel, text_column: str = "text") -> DataFrame:
    """The rows of the kept documents, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_column)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_mine(__name__)
        for batch in batches:
            yield batch.filter(pa.array(shared.value.judge(batch.column(at))["kept"]))

    return docs.mapInArrow(keep, docs.schema)
