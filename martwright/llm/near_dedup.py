"""Near duplicates by an inverted join over MinHash coordinates, confirmed on whole shingle sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.common import bucketed, byte_hash, chunks, mix, only_mine, partitions, row_of, stored, utf8, words_of
from martwright.llm.components import components

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
# Members of one posting list compared in one task; a longer list is dealt to pairs of such blocks.
BLOCK = 4096
# Buckets in which a set's shingles are counted, to bound from below how much two sets differ.
BUCKETS = 512
# Members of lists longer than this first meet hubs of the list; shorter lists are compared at once.
SHORT_LIST = 16
# Hubs that members meet in each round, before all that are still apart are compared.
HUB_ROUNDS = (1, 3, 4, 4)
# Links that the driver follows by itself; more are followed by joins.
FEW_LINKS = 1 << 16


@dataclass(frozen=True)
class Plan:
    """Sizes of the join.

    Two sets of similarity s agree in a coordinate with probability s. With 64 coordinates and 33
    matches asked for, a pair at 0.8 is missed with a probability of 1e-7; the first look at 8 bits of
    half of them, of which 12 must match, misses it with 3e-8. A pair with `matches` equal coordinates
    shares one among the `prefix` rarest of either side, so only these are posted.
    """

    words: int = 5
    percent: int = 80
    coordinates: int = 64
    matches: int = 33
    quick: int = 32
    quick_matches: int = 12

    @property
    def prefix(self) -> int:
        return self.coordinates - self.matches + 1

    @property
    def multipliers(self) -> np.ndarray:
        return mix(np.arange(1, self.coordinates + 1, dtype=np.uint64)) | np.uint64(1)


# ---- shingle sets -----------------------------------------------------------------------------


def shingles(data: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row (of all words where there are fewer), and their rows."""
    start, end = words_of(data, rows)
    word = byte_hash(LOWER[data], start, end)
    word_row = row_of(rows)[start] if len(start) else np.zeros(0, np.int32)
    n = np.bincount(word_row, minlength=len(rows) - 1)
    first = np.cumsum(n) - n
    size = np.minimum(n, k)
    count = np.where(n > 0, np.maximum(n - k, 0) + 1, 0)
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    h = size[row].astype(np.uint64)
    for j in range(k):
        inside = j < size[row]
        h[inside] = mix(h[inside] * np.uint64(3) + word[at[inside] + j])
    return h, row


def text_set(text: bytes, k: int) -> np.ndarray:
    data = np.frombuffer(text, np.uint8)
    return np.unique(shingles(data, np.array([0, len(data)]), k)[0])


def _describe(h: np.ndarray, multipliers: np.ndarray) -> tuple[int, int, np.ndarray]:
    """A 128-bit digest of a set of hashes, and its smallest value under each coordinate's order."""
    low = np.full(len(multipliers), ~np.uint64(0))
    for at in range(0, len(h), 2048):
        low = np.minimum(low, (h[at : at + 2048, None] * multipliers).min(axis=0))
    one, two = mix(h + np.uint64(7)).sum(), mix(h ^ np.uint64(0x5851F42D4C957F2D)).sum()
    return int(one.view(np.int64)), int(two.view(np.int64)), (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _counts(h: np.ndarray) -> bytes:
    """Shingles per bucket, at most 15 each, two buckets a byte."""
    n = np.minimum(np.bincount((h % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS), 15).astype(np.uint8)
    return (n[::2] | n[1::2] << 4).tobytes()


def _close(one: np.ndarray, two: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether bucket counts leave it possible that the sets reach the similarity.

    Two sets differ in at least as many shingles as their bucket counts do, and they reach the
    similarity only if these are few enough for their sizes. This never rules out a link.
    """
    apart = np.zeros(len(one), np.int64)
    for shift in (0, 4):
        x, y = (one >> shift & 15).astype(np.int8), (two >> shift & 15).astype(np.int8)
        apart += np.abs(x - y).sum(axis=1, dtype=np.int64)
    return apart * (100 + percent) <= (100 - percent) * sizes


def shingle_sets(docs: DataFrame, plan: Plan, id_column: str, text_column: str) -> DataFrame:
    """id, n_shingles, digest (d1, d2), signature, its short form and bucket counts of every text."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_mine(__name__)
        for batch in batches:
            data, rows = utf8(batch.column(1))
            size, d1, d2, sig, counts = [], [], [], [], []
            for _, _, d, r in chunks(data, rows):
                h, row = shingles(d, r, plan.words)
                cuts = np.searchsorted(row, np.arange(len(r)))
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    unique = np.unique(h[a:b])
                    one, two, low = _describe(unique, plan.multipliers)
                    size.append(len(unique))
                    d1.append(one)
                    d2.append(two)
                    sig.append(low)
                    counts.append(_counts(unique))
            flat = pa.array(np.concatenate(sig) if sig else np.zeros(0, np.int32))
            short = [(x[: plan.quick] & 0xFF).astype(np.uint8).tobytes() for x in sig]
            offsets = pa.array(np.arange(len(sig) + 1, dtype=np.int32) * plan.coordinates)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(size, pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array(counts, pa.binary()),
                    pa.array(short, pa.binary()),
                ],
                names=["id", "n", "d1", "d2", "sig", "counts", "short"],
            )

    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType)])
    schema = schema.add("n", "long").add("d1", "long").add("d2", "long").add("sig", T.ArrayType(T.IntegerType())).add("counts", "binary").add("short", "binary")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(describe, schema)


# ---- candidate pairs --------------------------------------------------------------------------


def postings(sets: DataFrame, plan: Plan) -> DataFrame:
    """token, rep, freq: the `prefix` rarest coordinate values of each set, where others share them.

    Values of one set alone come first in the order by frequency; they post nothing but take their
    places of the prefix, so that unlike documents hardly post at all.

    Spark sizes exploded rows like the rows they come from, and would broadcast all cells of a table that
    is small enough; the hint keeps them in a shuffle.
    """
    cells = sets.select("rep", F.posexplode("sig").alias("pos", "value"))
    token = F.shiftleft(F.col("pos").cast("long"), 32).bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF))
    cells = cells.select("rep", token.alias("token"))
    shared = cells.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).where("freq > 1")
    held = (
        cells.hint("merge")
        .join(shared, "token")
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("freq", "token"))).alias("held"))
    )
    take = F.greatest(F.lit(0), F.size("held") - F.lit(plan.coordinates - plan.prefix))
    kept = held.select("rep", F.explode(F.slice("held", F.lit(1), take)).alias("post"))
    return kept.select("rep", "post.token", "post.freq")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    _, _, data = column.buffers()
    offset = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset]) if len(column) else 0
    return np.frombuffer(data, np.uint8)[offset : offset + len(column) * width].reshape(-1, width)


def alike(pairs: DataFrame, sets: DataFrame, plan: Plan) -> DataFrame:
    """The pairs (a, b) whose sizes and bucket counts allow the similarity and whose signatures match
    often enough."""
    both = ("rep", "n", "sig", "counts")
    mine, yours = (sets.select([F.col(c).alias(f"{side}_{c}") for c in both]) for side in "ab")
    near = plan.percent * F.greatest("a_n", "b_n") <= 100 * F.least("a_n", "b_n")
    joined = pairs.join(mine, pairs["a"] == mine["a_rep"]).join(yours, pairs["b"] == yours["b_rep"])
    joined = joined.where(near).select(
        "a", "b", "a_sig", "b_sig", "a_counts", "b_counts", (F.col("a_n") + F.col("b_n")).alias("sizes")
    )

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            equal = _matrix(batch.column(2), plan.coordinates) == _matrix(batch.column(3), plan.coordinates)
            counts = [_bytes(batch.column(k), BUCKETS // 2) for k in (4, 5)]
            close = _close(*counts, batch.column(6).to_numpy(), plan.percent)
            yield batch.select([0, 1]).filter(pa.array(close & (equal.sum(axis=1) >= plan.matches)))

    return joined.mapInArrow(match, pairs.select("a", "b").schema)


def hub_pairs(posts: DataFrame, seeds: range) -> DataFrame:
    """Each member of a long posting list with the list's hubs, where their labels differ.

    A hub is the first member in one order of all documents, another one for each seed. So the
    many lists that like documents share mostly have the same hubs, and a member meets few of them.
    All seeds share one grouping and one join.
    """
    posts = posts.where(F.col("freq") > SHORT_LIST)

    def first(seed: int) -> Column:
        return F.min(F.struct(F.xxhash64("rep", F.lit(seed)).alias("h"), "rep", "label"))

    hubs = posts.groupBy("token").agg(
        F.array(*map(first, seeds)).alias("hubs"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    hubs = hubs.where("low <> high").select("token", "hubs")
    met = posts.join(hubs, "token").select("rep", "label", F.explode("hubs").alias("hub")).where("label <> hub.label")
    return met.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()


def cross_pairs(posts: DataFrame, sets: DataFrame, plan: Plan, whole: bool) -> DataFrame:
    """All pairs with different labels that share a posted value, match often enough and fit in size.

    `whole` compares whole signatures and bucket counts, which is for long lists; else the short form
    of the signatures alone, so that the many short lists move few bytes, and their few matches are
    left to `alike`.

    Members of a list are compared where they stand, block by block, by signature and then by bucket
    counts; only pairs that pass both leave the task. Lists whose members have one label are left out. A list longer than BLOCK is dealt to
    pairs of blocks, so no task holds more than two of them.
    """
    mixed = posts.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    open_posts = posts.join(mixed.where("low <> high").select("token"), "token")
    blocks = F.ceil(F.col("freq") / F.lit(BLOCK)).cast("int")
    sketch = ("sig", "counts") if whole else ("short",)
    rows = open_posts.join(sets.select("rep", "n", *sketch), "rep").select(
        "token", "rep", "label", "n", *sketch, F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"), blocks.alias("blocks")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", other).select(
        "token",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "rep",
        "label",
        "n",
        *sketch,
    )
    keys = ["token", "i", "j"]

    def compare(table: pa.Table) -> pa.RecordBatch:
        col = {c: table.column(c).combine_chunks() for c in table.column_names}
        if whole:
            sig = _matrix(col.pop("sig"), plan.coordinates)
            counts = _bytes(col.pop("counts"), BUCKETS // 2)
        else:
            sig = _bytes(col.pop("short"), plan.quick)
        c = {k: v.to_numpy(zero_copy_only=False) for k, v in col.items()}
        found_a, found_b = [], []
        at = np.arange(len(sig) - 1)
        step = 1
        while len(at):
            to = at + step
            same = (c["token"][at] == c["token"][to]) & (c["i"][at] == c["i"][to]) & (c["j"][at] == c["j"][to])
            at, to = at[same], to[same]
            ok = (c["label"][at] != c["label"][to]) & ((c["i"][at] == c["j"][at]) | (c["block"][at] != c["block"][to]))
            low, high = np.minimum(c["n"][at], c["n"][to]), np.maximum(c["n"][at], c["n"][to])
            ok &= plan.percent * high <= 100 * low
            x, y = at[ok], to[ok]
            for k in range(0, len(x), 50_000):
                xs, ys = x[k : k + 50_000], y[k : k + 50_000]
                part = (sig[xs] == sig[ys]).sum(axis=1) >= (plan.matches if whole else plan.quick_matches)
                xs, ys = xs[part], ys[part]
                if whole:
                    part = _close(counts[xs], counts[ys], c["n"][xs] + c["n"][ys], plan.percent)
                    xs, ys = xs[part], ys[part]
                found_a.append(xs)
                found_b.append(ys)
            step += 1
            at = at[at + step < len(sig)]
        a = np.concatenate(found_a) if found_a else np.zeros(0, np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, np.int64)
        ids = col["rep"]
        return pa.record_batch([ids.take(pa.array(a)), ids.take(pa.array(b))], names=["a", "b"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            # The last list may go on in the next batch.
            last = [held.column(k)[held.num_rows - 1].as_py() for k in keys]
            ends = np.ones(held.num_rows, bool)
            for k, value in zip(keys, last, strict=True):
                ends &= held.column(k).to_numpy() == value
            first = int(np.argmax(ends))
            if first:
                yield compare(held.slice(0, first))
                held = held.slice(first)
        if held is not None:
            yield compare(held)

    rep = sets.schema["rep"].dataType
    schema = T.StructType([T.StructField("a", rep), T.StructField("b", rep)])
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    found = dealt.mapInArrow(walk, schema)
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


# ---- confirmation -----------------------------------------------------------------------------


def packed_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Texts compressed, which makes the shuffles of the confirmation small."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(1)
        for batch in batches:
            packed = [press.compress((x.as_py() or "").encode()) for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(packed, pa.binary())], names=["rep", "z"])

    schema = T.StructType([T.StructField("rep", docs.schema[id_column].dataType)]).add("z", "binary")
    read = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return read.mapInArrow(pack, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, plan: Plan) -> DataFrame:
    """The pairs whose whole shingle sets reach the similarity.

    `texts` is bucketed by rep. Only the texts that a pair needs are taken out of it and shuffled, by
    plain joins, which Spark splits where many pairs share a member.
    """
    members = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    texts = stored(texts.join(members.hint("shuffle_hash"), "rep", "left_semi"), "wanted")
    mine = texts.select(F.col("rep").alias("a"), F.col("z").alias("za"))
    yours = texts.select(F.col("rep").alias("b"), F.col("z").alias("zb"))
    joined = pairs.join(yours, "b").join(mine, "a").select("a", "b", "za", "zb")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        known: tuple = (None, None)
        for batch in batches:
            keep = []
            for a, za, zb in zip(batch.column(0), batch.column(2), batch.column(3), strict=True):
                if known[0] != a.as_py():
                    known = (a.as_py(), text_set(unpress.decompress(za.as_py()), plan.words))
                one, two = known[1], text_set(unpress.decompress(zb.as_py()), plan.words)
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= plan.percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return joined.mapInArrow(confirm, pairs.select("a", "b").schema)


# ---- the whole ------------------------------------------------------------------------------


def _labels(
    full: DataFrame, reps: DataFrame, posts: DataFrame, sets_of: DataFrame, texts: DataFrame, plan: Plan
) -> DataFrame:
    """Components (v, label) of the classes that have links, found round by round."""
    keys = ["n", "d1", "d2"]
    classes = reps.select("rep", *keys)
    # Rows of one id with different texts are one document.
    owners = full.join(classes, keys).groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("b"))
    owned = full.join(classes, keys).select("id", F.col("rep").alias("b"))
    owned = owned.join(owners.where("a <> b").select("id", "a"), "id").where("a <> b").select("a", "b")
    links = stored(owned.distinct(), "links")
    tested: DataFrame | None = None

    def untested(pairs: DataFrame) -> DataFrame:
        return pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti")

    def labelled(links: DataFrame) -> DataFrame:
        labels = components(links, FEW_LINKS)
        return posts.join(labels.withColumnRenamed("v", "rep"), "rep", "left").withColumn(
            "label", F.coalesce("label", "rep")
        )

    # Mostly no id has two texts, and each class starts as its own component.
    met = posts.withColumn("label", F.col("rep")) if links.isEmpty() else stored(labelled(links), "met")
    seed = 0
    for hubs in HUB_ROUNDS:
        pairs = untested(hub_pairs(met, range(seed, seed + hubs)))
        pairs = stored(alike(pairs, sets_of, plan), "pairs")
        new = stored(confirmed(pairs, texts, plan), "links")
        tested = pairs if tested is None else tested.union(pairs)
        links, seed = links.union(new), seed + hubs
        if new.isEmpty():
            break
        met = stored(labelled(links), "met")
    long = cross_pairs(met.where(F.col("freq") > SHORT_LIST), sets_of, plan, True)
    short = cross_pairs(met.where(F.col("freq") <= SHORT_LIST), sets_of, plan, False)
    pairs = untested(long.union(alike(short, sets_of, plan)).distinct())
    new = stored(confirmed(stored(pairs, "pairs"), texts, plan), "links")
    return components(links.union(new), FEW_LINKS)


def near_duplicates(
    docs: DataFrame, plan: Plan | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id, n_shingles, component_id and kept.

    Words are lower-cased (A-Z) runs without separators; a document's set holds its distinct shingles
    of `plan.words` words, or all its words as one where there are fewer. Documents are linked where
    100 * intersection >= percent * union, and component_id is the smallest id reachable by links.

    Equal sets become one class first. The classes' MinHash coordinate values are posted to an
    inverted index, rarest first and only as many as a match needs (prefix); lists are skipped once
    all their members are known to be connected. Members first meet the hubs of their lists; each
    confirmed link merges labels. In the end every two members of a list with different labels
    are compared, so no link between unconnected classes is lost, and hot lists of connected copies
    never expand into pairs. All links are confirmed on the whole shingle sets.

    Documents without words (or null) have an empty set and are linked with nothing. Rows that share
    an id count as one document. A null id is linked with nothing: component null, kept. An empty table
    gives no rows; only the two named columns are read.
    """
    plan = plan or Plan()
    sets = stored(shingle_sets(docs, plan, id_column, text_column), "sets")
    full = sets.where("n > 0 and id is not null")
    keys = ["n", "d1", "d2"]
    # Rows of a class have equal sets and so equal sketches.
    sketch = F.first(F.struct("sig", "counts", "short")).alias("sketch")
    reps = full.groupBy(*keys).agg(F.min("id").alias("rep"), sketch)
    reps = stored(reps.select("rep", *keys, "sketch.*"), "classes")
    classes = reps.select("rep", *keys)
    posts = stored(postings(reps, plan), "postings")
    posted = posts.select("rep").distinct()
    sets_of = reps.join(posted, "rep", "left_semi").select("rep", "n", "sig", "counts", "short")
    sets_of = stored(sets_of, "signatures")
    packed = packed_texts(docs.where(F.col(id_column).isNotNull()), id_column, text_column)
    packed = packed.repartition(partitions(docs.sparkSession), "rep")
    packed = packed.join(posted, "rep", "left_semi").dropDuplicates(["rep"])
    with bucketed(packed, "texts", "rep") as texts:
        labels = _labels(full, reps, posts, sets_of, texts, plan)

    final = classes.join(labels.withColumnRenamed("v", "rep"), "rep", "left")
    final = final.select(*keys, F.coalesce("label", "rep").alias("component_id"))
    out = sets.select("id", *keys).join(final, keys, "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    component = F.when(F.col("id").isNotNull(), component)
    return out.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def keep_first(
    docs: DataFrame, plan: Plan | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row of each group of near duplicates, with all columns; rows with a null id all stay."""
    # Named so that no column of the documents can clash.
    found = near_duplicates(docs, plan, id_column, text_column).where("kept")
    kept = found.select(F.col(id_column).alias("__kept_id")).where("__kept_id is not null").distinct()
    first = docs.join(kept, docs[id_column] == kept["__kept_id"], "left_semi").dropDuplicates([id_column])
    return first.unionByName(docs.where(F.col(id_column).isNull()))
