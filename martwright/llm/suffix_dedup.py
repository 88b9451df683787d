"""Remove byte strings that occurred before, found in merged Burrows-Wheeler transforms.

Every window of `length` bytes belongs to one anchor: the smallest hash among its grams, the first of
equal ones. Equal windows have equal anchors, so windows can be compared anchor by anchor, in
independent tasks. A segment is a run of windows that share an anchor. Anchors that occur once are
done. Of segments with equal bytes the first stays for comparison and the others are removed whole. What
remains, different segments around a common anchor, is sorted in shards whose transforms are merged up
to `length` symbols; each repeated interval keeps its first window. A window reaches half of its other bytes
to one side of its anchor at least, so segments that share them on neither side have no window in common
and are not compared.

Anchors that a sample shows to be hot are never gathered: their windows are dealt by their own hash, after
each pack of texts has kept its first window of every hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.llm.bwt import STEP, merge, shard
from martwright.llm.common import chunks, mix, partitions, prefix_hash, range_hash, row_of, stored, utf8

# Bytes of a gram. Windows of 100 bytes hold 69 of them, so about one byte in 35 is an anchor.
GRAM = 32
# Place bits next to a hash while the smallest is sought; a string has fewer bytes than this.
PLACE_BITS = np.uint64(31)
# Bytes of segments merged at once, so few that a processor's cache holds their arrays, and shards they are
# sorted in.
COLLECTION, SHARDS = 1 << 17, 4
# An anchor with more bytes of different segments is compared by 128-bit hashes of its windows instead.
MOST = 1 << 24
# Documents of one row of entries, and bytes of their texts; a longer text is a row of its own.
PACK_DOCS, PACK_BYTES = 1 << 12, 1 << 25
# One text in RATE is looked at for hot anchors, of longer texts than LONG one slice in RATE. An anchor with
# HOT different segments there (about 16,000 in all) is hot. This changes who compares, not the result.
RATE, LONG, SLICE, HOT = 16, 1 << 20, 1 << 16, 1000
# Windows of hot anchors sorted at once.
WINDOWS = 1 << 20


# ---- anchors ----------------------------------------------------------------------------------


@dataclass
class Segments:
    """Runs of windows with one anchor: its hash, the segment's, the row, first and last window.

    left and right are short hashes of the anchor with the bytes that a window must reach to one side of it
    at least, 0 where the segment ends before.
    """

    anchor: np.ndarray
    content: np.ndarray
    row: np.ndarray
    first: np.ndarray
    last: np.ndarray
    left: np.ndarray
    right: np.ndarray


def segments(data: np.ndarray, rows: np.ndarray, length: int) -> Segments:
    """The segments of all windows of `length` bytes inside the rows of a chunk; places count in rows."""
    n, width = len(data) - length + 1, length - GRAM + 1
    if n < 1:
        empty = np.zeros(0, np.int64)
        short = empty.astype(np.uint16)
        return Segments(empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty, short, short)
    sums = prefix_hash(data)
    at = np.arange(len(data) - GRAM + 1)
    gram = range_hash(sums, at, at + GRAM)
    low = gram >> PLACE_BITS << PLACE_BITS | at.astype(np.uint64)
    reach = 1
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    low = np.minimum(low[:n], low[width - reach : width - reach + n])
    anchor = (low & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int64)
    row = row_of(rows)
    whole = row[:n] == row[length - 1 :]
    change = np.ones(n + 1, bool)
    change[1:-1] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1])
    edges = np.flatnonzero(change)
    first, last = edges[:-1], edges[1:] - 1
    keep = whole[first]
    first, last = first[keep], last[keep]
    own = row[first].astype(np.int64)
    content = range_hash(sums, first, last + length)
    at, near = anchor[first], -(-(length - GRAM) // 2)
    begin, end = at - near, at + GRAM + near
    left = range_hash(sums, np.maximum(begin, 0), at + GRAM) >> np.uint64(48)
    right = range_hash(sums, at, np.minimum(end, len(data))) >> np.uint64(48)
    left = np.where(begin >= first, np.maximum(left, 1), 0).astype(np.uint16)
    right = np.where(end <= last + length, np.maximum(right, 1), 0).astype(np.uint16)
    return Segments(gram[at], content, own, first - rows[own], last - rows[own], left, right)


# ---- packed rows: one per task and bucket, a column for each array ---------------------------


def _pack(arrays: dict[str, np.ndarray]) -> dict[str, bytes]:
    return {k: v.tobytes() for k, v in arrays.items()}


def _batch(out: list[dict], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.IntegerType: pa.int32(), T.LongType: pa.int64(), T.BinaryType: pa.binary()}
    return pa.record_batch(
        [pa.array([x[f.name] for x in out], kinds[type(f.dataType)]) for f in schema.fields],
        names=schema.fieldNames(),
    )


def _columns(*names: str) -> T.StructType:
    schema = T.StructType([T.StructField("bucket", T.IntegerType())])
    for name in names:
        schema = schema.add(name, "binary")
    return schema


ENTRY = {"key": "<i8", "content": "<u8", "doc": "<u2", "first": "<u4", "count": "<u1", "left": "<u2", "right": "<u2"}
# Windows of hot anchors: two hashes, the document and the place.
WINDOW = {"one": "<u8", "two": "<u8", "w_id": "<i8", "w_row": "<i8", "place": "<i8"}
CUT = ("cut_row", "cut_start", "cut_end")
ENTRIES = _columns(*ENTRY, "ids", "rows", *CUT, *WINDOW)
# Per document: wanted segments (kind 0) or removed runs (kind 1).
MARKS = T.StructType([T.StructField("row", T.LongType()), T.StructField("kind", T.IntegerType())])
MARKS = MARKS.add("start", "binary").add("end", "binary").add("key", "binary")
PIECES = _columns("key", "id", "row", "start", "size", "bytes")


def _hot(batches: Iterator[pa.RecordBatch], length: int, rate: int) -> Iterator[pa.RecordBatch]:
    """From a sample of the texts: anchors and the number of their different segments in a batch."""
    unpress = zstandard.ZstdDecompressor()
    for batch in (part for whole in batches for part in _packs(whole, 1)):
        rows = batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64)
        chosen = mix(rows + np.uint64(1)) % np.uint64(rate) == 0
        texts = []
        for z, whole in zip(batch.column(1), chosen.tolist(), strict=True):
            z = z.as_py()
            if zstandard.frame_content_size(z) > LONG:
                text = unpress.decompress(z)
                texts += [text[a : a + SLICE] for a in range(0, len(text), SLICE * rate)]
            elif whole:
                texts.append(unpress.decompress(z))
        data, offsets = utf8(pa.array(texts, pa.binary()))
        found = [segments(d, r, length) for _, _, d, r in chunks(data, offsets)]
        if not found:
            continue
        pairs = np.stack([np.concatenate([getattr(x, k) for x in found]) for k in ("anchor", "content")])
        anchor, number = np.unique(np.unique(pairs, axis=1)[0], return_counts=True)
        some = number > 1
        yield pa.record_batch([pa.array(anchor[some].view(np.int64)), pa.array(number[some])], names=["anchor", "n"])


def hot_anchors(pressed: DataFrame, length: int, rate: int, hot: int) -> np.ndarray:
    """Anchors with at least `hot` different segments in the sample, sorted; at most its segments / `hot`."""
    seen = pressed.select("row", "z").mapInArrow(lambda x: _hot(x, length, rate), "anchor long, n long")
    found = seen.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") >= hot).select("anchor").collect()
    return np.sort(np.array([r["anchor"] for r in found], np.int64).view(np.uint64))


def _take(s: Segments, which: np.ndarray) -> Segments:
    return Segments(*[getattr(s, f.name)[which] for f in fields(Segments)])


def _two_hashes(data: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    one = range_hash(prefix_hash(data), at, at + length)
    two = range_hash(prefix_hash(np.bitwise_xor(data, np.uint8(0x5A))), at, at + length)
    return one, mix(two)


def _windows(data: np.ndarray, rows: np.ndarray, s: Segments, length: int) -> dict[str, np.ndarray]:
    """The windows of the segments of a chunk: hashes, row and place."""
    count = s.last - s.first + 1
    string = np.repeat(np.arange(len(count)), count)
    place = s.first[string] + np.arange(len(string)) - np.repeat(np.cumsum(count) - count, count)
    row = s.row[string]
    one, two = _two_hashes(data, rows[row] + place, length)
    return {"one": one, "two": two, "row": row, "place": place}


def _first_windows(w: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The first window of each pair of hashes, and the others as runs to cut."""
    order = np.lexsort((w["place"], w["w_row"], w["w_id"], w["two"], w["one"]))
    again = np.zeros(len(order), bool)
    again[1:] = (w["one"][order][1:] == w["one"][order][:-1]) & (w["two"][order][1:] == w["two"][order][:-1])
    later = order[again]
    later = later[np.lexsort((w["place"][later], w["w_row"][later]))]
    row, place = w["w_row"][later], w["place"][later]
    opens = np.ones(len(later), bool)
    opens[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(opens)
    tail = np.append(head[1:], len(later))[: len(head)] - 1
    cuts = {"cut_row": row[head], "cut_start": place[head], "cut_end": place[tail]}
    return {k: v[order[~again]] for k, v in w.items()}, cuts


def _dealt(parts: list[tuple[np.ndarray, dict[str, np.ndarray]]], buckets: int) -> list[dict]:
    """Rows of ENTRIES: arrays, each group of them dealt to buckets by its own numbers; the rest is empty."""
    out: dict[int, dict] = {}
    for bucket, arrays in parts:
        by = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            own = by[edges[b] : edges[b + 1]]
            row = out.setdefault(b, dict.fromkeys(ENTRIES.fieldNames(), b"") | {"bucket": b})
            row |= _pack({k: v[own] for k, v in arrays.items()})
    return list(out.values())


def _packs(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose unpacked texts have about PACK_BYTES at most."""
    first, size = 0, 0
    for row, z in enumerate(batch.column(column)):
        own = zstandard.frame_content_size(z.as_py())
        if row > first and (size + own > PACK_BYTES or row - first == PACK_DOCS):
            yield batch.slice(first, row - first)
            first, size = row, 0
        size += own
    if batch.num_rows:
        yield batch.slice(first)


def _entries(
    batches: Iterator[pa.RecordBatch], length: int, buckets: int, hot: np.ndarray | None = None
) -> Iterator[pa.RecordBatch]:
    """Anchors of the texts, packed by bucket; later copies of a segment in the same pack become cuts.

    Of hot anchors the windows are given in place of segments. Cuts are dealt by document.
    """
    unpress = zstandard.ZstdDecompressor()
    hot = np.zeros(0, np.uint64) if hot is None else hot
    modulo = lambda x: (x % np.uint64(buckets)).astype(np.int32)

    def window_rows(held: list[dict[str, np.ndarray]], ids: np.ndarray, rows: np.ndarray) -> list[dict]:
        w = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
        row = w.pop("row")
        w |= {"w_id": ids[row], "w_row": rows[row]}
        first, cuts = _first_windows(w)
        cuts["cut_end"] = cuts["cut_end"] + length
        parts = [(modulo(first["one"]), first), (modulo(cuts["cut_row"].view(np.uint64)), cuts)]
        return _dealt(parts, buckets)

    for batch in batches:
        for part in _packs(batch, 2):
            ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            data, offsets = utf8(pa.array([unpress.decompress(x.as_py()) for x in part.column(2)], pa.binary()))
            found, held, size = [], [], 0
            for first, _, d, r in chunks(data, offsets):
                s = segments(d, r, length)
                if len(hot):
                    spread = np.isin(s.anchor, hot)
                    if spread.any():
                        w = _windows(d, r, _take(s, spread), length)
                        w["row"] = w["row"] + first
                        held.append(w)
                        size += len(w["row"])
                        s = _take(s, ~spread)
                        if size >= WINDOWS:
                            yield _batch(window_rows(held, ids, rows), ENTRIES)
                            held, size = [], 0
                s.row += first
                found.append(s)
            if held:
                yield _batch(window_rows(held, ids, rows), ENTRIES)
            s = Segments(*[np.concatenate([getattr(x, f.name) for x in found]) for f in fields(Segments)])
            s = _take(s, np.lexsort((s.first, rows[s.row], ids[s.row], s.content, s.anchor)))
            again = np.zeros(len(s.anchor), bool)
            again[1:] = (s.anchor[1:] == s.anchor[:-1]) & (s.content[1:] == s.content[:-1])
            old, s = _take(s, again), _take(s, ~again)
            cuts = {"cut_row": rows[old.row], "cut_start": old.first, "cut_end": old.last + length}
            out = {x["bucket"]: x for x in _dealt([(modulo(cuts["cut_row"].view(np.uint64)), cuts)], buckets)}
            bucket = modulo(s.anchor)
            by = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[by], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                new = by[edges[b] : edges[b + 1]]
                known, doc = np.unique(s.row[new], return_inverse=True)
                row = out.setdefault(b, dict.fromkeys(ENTRIES.fieldNames(), b"") | {"bucket": b})
                row |= _pack(
                    {
                        "key": s.anchor[new].view(np.int64),
                        "content": s.content[new],
                        "doc": doc.astype("<u2"),
                        "first": s.first[new].astype("<u4"),
                        "count": (s.last - s.first)[new].astype("<u1"),
                        "left": s.left[new],
                        "right": s.right[new],
                        "ids": ids[known],
                        "rows": rows[known],
                    }
                )
            yield _batch(list(out.values()), ENTRIES)


def _marks(
    row: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray | None = None
) -> list[dict]:
    """One row per document with its places."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    edges = np.append(np.flatnonzero(np.append(True, row[1:] != row[:-1])), len(row)) if len(row) else [0]
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        s, e = start[a:b], end[a:b]
        if key is None:
            # Runs that touch are one.
            top = np.maximum.accumulate(e)
            opens = np.append(True, s[1:] > top[:-1])
            s, e = s[opens], top[np.append(np.flatnonzero(opens)[1:] - 1, len(s) - 1)]
        out.append(
            {
                "row": int(row[a]),
                "kind": 1 if key is None else 0,
                "start": s.astype("<i8").tobytes(),
                "end": e.astype("<i8").tobytes(),
                "key": b"" if key is None else key[order][a:b].tobytes(),
            }
        )
    return out


def _met(key: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Whether another row has the same key and the same side; a side of 0 meets none."""
    by = np.lexsort((side, key))
    equal = (key[by][1:] == key[by][:-1]) & (side[by][1:] == side[by][:-1]) & (side[by][1:] > 0)
    out = np.zeros(len(by), bool)
    out[by[1:][equal]] = True
    out[by[:-1][equal]] = True
    return out


def _match(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Entries of a bucket: copies of a segment are removed, different ones of one anchor wanted.

    Cuts pass through. Of windows with equal hashes the first stays.
    """
    held: dict[str, list] = {k: [] for k in (*ENTRY, "id", "row", *WINDOW)}
    for batch in batches:
        passed: list[list] = [[], [], []]
        for x in batch.to_pylist():
            arrays = {k: np.frombuffer(x[k], t) for k, t in (ENTRY | WINDOW).items()}
            for k, v in arrays.items():
                held[k].append(v)
            held["id"].append(np.frombuffer(x["ids"], "<i8")[arrays["doc"]])
            held["row"].append(np.frombuffer(x["rows"], "<i8")[arrays["doc"]])
            for k, column in zip(CUT, passed, strict=True):
                column.append(np.frombuffer(x[k], "<i8"))
        if any(map(len, passed[0])):
            yield _batch(_marks(*map(np.concatenate, passed)), MARKS)
    if not held["key"]:
        return
    w = {k: np.concatenate(held.pop(k)) for k in WINDOW}
    # Equal windows are in the same share of the bucket, so that little more than one is sorted at once.
    shares = len(w["one"]) // WINDOWS + 1
    share = (w["one"] >> np.uint64(40)) % np.uint64(shares)
    for k in range(shares if len(share) else 0):
        _, cuts = _first_windows({name: v[share == k] for name, v in w.items()})
        out = _marks(cuts["cut_row"], cuts["cut_start"], cuts["cut_end"] + length)
        for at in range(0, len(out), 10_000):
            yield _batch(out[at : at + 10_000], MARKS)
    del w, share
    c = {k: np.concatenate(held.pop(k)) for k in list(held)}
    sorted_keys = np.sort(c["key"])
    twice = np.unique(sorted_keys[1:][sorted_keys[1:] == sorted_keys[:-1]])
    place = np.minimum(np.searchsorted(twice, c["key"]), max(len(twice) - 1, 0))
    own = np.flatnonzero(twice[place] == c["key"]) if len(twice) else np.zeros(0, np.int64)
    e = {k: c[k][own] for k in (*ENTRY, "id", "row")}
    order = np.lexsort((e["first"], e["row"], e["id"], e["content"], e["key"]))
    e = {k: v[order] for k, v in e.items()}
    same_key = np.zeros(len(order), bool)
    same_key[1:] = e["key"][1:] == e["key"][:-1]
    copy = same_key.copy()
    copy[1:] &= e["content"][1:] == e["content"][:-1]
    start = e["first"].astype(np.int64)
    end = start + e["count"] + length
    # Anchors whose first segments differ, and of these the segments that may have a window in common.
    head = np.flatnonzero(~copy)
    keys, number = np.unique(e["key"][head], return_counts=True)
    many = head[number[np.searchsorted(keys, e["key"][head])] > 1]
    near = {k: e[k][many] for k in ("key", "left", "right")}
    many = many[_met(near["key"], near["left"]) | _met(near["key"], near["right"])]
    out = _marks(e["row"][copy], start[copy], end[copy]) + _marks(e["row"][many], start[many], end[many], e["key"][many])
    for at in range(0, len(out), 10_000):
        yield _batch(out[at : at + 10_000], MARKS)


def _cut_pieces(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Sorted by document, its wanted segments and then its text: the segments' bytes, packed by bucket."""
    unpress = zstandard.ZstdDecompressor()
    now, wanted = None, []
    for batch in batches:
        pack: list[tuple] = []
        for x in batch.to_pylist():
            if x["row"] != now:
                now, wanted = x["row"], []
            if x["kind"] == 0:
                wanted.append(x)
            elif wanted:
                text = unpress.decompress(x["z"])
                for w in wanted:
                    places = [np.frombuffer(w[k], "<i8") for k in ("key", "start", "end")]
                    for key, a, b in zip(*[p.tolist() for p in places], strict=True):
                        pack.append((key, x["id"], x["row"], a, text[a:b]))
        if not pack:
            continue
        key, ids, rows, start, pieces = zip(*pack, strict=True)
        key = np.array(key, np.int64)
        bucket = (key.view(np.uint64) % np.uint64(buckets)).astype(np.int32)
        out = []
        for b in np.unique(bucket):
            own = np.flatnonzero(bucket == b)
            out.append(
                {"bucket": int(b)}
                | _pack(
                    {
                        "key": key[own],
                        "id": np.array(ids, np.int64)[own],
                        "row": np.array(rows, np.int64)[own],
                        "start": np.array(start, np.int64)[own],
                        "size": np.array([len(pieces[i]) for i in own], np.int64),
                        "bytes": np.frombuffer(b"".join(pieces[i] for i in own), np.uint8),
                    }
                )
            )
        yield _batch(out, PIECES)


# ---- repeated intervals -----------------------------------------------------------------------


def repeated_windows(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """String and place of every window that an earlier one equals; `order` ranks the strings' windows.

    Strings are data[starts:ends]; the window at place p of string i comes at order[i] + p.
    """
    own = np.array_split(np.arange(len(starts)), min(SHARDS, len(starts)))
    shards = [shard(data, starts[i], ends[i]) for i in own]
    merged = merge(shards, length)
    string = np.zeros(len(merged.place), np.int64)
    offset = np.zeros(len(merged.place), np.int64)
    for k, (s, i) in enumerate(zip(shards, own, strict=True)):
        mine = np.flatnonzero(merged.shard == k)
        at = merged.place[mine]
        string[mine] = i[s.string[at]]
        offset[mine] = (ends - starts)[string[mine]] - s.left[at]
    first, last = merged.intervals()
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.repeat(first - np.append(0, np.cumsum(last - first)[:-1]), last - first) + np.arange((last - first).sum())
    when = order[string[inside]] + offset[inside]
    begin = np.append(0, np.cumsum(last - first)[:-1])
    earliest = np.repeat(np.minimum.reduceat(when, begin), last - first)
    later = inside[when != earliest]
    return string[later], offset[later]


def _hashed_windows(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, order: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """The same by two 64-bit hashes of each window, in a few words of memory a window."""
    count = ends - starts - length + 1
    string = np.repeat(np.arange(len(starts)), count)
    offset = np.arange(len(string)) - np.repeat(np.cumsum(count) - count, count)
    at = starts[string] + offset
    one, two = _two_hashes(data, at, length)
    when = order[string] + offset
    by = np.lexsort((when, two, one))
    later = np.zeros(len(by), bool)
    later[1:] = (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1])
    return string[by[later]], offset[by[later]]


def _repeats(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Segments of a bucket, merged some anchors at a time: removed runs of their documents."""
    held: dict[str, list] = {k: [] for k in ("key", "id", "row", "start", "size", "bytes")}
    for batch in batches:
        for x in batch.to_pylist():
            for k in held:
                held[k].append(np.frombuffer(x[k], np.uint8 if k == "bytes" else "<i8"))
    if not held["key"]:
        return
    c = {k: np.concatenate(held.pop(k)) for k in list(held)}
    begin = np.cumsum(c["size"]) - c["size"]
    # In the order of the documents; a window's time is its string's turn and its place.
    by = np.lexsort((c["start"], c["row"], c["id"], c["key"]))
    key = c["key"][by]
    edges = np.append(np.flatnonzero(np.append(True, key[1:] != key[:-1])), len(key))
    weight = np.add.reduceat(c["size"][by], edges[:-1])
    groups: list[tuple[int, int, bool]] = []
    held_bytes = 0
    for a, b, w in zip(edges[:-1].tolist(), edges[1:].tolist(), weight.tolist(), strict=True):
        held_bytes += w
        if w > MOST:
            groups.append((a, b, True))
        elif groups and not groups[-1][2] and held_bytes <= COLLECTION:
            groups[-1] = (groups[-1][0], b, False)
        else:
            groups.append((a, b, False))
            held_bytes = w
    for a, b, hashed in groups:
        own = by[a:b]
        turn = np.lexsort((c["start"][own], c["row"][own], c["id"][own]))
        order = np.empty(len(own), np.int64)
        order[turn] = np.arange(len(own), dtype=np.int64) << 32
        find = _hashed_windows if hashed else repeated_windows
        string, offset = find(c["bytes"], begin[own], begin[own] + c["size"][own], order, length)
        if len(string):
            start = c["start"][own][string] + offset
            yield _batch(_marks(c["row"][own][string], start, start + length), MARKS)


# ---- the whole ------------------------------------------------------------------------------


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(1)
    for batch in batches:
        packed = [press.compress((x.as_py() or "").encode()) for x in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["id", "row", "z"])


def _finish(batches: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Sorted by document, its removed runs and then its text."""
    unpress = zstandard.ZstdDecompressor()
    now, runs = None, []
    for batch in batches:
        out, size = [], 0
        for x in batch.to_pylist():
            if size > PACK_BYTES:
                yield _finished(out, schema)
                out, size = [], 0
            if x["row"] != now:
                now, runs = x["row"], []
            if x["kind"] == 1:
                runs += zip(*[np.frombuffer(x[k], "<i8").tolist() for k in ("start", "end")], strict=True)
                continue
            text = unpress.decompress(x["z"])
            size += len(text)
            merged: list[list[int]] = []
            for a, b in sorted(runs):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            kept, at = [], 0
            for a, b in merged:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            out.append((x["doc"], len(text), sum(b - a for a, b in merged), len(merged), b"".join(kept), [a for a, _ in merged], [b for _, b in merged]))
        yield _finished(out, schema)


def _finished(out: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*out, strict=True)) or [()] * len(schema)
    kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.list_(pa.int64())] * 2
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=schema.fieldNames())


def remove_repeats(
    docs: DataFrame,
    length: int = 100,
    id_column: str = "doc_id",
    text_column: str = "text",
    rate: int = RATE,
    hot: int = HOT,
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept (binary), starts and ends of removed runs.

    Texts are UTF-8 bytes. Removed is each byte in a string of `length` bytes that also starts earlier:
    in a document with a smaller id, or in the same one before. Strings are judged on the input;
    matches never cross documents. `length` is a multiple of 4, up to 287. Ids are whole numbers.

    A null text is empty. Rows with one id count in the order in which they are read, a null id comes
    before all others. An empty table gives no rows; only the two named columns are read. `rate` and `hot`
    say which anchors are spread over tasks window by window; they never change the result.
    """
    if length % STEP or not GRAM <= length <= GRAM + 255:
        raise ValueError(f"length must be a multiple of {STEP} from {GRAM} to {GRAM + 255}")
    buckets = partitions(docs.sparkSession)
    low = F.lit(-(2**63))
    read = docs.select(
        F.coalesce(F.col(id_column).cast("long"), low).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.col(text_column).alias("text"),
    )
    # Row numbers must be the same in all that follows, so texts are stored with them.
    pressed = stored(read.mapInArrow(_texts, "id long, row long, z binary"), "texts")
    spread = hot_anchors(pressed, length, rate, hot)
    entries = pressed.mapInArrow(lambda x: _entries(x, length, buckets, spread), ENTRIES)
    marks = stored(entries.repartitionById(buckets, F.col("bucket")).mapInArrow(lambda x: _match(x, length), MARKS), "marks")

    text_rows = pressed.select("row", F.lit(2).alias("kind"), "id", "z", *[F.lit(None).cast("binary").alias(k) for k in ("start", "end", "key")])
    mark_rows = lambda m: m.select("row", "kind", F.lit(None).cast("long").alias("id"), F.lit(None).cast("binary").alias("z"), "start", "end", "key")

    def with_texts(m: DataFrame) -> DataFrame:
        """Marks of each document in front of its text."""
        return mark_rows(m).unionByName(text_rows).repartition(buckets, "row").sortWithinPartitions("row", "kind")

    pieces = with_texts(marks.where("kind = 0")).mapInArrow(lambda x: _cut_pieces(x, buckets), PIECES)
    repeats = pieces.repartitionById(buckets, F.col("bucket")).mapInArrow(lambda x: _repeats(x, length), MARKS)
    schema = T.StructType([T.StructField(id_column, T.LongType())]).add("n_bytes", "long").add("n_removed", "long")
    schema = schema.add("n_spans", "long").add("kept", "binary")
    schema = schema.add("starts", T.ArrayType(T.LongType())).add("ends", T.ArrayType(T.LongType()))
    runs = marks.where("kind = 1").unionByName(repeats)
    doc = F.when(F.col("id") != low, F.col("id")).alias("doc")
    return with_texts(runs).select("*", doc).mapInArrow(lambda x: _finish(x, schema), schema)


def removed_bytes(
    docs: DataFrame,
    length: int = 100,
    id_column: str = "doc_id",
    text_column: str = "text",
    rate: int = RATE,
    hot: int = HOT,
) -> DataFrame:
    """`remove_repeats` with the SHA-256 of the remaining bytes in place of the bytes."""
    found = remove_repeats(docs, length, id_column, text_column, rate, hot)
    return found.select(
        id_column, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "starts", "ends"
    )
