"""Strings that sums modulo a power of two take for each other, clashing names, long texts, other tokenizers."""

import hashlib
import json

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from conftest import rows
from pyspark.sql import functions as F
from samples import awkward, empty, no_labels, shared, shared_labels  # noqa: F401

from martwright.llm import common, suffix_dedup, tokens
from martwright.llm.common import byte_hash, free_names, utf8
from martwright.llm.licenses import _shingles
from martwright.llm.mixing import take_share
from martwright.llm.near_dedup import Plan, near_duplicates
from martwright.llm.pii import redact
from martwright.llm.quality import fit_quality, judge_quality
from martwright.llm.suffix_dedup import removed_bytes


def alternating(n, one, two):
    """The Thue-Morse string of n symbols: no sum of powers modulo 2**64 tells it from its complement."""
    return "".join(two if bin(k).count("1") % 2 else one for k in range(n))


PAIRS = [(alternating(n, "a", "b"), alternating(n, "b", "a")) for n in (64, 128, 1024, 4096)]


def test_hashes_tell_them_apart():
    for one, two in PAIRS:
        data, cuts = utf8(pa.array([one, two, one + "x", "yy" + two]))
        start, end = cuts[:-1], cuts[1:]
        h = byte_hash(data, start, end)
        assert len(set(h.tolist())) == 4
        again = byte_hash(data, np.array([cuts[3] + 2, cuts[2]]), np.array([cuts[4], cuts[3] - 1]))
        assert again.tolist() == [h[1], h[0]]
    none = np.zeros(0, np.int64)
    assert len(byte_hash(np.zeros(0, np.uint8), none, none)) == 0


def test_different_lines_and_words_are_no_repeats(spark, no_labels):
    lines = [f"{one}\n{two}\n{one}" for one, two in PAIRS]
    words = [f"{one} x y {two} x y {one} x y" for one, two in PAIRS]
    df = spark.createDataFrame(list(enumerate(lines + words)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in judge_quality(df, fit_quality(df, no_labels)).collect()}
    assert [found[k]["n_dup_lines"] for k in range(4)] == [1] * 4
    # The first three words come back at the end; the windows that differ in a long word do not.
    assert [found[k]["n_repeat_words"] for k in range(4, 8)] == [6] * 4


def test_different_words_are_not_linked(spark):
    df = spark.createDataFrame(
        [(10 * k + i, text) for k, pair in enumerate(PAIRS) for i, text in enumerate(pair)], "doc_id long, text string"
    )
    found = near_duplicates(df, Plan(words=2))
    assert rows(found, "doc_id", "component_id", "kept") == sorted(
        ((i, i, True) for i in (r["doc_id"] for r in df.collect())), key=lambda r: tuple(map(str, r))
    )


def test_shingles_of_long_words_differ():
    for one, two in PAIRS:
        data, cuts = utf8(pa.array([one, two]))
        h = byte_hash(data, cuts[:-1], cuts[1:])
        assert _shingles(h[:1], 1)[0] != _shingles(h[1:], 1)[0]


def test_names_of_the_user_keep_their_values(spark, shared, shared_labels):
    own = ("__n", "__text", "__p", "__spans", "__id", "__h", "__row", "__own", "__symbols")
    df = shared.limit(60).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in own})
    kept = take_share(df, shared_labels, {"clean": 1.25, "junk": 0.5, "toxic": 0.0})
    assert kept.columns == df.columns and kept.schema["__n"].dataType.simpleString() == "string"
    for found in (kept, redact(df)):
        for r in found.collect():
            assert all(r[c] == f"{c}{r['doc_id']}" for c in own)
    assert redact(df).count() == 60 and redact(df).columns == df.columns
    assert free_names(df, "__ID", "new") == ["___ID", "new"]


def test_nothing_of_a_domain_without_a_target_stays(shared, shared_labels):
    every = take_share(shared, shared_labels, {"clean": 2.0, "junk": 2.0, "toxic": 2.0}).count()
    assert every == shared.count()
    none = take_share(shared, shared_labels, {"clean": 0.0, "junk": 0.0, "toxic": 0.0}).count()
    assert none < 0.05 * every
    assert take_share(shared.limit(0), shared_labels, {"clean": 1.0, "junk": 1.0, "toxic": 1.0}).count() == 0


def log_lines(seed, size):
    rng = np.random.default_rng(seed)
    return "\n".join(f"{k:08d} level={rng.integers(3)} took {rng.integers(10**9)} ms" for k in range(size // 38))


def test_texts_are_unpacked_by_bytes(monkeypatch):
    press = zstandard.ZstdCompressor(1)
    sizes = [10, 10, 500, 2000, 10, 10, 0, 990, 20]
    batch = pa.record_batch([pa.array([press.compress(b"x" * n) for n in sizes], pa.binary())], names=["z"])
    monkeypatch.setattr(suffix_dedup, "PACK_BYTES", 1000)
    monkeypatch.setattr(suffix_dedup, "PACK_DOCS", 4)
    packs = [[zstandard.frame_content_size(z.as_py()) for z in p.column(0)] for p in suffix_dedup._packs(batch, 0)]
    assert packs == [[10, 10, 500], [2000], [10, 10, 0], [990], [20]]
    assert list(suffix_dedup._packs(batch.slice(0, 0), 0)) == []


def test_long_texts_are_deduplicated_whole(spark):
    """Texts longer than a pack and a chunk, with copies of parts across both."""
    long = log_lines(1, 3_000_000)
    data = [(1, long), (2, "own words first " * 3 + long[1_500_000:1_502_000]), (3, log_lines(2, 1_200_000)), (4, long)]
    seen, want = set(), []
    for i, t in data:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                gone[p : p + 100] = True
            else:
                seen.add(w)
        want.append((i, int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    assert rows(removed_bytes(df).select("doc_id", "n_removed", "kept_sha256")) == want


def test_patterns_come_from_the_file(tmp_path):
    import public_tokenizers

    for name in ("byte_bpe_50k", "word_bpe_49k"):
        settings = json.load(open(public_tokenizers.path(f"{name}.json"), encoding="utf-8"))["pre_tokenizer"]
        assert r"\p{L}" in tokens.pre_token_pattern(settings)
    for other in ({"type": "Whitespace"}, {"type": "ByteLevel", "use_regex": False, "add_prefix_space": False}):
        with pytest.raises(ValueError):
            tokens.pre_token_pattern(other)


def test_near_duplicates_leave_no_table_in_the_catalog(spark):
    before = {t.name for t in spark.catalog.listTables()}
    df = spark.createDataFrame([(1, "a b c"), (2, "a b c"), (3, "d e f")], "doc_id long, text string")
    assert near_duplicates(df, Plan(words=2)).where("kept").count() == 2
    assert {t.name for t in spark.catalog.listTables()} == before


def test_a_worker_frees_what_other_modules_remember():
    freed = []
    common.remembers("one", lambda: freed.append("one"))
    common.remembers("two", lambda: freed.append("two"))
    try:
        common.only_mine("one")
        assert freed == ["two"]
    finally:
        for module in ("one", "two"):
            common._remembered.pop(module)
