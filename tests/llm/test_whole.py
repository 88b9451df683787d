"""Rows that an operator once left out or gathered in one task."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from conftest import rows
from samples import awkward, empty, no_labels, shared, shared_labels  # noqa: F401

from martwright.llm import bwt, suffix_dedup
from martwright.llm.quality import best_threshold, fit_quality, fit_threshold
from martwright.llm.secrets import features, findings, label_findings
from martwright.llm.spans import matches
from martwright.llm.suffix_dedup import removed_bytes

PASSAGE = "".join(random.Random(0).choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(300))


def own_text(seed, size=150):
    rng = random.Random(seed)
    return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ ") for _ in range(size))


def kept_bytes(data):
    seen, out = set(), []
    for i, t in data:
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(b[p : p + 100])
        out.append((i, int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=lambda r: tuple(map(str, r)))


def test_windows_of_hot_anchors_are_removed_alike(spark, shared):
    data = [(i, own_text(i) + PASSAGE + own_text(-1 - i)) for i in range(60)]
    data += sorted((r["doc_id"] + 1000, r["text"] or "") for r in shared.select("doc_id", "text").collect())[:80]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    for hot in (2, 20):
        found = removed_bytes(df, rate=1, hot=hot).select("doc_id", "n_removed", "kept_sha256")
        assert rows(found) == kept_bytes(data)


def test_no_bucket_gets_a_whole_hot_anchor():
    """All texts share a passage, so they have different segments around the anchors at its edges."""
    press = zstandard.ZstdCompressor(1)
    texts = [press.compress((own_text(i) + PASSAGE + own_text(-1 - i)).encode()) for i in range(500)]
    columns = [pa.array(range(500), pa.int64()), pa.array(range(500), pa.int64()), pa.array(texts, pa.binary())]
    batch = pa.record_batch(columns, names=["id", "row", "z"])
    sample = next(suffix_dedup._hot(iter([batch.select(["row", "z"])]), 100, 1))
    anchors = np.array(sample["anchor"].to_pylist(), np.int64)[np.array(sample["n"].to_pylist()) >= 100]
    assert len(anchors) >= 1
    out = [x for b in suffix_dedup._entries(iter([batch]), 100, 16, np.sort(anchors.view(np.uint64))) for x in b.to_pylist()]
    assert not set(anchors.tolist()) & {int(k) for x in out for k in np.frombuffer(x["key"], "<i8")}
    windows = np.zeros(16, np.int64)
    for x in out:
        windows[x["bucket"]] += len(x["one"]) // 8
    assert windows.sum() > 200 and windows.max() < 2 * windows.mean()


def entries_of(texts, length=100):
    press = zstandard.ZstdCompressor(1)
    packed = [press.compress(t.encode()) for t in texts]
    columns = [pa.array(range(len(texts)), pa.int64()), pa.array(range(len(texts)), pa.int64()), pa.array(packed, pa.binary())]
    return list(suffix_dedup._entries(iter([pa.record_batch(columns, names=["id", "row", "z"])]), length, 1))


def test_segments_without_a_common_window_are_not_compared():
    """A phrase of 60 bytes has common anchors but no common window; one of 100 bytes has one."""
    for size, wanted in ((60, False), (100, True)):
        texts = [own_text(i) + PASSAGE[:size] + own_text(1000 + i) for i in range(50)]
        found = [x for b in suffix_dedup._match(iter(entries_of(texts)), 100) for x in b.to_pylist()]
        assert bool([x for x in found if x["kind"] == 0]) == wanted


@pytest.mark.parametrize("length", [32, 36, 100])
def test_common_strings_just_long_enough_or_not(spark, length):
    """Texts share strings of one byte less, as many, or more, cut from any place of a passage."""
    rng = random.Random(length)
    data = []
    for i in range(80):
        size = length + rng.choice([-1, 0, 0, 1, 30])
        a = rng.randrange(len(PASSAGE) - size)
        data.append((i, own_text(i, rng.randrange(40)) + PASSAGE[a : a + size] + own_text(1000 + i, rng.randrange(150))))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    seen, want = set(), []
    for i, t in data:
        windows = [t[p : p + length] for p in range(len(t) - length + 1)]
        gone = {p + k for p, w in enumerate(windows) if w in seen or w in windows[:p] for k in range(length)}
        seen.update(windows)
        kept = "".join(c for p, c in enumerate(t) if p not in gone)
        want.append((i, len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = removed_bytes(df, length).select("doc_id", "n_removed", "kept_sha256")
    assert rows(found) == sorted(want, key=lambda r: tuple(map(str, r)))
    assert sum(n > 0 for _, n, _ in want) > 20


def test_suffixes_of_a_shard_are_sorted():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 20):
        sizes = rng.integers(1, 90, 40)
        data = rng.integers(97, 97 + letters, sizes.sum()).astype(np.uint8)
        ends = np.cumsum(sizes)
        strings = [data[a:b].tobytes() for a, b in zip(ends - sizes, ends, strict=True)]
        # Ends are smaller than all letters, and in the order of the strings.
        want = sorted((s[p:], i, p) for i, s in enumerate(strings) for p in range(len(s) + 1))
        first = ends - sizes + np.arange(len(sizes))
        assert bwt.shard(data, ends - sizes, ends).suffixes.tolist() == [int(first[i]) + p for _, i, p in want]


def test_surroundings_go_on_through_other_matches(spark):
    text = "x" * 70 + ' AWS_SECRET_ACCESS_KEY = "wJalrXUtnFEMIK7MDENGbPxR" 12 AAAAAAAAAAAAAAAA ' + "b" * 20 + " end"
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = matches(df, {"run": "[A-Za-z0-9_]{16,}+"}, {}, ".").collect()
    assert len(found) == 5
    for r in found:
        assert r["match"] == text[r["start"] : r["end"]]
        assert r["before"] == text[max(0, r["start"] - 64) : r["start"]]
        assert r["after"] == text[r["end"] : r["end"] + 64]


def test_names_and_short_values_of_secrets(spark):
    key = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY12"
    texts = [
        (f"AWS_KEY={key} end", [key]),
        (f'AWS_SECRET_ACCESS_KEY = "{key}"', ["AWS_SECRET_ACCESS_KEY", key]),
        (f'AWS_SECRET_ACCESS_KEY="{key}="', ["AWS_SECRET_ACCESS_KEY", key + "="]),
        (f'blob "{key}==" end', [key + "=="]),
        ('password = "hunter2!x", next', ["hunter2!x"]),
        ("pwd: ab1!cd2; next", ["ab1!cd2"]),
        (f"Authorization: Bearer {key}.x9", [key + ".x9"]),
        (f"token = {key}!x9", [key + "!x9"]),
        ("nothing here", []),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id long, text string")
    found = findings(df, path_column=None)
    got = {}
    for r in found.orderBy("id", "start").collect():
        got.setdefault(r["id"], []).append(r["match"])
        assert texts[r["id"]][0][r["start"] : r["end"]] == r["match"]
    assert [got.get(i, []) for i in range(len(texts))] == [want for _, want in texts]
    told = {(r["id"], r["match"]): r for r in label_findings(features(found, [])).collect()}
    for i in (0, 1, 4, 6, 7):
        r = told[i, texts[i][1][-1]]
        assert r["label"] == 1.0 and r["announced"] == 1.0


def test_the_quality_threshold_is_fitted_on_all_labels(spark):
    rng, n = random.Random(5), 21_000
    words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(40)]
    good = [int(rng.random() < 0.5) for _ in range(n)]
    texts = [" ".join(rng.choice(words[: 20 + 20 * (1 - q)]) for _ in range(4)) for q in good]
    docs = spark.createDataFrame(pa.table({"doc_id": range(n), "text": texts})).repartition(4)
    labels = spark.createDataFrame(pa.table({"doc_id": range(n), "quality": good}))
    model = fit_quality(docs, labels)
    scores = model.scores(pa.array(texts))
    assert model.threshold == best_threshold(scores, np.array(good, bool))


def test_the_best_cut_of_scores_in_any_number_of_ranges(spark):
    rng = random.Random(8)
    for n in (2, 7, 400):
        data = [(rng.randrange(40) / 8 - 2, rng.random() < 0.4) for _ in range(n)] + [(0.5, True), (0.25, False)]
        scored = spark.createDataFrame(data, "score double, good boolean")
        assert fit_threshold(scored) == best_threshold(*(np.array(x) for x in zip(*data)))
    assert fit_threshold(scored.where("good")) == fit_threshold(scored.limit(0)) == -np.inf


def test_words_of_the_dictionary_are_looked_up_in_a_set(spark):
    """A finding costs its own length, not that of the dictionary."""
    triples = sorted({a + b + c for a in "abcdefgh" for b in "aeiou" for c in "lmnrst"})
    data = [(1, "token = badgelanternXYZ123 and balrem/dolbes/qqqqqqqqq"), (2, "key: 'Halbolcam0Balbal9'"), (3, "secret=é"), (4, "author")]
    found = features(findings(spark.createDataFrame(data, "doc_id long, text string"), path_column=None), triples)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "INSET" in plan and "map_from_arrays" not in plan
    got = {r["match"]: r["dictionary"] for r in found.collect()}
    want = {}
    for m in got:
        parts = [m[i : i + 3].lower() for i in range(max(len(m) - 2, 1))]
        want[m] = sum(x in triples for x in parts) / len(parts)
    assert got == want and len(got) == 4 and sum(0 < x < 1 for x in got.values()) >= 2


def test_names_are_only_looked_for_beside_a_sign(spark):
    """A name without an assigned value gives nothing; with either sign it does, whatever else the text holds."""
    texts = ["my token is here", "token=abc", "a = b, Bearer", "PASSWORD: x9", "x" * 20 + " auth", "api_key = 'p q' " + "y" * 20, "=:", None]
    found = findings(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), path_column=None)
    assert rows(found, "id", "match") == [(1, "abc"), (3, "x9"), (4, "x" * 20), (5, "p"), (5, "y" * 20)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Contains(") < plan.index("(?i)(token")
