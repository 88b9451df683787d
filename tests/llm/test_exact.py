"""Operators with one right answer, against plain Python over the same texts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import rows
from samples import awkward, empty, no_labels, shared, shared_labels  # noqa: F401
from tokenizers import Tokenizer

from martwright.llm import bwt
from martwright.llm.fingerprints import OrderMinHash, edited_fingerprints, fingerprints
from martwright.llm.near_dedup import Plan, keep_first, near_duplicates
from martwright.llm.packing import pack, pack_sequences
from martwright.llm.pii import personal_data, redact
from martwright.llm.quality import best_threshold, fit_quality, judge_quality, keep_quality
from martwright.llm.suffix_dedup import _hashed_windows, removed_bytes, repeated_windows
from martwright.llm.token_counts import Counter, token_counts
from martwright.llm.tokens import whole_tokens

BYTE, WORD = (public_tokenizers.path(f"{x}.json") for x in ("byte_bpe_50k", "word_bpe_49k"))
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("table", ["awkward", "shared"])
def test_token_counts(request, table):
    df = request.getfixturevalue(table)
    tokenizer = Tokenizer.from_file(BYTE)
    want = []
    for i, t in texts(df):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 1024))
    assert rows(token_counts(df, BYTE)) == sorted(want, key=lambda r: tuple(map(str, r)))


def test_token_counts_of_any_mix_of_spaces():
    rng, counter, tokenizer = random.Random(3), Counter(BYTE, whole_tokens(BYTE)), Tokenizer.from_file(BYTE)
    parts = ["a", "b ", " ", "\n", "\t", "'s", "'LL", "1", "é", ".", " the", "_", "²", " ", "<|endoftext|>"]
    for _ in range(800):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert counter.tokens(text) == len(tokenizer.encode(text, add_special_tokens=False).ids), repr(text)


def test_every_proven_string_is_one_token():
    tokenizer, proven = Tokenizer.from_file(BYTE), whole_tokens(BYTE)
    assert len(proven) > 40_000
    for string in proven[::500]:
        assert len(tokenizer.encode(string, add_special_tokens=False).ids) == 1


@pytest.mark.parametrize("table", ["awkward", "shared"])
def test_packing(request, table):
    df = request.getfixturevalue(table)
    found = pack_sequences(df, WORD).toPandas()
    tokenizer = Tokenizer.from_file(WORD)
    want = collections.Counter()
    for i, t in texts(df):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    got = collections.Counter(
        (None if np.isnan(r.doc_id) else int(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in found.itertuples()
    )
    assert got == want
    for _, group in found.groupby("sequence_id"):
        group = group.sort_values("offset")
        assert list(group.offset) == [0, *group.length.cumsum()[:-1]] and group.length.sum() <= 4096
    least = -(-found.length.sum() // 4096)
    assert found.sequence_id.nunique() <= least + 1


def test_local_search_beats_best_fit():
    rng = np.random.default_rng(1)
    for lengths in (rng.integers(600, 1400, 600), rng.integers(1, 4096, 500), np.full(30, 1366), np.zeros(0, int)):
        where, place, gap = pack(lengths, 4096)
        for b in range(int(where.max(initial=-1)) + 1):
            own = np.flatnonzero(where == b)
            assert 0 < lengths[own].sum() == 4096 - gap[own[0]]
            order = own[np.argsort(place[own])]
            assert list(place[order]) == [0, *np.cumsum(lengths[order])[:-1]]
    # Best fit leaves 3000, 2600 + 1400 and 1000; moving and exchanging items fills two.
    assert pack(np.array([3000, 2600, 1400, 1000, 96]), 4096)[0].max() == 1


def quality_of(text):
    w = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    triples = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = collections.Counter(triples)
    covered = {i + k for i, x in enumerate(triples) if times[x] > 1 for k in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("table", ["awkward", "shared"])
def test_quality_statistics(request, table, no_labels):
    df = request.getfixturevalue(table)
    found = judge_quality(df, fit_quality(df, no_labels)).drop("score")
    want = []
    for i, t in texts(df):
        q = quality_of(t)
        failed = q[0] < 50 or 100 * q[4] > 50 * q[0]
        want.append((i, *q, failed, not failed))
    assert rows(found) == sorted(want, key=lambda r: tuple(map(str, r)))


def test_quality_model_agrees_with_its_formula_and_labels(shared, shared_labels):
    model = fit_quality(shared, shared_labels)
    labels = {r["doc_id"]: r["quality"] for r in shared_labels.collect()}
    raw, good = collections.Counter(), collections.Counter()

    def buckets(text):
        b = text.encode()
        grams = [int.from_bytes(b[i : i + 4], "little") for i in range(len(b) - 3)]
        return [(g * 2654435761 % 2**32) >> 16 for g in grams]

    all_texts = dict(texts(shared))
    for i, t in all_texts.items():
        raw.update(buckets(t))
        if labels.get(i) == 1:
            good.update(buckets(t))
    size = 1 << 16
    weight = {
        k: np.log((good[k] + 1) / (good.total() + size)) - np.log((raw[k] + 1) / (raw.total() + size)) for k in raw
    }
    for r in judge_quality(shared, model).collect()[::20]:
        own = buckets(all_texts[r["doc_id"]])
        assert r["score"] == pytest.approx(sum(weight[k] for k in own) / max(1, len(own)), abs=1e-5)
        assert r["kept"] == (not r["base_failed"] and r["score"] >= model.threshold)
    judged = {r["doc_id"]: r for r in judge_quality(shared, model).collect()}
    told = [judged[i]["kept"] == (q == 1) for i, q in labels.items() if not judged[i]["base_failed"]]
    assert sum(told) >= 0.97 * len(told)


def test_threshold_and_kept_rows(awkward, no_labels):
    assert best_threshold(np.array([-2.0, -1.0, 1.0, 2.0]), np.array([False, False, True, True])) == 0.0
    assert best_threshold(np.array([1.0]), np.array([True])) == -np.inf
    kept = keep_quality(awkward, fit_quality(awkward, no_labels))
    assert kept.columns == awkward.columns
    assert {r["doc_id"] for r in kept.collect()} <= {1, 5, 6, 7, 8, 11, None}


def groups_of(df, k):
    sets = {}
    for i, t in texts(df):
        w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in WORDS.findall(t or "")]
        own = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} or ({tuple(w)} if w else set())
        if i is not None:
            sets.setdefault(i, []).append(own)
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                near = any(
                    x and y and 100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b]
                )
                if near:
                    label[a] = label[b] = min(label[a], label[b])
        if all(label[label[i]] == label[i] for i in label):
            break
    return label


def test_near_duplicates_of_awkward_rows(awkward, empty):
    label = groups_of(awkward, 2)
    found = near_duplicates(awkward, Plan(words=2)).collect()
    assert len(found) == awkward.count()
    for r in found:
        assert r["component_id"] == label.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or label[r["doc_id"]] == r["doc_id"])
    kept = keep_first(awkward, Plan(words=2))
    assert kept.columns == awkward.columns
    ids = sorted(str(r["doc_id"]) for r in kept.collect())
    assert ids == sorted([*(str(i) for i in label if label[i] == i), "None", "None"])


def test_near_duplicates_of_a_large_group(spark):
    """Copies that differ in a few words each: some pairs fall below the threshold, all are connected."""
    rng = random.Random(5)
    base = [rng.choice("abcdefghij") + str(rng.randint(0, 10**6)) for _ in range(100)]
    data = [(0, " ".join(base))]
    for i in range(1, 60):
        copy = list(base)
        for _ in range(rng.randint(1, 8)):
            copy[rng.randrange(100)] = f"x{rng.randint(0, 10**9)}"
        data.append((i, " ".join(copy)))
    data += [(100 + i, " ".join(rng.sample(base, 100))) for i in range(10)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    label = groups_of(df, 2)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(df, Plan(words=2)).collect()} == label
    assert len(set(label.values())) > 5


@pytest.mark.parametrize("table", ["awkward", "shared"])
def test_removed_bytes(request, table):
    df = request.getfixturevalue(table)
    data = texts(df)
    if table == "awkward":  # rows of one id have no order of their own
        data = [x for x in data if x[0] not in (None, 6)]
        df = df.where("doc_id is not null and doc_id <> 6")
    seen, want = set(), []
    for i, t in sorted(data):
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - 99):
            if b[p : p + 100] in seen:
                gone[p : p + 100] = True
            seen.add(b[p : p + 100])
        gone = gone[: len(b)]
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        want.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    found = removed_bytes(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows(found) == sorted(want, key=lambda r: tuple(map(str, r)))


def test_removed_bytes_of_repeated_rows(awkward):
    found = removed_bytes(awkward.where("doc_id = 6 or doc_id is null")).collect()
    six = sorted(r["n_removed"] for r in found if r["doc_id"] == 6)
    assert six[0] == 0 and six[1] > 0 and len(found) == 4


def test_merged_transforms_find_all_repeats():
    rng = np.random.default_rng(0)
    for _ in range(30):
        base = rng.integers(97, 100, 60).astype(np.uint8).tobytes()
        strings = []
        for _ in range(rng.integers(2, 12)):
            a = rng.integers(0, 30)
            strings.append(base[a : a + rng.integers(12, 30)])
        sizes = np.array([len(s) for s in strings])
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(strings), np.uint8)
        order = np.arange(len(strings), dtype=np.int64) << 32
        seen, want = set(), []
        for i, s in enumerate(strings):
            for p in range(len(s) - 11):
                if s[p : p + 12] in seen:
                    want.append((i, p))
                seen.add(s[p : p + 12])
        for find in (repeated_windows, _hashed_windows):
            got = find(data, ends - sizes, ends, order, 12)
            assert sorted(zip(*(x.tolist() for x in got), strict=True)) == want
        merged = bwt.merge([bwt.shard(data, ends - sizes, ends)], 12)
        shown = [data[:0].tobytes()] * len(merged.place)
        symbols = bwt.shard(data, ends - sizes, ends).symbols
        for k, place in enumerate(merged.place):
            stop = place + int(np.argmax(symbols[place:] == 0))
            shown[k] = symbols[place:stop].tobytes()[:12]
        assert shown == sorted(shown)
        for k in range(1, len(shown)):
            shared = next((j for j in range(12) if shown[k][j : j + 1] != shown[k - 1][j : j + 1] or j >= len(shown[k])), 12)
            assert merged.common[k] == shared // 4 * 4


@pytest.mark.parametrize("table", ["awkward", "shared"])
def test_edited_fingerprints(request, table):
    df = request.getfixturevalue(table)
    method = OrderMinHash()
    data = sorted(
        ((i, t or "") for i, t in texts(df)), key=lambda r: (r[0] is None, -(r[0] or 0), r[1])
    )
    want = []
    for (i, t), (_, u) in zip(data, data[1:] + data[:1], strict=True):
        half = len(t) // 2
        edited = t[: len(t) - half] + u[:half]
        a, b, c = (method.sketch(x) for x in (t, edited, u))
        shown = [x.astype(">u2").tobytes().hex() for x in (a, b)]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        want.append((i, len(t), digest, *shown, float((a == b).mean()), float((a == c).mean())))
    assert rows(edited_fingerprints(df)) == sorted(want, key=lambda r: tuple(map(str, r)))
    assert rows(fingerprints(df), "fingerprint") == sorted((w[3],) for w in want)


def test_order_sketch_follows_the_order_of_words():
    method = OrderMinHash(coordinates=256)
    rng = random.Random(2)
    parts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(60)) for _ in range(40)]
    text, turned = "".join(parts), "".join(reversed(parts))
    small = text[:100] + "#" + text[101:]
    near = [float((method.sketch(text) == method.sketch(x)).mean()) for x in (text, small, turned)]
    assert near[0] == 1.0 and near[1] > 0.9 and near[2] < 0.65
    long = "".join(parts) * 20
    assert (method.sketch(long) == method.sketch(long)).all()


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in doubled) % 10 == 0


def personal(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda: True,
                "ip": lambda m=m: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda d=d: 16 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=d: 8 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((kind, *m.span()))
    return out


PII = [
    "a@b.c_d@e.f x@y.z",
    "+1 (743) 555-3824 and 1.2.3.4.5.6.7.8 999.1.1.1 000001.2.3.4",
    "4111 1111 1111 1111 4111111111111112 5500-0000-0000-0004 4111111111111111",
    "\x01a@b.co\x02 é 😀 +49 30 1234567 +1+12345678",
    "a.b@@c.d@e.f-g.h. a@b.c@d.e",
    "1" * 5000,
    "1 " * 20_000,
    "a" * 50_000 + "@",
]


@pytest.mark.parametrize("table", ["awkward", "shared", "made"])
def test_personal_data(request, spark, table):
    if table == "made":
        df = spark.createDataFrame(list(enumerate(PII)), "doc_id long, text string")
    else:
        df = request.getfixturevalue(table)
    want = []
    for i, t in texts(df):
        found = personal(t)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
        counts = [sum(k == kind for k, *_ in found) for kind in PATTERNS]
        want.append((i, *counts, hashlib.sha256(listed.encode()).hexdigest(), listed))
    assert rows(personal_data(df)) == sorted(want, key=lambda r: tuple(map(str, r)))


def test_contexts_discover_what_no_pattern_matches(spark):
    """Phones stand behind "call me at"; so do two numbers in forms that no base pattern knows."""
    rng = random.Random(1)
    data = []
    for i in range(60):
        number = f"+1 555 {rng.randint(100, 999)} {rng.randint(1000, 9999)}"
        data.append((i, f"Please call me at {number} before {i} o'clock, order 77{i}00{i} is ready."))
    data += [(100, "Please call me at 0049/8912345 before noon."), (101, "The code 0049/8912345x was wrong.")]
    spans = {r["doc_id"]: r["spans"] for r in personal_data(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    at = data[60][1].index("0049")
    assert spans[100] == f"phone:{at}:{at + 12}" and spans[101] == ""
    assert all(s.count("phone") == 1 and "," not in s for i, s in spans.items() if i < 60)


def test_redacted_rows(awkward, empty):
    found = redact(awkward)
    assert found.columns == awkward.columns and found.count() == awkward.count()
    by_id = {r["doc_id"]: r["text"] for r in found.where("doc_id in (2, 7, 10)").collect()}
    assert by_id[2] is None and by_id[10].endswith("<phone> <email>")


def test_empty_tables(empty, no_labels):
    assert token_counts(empty, BYTE).count() == 0
    assert pack_sequences(empty, WORD).count() == 0
    assert judge_quality(empty, fit_quality(empty, no_labels)).count() == 0
    assert near_duplicates(empty).count() == 0
    assert removed_bytes(empty).count() == 0
    assert edited_fingerprints(empty).count() == 0
    assert personal_data(empty).count() == 0 and redact(empty).count() == 0
