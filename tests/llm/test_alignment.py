"""Alignment of two tokenizers against plain set operations on token ends."""

import bisect
import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from conftest import rows
from pyspark.sql import functions as F
from samples import awkward, empty, shared  # noqa: F401
from tokenizers import Tokenizer

from martwright.llm import alignment
from martwright.llm.alignment import align, common_places, gallop, link_statistics

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def printable():
    """The byte of each printable character of a byte-level vocabulary, by the published rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in shown]
    return {chr(x): x for x in shown} | {chr(256 + k): x for k, x in enumerate(rest)}


def tokens_of(texts):
    """(ids, byte strings) of both sides for each text, by the libraries."""
    one, two = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    to_byte = printable()
    for text in texts:
        a = one.encode(" " + text, add_special_tokens=False)
        b = two.encode(text)
        a_bytes = [bytes(to_byte[c] for c in t) for t in a.tokens]
        b_bytes = []
        for p in map(two.id_to_piece, b):
            byte = p.startswith("<0x") and p.endswith(">") and len(p) == 6
            b_bytes.append(bytes.fromhex(p[3:5]) if byte else p.replace("\u2581", " ").encode())
        whole = b" " + text.encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            yield [], [], [], []
        else:
            yield a.ids, a_bytes, b, b_bytes


def ends(parts):
    out = []
    for x in parts:
        out.append(len(x) + (out[-1] if out else 0))
    return out


def expected(data):
    linked, own = collections.Counter(), []
    for (i, _), (a, ab, b, bb) in zip(data, tokens_of([t or "" for _, t in data])):
        ae, be = ends(ab), ends(bb)
        cuts = sorted(set(ae) & set(be))
        # A token belongs to the group of the first cut at or behind its end.
        in_a, in_b = ([[] for _ in cuts] for _ in "ab")
        for own_ids, own_ends, into in ((a, ae, in_a), (b, be, in_b)):
            for k, e in zip(own_ids, own_ends):
                into[bisect.bisect_left(cuts, e)].append(str(k))
        said = [",".join(x) + "|" + ",".join(y) for x, y in zip(in_a, in_b)]
        at = {e: k for k, e in zip(a, ae)}
        links = [(at[e], k) for k, e in zip(b, be) if e in at]
        linked.update(links)
        own.append((i, len(a), len(b), len(cuts), links, hashlib.sha256(";".join(said).encode()).hexdigest() if cuts else ""))
    most = collections.defaultdict(int)
    for (_, b), n in linked.items():
        most[b] = max(most[b], n)
    return sorted(
        (
            (i, na, nb, ng, len(links), sum(linked[x] == most[x[1]] for x in links), sum(linked[x] for x in links), digest)
            for i, na, nb, ng, links, digest in own
        ),
        key=lambda r: tuple(map(str, r)),
    )


@pytest.mark.parametrize("table", ["awkward", "shared"])
def test_links_and_groups(request, table):
    df = request.getfixturevalue(table)
    data = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    found = link_statistics(df, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(found) == expected(data)


@pytest.mark.parametrize("frequent", [0, 40])
def test_pairs_beyond_the_broadcast_table_count_alike(spark, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    rng = random.Random(4)
    words = ["alpha", "the", "\n", "naïve", "日本", "ﬁ", "  two", "x1", "(a)", "<s>", "<|endoftext|>", "\u2581", "😀", "\0"]
    data = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 40)))) for k in range(200)]
    assert sum(r[1] > 0 for r in expected(data)) > 50
    assert sum(r[1] == 0 for r in expected(data)) > 50
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    assert rows(link_statistics(df, A, B)) == expected(data)


def test_frequent_pairs_are_bounded(spark, monkeypatch):
    counts = spark.createDataFrame([(n,) for n in [1] * 50 + [2] * 9 + [3] * 5 + [8, 1000]], "links long")
    for bound, least in ((0, 1 << 62), (1, 512), (2, 8), (15, 8), (16, 2), (66, 1)):
        monkeypatch.setattr(alignment, "FREQUENT", bound)
        assert alignment._frequent_from(counts) == least
    assert alignment._frequent_from(counts.limit(0)) == 1 << 62


def test_nothing_to_align(spark, empty):
    assert link_statistics(empty, A, B).count() == 0
    df = spark.createDataFrame([(1, None), (1, ""), (None, "\u2581")], "doc_id long, text string")
    assert rows(link_statistics(df, A, B)) == [(1, 0, 0, 0, 0, 0, 0, "")] * 2 + [(None, 0, 0, 0, 0, 0, 0, "")]


def test_cuts_are_numbers_of_tokens(shared):
    for r in align(shared, A, B).limit(20).collect():
        assert r["a_cuts"][-1] == len(r["a"]) and r["b_cuts"][-1] == len(r["b"])
        assert len(r["a_cuts"]) == len(r["b_cuts"]) and sorted(set(r["a_cuts"])) == r["a_cuts"]


def test_galloping_finds_what_sets_find():
    rng = random.Random(5)
    for n, m in ((0, 0), (0, 5), (1, 1), (3, 200), (200, 3), (150, 150), (1, 4000)):
        for _ in range(30):
            one, two = (sorted(rng.sample(range(4500), k)) for k in (n, m))
            here, there = common_places(one, two)
            assert [one[k] for k in here] == [two[k] for k in there] == sorted(set(one) & set(two))
            if two:
                wanted, start = rng.randrange(4600), rng.randrange(m)
                first = next((k for k in range(start, m) if two[k] >= wanted), m)
                assert gallop(two, start, wanted) == first


def test_a_very_long_text(spark):
    text = " ".join(random.Random(6).choice(["grain", "naïve", "日本", "mill,"]) for _ in range(250_000))
    df = spark.createDataFrame([(1, text), (2, "grain mill")], "doc_id long, text string")
    found = link_statistics(df, A, B).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == expected([(1, text), (2, "grain mill")])
    assert len(text) > alignment.RUN / 2 and found[0]["n_groups"] > 100_000


def test_clashing_columns(awkward):
    clash = awkward.withColumns({c: F.lit("x") for c in ("a", "b", "pairs", "links", "best")})
    assert rows(link_statistics(clash, A, B)) == rows(link_statistics(awkward, A, B))


def test_parts_are_encoded_as_the_whole():
    rng, side = random.Random(11), alignment.PieceSide(B)
    parts = ["a", " ", "  ", "\n", "é", "日本", "\u2581", "😀", "\0", "ﬁ", "the", "ing", "\t", " of", "<s>", "<unk>", "<0x41>", "\u0301", "\u3000"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    assert side.apart
    assert [x.tolist() for x in side.ids(made)] == sentencepiece.SentencePieceProcessor(model_file=B).encode(made)
