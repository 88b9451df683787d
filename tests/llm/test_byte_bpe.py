"""Byte-level BPE against the library, and its parts by themselves."""

import base64
import functools
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from conftest import rows
from samples import awkward, empty, shared  # noqa: F401

from martwright.llm.byte_bpe import Decoder, Encoder, PerfectHash, Ranks, decode, encode
from martwright.llm.pretokens import Splitter

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
MANY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@functools.cache
def library(path=PATH):
    lines = open(path, "rb").read().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def ranks(path=PATH):
    return Ranks.read(None, path, PATTERN)


@pytest.mark.parametrize("table", ["awkward", "shared"])
def test_encoded_as_by_the_library_and_decoded_back(request, table):
    df = request.getfixturevalue(table)
    found = decode(encode(df, PATH, PATTERN), PATH, PATTERN)
    want = []
    for r in df.select("doc_id", "text").collect():
        ids = library().encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), np.array(ids, "<u4").tobytes(), (r["text"] or "").encode()))
    got = [(r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in found.collect()]
    order = lambda r: tuple(map(str, r))
    assert sorted(got, key=order) == sorted(want, key=order)


def test_empty_table_and_null_ids(spark, empty):
    assert encode(empty, PATH, PATTERN).count() == 0
    df = spark.createDataFrame([(1, None), (2, bytearray(b"\x01\0\0\0"))], "doc_id long, ids binary")
    assert [r["decoded"] for r in decode(df, PATH, PATTERN).orderBy("doc_id").collect()] == [None, b'"']
    with pytest.raises(ValueError):
        decode(df.withColumnRenamed("doc_id", "decoded"), PATH, PATTERN)


def test_other_columns_pass_through_decoding(awkward):
    found = decode(encode(awkward, PATH, PATTERN).withColumnRenamed("n_tokens", "id"), PATH, PATTERN)
    assert found.columns == ["doc_id", "id", "ids", "decoded"] and found.count() == awkward.count()


@pytest.mark.parametrize("path", [PATH, MANY])
def test_any_characters(path):
    rng, encoder = random.Random(1), Encoder(ranks(path))
    parts = ["a", "b ", " ", "\n", "\t ", "'s", "'LL", "12", "é", ". ", " the", "_", "²", "日本", "😀", "\u0301", "\0", "\u3000", "Ж"]
    made = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    assert [x.tolist() for x in encoder.encode(made)] == library(path).encode_ordinary_batch(made)


def test_every_block_of_characters():
    """Each text holds a run of code points; letters the library does not know yet count as symbols."""
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    made = ["".join(f" {chr(c)}'s" for c in every[k : k + 16]) for k in range(0, len(every), 160)]
    made += [f"a{c}b {c}1{c}'s {c}{c}" for c in ranks().others[::50]]
    assert len(ranks().others) > 0
    assert [x.tolist() for x in Encoder(ranks()).encode(made)] == library().encode_ordinary_batch(made)


def test_long_texts_and_long_pre_tokens():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 12))) for _ in range(5000)]
    made = [" ".join(rng.choice(words) for _ in range(250_000)), "x" * 70_000, "".join(rng.choice("ab") for _ in range(60_000)), " " * 50_000]
    assert len(made[0]) > 1 << 20
    found = Encoder(ranks()).encode(made)
    assert [x.tolist() for x in found] == [library().encode_ordinary(x) for x in made]
    assert Decoder(ranks()).decode(found) == [x.encode() for x in made]


def test_the_perfect_hash_has_one_slot_per_string():
    rng = random.Random(3)
    for n in (0, 1, 2, 3, 7, 1000):
        strings = [bytes([k % 256, k // 256]) * (k % 5 + 1) for k in range(n)]
        table = PerfectHash.build(strings)
        assert sorted(table.slot(x) for x in strings) == list(range(n))
        assert all(table.strings[table.slot(x)] == x for x in strings)
        assert all(table.slot(rng.randbytes(9)) is None for _ in range(200))
    assert len(ranks().table.displacement) * 4 >= len(ranks().rank) == 50_256
    with pytest.raises(ValueError):
        PerfectHash.build([b"a", b"a"])


def test_whole_pre_tokens_are_not_merged(monkeypatch):
    encoder = Encoder(ranks())
    monkeypatch.setattr(encoder, "missed", lambda piece: 1 / 0)
    assert [x.tolist() for x in encoder.encode([" the government's house", ""])] == [
        library().encode_ordinary(" the government's house"),
        [],
    ]


def test_the_query_derives_its_digests(spark, shared):
    from martwright.llm.queries import op12_byte_bpe
    from samples import SF

    want = []
    for r in shared.select("doc_id", "text").collect():
        ids = np.array(library().encode_ordinary(r["text"] or ""), "<u4")
        digest = hashlib.sha256((r["text"] or "").encode()).hexdigest()
        want.append((r["doc_id"], len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), digest))
    assert rows(op12_byte_bpe(spark, SF)) == sorted(want, key=lambda r: tuple(map(str, r)))


def test_splitting_is_the_same_in_pieces():
    text = "a b  c\n" * 200_000
    assert [x for part in Splitter(PATTERN).cut(text) for x in part] == Splitter(PATTERN).pattern.findall(text)
