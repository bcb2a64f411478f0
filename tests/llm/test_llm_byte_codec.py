"""Two-tier byte-level encoding against the library."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from candlegrid.llm import byte_codec
from candlegrid.llm.byte_codec import ByteCodec, PerfectHash, byte_digests, encode_bytes, vocabulary

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PARTS = [
    "'s", "'ll", "' ", " ", "  ", "\n", "\t", "　", "\xa0", "a", "Zeit", " über", "日本", "١", "!?", "՘", "࢏", "\U0003fc3f", "é", "é", "<|endoftext|>", "\x85", "\x1c", "x" * 70,
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_tells_strangers_apart():
    table = vocabulary(PATH).table
    assert sorted(table.values) == list(range(table.n)) and len(set(table.keys)) == table.n
    assert all(table.get(k) == v for k, v in zip(table.keys, table.values, strict=True))
    assert table.get(b"no such token in there") == -1
    for n in (1, 2, 3, 7):
        small = PerfectHash([bytes([i]) for i in range(n)], list(range(10, 10 + n)))
        assert [small.get(bytes([i])) for i in range(n + 1)] == [*range(10, 10 + n), -1]


def test_random_texts_as_the_library(library):
    rng, codec = random.Random(7), ByteCodec(PATH, public_tokenizers.PATTERN)
    for _ in range(4000):
        text = "".join(rng.choice(PARTS) if rng.random() < 0.8 else chr(rng.choice([rng.randrange(0x300), rng.randrange(0x300, 0xD800), rng.randrange(0xE000, 0x110000)])) for _ in range(rng.randrange(12)))
        ids = codec.encode(text)
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_long_texts_are_cut_match_by_match(library, monkeypatch):
    monkeypatch.setattr(byte_codec, "LONG", 50)
    monkeypatch.setattr(byte_codec, "REMEMBERED", 3)
    text = "Much said, and 'll be 12 said\n again  " * 40 + "qz" * 3000
    assert ByteCodec(PATH, public_tokenizers.PATTERN).encode(text).tolist() == library.encode_ordinary(text)


def test_rows(spark, library):
    texts = {1: "Two words, two words.", 2: None, 3: "", None: "՘ x", 5: "z" * 20_000}
    rows = [(i, t, "text") for i, t in texts.items()] + [(1, texts[1], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = encode_bytes(docs, PATH)
    assert found.columns == ["doc_id", "ids", "decoded"]
    told = byte_digests(found).collect()
    assert len(told) == len(rows)
    for r in told:
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert encode_bytes(docs.limit(0), PATH).count() == 0
