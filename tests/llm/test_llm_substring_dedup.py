"""Parsing against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from candlegrid.llm import substring_dedup
from candlegrid.llm.substring_dedup import deduplicated, digests, factors, merge_factors
from candlegrid.llm.words import blank_parted, words_of


def brute(docs, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in docs]
    first = {}
    for (i, _), own in zip(docs, words, strict=True):
        for k in range(len(own) - window + 1):
            if i is not None:
                key = tuple(own[k : k + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for (i, _), own in zip(docs, words, strict=True):
        gone = set()
        for k in range(len(own) - window + 1):
            if i is not None and first[tuple(own[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("chunk", [1_200_000, 40])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK_SEEDS", chunk)
    monkeypatch.setattr(substring_dedup, "SLICE_BYTES", 300)
    rng = random.Random(11)
    vocabulary = ["a", "B", "b", "é", "the", "x\x85y", "\x00"]
    passages = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 14))) for _ in range(8)]
    docs = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(9))) for _ in range(rng.randrange(6))]
        docs.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(parts)))
    docs += [(7, docs[7][1]), (7, docs[8][1]), (200, docs[0][1]), (None, docs[1][1]), (None, None), (201, None), (202, ""), (-5, passages[0])]
    rng.shuffle(docs)
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, factors int").repartition(4)
    got = digests(deduplicated(frame, 4, block_bytes=100)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(docs, 4)))


def test_factors_grow_and_meet(spark):
    first, second = "a b c d e f g h", "g h i j k l m n"
    docs = spark.createDataFrame([(1, first), (2, second), (3, f"{first} {second[4:]} z")], "doc_id long, text string")
    row = factors(docs, 4).where("doc_id = 3").first()
    assert [(f.start, f.length, f.source, f.source_start) for f in row.factors] == [(0, 8, 1, 0), (6, 8, 2, 0)]


def test_merging_needs_the_same_source():
    got = merge_factors(np.array([0, 0, 0]), np.array([5, 3, 4]), np.array([9, 9, 9]), np.array([7, 1, 2]), 3)
    assert got.tolist() == [[0, 3, 4, 9, 1], [0, 5, 3, 9, 7]]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert deduplicated(docs).count() == 0


def test_words_of_one_letter_pattern_have_hashes_of_their_own(spark):
    # letters in the order of Thue and Morse and their mirror cancel out in any polynomial modulo a power of two
    one = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    other = one.translate(str.maketrans("ab", "ba"))
    hashes = words_of(pa.array([f"{one} {other} ab ba {one}"]), blank_parted()).hashes.tolist()
    assert len(set(hashes)) == 4 and hashes[0] == hashes[4]
    same = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"{same} {one}"), (2, f"{same} {other}")], "doc_id long, text string")
    assert [r.n_removed for r in deduplicated(docs).orderBy("doc_id").collect()] == [0, 0]
