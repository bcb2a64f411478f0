"""FM-index search against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from candlegrid.llm.decontamination import FmIndex, contamination, contamination_digests, cut_spans, suffix_array
from candlegrid.llm.words import blank_parted, letters_only, words_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def tokens(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, window):
    words, hit, found = tokens(text), set(), set()
    for name, body in items:
        own = tokens(body)
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own and name is not None else 0):
            for j in range(len(words) - size + 1):
                if words[j : j + size] == own[i : i + size]:
                    hit.update(range(j, j + size))
                    found.add(str(name))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


def test_suffix_array_and_index():
    rng = np.random.default_rng(3)
    for _ in range(60):
        values = np.concatenate([np.concatenate(([0], rng.integers(1, 5, rng.integers(1, 12)))) for _ in range(rng.integers(1, 6))])
        told = values.tolist()
        assert suffix_array(values).tolist() == sorted(range(len(told)), key=lambda i: told[i:])
        index = FmIndex(values)
        for size in (1, 2, 3):
            phrases = rng.integers(1, 6, (8, size))
            phrases = phrases[phrases.max(axis=1) <= values.max()]
            low, high = index.search(phrases)
            for p, a, b in zip(phrases.tolist(), low, high, strict=True):
                expect = [i for i in range(len(told) - size + 1) if told[i : i + size] == p]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == expect


def test_words_are_the_patterns():
    rng = random.Random(2)
    texts = ["".join(rng.choice(" aB9é\t\x00\x1c,.\x85　漢\n-") for _ in range(rng.randrange(30))) for _ in range(300)] + [None, ""]
    for alphabet, pattern, lower in ((letters_only(), WORD, True), (blank_parted(), re.compile(r"[^\x20\x09-\x0D]+"), False)):
        got = words_of(pa.array(texts).slice(1), alphabet)
        for d, text in enumerate(texts[1:]):
            expect = pattern.findall((text or "").translate(LOWER) if lower else text or "")
            assert [got.word(i).decode() for i in range(got.first_word[d], got.first_word[d + 1])] == expect
        by_word = {}
        for i, h in enumerate(got.hashes.tolist()):
            assert by_word.setdefault(got.word(i), h) == h
        assert len(set(by_word.values())) == len(by_word)


@pytest.mark.parametrize("block_bytes", [4_000_000, 300])
def test_against_brute_force(spark, block_bytes):
    rng = random.Random(7)
    vocabulary = "a b c dd É ee".split()
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 3, 5, 9])))) for i in range(25)] + [(3, "c c c c c"), (None, "a b"), (30, None), (4, "dd")]
    docs = [(i, " ".join(rng.choice([*vocabulary, "zz", "q, A", "B\nC"]) for _ in range(rng.randrange(40)))) for i in range(60)]
    docs += [(1, docs[1][1]), (None, "a b c dd"), (90, None), (91, ""), (92, "zz " * 5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, spans int").repartition(3)
    got = contamination_digests(contamination(frame, bench, window=4, block_bytes=block_bytes)).collect()
    expect = [(d, *brute(t, items, 4)) for d, t in docs]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expect))


def test_empty(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination_digests(contamination(docs, none)).first().n_hit == 0
    assert contamination(docs.limit(0), none).count() == 0


def test_cut():
    texts = pa.array(["x", "One, two. Three (four) five!", None])
    assert cut_spans(texts, [[], [(1, 3), (4, 5)], []]) == ["x", "One,  (four) !", None]


def test_phrases_beyond_a_shards_numbers(spark):
    index = FmIndex(np.array([0, 1, 2, 3, 0, 2, 3]))
    low, high = index.search(np.array([[2, 3], [3, 4], [4, 4], [9, 1], [1, 900], [1, 2]]))
    assert (high - low).tolist() == [2, 0, 0, 0, 0, 1]
    # a short document in a shard of its own, among items of many more words
    items = [(i, " ".join(f"w{rng}x" for rng in range(12 * i, 12 * i + 12))) for i in range(80)]
    docs = [(i, f"so {t} it is") for i, t in items] + [(100, "nothing of it")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(90)
    got = contamination_digests(contamination(frame, bench)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, *brute(t, items, 10))) for d, t in docs)
