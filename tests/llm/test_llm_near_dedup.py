"""Multi-index hashing and components against brute force."""

import random

import pytest

from candlegrid.llm import near_dedup
from candlegrid.llm.near_dedup import components, fingerprint_of, links, near_duplicates


def brute_links(values):
    return {(a, b) for i, a in enumerate(values) for b in values[i + 1 :] if 1 <= (a ^ b).bit_count() <= 2}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def sample(seed):
    rng = random.Random(seed)
    out = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(15):
            x = base
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("crowd", [512, 3])
def test_links_are_all_within_two_bits(spark, monkeypatch, crowd):
    monkeypatch.setattr(near_dedup, "CROWD", crowd)
    values = sample(5)
    frame = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = {tuple(sorted((r.a % (1 << 64), r.b % (1 << 64)))) for r in links(frame).collect()}
    assert found == brute_links(values)


def test_components_of_a_long_chain_and_a_star(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200)]
    random.Random(1).shuffle(pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert {n: r for n, r in got.items() if n != r} == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200, 202: 200}


def test_fingerprint_matches_the_built_in_hash(spark):
    text = "Der Über a b\tC\x0bd e é"
    words = "der Über a b c d e é".split()
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    rows = spark.createDataFrame([(s,) for s in shingles], "s string").selectExpr("xxhash64(s) as h").collect()
    hashes = [r.h % (1 << 64) for r in rows]
    expect = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert fingerprint_of(text) == expect
    assert fingerprint_of("") == fingerprint_of(None) == fingerprint_of(" \n") == 0


def test_rows(spark):
    text = " ".join(f"w{i}" for i in range(200))
    docs = spark.createDataFrame(
        [(5, text, 1), (3, text, 2), (3, text, 2), (9, "", 3), (8, None, 4), (None, text, 5), (7, "quite another text", 6)],
        "doc_id long, text string, component_id int",
    )
    got = sorted(((r.doc_id, r.component_id) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([(3, 3), (3, 3), (5, 3), (7, 7), (8, 8), (9, 8), (None, 3)], key=str)
    assert near_duplicates(docs.limit(0)).count() == 0
