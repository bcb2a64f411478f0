"""Octopus multiproofs against a tree built node by node."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlegrid.llm.merkle import derived, fold, folded, lacking, level_sizes, manifest, numbered, proof_digests, siblings


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append(fold(levels[-1]))
    return levels


def test_multiproof_of_any_set_of_leaves_is_minimal_and_reaches_the_top():
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randrange(1, 40)
        leaves = [h(str(i)) for i in range(n)]
        levels, sizes = tree_of(leaves), level_sizes(n)
        assert [len(x) for x in levels] == sizes
        own = rng.sample(range(n), rng.randrange(1, n + 1))
        wanted = lacking(np.array(own), sizes)
        assert len(set(wanted)) == len(wanted)
        fetched = {(a, i): levels[a][i] for a, i in wanted}
        made = derived({i: leaves[i] for i in own}, fetched, sizes)
        assert made[-1][0] == levels[-1][0]
        # nothing that is fetched could be derived: no leaf of the set lies below it
        assert not any(i >> a == j for a, j in wanted for i in own)
        for i in own:
            beside = siblings(made, sizes, i)
            assert folded(leaves[i], i, beside) == levels[-1][0]
            assert folded(h("other"), i, beside) != levels[-1][0]


def told(row, more=0):
    parts = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = row[name]
        if value is None:
            parts.append("-")
            continue
        value = str(value + more if name == "n_chars" else value)
        parts.append(f"{len(value.encode())}:{value}")
    return h("".join(parts))


def brute(rows):
    trees = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append(row)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for own in trees.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, told(r)))
    levels = {x: tree_of([told(r) for r in trees[x]]) for x in langs}
    upper = tree_of([levels[x][-1][0] for x in langs])
    out = []
    for rank, lang in enumerate(langs):
        for position, row in enumerate(trees[lang]):
            beside, path = [], [(levels[lang], position), (upper, rank)]
            hit = row["doc_id"] is not None and row["n_chars"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            at = told(row, 1) if hit else told(row)
            for tree, i in path:
                for level in tree[:-1]:
                    if (i ^ 1) < len(level):
                        beside.append(level[i ^ 1])
                        at = h(level[i ^ 1] + at if i & 1 else at + level[i ^ 1])
                    else:
                        at = h(at)
                    i >>= 1
            root = upper[-1][0]
            out.append((row["doc_id"], told(row), levels[lang][-1][0], root, h("".join(beside)), at, at == root))
    return out


COLUMNS = "doc_id long, source string, lang string, n_chars int, text string, tree string, n long, digest string"


def order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("block, partition", [(12, 14), (2, 2), (2, 3), (1, 4)])
def test_manifest_against_brute_force(spark, block, partition):
    rng = random.Random(block)
    rows = [
        {
            "doc_id": rng.choice([None, rng.randrange(200)]) if rng.random() < 0.3 else 1000 + i,
            "source": rng.choice([None, "", "a"]),
            "lang": rng.choice([None, "", "en", "en", "en", "en", "ü", "zz", "-", "="]),
            "n_chars": rng.choice([None, 5, 7]),
            "text": rng.choice([None, "", "é 1", "x" * 5000, f"t{i}"]),
        }
        for i in range(150)
    ]
    rows += rows[:20]
    docs = spark.createDataFrame([(*r.values(), "a", 1, "b") for r in rows], COLUMNS).repartition(5)
    found = proof_digests(manifest(docs, block=block, partition=partition))
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert order(tuple(r) for r in found.collect()) == order(brute(rows))


def test_one_leaf_one_language_and_none(spark):
    row = {"doc_id": 3, "source": "s", "lang": "en", "n_chars": 1, "text": "t"}
    docs = spark.createDataFrame([(*row.values(), "a", 1, "b")], COLUMNS)
    assert [tuple(r) for r in proof_digests(manifest(docs)).collect()] == brute([row])
    assert manifest(docs.limit(0)).count() == 0


def test_numbering_of_a_hot_group(spark):
    rows = [("hot", i % 7) for i in range(1000)] + [(f"g{i}", i) for i in range(50)]
    found = numbered(spark.createDataFrame(rows, "g string, k long").repartition(6), "g", [F.col("k")]).collect()
    hot = sorted((r.position, r.k) for r in found if r.g == "hot")
    assert [p for p, _ in hot] == list(range(1000)) and [k for _, k in hot] == sorted(k for g, k in rows if g == "hot")
    assert all(r.position == 0 and r.n == 1 for r in found if r.g != "hot")
