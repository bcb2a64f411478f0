"""The trie of conversations against one built turn by turn."""

import hashlib
import random
import zlib

import pytest

from candlegrid.llm.conversation_trie import common_turns, prefix_trie

COLUMNS = "conv_id long, turn int, role string, text string, path string, n long, id string"


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in own.items()}
    members, ends, kids = {(): []}, {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        told = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(told) + 1):
            members.setdefault(told[:d], []).append(c)
            if d:
                kids.setdefault(told[: d - 1], set()).add(told[:d])
        ends.setdefault(told, []).append(c)
    if not own:
        return []

    def below(node):
        leaves, saved = 0, 0
        todo = [node]
        while todo:
            at = todo.pop()
            todo += kids.get(at, ())
            leaves += at not in kids
            saved += (len(members[at]) - 1) * len(at[-1][1].encode()) if at else 0
        return leaves, saved

    out = []
    for node, of in members.items():
        told = ",".join(map(str, sorted(ends.get(node, []))))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(of), len(node), parent, len(of), len(kids.get(node, ())), *below(node), hashlib.sha256(told.encode()).hexdigest()))
    return out


def conversations(seed, n, long=0):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(3 * n), n):
        for turn in range(rng.choice([1, 2, 3, 5, 9, 12])):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(["a", "a", "a", "é", "", None])))
    for c in range(long):
        rows += [(1000 + 5 * c, t, "user", f"same {t}" if t < 37 + c % 3 else f"{c}") for t in range(40)]
    return rows


def found(spark, rows, **settings):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], COLUMNS).repartition(3)
    return sorted(map(tuple, prefix_trie(docs, **settings).collect()), key=repr)


def test_common_turns():
    a, b = b"a" * 16, b"b" * 16
    assert common_turns(a + b, a + b + a) == 2 and common_turns(a, b) == 0 and common_turns(b"", a) == 0
    assert common_turns(a + b[:8] + a[:8], a + b) == 1


@pytest.mark.parametrize("settings", [{}, {"chunk": 13}, {"run": 9, "few": 20}, {"chunk": 9, "run": 5, "few": 9}])
def test_against_brute_force(spark, settings):
    rows = conversations(len(settings), 120, 3 if "chunk" in settings else 0)
    assert found(spark, rows, **settings) == sorted(brute(rows), key=repr)


def test_odd_rows(spark):
    # no id; no turn number; absent first of the group; a conversation that loses its turns; a repeated row
    rows = [(None, 0, "user", "x"), (7, None, "user", "late"), (7, 1, None, None), (7, 1, None, None), (11, 0, "u", "x" * 100_000)]
    assert found(spark, rows) == sorted(brute(rows), key=repr)
    assert found(spark, [(None, 0, "user", "x")]) == []
    assert found(spark, [(6, 0, "user", "x")]) == sorted(brute([(6, 0, "user", "x")]), key=repr)
