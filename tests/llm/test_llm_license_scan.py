"""Diagonal voting against brute force."""

import random
import re

from candlegrid.llm.license_scan import NOTICES, PHRASES, scan, summary

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(i, text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    hits = [(k, label) for label, p in PHRASES.items() for k in range(len(words)) if words[k : k + len(p.split())] == p.split()]
    starts = [k for k, _ in hits]
    return i, len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in hits}))


def test_base_against_brute_force(spark):
    rng = random.Random(4)
    pieces = ["MIT", "mit", "license", "License,", "Apache", "general", "public", "GENERAL", "\u212aey", "\u00e9", "--", "license\nmit"]
    docs = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randrange(40)))) for i in range(200)]
    docs += [(3, docs[3][1]), (3, docs[3][1]), (None, "MIT license"), (500, None), (501, ""), (502, "mit"), (503, "...")]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, words int")
    got = [tuple(r)[:6] for r in summary(scan(frame)).collect()]
    assert sorted(map(str, got)) == sorted(str(brute(*d)) for d in docs)


def test_notices(spark):
    whole = NOTICES["mit-notice"]
    docs = [
        (1, f"x y {whole.upper()}."),
        (2, whole.replace("free of charge", "wholly free of any charge")),
        (3, "free of charge to any person"),
        (4, "Licensed under the Apache License, Version 2.0."),
        (4, "Licensed under the Apache License, Version 2.0."),
    ]
    rows = summary(scan(spark.createDataFrame(docs, "doc_id long, text string"))).orderBy("doc_id").collect()
    assert [r.labels for r in rows] == ["mit-notice", "mit-notice", "", "apache,apache-notice", "apache,apache-notice"]
    assert [r.score for r in rows][::3] == [1.0, 1.0] and 0.6 <= rows[1].score < 1 and rows[2].score == 0


def test_repeated_pairs_are_no_notice(spark):
    docs = [
        (1, "rights reserved rights reserved"),
        (2, "spdx license spdx license"),
        (3, "rights reserved all rights"),
        (4, "rights reserved, all rights reserved"),
        (5, "rights reserved rights reserved"),
        (5, "rights reserved rights reserved"),
    ]
    rows = summary(scan(spark.createDataFrame(docs, "doc_id long, text string"))).orderBy("doc_id").collect()
    assert [(r.labels, r.score) for r in rows] == [("", 0.0), ("", 0.0), ("", 0.0), ("reserved", 1.0), ("", 0.0), ("", 0.0)]


def test_empty(spark):
    assert summary(scan(spark.createDataFrame([], "doc_id long, text string"))).count() == 0
