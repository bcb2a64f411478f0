"""Anchor expansion against the patterns that define the base kinds."""

import random
import re

import pytest

from candlegrid.llm.pii import BASE, find, find_pii, luhn, mask, span_digests

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    found = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], BASE.index(s[0])))


@pytest.mark.parametrize("seed", range(4))
def test_base_is_the_patterns(seed):
    rng = random.Random(seed)
    pieces = ["a", "B.", "@", "@x.y", "1", "25", "255", ".", "..", "+", "+1 (555) ", " ", "-", "4736962573099581", "é", "%", "\n", "1.2.3.4", "٣", "4111 1111-1111 1111"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(25)))
        assert [s for s in find(text) if s[0] in BASE] == brute(text), repr(text)


def test_added_kinds():
    text = 'see https://a.example/x?y=1. token = "0b96a8c8d79c" and IBAN: DE44 5001 0517 5407 at 12 Old Mill Street.'
    kinds = {k: text[a:b] for k, a, b in find(text)}
    assert kinds["url"] == "https://a.example/x?y=1"
    assert kinds["secret"] == "0b96a8c8d79c"
    assert kinds["account"] == "DE44 5001 0517 5407"
    assert kinds["address"] == "12 Old Mill Street"
    assert [s for s in find("an account of the road and its token street") if s[0] not in BASE] == []


def test_mask():
    text = "write to a.b@c.de or +1 (487) 555-7209 now"
    assert mask(text, find(text)) == "write to [email] or [phone] now"


def test_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.c", "x"), (1, "a@b.c", "x"), (None, None, None), (2, "", "y")], "doc_id long, text string, spans string")
    rows = sorted(span_digests(find_pii(docs)).collect(), key=lambda r: (r.doc_id or 0, r.n_email))
    assert [(r.doc_id, r.n_email, r.spans) for r in rows] == [(None, 0, ""), (1, 1, "email:0:5"), (1, 1, "email:0:5"), (2, 0, "")]
    assert span_digests(find_pii(docs.limit(0))).count() == 0
    assert find_pii(docs, masked=True).where("doc_id is null").first().masked is None
