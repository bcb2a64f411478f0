"""Sketches, peeling and successors against brute force."""

import hashlib
import random

import pytest
import xxhash
from pyspark.sql import functions as F

from candlegrid.llm import fingerprints
from candlegrid.llm.fingerprints import LONG, POINTS, WIDTHS, WINDOW, WORDS, compared, difference, signed, sketch
from candlegrid.llm.fingerprints import paragraphs as paragraphs_of

MASK = 2**64 - 1


def xx(*parts):
    """Hash of several values, each seeded by the one before; missing ones leave the seed as it is."""
    h = 42
    for p in parts:
        if p is not None:
            h = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else p, h)
    return h


def paragraphs(text):
    words, out = text.split(" "), ""
    for k, w in enumerate(words):
        for i, c in enumerate(w):
            out += c
            if len(w) > LONG and xx(*w[max(0, i - WINDOW + 1) : i + 1]) % POINTS == 0:
                out += "\n"
        out += "\n" if xx(words[k - 1] if k else None, w) % WORDS == 0 else " "
    return {p for p in out.split("\n") if p.strip(" ")} if text else set()


def jaccard(a, b):
    a, b = paragraphs(a), paragraphs(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(docs):
    # rows with one id are told apart by hashes, so ids are distinct here
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    out = {}
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), pytest.approx(jaccard(text, edited)), pytest.approx(jaccard(text, after)), edited)
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choice("ab \u00e9\U0001f600") for _ in range(rng.randrange(200))) for _ in range(300)]
    docs = [(rng.getrandbits(40), "\n".join(rng.choices(lines, k=rng.randrange(60)))) for _ in range(60)]
    docs += [(1, None), (2, ""), (3, "x"), (4, "xyz"), (None, "abcdef"), (5, docs[0][1])]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, id int").repartition(5)
    got = {r.doc_id: r for r in compared(frame).collect()}
    expect = brute(docs)
    assert len(got) == len(docs)
    for i, (n, sha, near_edited, near_next, _) in expect.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.near_edited, r.near_next) == (n, sha, near_edited, near_next), i
    by_text = {}
    for i, text in docs:
        assert by_text.setdefault(text or "", got[i].fingerprint) == got[i].fingerprint
        assert by_text.setdefault(expect[i][4], got[i].edited_fingerprint) == got[i].edited_fingerprint
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint


@pytest.mark.parametrize("shared, only", [(0, 0), (5, 3), (50, 1), (40, 300), (0, 40)])
def test_difference_recovers_the_digests(spark, shared, only):
    rng = random.Random(shared + only)
    keys = [rng.getrandbits(63) for _ in range(shared + 2 * only)]
    a, b = keys[: shared + only], keys[:shared] + keys[shared + only :]
    row = spark.createDataFrame([(a, b)], "a array<long>, b array<long>")
    cells = [sketch(signed(F.col(c), 1), fingerprints.WIDTHS[0]) for c in "ab"]
    got = row.select(difference(F.col("a"), F.col("b"), *cells).alias("d")).first().d
    assert set(got.a) == set(a) - set(b) and set(got.b) == set(b) - set(a)


def test_copies_and_empty(spark):
    docs = spark.createDataFrame([(7, "abc"), (7, "abc"), (7, "abc"), (3, "xyz")], "doc_id long, text string")
    rows = compared(docs).orderBy("doc_id", "near_next").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert [(r.doc_id, r.edited_sha256, r.near_next) for r in rows] == [(3, sha("xya"), 0.0), (7, sha("abx"), 0.0), (7, sha("aba"), 1.0), (7, sha("aba"), 1.0)]
    assert compared(docs.limit(0)).count() == 0
    assert compared(docs.where("doc_id = 3")).first().near_next == 1.0


def check_of(key):
    return xx(key.to_bytes(8, "little"), (7).to_bytes(4, "little"))


def read(fingerprint):
    """Cells of a returned fingerprint."""
    return [[int(n), int(k, 16), int(c, 16)] for n, k, c in (cell.split(":") if cell else ("0", "0", "0") for cell in fingerprint.split(","))]


def peeled(a, b):
    """Digests only in a and only in b, from returned fingerprints alone; None if they can't be told."""
    width = WIDTHS[0]
    cells = [[x[0] - y[0], x[1] ^ y[1], x[2] ^ y[2]] for x, y in zip(read(a), read(b), strict=True)]
    out = {1: set(), -1: set()}
    while pure := next((c for c in cells if abs(c[0]) == 1 and c[2] == check_of(c[1])), None):
        sign, key, check = pure
        out[sign].add(key)
        for row, bits in enumerate((0, 20, 40)):
            cell = cells[row * width + (key >> bits) % width]
            cell[0], cell[1], cell[2] = cell[0] - sign, cell[1] ^ key, cell[2] ^ check
    return (out[1], out[-1]) if not any(x for c in cells for x in c) else None


def test_returned_fingerprints_can_be_peeled(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    body = rng.choices(words, k=2000)
    texts = [" ".join(body)]
    for at in (3, 700, 1990):
        texts.append(" ".join([*body[:at], "added", *body[at:]]))
    texts.append(" ".join(rng.choices(words, k=2000)))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in compared(frame).collect()}
    digests = [{xx(p) for p in paragraphs(t)} for t in texts]
    for i in (1, 2, 3):
        assert peeled(got[0].fingerprint, got[i].fingerprint) == (digests[0] - digests[i], digests[i] - digests[0])
    assert peeled(got[0].fingerprint, got[0].fingerprint) == (set(), set())
    # too much differs for so few cells, which peeling notices
    assert peeled(got[0].fingerprint, got[4].fingerprint) is None


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnop    ", "\u4e00\u4e8c\u4e09\U0001f600\u56db\u4e94\u516d\u4e03"])
def test_whole_texts_count_wherever_they_differ(spark, letters):
    rng = random.Random(len(letters))
    body, other = ("".join(rng.choices(letters, k=5512)) for _ in range(2))
    # by descending id each is compared with the next
    docs = [(4, "x" + body), (3, body), (2, body[:512] + other[512:]), (1, body[:-1] + "y")]
    got = {r.doc_id: r.near_next for r in compared(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    expect = brute(docs)
    assert all(got[i] == expect[i][3] for i in got)
    # a letter changes one paragraph of some twenty to thirty; the first after the last differs from it by two letters
    assert got[4] > 0.9 and got[3] < 0.2 and got[1] > 0.8


def test_very_long_texts(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=6)) for _ in range(50_000)]
    long = " ".join(rng.choices(words, k=30_000))
    unbroken = "".join(rng.choices("abcdefgh", k=100_000))
    docs = [(4, "z" + long), (3, long), (2, "z" + unbroken), (1, unbroken)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in compared(frame).collect()}
    expect = brute(docs)
    for i, (n, sha, near_edited, near_next, _) in expect.items():
        assert (got[i].n_chars, got[i].edited_sha256, got[i].near_edited, got[i].near_next) == (n, sha, near_edited, near_next)
    assert got[4].near_next > 0.99 and got[2].near_next > 0.99 and got[3].near_next < 0.01


def test_paragraphs_keep_the_text(spark):
    rng = random.Random(6)
    text = "one two\n\nthree " + "k" * 20 + " " + "".join(rng.choices("\u00e9\U0001f600abcdefg", k=400))
    row = spark.createDataFrame([(text,)], "t string").select(paragraphs_of(F.col("t")).alias("p")).first()
    assert "".join(row.p).replace(" ", "") == text.replace("\n", "").replace(" ", "")
    assert len(row.p) > 4
