"""Token counts and the codec against the tokenizers' own library; the toxicity grammar by hand."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from candlegrid.llm.bpe_codec import Codec, encode
from candlegrid.llm.token_counts import token_counts
from candlegrid.llm.toxicity import Model, Scorer, learn, score

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "ab 'sS \n\té1½　漢\U0001f600aaa՘\x1c\x85  \rΣİÅ"


def texts(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) if rng.random() < 0.9 else "<|endoftext|>" for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("piece", [32_768, 5])
def test_rows_are_the_librarys(spark, piece):
    docs = [(i, t) for i, t in enumerate(texts(1, 200))] + [(3, None), (None, "Hello  world"), (4, ""), (4, "ab" * 60), (4, "ab" * 60)]
    frame = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, ids int").repartition(3)
    library = Tokenizer.from_file(WORDS)
    expect = []
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expect.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    got = [(r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in encode(frame, WORDS, piece).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expect))
    library = Tokenizer.from_file(BYTES)
    counted = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(frame, BYTES, 20).collect()]
    sizes = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in docs]
    assert sorted(map(str, counted)) == sorted(str((*s, s[2] > 20)) for s in sizes)
    assert encode(frame.limit(0), WORDS).count() == token_counts(frame.limit(0), BYTES).count() == 0


def test_small_windows_join_to_the_same_tokens():
    codec, library, rng = Codec(WORDS, 2, 1), Tokenizer.from_file(WORDS), random.Random(2)
    for _ in range(150):
        text = "".join(rng.choice("aabhetin") for _ in range(rng.randrange(1, 200)))
        assert np.frombuffer(codec.text(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_clauses():
    def events(text):
        return dict(zip(("insult", "aimed", "negated", "reported", "threat"), Scorer(Model({}, {"vequ": 0.5})).events(text).tolist(), strict=True))

    none = dict.fromkeys(("insult", "aimed", "negated", "reported", "threat"), 0.0)
    assert events("What a stupid thing.") == none | {"insult": 1}
    assert events("You are a stupid moron!") == none | {"aimed": 2}
    assert events("A moron, that is. You know") == none | {"insult": 1}
    assert events("Such a moron you are") == none | {"aimed": 1}
    assert events("You are not a moron") == none | {"negated": 1}
    assert events('He called "you idiot" out') == none | {"reported": 1}
    assert events("I will hurt you") == none | {"threat": 1}
    assert events("I will not hurt you") == events("they hurt the dog") == events("") == events(None) == none
    assert events("tout vequment la") == none | {"insult": 0.5}


def test_every_word_is_read():
    def events(text):
        return Scorer(Model({}, {})).events(text).tolist()

    for text in ("you\tare\ta\tmoron", "you\u00a0moron", "you/moron", "you\u2014moron", "you--moron", "you-moron", "moron_you", "(you)(moron)"):
        assert events(text) == [0, 1, 0, 0, 0], text
    assert events("you...moron") == events("a moron\r\nyou") == events("so\u2026moron") == [1, 0, 0, 0, 0]
    assert events('they/"moron"') == [0, 0, 0, 1, 0]
    assert events("will/hurt/you") == [0, 0, 0, 0, 1]
    assert events("x/" * 200 + "you/moron") == [0, 1, 0, 0, 0]


def test_learns_words_and_roots(spark):
    rng = random.Random(3)
    plain = [f"w{i}" for i in range(50)]
    docs, labels = [], []
    for i in range(200):
        toxic = i % 4 == 0
        words = rng.choices(plain, k=30) + ([rng.choice(["grumblox", f"zorq{i}"])] if toxic else [])
        rng.shuffle(words)
        docs.append((i, " ".join(words), 9.0))
        labels.append((i, int(toxic)))
    frame = spark.createDataFrame([*docs, (900, None, 1.0), (None, "w1", 1.0)], "doc_id long, text string, score double")
    told = spark.createDataFrame([*labels, (5, None), (None, 1)], "doc_id long, toxic int")
    model = learn(frame, told)
    rows = score(frame, model).collect()
    right = sum((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in rows if r.doc_id is not None and r.doc_id < 200)
    assert len(rows) == 202 and right >= 195 and all(0 <= r.score <= 1 for r in rows)
    assert learn(frame, told.limit(0)).weights and score(frame.limit(0), model).count() == 0
