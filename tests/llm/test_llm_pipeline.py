"""The stages against brute force on small tables."""

import random
import re

import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from candlegrid.llm.decontamination import cut_spans
from candlegrid.llm.near_dedup import fingerprint_of, near_duplicates, similar_documents
from candlegrid.llm.pii import find, mask

rng = random.Random(9)
VOCABULARY = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "nu") for b in ("re", "sa", "ti") for c in ("", "n", "st", "lk")]


def prose(n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("corpus")
    passage = prose(14)
    docs = [(i, prose(120)) for i in range(60)]
    for i in range(10):
        words = docs[i][1].split()
        words[60] = "changed"
        docs.append((100 + i, " ".join(words)))
        docs.append((200 + i, docs[i][1]))
    docs += [(300 + i, f"{prose(40)} you are a stupid moron {prose(20)}. You pathetic clown.") for i in range(25)]
    docs += [(400, f"{prose(30)} {passage} {prose(30)}"), (401, "write to a.b@c.de or 10.0.0.1"), (402, None), (403, ""), (None, prose(50)), (404, prose(50)), (404, prose(50))]
    rows = [(i, t, "en", "src1", None if t is None else len(t)) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(300 <= i < 400)) for i, _ in docs if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), docs, passage


def test_run(spark, tables):
    folder, docs, passage = tables
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    kept, seen = [], []
    for i, text in sorted((d for d in docs if not (d[0] or 0) in range(300, 400)), key=lambda d: (d[0] is None, d[0])):
        own = shingles(text or "")
        if any(own == s or own and s and len(own & s) >= 0.8 * len(own | s) for s in seen):
            continue
        seen.append(own)
        cut = (text or "").replace(passage, "")
        masked = mask(cut, find(cut))
        kept.append((i, len(tokenizer.encode(masked, add_special_tokens=False).ids), tokenizer.decode(tokenizer.encode(masked, add_special_tokens=False).ids, skip_special_tokens=False)))
    got = [(r.doc_id, r.n_tokens, r.decoded) for r in corpus_pipeline.run(spark, folder).collect()]
    # of rows with one id that differ both stay
    assert sorted(map(str, got)) == sorted(map(str, kept))


def test_stages_keep_the_columns(spark, tables):
    folder, _, _ = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet").selectExpr("*", "1 as score", "2 as spans", "3 as node", "4 as items")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.dtypes == docs.dtypes, name
        assert out.count() > 60 and stage(spark, docs.limit(0), folder).count() == 0, name


def test_similar_documents_by_brute_force(spark):
    docs, parts = [], [prose(30) for _ in range(30)]
    for i in range(150):
        docs.append((i, " ".join(rng.choice(parts) if rng.random() < 0.2 else p for p in parts[i % 15 : i % 15 + 12])))
    found = similar_documents(spark.createDataFrame(docs, "doc_id long, text string"), 0.8).collect()
    group = {r.doc_id: r.group for r in found}
    sets = {i: shingles(t) for i, t in docs}
    # sketches of 128 tell 0.9 from 0.7, if not every pair at the border
    for i in sets:
        for j in range(i):
            alike = len(sets[i] & sets[j]) / len(sets[i] | sets[j])
            if alike >= 0.93:
                assert group[i] == group[j]
    assert len(set(group.values())) > 10


def test_cut_leaves_other_words():
    assert cut_spans(pa.array(["a b c d"]), [[(1, 3)]]) == ["a  d"]
    assert re.sub(" +", " ", "a  d") == "a d"


def brute_groups(docs):
    sets = {i: shingles(t) for i, t in docs}
    group = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if j < i and group[i] != group[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                group = {k: min(group[i], group[j]) if g in (group[i], group[j]) else g for k, g in group.items()}
    return group


def found_groups(spark, docs):
    least, rows = {}, similar_documents(spark.createDataFrame(docs, "doc_id long, text string"), 0.8).collect()
    for r in rows:
        least[r.group] = min(r.doc_id, least.get(r.group, r.doc_id))
    return {r.doc_id: least[r.group] for r in rows}


def test_long_texts_at_the_border(spark):
    # pairs of 400 shingles, of which all but 3 to 14 runs of five differ: from 0.70 to 0.93
    own, docs = random.Random(21), []
    for i in range(120):
        words = [f"x{own.randrange(10**6)}" for _ in range(404)]
        other = list(words)
        for k in range(3 + i % 12):
            other[10 + 25 * k] = f"y{i}"
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    assert found_groups(spark, docs) == brute_groups(docs)


def test_pairs_over_one_template(spark):
    # all texts are alike at 0.6 and meet in the same buckets; pairs are alike at 0.82
    own, docs = random.Random(5), []
    template = [f"t{i}" for i in range(304)]
    for i in range(100):
        words = template + [f"x{own.randrange(10**6)}" for _ in range(100)]
        other = list(words)
        for k in range(8):
            other[309 + 12 * k] = f"y{i}"
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    assert found_groups(spark, docs) == brute_groups(docs)


def test_fingerprints_within_two_bits_are_near_copies(spark):
    # a line that repeats decides the fingerprints; sets of shingles are alike at 0.2 only
    line, own = " ".join(f"k{i}" for i in range(7)), random.Random(11)
    docs = [(i, f"{line} " * 60 + " ".join(f"x{own.randrange(10**6)}" for _ in range(12))) for i in range(6)]
    docs += [(10 + i, prose(80)) for i in range(20)] + [(40, ""), (41, " "), (42, "one two"), (43, "three four")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    own = {r.doc_id: r.component_id for r in near_duplicates(frame).collect()}
    assert {own[i] for i in range(6)} == {0} and all((fingerprint_of(docs[0][1]) ^ fingerprint_of(docs[i][1])).bit_count() <= 2 for i in range(6))
    assert len({r.group for r in similar_documents(frame, 0.8, prints=True).collect()}) == len(set(own.values()))
    kept = corpus_pipeline.near_dedup(spark, frame.selectExpr("*", "'en' as lang"), "").collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(own.values()))
