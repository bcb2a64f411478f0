"""Substring deduplication by relative Lempel-Ziv parsing.

The reference is the corpus itself. Its seeds, the runs of `window` words, are filed in reference blocks by their
hash; each block is indexed by sorting and keeps, for each seed, the occurrence in the document with the smallest
id. Every document is parsed against all blocks: where a seed has an earlier document, a factor begins there, and
it grows greedily as long as the next seed continues in the same source. A factor of `window` words or more is a
duplicate span. Where one factor ends, the seeds that cross the boundary are looked up like all others, so a span
that goes on in another source is found, and neighbouring factors merge.

A chunk of documents is combined before it is sent: of a seed's occurrences in the chunk only those with the
smallest id go to the block, the others are factors already. A passage that a third of all documents hold thus
reaches its block once a chunk. Words aren't sent, only seeds of 64 bits; two different runs of words among n
are taken for one with a chance of about n / 2**64 for each. A seed's place is its word's number in the chunk, which
ascends within a block's row, so that only steps are sent, byte by byte in planes that are mostly zero.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.llm.batches import slices, stored
from candlegrid.llm.words import blank_parted, window_hashes, words_of

WINDOW = 13
#: Bytes of documents whose words are cut at once, and seeds that are combined at once (or one slice's, if more).
SLICE_BYTES, CHUNK_SEEDS = 2_000_000, 1_200_000
#: Bytes of documents for each reference block.
BLOCK_BYTES = 8_000_000

_SEEDS = T.StructType(
    [
        T.StructField("block", T.IntegerType()),
        T.StructField("chunk", T.LongType()),
        T.StructField("seed", T.BinaryType()),  # uint64 each
        T.StructField("place", T.BinaryType()),  # ascending, packed: first word, by its number in the chunk
        T.StructField("ids", T.BinaryType()),  # int64 each: ids of the documents that occur, in order
        T.StructField("many", T.BinaryType()),  # packed: seeds of each of these
        T.StructField("shift", T.BinaryType()),  # packed: first word's number in the document less that in the chunk
        T.StructField("source", T.BinaryType()),  # int64 each: set where the factor is known
        T.StructField("source_place", T.BinaryType()),  # packed: first word, by its number in the source
    ]
)
_HITS = T.StructType([f for f in _SEEDS.fields if f.name in ("chunk", "place", "source", "source_place")])


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 to 2**32 - 1 as four planes of bytes, the lowest first."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(told: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(told, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def pack_ascending(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_ascending(told: bytes) -> np.ndarray:
    return np.cumsum(unpack(told))


def _first_of_each(seed: np.ndarray, ids: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each occurrence, which one is the seed's first: smallest id, then smallest place."""
    order = np.lexsort((place, ids, seed))
    told = seed[order]
    head = np.concatenate(([True], told[1:] != told[:-1])) if len(told) else np.zeros(0, bool)
    first = np.empty(len(seed), np.int64)
    first[order] = order[np.flatnonzero(head)[np.cumsum(head) - 1]] if len(told) else order
    return first


class _Chunk:
    """Seeds of documents until enough are held."""

    def __init__(self, blocks: int, window: int):
        self.blocks, self.window, self.held, self.words = blocks, window, 0, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids: list[np.ndarray] = []
        self.first: list[np.ndarray] = []

    @property
    def docs(self) -> int:
        return sum(map(len, self.ids))

    def add(self, texts: pa.Array, ids: np.ndarray) -> None:
        words = words_of(texts, blank_parted())
        seeds = window_hashes(words.hashes, self.window)
        # a run belongs to one text
        at = np.flatnonzero(words.doc[: len(seeds)] == words.doc[self.window - 1 :]) if len(seeds) else np.zeros(0, np.int64)
        self.parts.append((seeds[at], words.doc[at] + self.docs, at + self.words))
        self.ids.append(ids)
        self.first.append(words.first_word[:-1] + self.words)
        self.words += len(words.hashes)
        self.held += len(at)

    def rows(self, chunk: int):
        """The block rows of what is held, and one row of the factors inside the chunk."""
        seed, owner, at = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        all_ids, first_word = np.concatenate(self.ids), np.concatenate(self.first)
        ids, place = all_ids[owner], at - first_word[owner]
        first = _first_of_each(seed, ids, place)
        inner = np.flatnonzero(ids[first] < ids)
        source = first[inner]
        if len(inner):
            yield (-1 - chunk % self.blocks, chunk, b"", pack_ascending(at[inner]), b"", b"", b"", ids[source].tobytes(), pack(place[source]))
        sent = np.flatnonzero(ids[first] == ids)
        block = (seed[sent] % np.uint64(self.blocks)).astype(np.int64)
        order = np.argsort(block, kind="stable")
        sent, block = sent[order], block[order]
        bounds = np.searchsorted(block, np.arange(self.blocks + 1))
        for b in range(self.blocks):
            own = sent[bounds[b] : bounds[b + 1]]
            if len(own):
                docs, many = np.unique(owner[own], return_counts=True)
                yield (b, chunk, seed[own].tobytes(), pack_ascending(at[own]), all_ids[docs].tobytes(), pack(many), pack_ascending(first_word[docs]), b"", b"")


def _table(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(columns, schema.fields, strict=True)], names=schema.names)


def _parse_block(rows: list[dict]):
    """Factors that the seeds of one block give, by chunk."""
    seed = np.concatenate([np.frombuffer(r["seed"], np.uint64) for r in rows])
    at = [unpack_ascending(r["place"]) for r in rows]
    many = [unpack(r["many"]) for r in rows]
    ids = np.concatenate([np.repeat(np.frombuffer(r["ids"], np.int64), m) for r, m in zip(rows, many, strict=True)])
    place = np.concatenate([a - np.repeat(unpack_ascending(r["shift"]), m) for r, a, m in zip(rows, at, many, strict=True)])
    first = _first_of_each(seed, ids, place)
    hit = ids[first] < ids
    begin = 0
    for r, a in zip(rows, at, strict=True):
        own = np.flatnonzero(hit[begin : begin + len(a)])
        if len(own):
            source = first[begin + own]
            yield (r["chunk"], pack_ascending(a[own]), ids[source].tobytes(), pack(place[source]))
        begin += len(a)


def merge_factors(owner: np.ndarray, place: np.ndarray, source: np.ndarray, source_place: np.ndarray, window: int) -> np.ndarray:
    """Greedy factors from seeds with a source: rows of (owner, start, length, source, source start), in order of the text."""
    order = np.lexsort((place, owner))
    owner, place, source, source_place = owner[order], place[order], source[order], source_place[order]
    goes_on = (owner[1:] == owner[:-1]) & (place[1:] == place[:-1] + 1) & (source[1:] == source[:-1]) & (source_place[1:] == source_place[:-1] + 1)
    head = np.flatnonzero(np.concatenate(([True], ~goes_on))) if len(owner) else np.zeros(0, np.int64)
    seeds = np.diff(np.concatenate((head, [len(owner)])))
    return np.column_stack([owner[head], place[head], seeds + window - 1, source[head], source_place[head]]).astype(np.int64)


def factors(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Factors of at least `window` words that an earlier document holds: one row per document that has any.

    Columns: id, a and b (two hashes of the text), factors (array of start, length, source, source_start, in words).
    Ids are whole numbers; texts without an id take no part; of rows with one id none is earlier than the other.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).where("_id is not null and _text is not null")
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(8, math.ceil(size / block_bytes))
    keyed = rows.select("_id", F.xxhash64("_text").alias("a"), F.xxhash64("_text", F.lit(1)).alias("b"), "_text")
    # what a chunk's owners are called travels beside the seeds as one more row of the chunk
    names = T.StructType([*_SEEDS.fields, T.StructField("names", T.BinaryType())])

    def cut(batches):
        task = TaskContext.get().partitionId()
        number = 0
        chunk, called = _Chunk(blocks, window), []

        def flush():
            nonlocal chunk, called, number
            key = (task << 32) + number
            number += 1
            made = [(*row, None) for row in chunk.rows(key)]
            named = np.column_stack([np.concatenate(called), np.concatenate(chunk.first)])
            made.append((-1 - key % blocks, key, b"", b"", b"", b"", b"", b"", b"", named.astype(np.int64).tobytes()))
            chunk, called = _Chunk(blocks, window), []
            for at in range(0, len(made), 64):
                yield _table(made[at : at + 64], names)

        for whole in batches:
            for part in slices(whole, 3, SLICE_BYTES):
                ids = part.column(0).to_numpy()
                chunk.add(part.column(3), ids)
                called.append(np.column_stack([ids, part.column(1).to_numpy(), part.column(2).to_numpy()]))
                if chunk.held >= CHUNK_SEEDS:
                    yield from flush()
        if chunk.docs:
            yield from flush()

    hits = T.StructType([*_HITS.fields, T.StructField("names", T.BinaryType())])

    def parse(batches):
        held: list[dict] = []

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["block"] < 0:
                    yield _table([tuple(row[n] for n in hits.names)], hits)
                    continue
                if held and held[0]["block"] != row["block"]:
                    yield from _batches([(*x, None) for x in _parse_block(held)], hits)
                    held = []
                held.append(row)
        if held:
            yield from _batches([(*x, None) for x in _parse_block(held)], hits)

    seeds = keyed.mapInArrow(cut, names)
    parsed = seeds.repartition("block").sortWithinPartitions("block").mapInArrow(parse, hits)

    span = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "source", "source_start")])
    out = T.StructType([T.StructField("_id", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("factors", T.ArrayType(span))])

    def join(batches):
        held: list[dict] = []

        def done():
            keys = np.concatenate([np.frombuffer(r["names"], np.int64).reshape(-1, 4) for r in held if r["names"]])
            own = [r for r in held if not r["names"]]
            if not own:
                return
            at = np.concatenate([unpack_ascending(r["place"]) for r in own])
            source = np.concatenate([np.frombuffer(r["source"], np.int64) for r in own])
            source_place = np.concatenate([unpack(r["source_place"]) for r in own])
            owner = np.searchsorted(keys[:, 3], at, "right") - 1
            found = merge_factors(owner, at - keys[owner, 3], source, source_place, window)
            bounds = np.flatnonzero(np.concatenate(([True], found[1:, 0] != found[:-1, 0])))
            for a, b in zip(bounds.tolist(), [*bounds[1:].tolist(), len(found)], strict=True):
                key = keys[found[a, 0]]
                spans = [dict(zip(span.names, x, strict=True)) for x in found[a:b, 1:].tolist()]
                yield int(key[0]), int(key[1]), int(key[2]), spans

        def made():
            rows = list(done())
            kind = pa.list_(pa.struct([(n, pa.int64()) for n in span.names]))
            for at in range(0, len(rows), 1000):
                part = list(zip(*rows[at : at + 1000], strict=True))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in part[:3]], pa.array(part[3], kind)], names=out.names)

        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if held and held[0]["chunk"] != row["chunk"]:
                    yield from made()
                    held = []
                held.append(row)
        if held:
            yield from made()

    joined = parsed.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(join, out)
    return joined.withColumnRenamed("_id", id_col)


def _batches(rows: list[tuple], schema: T.StructType):
    for at in range(0, len(rows), 64):
        yield _table(rows[at : at + 64], schema)


def deduplicated(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: id, n_words, n_removed, factors, kept (words joined by one blank).

    A word goes if a run of `window` words that covers it also starts in a document with a smaller id. Null and
    empty texts have no words and keep ""; rows without an id keep all; equal rows are treated alike; other columns
    are ignored.
    """
    found = stored(factors(docs, window, id_col, text_col, block_bytes).withColumnRenamed(id_col, "_f"), "factors")
    # a document's factors may come in parts if a task ran twice
    found = found.groupBy("_f", "a", "b").agg(F.array_distinct(F.flatten(F.collect_list("factors"))).alias("factors"))
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("a2"), F.xxhash64(text, F.lit(1)).alias("b2"), text.alias("_text"))
    both = rows.join(found, (F.col("_id").cast("long") == F.col("_f")) & (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2")), "left").select("_id", "factors", "_text")
    schema = T.StructType([both.schema["_id"], both.schema["factors"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])

    def cut(batches):
        for whole in batches:
            for part in slices(whole, 2):
                counts, removed, kept = [], [], []
                starts = part.column(1)
                for i, text in enumerate(part.column(2).to_pylist()):
                    words = text.encode().split() if text else []
                    counts.append(len(words))
                    spans = starts[i].as_py()
                    if spans:
                        gone = np.zeros(len(words) + 1, np.int64)
                        for s in spans:
                            gone[s["start"]] += 1
                            gone[s["start"] + s["length"]] -= 1
                        stays = np.cumsum(gone)[:-1] == 0
                        words = [words[k] for k in np.flatnonzero(stays).tolist()]
                    removed.append(counts[-1] - len(words))
                    kept.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=schema.names)

    return both.mapInArrow(cut, schema).withColumnRenamed("_id", id_col)


def digests(done: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of deduplicated()'s rows: n_words, n_removed, SHA-256 of what is kept."""
    return done.select(id_col, "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))
