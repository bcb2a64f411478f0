"""Benchmark decontamination with an FM-index per training shard.

A shard is a slice of documents, of bounded bytes. Its words become numbers: those of the benchmark's vocabulary
keep theirs, every other word is a separator. Stretches between separators that are too short for any phrase can
hold none and are left out, which changes no result. Over the rest stands an FM-index: Burrows-Wheeler transform,
wavelet matrix for ranks, and sampled suffix positions. All phrases are searched backwards at once, occurrences
are located through the samples, checked against the words themselves, and merged to spans.

The benchmark is the stated query set. It is taken in blocks of bounded bytes; each block is searched in all
documents, and only one block at a time is sent to the tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.llm.batches import slices, stored
from candlegrid.llm.words import Words, letters_only, words_of

WINDOW = 10
#: Bytes of benchmark text in a block.
BLOCK_BYTES = 4_000_000
#: Bytes of documents in a shard; one longer text makes a shard of its own.
SHARD_BYTES = 2_000_000
#: Every so many places of an index keep their position.
SAMPLE = 8


class WaveletMatrix:
    """Ranks of any symbol in a sequence, level by level from the highest bit."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        for level in range(bits - 1, -1, -1):
            bit = (values >> level & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(bit, dtype=np.int32))))
            self.zeros.append(len(values) - int(self.ones[-1][-1]))
            values = np.concatenate((values[~bit], values[bit]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each end."""
        begins = np.zeros_like(ends)
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (symbols >> (self.bits - 1 - level) & 1).astype(bool)
            ends = np.where(bit, zeros + ones[ends], ends - ones[ends])
            begins = np.where(bit, zeros + ones[begins], begins - ones[begins])
        return ends - begins


def suffix_array(values: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling the compared prefix."""
    n = len(values)
    order = np.argsort(values, kind="stable")
    rank = np.empty(n, np.int64)
    rank[order] = np.concatenate(([0], np.cumsum(values[order][1:] != values[order][:-1])))
    step = 1
    while n and rank[order[-1]] < n - 1:
        beyond = np.zeros(n, np.int64)
        beyond[: n - step] = rank[step:] + 1
        key = rank * (n + 1) + beyond
        order = np.argsort(key, kind="stable")
        told = key[order]
        rank[order] = np.concatenate(([0], np.cumsum(told[1:] != told[:-1])))
        step *= 2
    return order


class FmIndex:
    """Over stretches of numbers from 1 on, each stretch after a zero that parts it from the one before."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        parted = values == 0
        # separators differ from one another, so no comparison runs on into the next stretch
        apart = values + int(parted.sum())
        apart[parted] = np.arange(int(parted.sum()))
        self.order = suffix_array(apart)
        last = values[self.order - 1]
        self.last = last
        self.largest = int(values.max(initial=0))
        self.bits = max(1, self.largest.bit_length())
        self.ranks = WaveletMatrix(last, self.bits)
        self.less = np.concatenate(([0], np.cumsum(np.bincount(values, minlength=1 << self.bits))))
        # a stretch's first place keeps its position, so no walk has to cross a separator
        keeps = (np.arange(n) % SAMPLE == 0) | np.concatenate(([True], parted[:-1])) | parted
        self.sampled = keeps[self.order]
        self.position = np.where(self.sampled, self.order, -1)
        del self.order

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For phrases of one length (a row each): the ranges of suffixes that begin with them."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), len(self.last), np.int64)
        # a number beyond the shard's largest occurs nowhere and has no place in its tables
        alive = np.flatnonzero((phrases <= self.largest).all(axis=1))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbols = phrases[alive, column]
            low[alive] = self.less[symbols] + self.ranks.rank(symbols, low[alive])
            high[alive] = self.less[symbols] + self.ranks.rank(symbols, high[alive])
            alive = alive[low[alive] < high[alive]]
            if not len(alive):
                break
        high = np.maximum(low, high)
        dead = np.ones(len(phrases), bool)
        dead[alive] = False
        high[dead] = low[dead]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes, by walking back to a sampled one."""
        rows, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.empty(len(rows), np.int64)
        todo = np.arange(len(rows))
        while len(todo):
            there = self.sampled[rows[todo]]
            found = todo[there]
            out[found] = self.position[rows[found]] + steps[found]
            todo = todo[~there]
            symbols = self.last[rows[todo]]
            rows[todo] = self.less[symbols] + self.ranks.rank(symbols, rows[todo])
            steps[todo] += 1
        return out


@dataclass
class Block:
    """A part of the benchmark, ready for search: vocabulary, distinct phrases by length, and the items of each phrase.

    Phrases are numbered through, length by length; those of phrase k are owners[bounds[k] : bounds[k + 1]].
    """

    names: list[str]
    hashes: np.ndarray  # of the vocabulary, sorted
    words: list[bytes]  # in the same order
    phrases: dict[int, np.ndarray]  # length: numbers, a row each
    owners: np.ndarray
    bounds: np.ndarray

    @property
    def shortest(self) -> int:
        return min(self.phrases, default=0)


def prepare(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> Block:
    """Items as (id as text, text); those without words or id have no phrases."""
    items = [i for i in items if i[0] is not None]
    told = words_of(pa.array([t for _, t in items], pa.string()), letters_only())
    vocabulary: dict[int, bytes] = {}
    for i, h in enumerate(told.hashes.tolist()):
        if h not in vocabulary:
            vocabulary[h] = told.word(i)
    hashes = np.array(sorted(vocabulary), np.uint64)
    number = np.searchsorted(hashes, told.hashes) + 1
    names = sorted({i for i, _ in items})
    of = {name: k for k, name in enumerate(names)}
    rows: dict[int, dict[tuple[int, ...], set[int]]] = {}
    for k, (name, _) in enumerate(items):
        own = number[told.first_word[k] : told.first_word[k + 1]].tolist()
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if size else 0):
            rows.setdefault(size, {}).setdefault(tuple(own[i : i + size]), set()).add(of[name])
    held = [sorted(owners) for found in rows.values() for owners in found.values()]
    return Block(
        names,
        hashes,
        [vocabulary[h] for h in hashes.tolist()],
        {size: np.array(list(found), np.int64) for size, found in rows.items()},
        np.array([i for own in held for i in own], np.int64),
        np.cumsum([0, *map(len, held)]),
    )


def find_in_shard(words: Words, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences in a shard as (first word, end word, phrase)."""
    none = np.zeros(0, np.int64)
    if not len(words.hashes) or not len(block.hashes):
        return none, none, none
    at = np.minimum(np.searchsorted(block.hashes, words.hashes), len(block.hashes) - 1)
    number = np.where(block.hashes[at] == words.hashes, at + 1, 0)
    # stretches of vocabulary words within one text, long enough for the shortest phrase
    inside = number > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | (words.doc[1:] != words.doc[:-1])
    first = np.flatnonzero(begins)
    if not len(first):
        return none, none, none
    length = np.add.reduceat(inside, first, dtype=np.int64)
    enough = length >= block.shortest
    first, length = first[enough], length[enough]
    if not len(first):
        return none, none, none
    # the stretches one after the other, a zero before each
    total = int((length + 1).sum())
    heads = np.cumsum(length + 1) - (length + 1)
    source = np.ones(total, np.int64)
    source[heads] = first - np.concatenate(([0], (first + length)[:-1]))
    source = np.cumsum(source) - 1
    values = number[np.clip(source, 0, len(number) - 1)]
    values[heads] = 0
    index = FmIndex(values)
    starts, ends, which, before = [none], [none], [none], 0
    for size, phrases in block.phrases.items():
        low, high = index.search(phrases)
        hits = np.flatnonzero(high > low)
        many = (high - low)[hits]
        rows = np.repeat(low[hits], many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
        start = source[index.locate(rows)]
        starts.append(start)
        ends.append(start + size)
        which.append(np.repeat(hits + before, many))
        before += len(phrases)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(which)


def _same_words(words: Words, places: np.ndarray, block: Block) -> np.ndarray:
    """Of word places whose hashes are in the vocabulary: whether the words themselves are."""
    at = np.searchsorted(block.hashes, words.hashes[places])
    return np.array([words.word(p) == block.words[k] for p, k in zip(places.tolist(), at.tolist(), strict=True)], bool)


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Spans that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    order = np.lexsort((ends, starts))
    for a, b in zip(starts[order].tolist(), ends[order].tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _search_block(docs: DataFrame, block: Block, first: bool, cut: bool = False) -> DataFrame:
    """Adds the block's findings to `_spans` and `_items`; `cut` takes the words of all spans out of the text."""
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    own = [f for f in docs.schema.fields if f.name not in ("_n_words", "_spans", "_items")]
    schema = T.StructType([*own, T.StructField("_n_words", T.LongType()), T.StructField("_spans", span), T.StructField("_items", T.ArrayType(T.StringType()))])
    text = [f.name for f in own].index("_text")

    def run(batches):
        for whole in batches:
            for part in slices(whole, text, SHARD_BYTES):
                words = words_of(part.column(text), letters_only())
                start, end, phrase = find_in_shard(words, block)
                if len(start):
                    places = np.unique(np.concatenate([np.arange(a, b) for a, b in set(zip(start.tolist(), end.tolist(), strict=True))]))
                    wrong = np.zeros(len(words.hashes) + 1, np.int64)
                    wrong[places[~_same_words(words, places, block)] + 1] = 1
                    wrong = np.cumsum(wrong)
                    right = wrong[end] == wrong[start]
                    start, end, phrase = start[right], end[right], phrase[right]
                n = part.num_rows
                spans: list[list] = [[] for _ in range(n)]
                names: list[list] = [[] for _ in range(n)]
                order = np.argsort(words.doc[start], kind="stable") if len(start) else start
                of, heads = np.unique(words.doc[start[order]], return_index=True) if len(start) else (start, start)
                for d, hits in zip(of.tolist(), np.split(order, heads[1:]), strict=True) if len(of) else ():
                    base = int(words.first_word[d])
                    spans[d] = [(a - base, b - base) for a, b in merge_spans(start[hits], end[hits])]
                    owners = [block.owners[block.bounds[k] : block.bounds[k + 1]] for k in np.unique(phrase[hits]).tolist()]
                    names[d] = [block.names[i] for i in np.unique(np.concatenate(owners)).tolist()]
                if not first:
                    for d in range(n):
                        before = [(s["start"], s["end"]) for s in part.column("_spans")[d].as_py()]
                        both = np.array([*before, *spans[d]], np.int64).reshape(-1, 2)
                        spans[d] = merge_spans(both[:, 0], both[:, 1])
                        names[d] = sorted({*names[d], *part.column("_items")[d].as_py()})
                texts = part.column(text)
                if cut:
                    texts = pa.array(cut_words(words, texts, spans), pa.string())
                columns = [
                    *[texts if f.name == "_text" else part.column(f.name) for f in own],
                    pa.array(np.diff(words.first_word)),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(names, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), with_text: bool = False, cut: bool = False, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of docs: id, what `keep` names, n_words, spans (array of start and end word), items (ids as text, sorted).

    An item's phrases are its runs of `window` words, or all its words if it has fewer; items without words or
    without id have none. Null texts have no words. Repeated rows and null ids each keep their row; other columns
    are ignored; without benchmark items nothing is found. with_text keeps the text; cut
    keeps it without the words of the spans, each from its first word's begin to its last word's end.
    """
    told = benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string").alias("text")).distinct()
    size = told.agg(F.sum(F.octet_length("text") + 32)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    found = docs.select(F.col(id_col).alias("_id"), *[F.col(k).alias(f"_keep_{k}") for k in keep], F.col(text_col).cast("string").alias("_text"))
    for b in range(blocks):
        # a block is a hash part of bounded expected size
        rows = told.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == b).collect() if blocks > 1 else told.collect()
        if b:
            found = stored(found, "contamination")
        found = _search_block(found, prepare([(r["item"], r["text"]) for r in rows], window), b == 0, cut and b == blocks - 1)
    names = [F.col("_id").alias(id_col), *[F.col(f"_keep_{k}").alias(k) for k in keep]]
    if with_text or cut:
        names.append(F.col("_text").alias(text_col))
    return found.select(*names, F.col("_n_words").alias("n_words"), F.col("_spans").alias("spans"), F.col("_items").alias("items"))


def contamination_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of contamination()'s rows: n_words, n_hit, n_items, SHA-256 of the items, contaminated."""
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        id_col,
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(F.array_sort("items"), ","), "UTF-8"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def cut_words(words: Words, texts: pa.Array, spans: list[list[tuple[int, int]]]) -> list[str | None]:
    """The texts that the words are of, without the words of each text's spans."""
    out: list[str | None] = texts.to_pylist()
    for d, own in enumerate(spans):
        if not own:
            continue
        base, at, parts = int(words.first_word[d]), int(words.offsets[d]), []
        for a, b in own:
            parts.append(words.data[at : words.starts[base + a]].tobytes())
            at = int(words.starts[base + b - 1] + words.lengths[base + b - 1])
        parts.append(words.data[at : words.offsets[d + 1]].tobytes())
        out[d] = b"".join(parts).decode()
    return out


def cut_spans(texts: pa.Array, spans: list[list[tuple[int, int]]]) -> list[str | None]:
    """The texts without the words of the spans, each span from its first word's begin to its last word's end."""
    return cut_words(words_of(texts, letters_only()), texts, spans)
