"""Byte-level BPE encoding and decoding in two tiers.

A text is cut into pre-tokens. The first tier is a minimal perfect hash over the vocabulary: one probe tells
whether a whole pre-token is a token, and which. The second tier takes what misses: its bytes form a linked list,
and a heap hands out the adjacent pair whose joined bytes have the lowest rank, until no pair is a token. The same
hash answers for the pairs. A task remembers the pre-tokens that it has met.

The library decides what a letter, a number and a blank is. Where its tables and those of the regex module may
differ, it is asked, character by character, and a character of the same kind stands in for the match.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import regex
import tiktoken
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.llm.batches import Memo, map_texts
from candlegrid.llm.vocabulary import AGREED

#: Pre-tokens a task remembers, and joined pairs, each twice over.
REMEMBERED, PAIRS = 200_000, 200_000
#: Characters from which on a text's pre-tokens are taken one by one instead of as a list.
LONG = 1_000_000
#: Keys for each bucket of the perfect hash, and displacements tried at once.
BUCKET, TRIES = 4, 128

#: Bytes up to which a word's links are copied from a list.
SHORT = 64
_LINKS = list(range(-1, SHORT + 1))

_hash = xxhash.xxh3_64_intdigest


class PerfectHash:
    """A minimal perfect hash: n keys, n slots, one probe.

    A key's bucket has a displacement that sends all the bucket's keys to slots of their own; buckets of one key
    name their slot (below zero). A slot's key is compared, so that other strings are told apart.
    """

    def __init__(self, keys: list[bytes], values: list[int]):
        n = len(keys)
        self.n, self.buckets, self.seed = n, max(1, n // BUCKET), 0
        slots = self._place(keys)
        while slots is None:
            self.seed += 1
            slots = self._place(keys)
        self.keys: list[bytes] = [b""] * n
        self.values = [-1] * n
        for i, slot in enumerate(slots.tolist()):
            self.keys[slot] = keys[i]
            self.values[slot] = values[i]

    def _place(self, keys: list[bytes]) -> np.ndarray | None:
        """The keys' slots, or None if a bucket has no displacement under this seed."""
        n = self.n
        hashes = np.array([_hash(k, self.seed) for k in keys], np.uint64)
        low, high = (hashes & np.uint64(0xFFFFFFFF)).astype(np.int64), (hashes >> np.uint64(32)).astype(np.int64)
        order = np.argsort(low % self.buckets, kind="stable")
        bounds = np.searchsorted((low % self.buckets)[order], np.arange(self.buckets + 1))
        self.shift = [0] * self.buckets
        taken = np.zeros(n, bool)
        slot_of = np.zeros(n, np.int64)
        sizes = np.diff(bounds)
        for b in np.argsort(-sizes, kind="stable").tolist():
            own = order[bounds[b] : bounds[b + 1]]
            if len(own) < 2:
                break
            for base in range(0, n, TRIES):
                slots = (low[own] // self.buckets + np.arange(base, base + TRIES)[:, None] * (high[own] | 1)) % n
                told = np.sort(slots, axis=1)
                fits = np.flatnonzero(~taken[slots].any(axis=1) & (told[:, 1:] != told[:, :-1]).all(axis=1))
                if len(fits):
                    break
            else:
                return None
            self.shift[b] = base + int(fits[0])
            slot_of[own] = slots[fits[0]]
            taken[slots[fits[0]]] = True
        free = iter(np.flatnonzero(~taken).tolist())
        for b in np.flatnonzero(sizes == 1).tolist():
            slot = next(free)
            self.shift[b] = -1 - slot
            slot_of[order[bounds[b]]] = slot
        return slot_of

    def get(self, key: bytes) -> int:
        """The key's value, or -1."""
        h = _hash(key, self.seed)
        low = h & 0xFFFFFFFF
        shift = self.shift[low % self.buckets]
        slot = (low // self.buckets + shift * (h >> 32 | 1)) % self.n if shift >= 0 else -1 - shift
        return self.values[slot] if self.keys[slot] == key else -1


class Vocabulary:
    """A rank file: token bytes by id, the perfect hash over them, and the ids of bytes and of pairs of bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            told = [line.split() for line in file if line.strip()]
        tokens = [base64.b64decode(a) for a, _ in told]
        ids = [int(b) for _, b in told]
        self.table = PerfectHash(tokens, ids)
        self.bytes_of = dict(zip(ids, tokens, strict=True))
        get = self.table.get
        self.single = [get(bytes([b])) for b in range(256)]
        self.double = [get(bytes([a, b])) for a in range(256) for b in range(256)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The file's vocabulary, kept by a worker."""
    return Vocabulary(path)


def merge_bytes(word: bytes, vocab: Vocabulary, ranks: Memo) -> list[int]:
    """Tokens of a stretch of bytes: the adjacent pair of lowest rank, the leftmost of equals, joins until none is a token.

    ranks remembers what the vocabulary's hash says of joined pairs.
    """
    n = len(word)
    tokens = [vocab.single[b] for b in word]
    double = vocab.double
    # rank of what begins at each link together with the next one; -1: none, or the link is gone
    at = [double[a << 8 | b] for a, b in zip(word, word[1:], strict=False)]
    heap = [r << 32 | i for i, r in enumerate(at) if r >= 0]
    if not heap:
        return tokens
    heapq.heapify(heap)
    at.append(-1)
    after, before = (_LINKS[2 : n + 2], _LINKS[:n]) if n < SHORT else (list(range(1, n + 1)), list(range(-1, n - 1)))
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        top = pop(heap)
        r, i = top >> 32, top & 0xFFFFFFFF
        if at[i] != r:
            continue
        j = after[i]
        k = after[i] = after[j]
        tokens[i], tokens[j], at[j] = r, -1, -1
        if k < n:
            before[k] = i
            at[i] = r = ranks[word[i : after[k]]]
            if r >= 0:
                push(heap, r << 32 | i)
        else:
            at[i] = -1
        h = before[i]
        if h >= 0:
            at[h] = r = ranks[word[h:k]]
            if r >= 0:
                push(heap, r << 32 | h)
    return [t for t in tokens if t >= 0]


@lru_cache(maxsize=2)
def _probe(pattern: str) -> tiktoken.Encoding:
    """An encoding whose tokens above 255 show whether a character goes on with a letter, a number or a sign."""
    ranks = {bytes([b]): b for b in range(256)}
    for sign in b"a1!":
        for lead in range(0xC2, 0xF5):
            ranks[bytes([sign, lead])] = len(ranks)
    return tiktoken.Encoding("kinds", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def kind_of(character: str, pattern: str) -> str:
    """One that stands for a character beyond ASCII: a letter, a number, another sign or a blank, as the library has it."""
    ids = _probe(pattern).encode_ordinary(f"a{character} 1{character} !{character}")
    shown = [(i - 256) // (0xF5 - 0xC2) for i in ids if i >= 256]
    return "x0!"[shown[0]] if shown else "\t"


class ByteCodec:
    """Encodes and decodes texts; remembers pre-tokens."""

    def __init__(self, path: str, pattern: str):
        self.vocab, self.pattern = vocabulary(path), pattern
        matcher = regex.compile(pattern)
        self.findall, self.finditer = matcher.findall, matcher.finditer
        self.kinds = Memo(lambda c: kind_of(c, pattern), REMEMBERED)
        self.known = Memo(self._piece, REMEMBERED)
        self.ranks = Memo(self.vocab.table.get, PAIRS)

    def _piece(self, piece: str) -> bytes:
        told = piece.encode()
        token = self.vocab.table.get(told)
        return array("i", [token] if token >= 0 else merge_bytes(told, self.vocab, self.ranks)).tobytes()

    def _pieces(self, text: str):
        stands = {ord(c): self.kinds[c] for c in set(text) if c > AGREED}
        if stands:
            return (text[m.start() : m.end()] for m in self.finditer(text.translate(stands)))
        return self.findall(text) if len(text) < LONG else (m.group() for m in self.finditer(text))

    def encode(self, text: str | None) -> np.ndarray:
        """Token ids."""
        return np.frombuffer(b"".join(map(self.known.__getitem__, self._pieces(text))) if text else b"", np.intc)

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids.tolist()))


def encode_bytes(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ids (array of int, in order) and decoded (binary, the bytes that the ids stand for).

    ranks: path of a file of base64 tokens and ranks with all 256 bytes, readable on every executor; pattern: the
    cut into pre-tokens. Strings of special tokens are ordinary text. Null and empty texts have no ids and decode to
    no bytes. Very long texts are cut match by match, so that a task holds one text's ids and not its pre-tokens.
    Repeated rows and null ids each keep their row; other columns are ignored; an empty table gives an empty result.
    """

    def make():
        own = ByteCodec(ranks, pattern)

        def apply(texts):
            ids = [own.encode(t) for t in texts]
            return ids, [own.decode(i) for i in ids]

        return apply

    columns = [T.StructField("ids", T.ArrayType(T.IntegerType(), False)), T.StructField("decoded", T.BinaryType())]
    return map_texts(docs, make, columns, id_col, text_col)


def byte_digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of encode_bytes()'s rows: n_tokens, the SHA-256 of the decimal ids joined by commas and of the decoded bytes."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
