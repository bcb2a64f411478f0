"""Byte-pair encoding by tree concatenation, and decoding.

A long unsplit stretch is halved, the halves are encoded, and a window of tokens around the join is encoded
again, growing until its outermost tokens are the ones that both sides already have. An encoding whose adjacent
token pairs are each the encoding of their own text is the encoding of the whole, so agreement at the window's
two edges settles the join. Long texts are cut into pieces that Spark encodes as rows of their own, and are
joined afterwards in the same way: between two pieces the text from the last blank of one to the first blank of
the other is encoded anew.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.llm.batches import Memo, map_texts
from candlegrid.llm.vocabulary import AGREED, Merges, load, merge_by_heap, special_pattern

#: Chunks a task remembers, and words, each twice over.
REMEMBERED = 150_000
#: Symbols up to which a stretch is encoded directly.
LEAF = 24
#: Symbols up to which merging searches the pairs in turn instead of on a heap.
DIRECT = 64
#: Tokens on each side of a join in the first window.
WINDOW = 2
#: Characters of a piece when a long text is spread over tasks.
PIECE = 32_768
# fixed values: white space between chunks, as the tokenizer's patterns see it
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def merge_all(symbols: list[int], merges: Merges) -> list[int]:
    """The encoding of one stretch: the lowest-ranked pair, the leftmost of equals, merges until none is left."""
    symbols, rank = symbols[:], merges.rank
    if len(symbols) > DIRECT:
        merge_by_heap(symbols, merges)
        return [s for s in symbols if s >= 0]
    none = len(merges.result)
    ranks = [rank.get(a << 32 | b, none) for a, b in zip(symbols, symbols[1:], strict=False)]
    while ranks:
        low = min(ranks)
        if low == none:
            break
        i = ranks.index(low)
        symbols[i : i + 2] = [made] = [merges.result[low]]
        del ranks[i]
        if i < len(ranks):
            ranks[i] = rank.get(made << 32 | symbols[i + 1], none)
        if i:
            ranks[i - 1] = rank.get(symbols[i - 1] << 32 | made, none)
    return symbols


class Codec:
    """Encodes and decodes texts; remembers chunks between blanks."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        self.merges = load(path)
        self.leaf, self.window = leaf, window
        self.special = special_pattern(self.merges.specials)
        # symbols that each token is made of, for windows
        self.parts: dict[int, list[int]] = {}
        for pair, made in zip(self.merges.rank, self.merges.result, strict=True):
            if made not in self.parts:
                self.parts[made] = [*self.parts.get(pair >> 32, [pair >> 32]), *self.parts.get(pair & 0xFFFFFFFF, [pair & 0xFFFFFFFF])]
        self.chunks = Memo(self.chunk, REMEMBERED)
        self.known = Memo(self.word, REMEMBERED)

    # ---- one unsplit stretch ----

    def stretch(self, symbols: list[int]) -> list[int]:
        if len(symbols) <= self.leaf:
            return merge_all(symbols, self.merges)
        middle = len(symbols) // 2
        return self.join(self.stretch(symbols[:middle]), self.stretch(symbols[middle:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two encoded neighbours, by a window that grows until both sides agree with it."""
        size = self.window
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            symbols = [s for token in [*left[a:], *right[:b]] for s in self.parts.get(token, [token])]
            anew = merge_all(symbols, self.merges)
            left_agrees = a == 0 or anew[0] == left[a]
            right_agrees = b == len(right) or anew[-1] == right[b - 1]
            if left_agrees and right_agrees:
                return [*left[:a], *anew, *right[b:]]
            size *= 4

    # ---- chunks and texts ----

    def word(self, word: str) -> bytes:
        """Token ids, little-endian 32 bits each, of one word."""
        told = word.encode()
        symbols = [*map(self.merges.first.__getitem__, told)]
        symbols[-1] = self.merges.last[told[-1]]
        return np.array(self.stretch(symbols), "<u4").tobytes()

    def chunk(self, chunk: str) -> bytes:
        """Token ids of a stretch without blanks or of any text."""
        known = self.known
        if self.special is None or not any(mark in chunk for mark in self.merges.specials):
            return b"".join(map(known.__getitem__, self._words(chunk)))
        ids = []
        for i, part in enumerate(self.special.split(chunk)):
            if i % 2:
                ids.append(np.array([self.merges.specials[part]], "<u4").tobytes())
            elif part:
                ids += map(known.__getitem__, self._words(part))
        return b"".join(ids)

    def _words(self, part: str) -> list[str]:
        if part.isascii():
            # letters alone are one word, and so are those before a last sign
            if part.isalpha():
                return [part.lower()]
            if part[:-1].isalpha() and not part[-1].isalnum() and not part[-1].isspace():
                return [part[:-1].lower(), part[-1]]
            return self.merges.pattern.findall(part.lower())
        if max(part) <= AGREED:
            # letter by letter, as the library does: no context for a sigma at a word's end, which lies beyond AGREED
            return self.merges.pattern.findall(unicodedata.normalize("NFC", part).lower())
        told = self.merges.library.normalizer.normalize_str(part)
        return [told[a:b] for _, (a, b) in self.merges.library.pre_tokenizer.pre_tokenize_str(told)]

    def text(self, text: str | None) -> bytes:
        return b"".join(map(self.chunks.__getitem__, split_chunks(text))) if text else b""

    def decode(self, ids: bytes) -> str:
        """The text of token ids: a file without a decoder shows its tokens with blanks between."""
        return " ".join(map(self.merges.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    # ---- pieces of a long text ----

    def piece(self, piece: str) -> tuple[str, bytes, str | None]:
        """What stands before the first blank, the ids up to the last blank, what follows it; the last is None without a blank."""
        chunks = split_blanks(piece)
        if len(chunks) == 1:
            return piece, b"", None
        head, *middle, tail = chunks
        return head, b"".join([self.chunks[c] for c in middle if c]), tail

    def join_pieces(self, pieces: list[tuple[str, bytes, str | None]]) -> bytes:
        """Ids of the whole text: at each join the stretch between the nearest blanks is encoded anew."""
        done, held = [], []
        for head, middle, tail in pieces:
            held.append(head)
            if tail is not None:
                done += [self.chunk("".join(held)), middle]
                held = [tail]
        done.append(self.chunk("".join(held)))
        return b"".join(done)


def split_chunks(text: str) -> list[str]:
    """Stretches between white space; the four separators that only Python counts as blanks stay in."""
    if not _SEPARATORS.isdisjoint(text):
        return [c for c in split_blanks(text) if c]
    return text.split()


_SEPARATORS = frozenset("\x1c\x1d\x1e\x1f")
_TO_BLANK = {ord(c): " " for c in BLANKS}


def split_blanks(text: str) -> list[str]:
    """Stretches between single blanks, empty ones too."""
    return text.translate(_TO_BLANK).split(" ")


def codec(path: str, leaf: int = LEAF, window: int = WINDOW) -> Codec:
    return Codec(path, leaf, window)


def encode(docs: DataFrame, tokenizer: str, piece: int = PIECE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, ids (binary, little-endian unsigned 32-bit), decoded (string).

    tokenizer: path of a word-end BPE file, readable on every executor. Null and empty texts have no ids and
    decode to "". Texts over `piece` characters are encoded in pieces by many tasks, whatever their length;
    repeated rows and null ids each keep their row; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    columns = [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]

    def whole():
        own = codec(tokenizer)

        def apply(texts):
            ids = [own.text(t) for t in texts]
            return ids, [own.decode(i) for i in ids]

        return apply

    length = F.length("_text")
    short = map_texts(rows.where(F.coalesce(length <= piece, F.lit(True))), whole, columns, "_id", "_text")

    # a long text's pieces, once for all its copies, are dealt out by text and place
    long = rows.where(length > piece)
    text_key = F.struct(F.xxhash64("_text").alias("a"), F.xxhash64("_text", F.lit(1)).alias("b"))
    places = F.sequence(F.lit(0), ((length - 1) / piece).cast("int"))
    cut = long.select(text_key.alias("key"), "_text", F.explode(places).alias("place")).select(
        "key", "place", F.substring("_text", F.col("place") * piece + 1, F.lit(piece)).alias("piece")
    )
    cut = cut.groupBy("key", "place", "piece").agg(F.lit(1).alias("one"))

    def pieces():
        own = codec(tokenizer)

        def apply(texts):
            return list(zip(*[own.piece(t) for t in texts], strict=True)) or [[], [], []]

        return apply

    parts = [T.StructField("head", T.StringType()), T.StructField("middle", T.BinaryType()), T.StructField("tail", T.StringType())]
    encoded = map_texts(cut.drop("one"), pieces, parts, "key", "piece", keep=["place"])
    joined = encoded.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "head", "middle", "tail"))).alias("parts"))
    schema = T.StructType([T.StructField("key", joined.schema["key"].dataType), *columns])

    def join(batches):
        import pyarrow as pa

        own = codec(tokenizer)
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                told = [(p["head"], p["middle"], p["tail"]) for p in one.column(1)[0].as_py()]
                ids = own.join_pieces(told)
                yield pa.RecordBatch.from_arrays([one.column(0), pa.array([ids], pa.binary()), pa.array([own.decode(ids)])], names=["key", "ids", "decoded"])

    whole_long = joined.mapInArrow(join, schema)
    long_rows = long.select("_id", text_key.alias("key")).join(whole_long, "key").select("_id", "ids", "decoded")
    return short.union(long_rows).withColumnRenamed("_id", id_col)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of encode()'s rows: n_tokens and the SHA-256 of ids and of the decoded text."""
    return encoded.select(
        id_col,
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
