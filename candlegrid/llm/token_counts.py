"""Token counts without tokens: byte pairs merge on a heap over a linked list, and the count is symbols minus merges."""

from __future__ import annotations


import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from candlegrid.llm.batches import Memo, map_texts
from candlegrid.llm.vocabulary import AGREED, Merges, load, merge_by_heap, special_pattern

#: Words whose counts a task remembers, twice over.
REMEMBERED = 300_000


def merged_length(symbols: list[int], merges: Merges) -> int:
    """Symbols of a word minus its merges."""
    return len(symbols) - merge_by_heap(symbols[:], merges)


class Counter:
    """Counts tokens of texts; remembers the counts of words."""

    def __init__(self, path: str):
        self.merges = load(path)
        self.words = Memo(self._word, REMEMBERED)
        self.chunks = Memo(self._chunk, REMEMBERED)
        self.findall = self.merges.pattern.findall
        self.special = special_pattern(self.merges.specials)

    def _word(self, word: str) -> int:
        first = self.merges.first
        return merged_length([first[b] for b in word.encode()], self.merges)

    def _chunk(self, chunk: str) -> int:
        words = self.words
        if max(chunk) <= AGREED:
            return sum(map(words.__getitem__, self.findall(chunk)))
        spans = self.merges.library.pre_tokenizer.pre_tokenize_str(chunk)
        return sum(words[chunk[a:b]] for _, (a, b) in spans)

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        if not text:
            return 0
        # a single blank between visible characters always begins a word, so what lies between blanks stands alone
        total, chunks = 0, self.chunks
        if _ODD_BLANKS.search(text):
            return self._chunk(text)
        lines = text.split("\n")
        for line in lines:
            first, *rest = line.split(" ")
            total += chunks[first]
            if rest:
                total += sum(map(chunks.__getitem__, [f" {w}" for w in rest]))
        return total + (len(lines) - 1) * self.words["\n"]

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not any(mark in text for mark in self.merges.specials):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(1 if i % 2 else self.plain(part) for i, part in enumerate(parts))


# fixed values: white space other than the blank and the line feed, as the word patterns see it
_ODD_BLANKS = regex.compile(r"[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]|^ | $|  | \n|\n[ \n]|^\n|\n$")


def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    tokenizer: path of a byte-level BPE file, readable on every executor. Special strings inside a text count
    one token each, nothing is added or cut. Null and empty texts have 0 bytes and 0 tokens; repeated rows and
    null ids each keep their row; other columns are ignored; an empty table gives an empty result.
    """

    def make():
        count = counter(tokenizer).count

        def apply(texts):
            tokens = [count(t) for t in texts]
            return [len(t.encode()) if t else 0 for t in texts], tokens, [n > limit for n in tokens]

        return apply

    columns = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())]
    return map_texts(docs, make, columns, id_col, text_col)
