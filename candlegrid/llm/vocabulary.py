"""What the two byte-pair tokenizers share: merge ranks, byte letters, and the cut of a text into words."""

from __future__ import annotations

import heapq
import json
from dataclasses import dataclass, field
from functools import lru_cache

import regex
from tokenizers import Tokenizer

# fixed values: word patterns of the two public tokenizers, as their files and libraries state them
BYTE_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Up to here the regex module and the tokenizer's library agree on letters; beyond, the library cuts.
AGREED = "ɏ"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the others from U+0100 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    shown = set(own)
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


@dataclass
class Merges:
    """Merge rules by symbol ids; a pair's key is (left << 32) | right."""

    ids: dict[str, int]
    rank: dict[int, int]
    result: list[int]
    specials: dict[str, int]
    names: dict[int, str]
    suffix: str
    library: Tokenizer
    pattern: regex.Pattern
    first: list[int] = field(default_factory=list)  # symbol of each byte
    last: list[int] = field(default_factory=list)  # the same at a word's end


@lru_cache(maxsize=2)
def load(path: str) -> Merges:
    """The file's rules, kept by a worker; what words have been merged to is kept by a task only."""
    with open(path, encoding="utf-8") as file:
        told = json.load(file)
    ids: dict[str, int] = told["model"]["vocab"]
    suffix = told["model"]["end_of_word_suffix"] or ""
    rank, result = {}, []
    for left, right in (m if isinstance(m, list) else m.split(" ") for m in told["model"]["merges"]):
        rank.setdefault(ids[left] << 32 | ids[right], len(result))
        result.append(ids[left + right])
    specials = {t["content"]: t["id"] for t in told["added_tokens"]}
    letters = byte_letters()
    splits = [p for p in (told["pre_tokenizer"].get("pretokenizers") or []) if p["type"] == "Split"]
    merges = Merges(
        ids,
        rank,
        result,
        specials,
        {i: t for t, i in [*ids.items(), *specials.items()]},
        suffix,
        Tokenizer.from_file(path),
        regex.compile(splits[0]["pattern"]["Regex"] if splits else BYTE_WORDS),
    )
    merges.first = [ids[x] for x in letters]
    merges.last = [ids[x + suffix] for x in letters]
    return merges


def special_pattern(specials: dict[str, int]) -> regex.Pattern | None:
    return regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None


def merge_by_heap(symbols: list[int], merges: Merges) -> int:
    """Merges the lowest-ranked adjacent pair, the leftmost of equals, until none is left; returns the number of merges.

    symbols is changed in place: what a merge used up becomes -1.
    """
    n = len(symbols)
    get, result = merges.rank.get, merges.result
    # rank of the pair that begins at each symbol; -1: none, or the symbol is gone
    at = [get(a << 32 | b, -1) for a, b in zip(symbols, symbols[1:], strict=False)]
    heap = [r << 32 | i for i, r in enumerate(at) if r >= 0]
    if not heap:
        return 0
    heapq.heapify(heap)
    at.append(-1)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pop, push, done = heapq.heappop, heapq.heappush, 0
    while heap:
        top = pop(heap)
        r, i = top >> 32, top & 0xFFFFFFFF
        if at[i] != r:
            continue
        j = after[i]
        k = after[i] = after[j]
        symbols[i] = made = result[r]
        symbols[j] = -1
        at[j] = -1
        done += 1
        if k < n:
            before[k] = i
            r = at[i] = get(made << 32 | symbols[k], -1)
            if r >= 0:
                push(heap, r << 32 | i)
        else:
            at[i] = -1
        h = before[i]
        if h >= 0:
            r = at[h] = get(symbols[h] << 32 | made, -1)
            if r >= 0:
                push(heap, r << 32 | h)
    return done
