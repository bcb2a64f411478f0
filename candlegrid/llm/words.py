"""Words of many texts at once, as NumPy arrays over an Arrow batch's bytes.

White space and punctuation that part words are ASCII, so words can be cut in UTF-8 without decoding it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))  # fixed values: multipliers of the splitmix64 finaliser
_STEP = np.uint64(0x9E3779B97F4A7C15)  # fixed value: its increment
#: Places of a word whose values are kept.
_NEAR = 64
BASE = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values, one to one."""
    x = np.array(x, np.uint64)
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


@dataclass(frozen=True)
class Alphabet:
    """Per byte: whether it belongs to words, and the byte that stands for it in hashes."""

    inside: np.ndarray
    value: np.ndarray


def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


@lru_cache(maxsize=2)
def blank_parted(lower: bool = False) -> Alphabet:
    """Words are [^\\x20\\x09-\\x0D]+, with A-Z lower-cased or as they are."""
    inside = np.ones(256, bool)
    inside[[0x20, *range(0x09, 0x0E)]] = False
    return Alphabet(inside, _lowered() if lower else np.arange(256, dtype=np.uint8))


@lru_cache(maxsize=1)
def letters_only() -> Alphabet:
    """A-Z lower-cased; words are then [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+."""
    inside = np.zeros(256, bool)
    inside[0x30:0x3A] = inside[0x41:0x5B] = inside[0x61:0x7B] = inside[0x80:] = True
    return Alphabet(inside, _lowered())


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def _placed(place: np.ndarray, byte: np.ndarray) -> np.ndarray:
    """What a byte at a place of a word adds to its hash."""
    return mix(place.astype(np.uint64) * _STEP ^ _byte_values()[byte])


@lru_cache(maxsize=1)
def _placed_values() -> np.ndarray:
    """The same for the first places, by place and byte."""
    return _placed(np.repeat(np.arange(_NEAR), 256), np.tile(np.arange(256), _NEAR))


@dataclass
class Words:
    """Words of consecutive texts: bytes, and per word its first byte, length, text and 64-bit hash; first_word: per text, and the end."""

    alphabet: Alphabet
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    doc: np.ndarray
    hashes: np.ndarray
    first_word: np.ndarray

    def word(self, i: int) -> bytes:
        """A word as the alphabet shows it."""
        return self.alphabet.value[self.data[self.starts[i] : self.starts[i] + self.lengths[i]]].tobytes()


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the texts and where each begins; nulls are empty."""
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    held = texts.buffers()[2] if len(texts) else None
    data = np.frombuffer(held, np.uint8)[offsets[0] : offsets[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def words_of(texts: pa.Array, alphabet: Alphabet) -> Words:
    """Words of each text, in order."""
    data, offsets = bytes_of(texts)
    inside = alphabet.inside[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    # a text's first byte begins a word even if the text before it ends within one
    heads = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[heads] = inside[heads]
    starts = np.flatnonzero(first)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return Words(alphabet, data, offsets, none, none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64))
    lengths = np.add.reduceat(inside, starts, dtype=np.int64)
    # a word's hash adds up one spread value per byte and its place in the word, so no pattern of letters cancels out
    place = np.arange(len(data), dtype=np.int32)
    place[starts[0] :] -= np.repeat(starts.astype(np.int32), np.diff(starts, append=len(data)))
    shown = alphabet.value[data]
    values = _placed_values()[np.minimum(place, _NEAR - 1) << 8 | shown]
    far = np.flatnonzero((place >= _NEAR) & inside)
    if len(far):
        values[far] = _placed(place[far], shown[far])
    values[~inside] = 0
    hashes = mix(np.add.reduceat(values, starts) + lengths.astype(np.uint64) * _STEP)
    doc = np.searchsorted(offsets, starts, "right") - 1
    return Words(alphabet, data, offsets, starts, lengths, doc, hashes, np.searchsorted(starts, offsets, "left"))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` consecutive words, by place; len(hashes) - size + 1 values."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(size):
        out *= BASE
        out += hashes[i : i + n]
    return mix(out)
