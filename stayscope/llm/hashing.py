"""Words of a text and their 64-bit hashes, with numpy over the text's UTF-8 bytes."""

from __future__ import annotations

import numpy as np

from stayscope.llm.common import ship

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def random_table(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit integers; a longer table begins with a shorter one."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * _GOLD)


def byte_classes(is_word) -> np.ndarray:
    """For each byte 0 if it separates words, else the byte with A-Z lower-cased."""
    table = np.zeros(256, dtype=np.uint8)
    for b in range(256):
        if is_word(b):
            table[b] = b + 32 if 65 <= b <= 90 else b
    return table


#: Words of anything but white space; NUL counts as a word byte, under the unused code 0xFF.
BY_WHITE = byte_classes(lambda b: b != 32 and not 9 <= b <= 13)
BY_WHITE[0] = 0xFF
#: Words of ASCII letters and digits and of all bytes beyond ASCII.
BY_ALNUM = byte_classes(lambda b: b >= 128 or chr(b).isalnum())

_BYTE = random_table(256, 1)


class Words:
    """Lower-cased words of one text: byte bounds and hashes.

    A word's hash is a sum over its bytes of (random number of the byte) * (random number of its
    position), mixed with its length.
    """

    __slots__ = ("classes", "starts", "ends", "hashes")
    places = random_table(64, 2)

    def __init__(self, text: str, classes: np.ndarray):
        self.classes = classes[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]
        inside = np.zeros(len(self.classes) + 2, dtype=np.int8)
        inside[1:-1] = self.classes > 0
        turns = np.flatnonzero(np.diff(inside))
        self.starts, self.ends = turns[0::2], turns[1::2]
        lengths = self.ends - self.starts
        if not len(lengths):
            self.hashes = np.zeros(0, dtype=np.uint64)
            return
        if (longest := int(lengths.max())) > len(Words.places):
            Words.places = random_table(2 * longest, 2)
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        values = _BYTE[self.classes[inside[1:-1] > 0]] * Words.places[place]
        self.hashes = mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))

    def __len__(self) -> int:
        return len(self.starts)

    def joined(self, start: int, end: int) -> bytes:
        """Words ``start`` to ``end`` (exclusive), lower-cased, joined by one space."""
        raw = self.classes
        return b" ".join(raw[a:b].tobytes() for a, b in zip(self.starts[start:end], self.ends[start:end]))


_PLACE_OF_WORD = random_table(64, 3) | np.uint64(1)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` (at most 64) consecutive words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += words[k : k + n] * _PLACE_OF_WORD[k]
    return mix(total + np.uint64(width))


ship(__name__)
