"""Hashes of words and of runs of words, whole texts at a time with numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_SPACES = np.array([b in b" \t\n\x0b\x0c\r" for b in range(256)])
_MARKS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
#: A-Z as a-z, and a space for every ASCII byte that is no letter or digit.
_FOLDED = bytes(b" "[0] if _MARKS[b] else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one to one)."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@cache
def _letters(folded: bool) -> np.ndarray:
    numbers = np.arange(256, dtype=np.uint64)
    if folded:
        numbers[ord("A") : ord("Z") + 1] += np.uint64(32)
    return mixed((numbers + np.uint64(1)) * np.uint64(_MULTIPLIER))


class _Powers:
    """Powers of the multiplier and of its inverse, as many as the longest text so far needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(2 * len(self.up), n)
            rows = []
            for base in (_MULTIPLIER, _INVERSE):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                rows.append(np.multiply.accumulate(steps))
            self.up, self.down = rows
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(text: str, *, folded: bool = False, marks_split: bool = False) -> np.ndarray:
    """A 64-bit hash per word of the text, in order.

    Words are what ``[^\\x20\\x09-\\x0D]+`` finds; with ``marks_split`` ASCII marks separate words too.
    ``folded`` takes A-Z as a-z. Equal words have equal hashes in every process.
    """
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    inside = ~(_MARKS if marks_split else _SPACES)[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edges[::2], edges[1::2]
    up, down = _POWERS.upto(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_letters(folded)[data] * up, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts])


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """A hash per run of ``length`` consecutive words; none if there are fewer words."""
    count = len(words) - length + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for place in range(length):
        total = total * np.uint64(_MULTIPLIER) + words[place : place + count]
    return mixed(total + np.uint64(length))


def shingles(words: np.ndarray, length: int) -> np.ndarray:
    """The sorted distinct runs of words; the whole sequence counts as one run if it is shorter."""
    if not len(words):
        return words
    return np.unique(runs(words, min(length, len(words))))


def folded_words(text: str, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between ASCII marks and controls, A-Z as a-z, as UTF-8: lists of the words of ``piece`` bytes at a
    time (more only where one word is longer), so that a very long text never stands as one list."""
    data = text.encode("utf-8", "surrogatepass").translate(_FOLDED)
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > piece:
            end = data.rfind(b" ", start, start + piece)
            if end < 0:
                end = data.find(b" ", start + piece)
            if end < 0:
                end = len(data)
        yield data[start:end].split()
        start = end + 1
