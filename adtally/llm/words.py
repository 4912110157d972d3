"""Words of whole texts as numpy arrays, in pieces of bounded size; no Spark here."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def _kept(keep) -> bytes:
    """A byte table that lower-cases A-Z and turns bytes that are no part of a word into spaces."""
    return bytes(b + 32 if 65 <= b <= 90 else b if keep(b) else 32 for b in range(256))


# The two meanings of a word, over UTF-8: runs of letters, digits and all beyond ASCII,
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing; and runs of anything but [\x20\x09-\x0D].
ALNUM = _kept(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
SPACED = _kept(lambda b: not 9 <= b <= 13)
PIECE = 1 << 20
_FACTOR = 0xD6E8FEB86659FD93


def _cut(text: str, table: bytes, size: int) -> Iterator[bytes]:
    """The text with spaces between words, some ``size`` bytes at a time and never within a word."""
    data = text.encode("utf-8", "surrogatepass").translate(table)
    start = 0
    while start < len(data):
        stop = start + size
        if stop < len(data):
            stop = data.find(b" ", stop)
            stop = len(data) if stop < 0 else stop
        yield data[start:stop]
        start = stop


def pieces(text: str, table: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The words of ``text``, lower-cased (A-Z), some ``size`` bytes at a time."""
    return (part.split() for part in _cut(text, table, size))


class Hasher:
    """64-bit hashes of words: a polynomial in the bytes, each byte standing for a random number.

    The sums of all words of a piece come from one running sum over its bytes.
    """

    def __init__(self, seed: int = 0) -> None:
        self._numbers = mixed(np.arange(1, 257, dtype=np.uint64) + np.uint64(seed * 1000))
        self._powers = self._inverse = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if size >= len(self._powers):
            size = max(size + 1, 1 << 16)
            grown = lambda f: np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, f, np.uint64)]))
            self._powers, self._inverse = grown(_FACTOR), grown(pow(_FACTOR, -1, 1 << 64))

    def _piece(self, data: bytes, beginnings: tuple[int, ...] = ()) -> np.ndarray:
        codes = np.frombuffer(data, np.uint8)
        inside = np.concatenate([[False], codes != 32, [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, stop = edges[0::2], edges[1::2]
        self._grow(len(codes))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._numbers[codes] * self._powers[:len(codes)])])
        whole = mixed((sums[stop] - sums[start]) * self._inverse[start])
        parts = [whole]
        for n in beginnings:
            at = start[stop - start > n]
            parts.append(mixed((sums[at + n] - sums[at]) * self._inverse[at] + np.uint64(n)))
        return np.concatenate(parts) if beginnings else whole

    def text(self, text: str | None, table: bytes, size: int = PIECE) -> np.ndarray:
        """The hashes of all words of a text in order."""
        parts = [self._piece(part) for part in _cut(text or "", table, size)]
        if len(parts) == 1:
            return parts[0]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def with_beginnings(self, text: str | None, table: bytes, beginnings: tuple[int, ...], size: int = PIECE) -> np.ndarray:
        """The hashes of all words and of the first bytes of longer ones, in no order."""
        parts = [self._piece(part, beginnings) for part in _cut(text or "", table, size)]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the finaliser of splitmix64)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """One hash per run of ``n`` words, in order; fewer words are one run, none are none."""
    if not len(words):
        return np.empty(0, np.uint64)
    width = min(n, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for i in range(width):
        out += words[i:i + count] * np.uint64(pow(0x9E3779B97F4A7C15, i + 1, 1 << 64))
    return mixed(out)
