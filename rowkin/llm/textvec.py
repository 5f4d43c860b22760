"""Words, word hashes and n-gram hashes of many texts at once, as numpy arrays.

The texts of a chunk are joined into one byte array. Word borders come from a byte table, and a word's hash is
a difference of prefix sums of byte codes times powers of an odd number modulo 2^64, so nothing is done word by
word in Python. A chunk holds CHUNK bytes, or one text if that is longer: memory follows the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 21
_M64 = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next chunk."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK + (1 << 16))
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if n <= CHUNK + (1 << 16):
            _powers[base] = have
    return have[:n]


#: Byte classes: which bytes belong to words.
_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
CLASSES = {"not_space": _NOT_SPACE, "alnum": _ALNUM}


def chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as UTF-8 with A-Z lower-cased) until CHUNK bytes; null is empty."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass").lower() if isinstance(t, str) else b""  # bytes.lower() is ASCII only
        if held and size + len(b) > CHUNK:
            yield first, held
            first, held, size = i, [], 0
        held.append(b)
        size += len(b) + 1
    if held:
        yield first, held


class Words:
    """The words of a chunk: start, end (byte offsets in buf), hash (uint64), first (by text, n + 1 word indexes)."""

    def __init__(self, texts: list[bytes], kind: str = "not_space"):
        joined = b"\n".join(texts) + b"\n"  # a line feed belongs to no word of either class
        self.buf = np.frombuffer(joined, dtype=np.uint8)
        inside = CLASSES[kind][self.buf]
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        self.start, self.end = edge[::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.text_start = np.concatenate([[0], ends[:-1]]) if len(texts) else np.zeros(0, dtype=np.int64)
        self.text_end = ends - 1
        self.first = np.concatenate([[0], np.searchsorted(self.start, ends)])
        n = len(self.buf)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_CODES[self.buf] * _powers_of(_BASE, n), out=sums[1:])
        self._sums, self._shift = sums, _powers_of(_INVERSE, n)[self.start]
        self.hash = mix((sums[self.end] - sums[self.start]) * self._shift)

    def prefix_hash(self, size: int) -> np.ndarray:
        """Hash of each word's first `size` bytes, apart from any word's own hash; 0 for words no longer than that."""
        raw = (self._sums[np.minimum(self.start + size, self.end)] - self._sums[self.start]) * self._shift
        return np.where(self.end - self.start > size, mix(raw + np.uint64(size * 0x1000193)), np.uint64(0))

    def __len__(self) -> int:
        return len(self.start)

    def text_of(self) -> np.ndarray:
        """The text's index, for each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def gram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive word hashes; len(words) - n + 1 values (none if that isn't positive)."""
    size = len(words) - n + 1
    if size <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(size, dtype=np.uint64)
    for i in range(n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[i : i + size]
    return mix(out)


def grams_at(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """gram_hash(words, n)[at], without the others."""
    out = np.zeros(len(at), dtype=np.uint64)
    for i in range(n):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[at + i]
    return mix(out)
