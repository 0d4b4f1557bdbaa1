"""Vectorised words and word hashes over batches of UTF-8 texts (numpy).

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D``; in
UTF-8 these bytes never occur inside a multi-byte character, so this equals
the same rule on code points.  Hashes are 64 bits wide and depend on the
word's bytes only, never on the batch, so all tasks agree on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_STEP = 0xD6E8FEB86659FD93


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser spreading every input bit over the 64 output bits."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(32)
    return h


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(_STEP))


_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, dtype=U64)
        out[0] = 1
        have = _powers[base] = np.multiply.accumulate(out)
    return have[:n]


def is_space() -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


_SPACE = is_space()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def slices(texts: list[bytes], limit: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes each (one text at least)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t) + 1
    if start < len(texts):
        yield start, len(texts)


class Words:
    """Words of a list of texts: hash, owning text, byte span in the text."""

    def __init__(self, texts: list[bytes], lower: bool = True, word_byte: np.ndarray | None = None):
        joined = b"\n".join(texts)
        buf = np.frombuffer(joined, dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.base = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=self.base[1:])
        if lower:
            buf = _LOWER[buf]
        inside = word_byte[buf] if word_byte is not None else ~_SPACE[buf]
        if len(inside):
            # a separator byte stands between texts, whatever counts as a word
            inside[self.base[1:-1] - 1] = False
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        self.start, self.end = edge[0::2], edge[1::2]
        self.text = np.searchsorted(self.base, self.start, side="right") - 1
        self.first = np.searchsorted(self.text, np.arange(len(texts) + 1))
        self.buf = buf
        self.total = np.zeros(len(buf) + 1, dtype=U64)
        np.cumsum(_byte_values()[buf] * _power(_BASE, len(buf)), out=self.total[1:])
        self.hash = self.span_hash(self.start, self.end)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte spans of the batch, by content and length."""
        back = _power(pow(_BASE, -1, 1 << 64), len(self.total))
        h = (self.total[end] - self.total[start]) * back[start]
        return mix(h + (end - start).astype(U64))

    def local_start(self) -> np.ndarray:
        return self.start - self.base[self.text]

    def local_end(self) -> np.ndarray:
        return self.end - self.base[self.text]


def run_hash(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of `n` consecutive entries of `h`."""
    if len(h) < n:
        return np.zeros(0, dtype=U64)
    out = np.full(len(h) - n + 1, n, dtype=U64)
    for k in range(n):
        out *= U64(_BASE)
        out += h[k:len(h) - n + 1 + k]
    return mix(out)


def shingles(words: Words, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """All `n`-word shingles: their hashes and owning texts, text by text.

    A text of 1 to n-1 words gives one shingle, its whole sequence.
    """
    full = run_hash(words.hash, n)
    ok = words.text[:len(full)] == words.text[n - 1:] if len(full) else np.zeros(0, dtype=bool)
    hs, ts = [full[ok]], [words.text[:len(full)][ok]]
    count = np.diff(words.first)
    for k in range(1, n):
        short = np.flatnonzero(count == k)
        if len(short):
            at = words.first[short]
            h = np.full(len(short), k, dtype=U64)
            for j in range(k):
                h = h * U64(_BASE) + words.hash[at + j]
            hs.append(mix(h))
            ts.append(short)
    h, t = np.concatenate(hs), np.concatenate(ts)
    if len(hs) > 1:
        order = np.argsort(t, kind="stable")
        h, t = h[order], t[order]
    return h, t
