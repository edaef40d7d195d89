"""The words of whole Arrow columns of texts, found and hashed without a Python object for each word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from streamweave.llm.common import mix

BASE = 0x9E3779B97F4A7C15
#: Longer words are hashed one by one: polynomials modulo 2^64 have weak spots for long regular strings.
LONG = 64
#: Tables over bytes: A-Z lower-cased or all as they are, and the kind of each byte (0: no part of a word).
AS_IT_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IT_IS.copy()
LOWER[65:91] += 32


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """Runs of bytes of one kind (other than 0) in every text: bytes, starts and ends, 64-bit hashes.

    first[i] is the number of text i's first word, first[-1] that of all words; null texts have none."""

    _up = _down = np.ones(1, np.uint64)

    def __init__(self, column: pa.Array, kinds: np.ndarray, letters: np.ndarray = LOWER):
        column = column.cast(pa.large_binary()).fill_null(b"")
        if len(column):
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        else:
            at = np.zeros(1, np.int64)
        raw = column.buffers()[2]
        raw = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        self.bytes = letters[raw]
        kind = kinds[self.bytes]
        edge = np.ones(len(kind) + 1, bool)
        edge[1:-1] = kind[1:] != kind[:-1]
        edge[at] = True  # no word crosses two texts
        inside = kind > 0
        self.start = np.flatnonzero(inside & edge[:-1])
        self.end = np.flatnonzero(inside & edge[1:]) + 1
        self.first = np.searchsorted(self.start, at)
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        """Polynomials in an odd base, from one running sum over all bytes."""
        n = len(self.bytes)
        if n > len(Words._up):
            Words._up = powers(BASE, n + n // 4 + 1)
            Words._down = powers(pow(BASE, -1, 2 ** 64), n + n // 4 + 1)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.multiply(self.bytes, Words._up[:n], out=total[1:])
        np.cumsum(total[1:], out=total[1:])
        size = self.end - self.start
        out = mix((total[self.end] - total[self.start]) * Words._down[self.start] + size.astype(np.uint64))
        for i in np.flatnonzero(size > LONG).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.bytes[self.start[i]:self.end[i]].tobytes())
        return out

    def of(self, i: int) -> np.ndarray:
        """The hashes of text i's words."""
        return self.hash[self.first[i]:self.first[i + 1]]

    def runs(self, k: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hashes of the k words from each start, or from the word numbers ``at``."""
        n = max(0, len(self.hash) - k + 1)
        factor = powers(0xD1B54A32D192ED03, k + 1)
        out = np.zeros(n if at is None else len(at), np.uint64)
        for j in range(k):
            out += (self.hash[j:j + n] if at is None else self.hash[at + j]) * factor[j + 1]
        return out

    def text(self, at: int, k: int) -> bytes:
        """k words from word ``at`` on, with a space between."""
        return b" ".join(self.bytes[a:b].tobytes() for a, b in zip(self.start[at:at + k], self.end[at:at + k]))
