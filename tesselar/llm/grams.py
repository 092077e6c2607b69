"""Word n-grams of texts as 64-bit hashes, in NumPy over the bytes of a text."""

from __future__ import annotations

import hashlib

import numpy as np

#: Fixed odd multiplier of the running hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Powers:
    """Powers of the multiplier and of its inverse, grown to the longest text seen."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(BASE, len(self.up), 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(INVERSE, len(self.down), 1 << 64))])
        return self.up, self.down


POWERS = Powers()


def normalised(text: str | None) -> bytes:
    """The words of a text (split at ASCII white space) with one blank between them."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def digest(words: bytes) -> bytes:
    """128 bits that identify a word sequence."""
    return hashlib.blake2b(words, digest_size=16).digest()


def gram_hashes(words: bytes, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of normalised words; fewer words than n are one gram, none have none."""
    if not words:
        return np.empty(0, np.uint64)
    raw = np.frombuffer(words, np.uint8)
    up, down = POWERS.to(len(raw) + 1)
    running = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=running[1:])
    blanks = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.concatenate([blanks, [len(raw)]])
    width = min(n, len(starts))
    starts, ends = starts[: len(starts) - width + 1], ends[width - 1 :]
    return np.unique(mix((running[ends] - running[starts]) * down[starts]))
