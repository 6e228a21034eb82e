"""64-bit hashes of the words of many texts at once (numpy, inside tasks).

A word is a maximal run of bytes other than the six ASCII white-space bytes, with
A-Z folded; its hash is the polynomial ``sum(value[byte_i] * P ** i)`` modulo 2**64,
finished by a mixer.  Prefix sums over a buffer of many texts give every word's
hash by one subtraction and one multiplication, whatever its place in the buffer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

PIECE = 1 << 19
_P = 0x9E3779B97F4A7C15
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse; a worker keeps them for its next tasks.

    They are kept on the numpy module: a cache of this module's own would either be sent along or, as a
    decorated function, be looked up in a package that executors need not have.
    """
    kept = np.__dict__.setdefault("_powers_of_word_hashes", {})
    if n not in kept:
        while len(kept) > 1:
            kept.pop(min(kept))
        kept[n] = tuple(np.multiply.accumulate(np.concatenate(([np.uint64(1)], np.full(n - 1, x, np.uint64))))
                        for x in (_P, pow(_P, -1, 1 << 64)))
    return kept[n]


class WordHasher:
    """Hashes texts; holds the tables of powers, which grow to the longest piece met."""

    def __init__(self) -> None:
        value = np.random.default_rng(5).integers(1, 2**64, 256, dtype=np.uint64)
        value[65:91] = value[97:123]
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        value[self.space] = 0
        self.value = value
        self.powers, self.inverses = _powers(2 * PIECE)

    def of_buffer(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of ``data`` and the offsets they start at."""
        a = np.frombuffer(data, np.uint8)
        if len(a) >= len(self.powers):
            self.powers, self.inverses = _powers(1 << len(a).bit_length())
        edges = np.flatnonzero(np.diff(np.concatenate(([True], self.space[a], [True]))))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(self.value[a] * self.powers[: len(a)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64)), starts

    def _long(self, data: bytes) -> np.ndarray:
        parts, at = [], 0
        while at < len(data):
            cut = _SPACE.search(data, min(len(data), at + PIECE))
            end = cut.start() if cut else len(data)
            parts.append(self.of_buffer(data[at:end])[0])
            at = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def texts(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The word hashes of each text, in order; short texts are hashed together."""
        held: list[bytes] = []
        size = 0

        def flush() -> Iterator[np.ndarray]:
            offsets = np.cumsum([0] + [len(x) + 1 for x in held])
            h, starts = self.of_buffer(b"\n".join(held))
            at = np.searchsorted(starts, offsets)
            for i in range(len(held)):
                yield h[at[i]:at[i + 1]]

        for t in texts:
            data = (t or "").encode("utf-8", "surrogatepass")
            if size + len(data) > PIECE and held:
                yield from flush()
                held, size = [], 0
            if len(data) > PIECE:
                yield self._long(data)
            else:
                held.append(data)
                size += len(data) + 1
        if held:
            yield from flush()


def ngrams(words: np.ndarray, width: int) -> np.ndarray:
    """The sorted distinct hashes of ``width`` words in a row; fewer words make one n-gram."""
    if not len(words):
        return np.empty(0, np.uint64)
    k = min(width, len(words))
    n = len(words) - k + 1
    out = words[:n].copy()
    for i in range(1, k):
        out *= np.uint64(_P)
        out ^= out >> np.uint64(29)
        out += words[i: n + i]
    return np.unique(mixed(out + np.uint64(k)))
