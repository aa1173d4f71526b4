"""Vectorised splitting and hashing of UTF-8 text in numpy.

A run is a maximal stretch of bytes outside a set of break bytes (all ASCII,
so runs never split a character).  Hashes are sums of random numbers of the bytes
times random numbers of their places in the run, modulo 2**64, mixed; they are the
same in every process.  No two places stand in a fixed proportion (as powers of one
base do, on which texts can be made that cancel out), so texts agree by chance alone.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: Bytes hashed at a time (a longer run is hashed in one go).
SEGMENT = 1 << 20

WORD_BREAKS = np.zeros(256, bool)
WORD_BREAKS[[0x20, *range(0x09, 0x0E)]] = True
BLANK = np.zeros(256, bool)
BLANK[0x20] = True
#: Upper-case ASCII to lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _random_places(n: int) -> np.ndarray:
    """Odd random numbers; a longer draw begins with the shorter one."""
    return np.random.Generator(np.random.PCG64(51_966)).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


_PLACES = _random_places(1 << 16)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def _places(n: int) -> np.ndarray:
    global _PLACES
    if n > len(_PLACES):
        _PLACES = _random_places(1 << int(n - 1).bit_length())
    return _PLACES


def bounds(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run."""
    edge = np.empty(len(data) + 2, np.int8)
    edge[0] = edge[-1] = 0
    edge[1:-1] = ~breaks[data]
    step = np.diff(edge)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of ``data``."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        # runs that begin within a segment, one at least
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + SEGMENT)))
        lens = ends[at:to] - starts[at:to]
        offs = np.cumsum(lens) - lens
        place = np.arange(int(lens.sum())) - np.repeat(offs, lens)
        part = data[np.repeat(starts[at:to], lens) + place]
        out[at:to] = np.add.reduceat(_BYTE[part] * _places(int(lens.max()))[place], offs)
        at = to
    return mix(out)


def join_texts(texts: list[bytes], gap: bytes = b" ") -> tuple[np.ndarray, np.ndarray]:
    """One buffer with a gap after every text, and the place where each begins (and the end)."""
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + len(gap) for t in texts], out=begin[1:])
    return np.frombuffer(gap.join(texts) + gap, np.uint8) if texts else np.zeros(0, np.uint8), begin
