"""64-bit fingerprints of words, of runs of words and of byte strings, for whole arrays at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U64 = np.uint64
#: Multiplier of the polynomial over bytes; odd, so that it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> U64(31))
    x = x * U64(0x7FB5D329728EA185)
    x = x ^ (x >> U64(27))
    x = x * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


@lru_cache(maxsize=2)
def _powers(length: int, base: int) -> np.ndarray:
    powers = np.empty(length + 1, np.uint64)
    powers[0] = 1
    done = 1
    while done <= length:
        step = U64(pow(base, done, 2**64))
        more = min(done, length + 1 - done)
        powers[done : done + more] = powers[:more] * step
        done += more
    return powers


def _grown(length: int) -> int:
    return 1 << max(16, (length - 1).bit_length())


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words, A-Z lowered, and the words of each text as end offsets."""
    joined = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = _SPACES[joined]
    inside = ~space
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside))))
    starts, ends = edge[0::2], edge[1::2]
    size = _grown(len(joined))
    up, down = _powers(size, _BASE), _powers(size, pow(_BASE, -1, 2**64))
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTE[_LOWER[joined]] * up[: len(joined)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts])
    bounds = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64))
    return hashes, np.searchsorted(starts, bounds)


def shingles(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Sorted distinct fingerprints of the runs of ``width`` words of each text.

    A text with fewer words has one, of its whole sequence; one without words has none.
    """
    words, ends = word_hashes(texts)
    runs = words.copy()
    for k in range(1, width):
        runs[: len(words) - k] = runs[: len(words) - k] * U64(0xD6E8FEB86659FD93) + words[k:] if len(words) > k else 0
    runs = mix(runs)
    made, start = [], 0
    for end in ends.tolist():
        n = end - start
        if n >= width:
            made.append(np.unique(runs[start : end - width + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for k in range(start, end):
                whole = whole * U64(0xA0761D6478BD642F) ^ words[k]
            made.append(mix(whole))
        else:
            made.append(np.empty(0, np.uint64))
        start = end
    return made
