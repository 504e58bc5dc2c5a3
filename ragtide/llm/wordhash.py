"""Vectorised 64-bit hashes of words and word sequences (numpy)."""

from __future__ import annotations

import numpy as np
import xxhash

#: Odd constants; any would do.
BASE, BASE_INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 1 << 64)
CHUNK, LONG = 1 << 18, 64
_powers: list[np.ndarray] = []


def powers() -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for a chunk of bytes."""
    if not _powers:
        for b in (BASE, BASE_INVERSE):
            p = np.full(CHUNK + LONG + 2, b, np.uint64)
            p[0] = 1
            _powers.append(np.multiply.accumulate(p))
    return _powers[0], _powers[1]


def mix(h: np.ndarray, salt: int = 0) -> np.ndarray:
    h = h + np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2 ** 64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of data[start:end] (bytes) for ascending, disjoint spans."""
    out = np.empty(len(starts), np.uint64)
    up, down = powers()
    lengths = ends - starts
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK)))
        a, b = starts[i:j] - starts[i], np.minimum(ends[i:j] - starts[i], CHUNK + LONG)
        part = data[starts[i]:starts[i] + b[-1]]
        # prefix sums of byte * BASE**position; a span is their difference, moved to 0
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part.astype(np.uint64) * up[:len(part)], out=sums[1:])
        out[i:j] = (sums[b] - sums[a]) * down[a]
        i = j
    out = mix(out ^ (lengths.astype(np.uint64) << np.uint64(48)))
    for k in np.nonzero(lengths > LONG)[0].tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k]:ends[k]].tobytes(), 1)
    return out


def hash_windows(words: np.ndarray, n: int, salt: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes, by doubling."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    total, done, step = None, 0, mix(words, salt)
    size, factor = 1, pow(BASE + 2 * salt, 1, 1 << 64)
    while True:
        if n & size:
            # append a run of `size` behind the `done` words gathered so far
            if total is None:
                total = step[:len(words) - n + 1]
            else:
                total = total * np.uint64(factor) + step[done:done + len(words) - n + 1]
            done += size
        if done == n:
            return mix(total, salt)
        step = step[:-size] * np.uint64(factor) + step[size:]
        size, factor = 2 * size, factor * factor % (1 << 64)
