"""64-bit hashes of substrings, whole arrays at a time.

The hash of bytes i to j is ``(S[j] - S[i]) * BASE**-i`` modulo 2^64, where S is
the running sum of ``TABLE[byte] * BASE**position``: any substring of a text is
hashed from two entries of S.
"""

from __future__ import annotations

import numpy as np

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.int64).astype(np.uint64) | np.uint64(1)
SPACES = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])

_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 18)
        made = []
        for base in (BASE, INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps, dtype=np.uint64))
        if size > 1 << 21:  # for one very long text only; not kept
            return made[0][:n], made[1][:n]
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit values; distinct values stay distinct."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def running(data: np.ndarray) -> np.ndarray:
    """S for the bytes, with a leading 0."""
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(TABLE[data] * powers(len(data))[0], out=out[1:])
    return out


def substrings(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return (sums[ends] - sums[starts]) * powers(len(sums))[1][starts]


def shingle_sets(texts: list[str], size: int = 3) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text, A-Z in lower case.

    A text of fewer words than ``size`` has its whole sequence as one shingle, a
    text without words none.
    """
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    space = SPACES[data]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[0::2], edges[1::2]
    word = mix(substrings(running(data), starts, ends))
    lengths = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    begins = np.cumsum(lengths) - lengths
    at = np.searchsorted(starts, np.append(begins, len(data)))
    factors = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    if len(word) >= size:
        joint = sum(word[k : len(word) - size + 1 + k] * factors[k] for k in range(size))
        joint = mix(joint)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            found = np.sort(joint[a : b - size + 1])
            new = np.empty(len(found), bool)
            new[0] = True
            np.not_equal(found[1:], found[:-1], out=new[1:])
            out.append(found[new])
        elif b > a:
            short = (word[a:b] * factors[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def slices(sizes: list[int], most: int):
    """Ranges of consecutive items whose sizes add up to ``most`` or that hold one item."""
    begin, held = 0, 0
    for i, s in enumerate(sizes):
        if held and held + s > most:
            yield begin, i
            begin, held = i, 0
        held += s
    if begin < len(sizes):
        yield begin, len(sizes)
