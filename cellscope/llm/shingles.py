"""Word shingles of a text as 64-bit hashes, and their SetSketch registers."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

SHINGLE_WORDS = 5
#: SetSketch: number of registers, base and rate of the exponential spacing, largest register.
M = 128
BASE = 1.001
RATE = 20.0
Q = 65534

_rng = np.random.default_rng(20240229)
_LONGEST = 64                       # bytes of a word that the position table covers
_BYTE = _rng.integers(0, 1 << 64, (_LONGEST, 256), np.uint64)
_EXACT = _BYTE.copy()
_BYTE[:, 65:91] = _BYTE[:, 97:123]  # A-Z as a-z
_PLACE = _rng.integers(0, 1 << 64, SHINGLE_WORDS + 1, np.uint64) | np.uint64(1)
_REGISTER = _rng.integers(0, 1 << 64, M, np.uint64) | np.uint64(1)
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str, exact: bool = False) -> np.ndarray:
    """A 64-bit hash of every word, A-Z taken as a-z unless `exact`."""
    raw = np.frombuffer(text.encode(), np.uint8)
    word = ~_SPACE[raw]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, np.uint64)
    inside = np.flatnonzero(word)
    of_byte = np.cumsum(begins)[inside] - 1
    pos = inside - starts[of_byte]
    first = np.flatnonzero(pos == 0)
    size = np.diff(np.append(first, len(inside)))
    hashes = np.add.reduceat((_EXACT if exact else _BYTE)[pos % _LONGEST, raw[inside]], first)
    for k in np.flatnonzero(size > _LONGEST):     # longer than the table: hash the word by itself
        w = raw[starts[k]:starts[k] + size[k]].tobytes()
        hashes[k] = xxhash.xxh3_64_intdigest(w if exact else w.lower())
    return _mix(hashes + size.astype(np.uint64))


def shingle_set(text: str | None) -> np.ndarray:
    """The distinct shingles of a whole text, sorted. Fewer than five words make one shingle of
    them all; no word makes none."""
    w = word_hashes(text or "")
    n = len(w) - SHINGLE_WORDS + 1
    if not len(w):
        return w
    if n < 1:
        return _mix((w * _PLACE[:len(w)]).sum(keepdims=True) + _PLACE[-1:] * np.uint64(len(w)))
    total = w[:n] * _PLACE[0]
    for k in range(1, SHINGLE_WORDS):
        total += w[k:n + k] * _PLACE[k]
    return np.unique(_mix(total))


def fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the whole set."""
    d = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
    return tuple(int.from_bytes(x, "little", signed=True) for x in (d[:8], d[8:]))


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set: floor(1 - log_b) of the least of its exponential variables,
    one hash function for each register, cut to 0..Q+1. The registers of a union are the
    registers' maxima."""
    low = np.full(M, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):       # bounds the table of products for long texts
        np.minimum(low, (shingles[at:at + 2048, None] * _REGISTER).min(0), out=low)
    u = (low.astype(np.float64) + 0.5) / 2.0 ** 64
    spaced = np.floor(1 - np.log(-np.log1p(-np.minimum(u, 1 - 1e-16)) / RATE) / np.log(BASE))
    return np.clip(spaced, 0, Q + 1).astype(np.uint16)


def _p(x: np.ndarray) -> np.ndarray:
    """Chance that one side's register is the greater one, for a share x of elements of its own."""
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def log_likelihood(j, u, v, more, less, same):
    """Of Jaccard similarity j for shares u, v of the two cardinalities and the counts of
    registers that are greater, less and equal."""
    a, b = np.maximum(_p(u - v * j), 1e-12), np.maximum(_p(v - u * j), 1e-12)
    return more * np.log(a) + less * np.log(b) + same * np.log(np.maximum(1 - a - b, 1e-12))


def joint_estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood Jaccard similarity of pairs of sketches with known set sizes, and the
    log-likelihood there. The function is concave in j: ternary search, all pairs at once."""
    more, less = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - more - less
    u = na / (na + nb)
    v = 1 - u
    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        right = log_likelihood(x, u, v, more, less, same) < log_likelihood(y, u, v, more, less, same)
        lo, hi = np.where(right, x, lo), np.where(right, hi, y)
    j = (lo + hi) / 2
    return j, log_likelihood(j, u, v, more, less, same)


def may_reach(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float,
              margin: float) -> tuple[np.ndarray, np.ndarray]:
    """The estimate, and whether `least` is within `margin` of the best log-likelihood (18 is six
    standard deviations) or the estimate reaches it."""
    j, best = joint_estimate(ra, rb, na, nb)
    more, less = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - more - less
    u = na / (na + nb)
    at = log_likelihood(np.full(len(u), least), u, 1 - u, more, less, same)
    return j, (j >= least) | (best - at <= margin)
