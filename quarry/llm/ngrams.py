"""Hashes of words and character n-grams of whole texts, in numpy.

A hash is a sum of values times fixed random odd 64-bit keys, one key per
position, taken modulo 2**64; its upper bits choose a bucket.
"""

from __future__ import annotations

import numpy as np

from .common import WHITE

_KEYS = np.random.Generator(np.random.PCG64(20240229)).integers(1 << 62, 1 << 64, 128, np.uint64, endpoint=False) | np.uint64(1)
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(WHITE.encode())] = False
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of eight


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of the hash; no two
    hashes become one."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def char_grams(points: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of n code points."""
    m = len(points) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    wide = points.astype(np.uint64) + np.uint64(1)
    out = wide[:m] * _KEYS[n]
    for i in range(1, n):
        out += wide[i : m + i] * _KEYS[n + i]
    return out


def _spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    inside = np.zeros(len(raw) + 2, bool)
    np.take(_IS_WORD, raw, out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def count_words(data: bytes) -> int:
    return len(_spans(np.frombuffer(data, np.uint8))[0])


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash per word of a UTF-8 text, in order: eight bytes at a
    time, all words at once."""
    starts, ends = _spans(np.frombuffer(data, np.uint8))
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = data + bytes(8)
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))  # at every byte
    left = ends - starts
    out = (eight[starts] & _MASKS[np.minimum(left, 8)]) * _KEYS[0] + left.astype(np.uint64) * _KEYS[1]
    more, at = np.flatnonzero(left > 8), 8
    while len(more):
        part = eight[starts[more] + at] & _MASKS[np.minimum(left[more] - at, 8)]
        out[more] = _mixed(out[more]) + part * _KEYS[2]
        at += 8
        more = more[left[more] > at]
    return _mixed(out)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words (n of 64 at most)."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:m] * _KEYS[64]
    part = np.empty_like(out)
    for i in range(1, n):
        np.multiply(hashes[i : m + i], _KEYS[64 + i], out=part)
        out += part
    return _mixed(out)


def long_runs(short: np.ndarray, size: int, n: int, starts=None) -> np.ndarray:
    """Hashes of runs of n words out of those of ``size`` words (``short``,
    n at least size): as many of them side by side as fit, and the last."""
    offsets = [*range(0, n - size, size), n - size]
    if starts is None:
        starts = np.arange(max(0, len(short) - (n - size)))
    out = np.zeros(len(starts), np.uint64)
    for i, offset in enumerate(offsets):
        out += short[starts + offset] * _KEYS[4 + i]
    return _mixed(out)


def buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))
