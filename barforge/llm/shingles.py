"""Sets of word shingles as 64-bit hashes, computed from Arrow buffers a window of bytes at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_ONE = np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + _ONE
for _c in range(65, 91):  # A-Z count as a-z
    _BYTE[_c] = _BYTE[_c + 32]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are hashed at once; what they need is some 50 times as much.
SEGMENT = 1 << 18
_powers: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power() -> list[np.ndarray]:
    """Powers of the base and of its inverse, up to a segment's length."""
    if not _powers:
        for base in (_BASE, _BASE_INVERSE):
            run = np.full(SEGMENT + 1, base, np.uint64)
            run[0] = _ONE
            _powers.append(np.multiply.accumulate(run))
    return _powers


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and the offsets of each."""
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z in lower case), and for each text the place of its first word.

    A word's hash is the mixed sum of its bytes' values times powers of the base, so a word that
    goes on behind a segment is put together from its parts.
    """
    data, offsets = buffers(texts)
    n = len(data)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    power, inverse = _power()
    hashes, begins = [], []
    value_before, length_before, begun = 0, 0, -1  # of a word that the last segment did not end
    for low in range(0, n, SEGMENT):
        part = data[low : low + SEGMENT]
        m = len(part)
        cut = np.zeros(m + 1, bool)
        cut[offsets[slice(*np.searchsorted(offsets, [low, low + m + 1]))] - low] = True
        inside = ~_SPACE[part]
        starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1] | cut[1:-1]])
        ends = np.flatnonzero(inside & np.r_[~inside[1:] | cut[1:-1], True]) + 1
        total = np.zeros(m + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[:m], out=total[1:])
        value = (total[ends] - total[starts]) * inverse[starts]
        length = ends - starts
        place = low + starts
        if begun >= 0:
            factor = pow(int(_BASE), length_before, 1 << 64)
            value[0] = np.uint64((value_before + factor * int(value[0])) & (1 << 64) - 1)
            length[0] += length_before
            place[0], begun = begun, -1
        if inside[-1] and not cut[m] and not _SPACE[data[low + m]]:  # the end of the data is a cut
            value_before, length_before, begun = int(value[-1]), int(length[-1]), int(place[-1])
            value, length, place = value[:-1], length[:-1], place[:-1]
        hashes.append(mix(value + length.astype(np.uint64)))
        begins.append(place)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(begins), offsets)


def sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Each text's sorted distinct shingles of ``size`` words; with fewer words, the sequence as one."""
    hashes, first = words(texts)
    rolled = hashes.copy()
    for k in range(1, size):
        rolled = rolled[: len(hashes) - k] if len(hashes) > k else rolled[:0]
        rolled = mix(rolled * _BASE + hashes[k : k + len(rolled)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            one = hashes[a : a + 1]
            for k in range(1, b - a):
                one = mix(one * _BASE + hashes[a + k : a + k + 1])
            out.append(mix(one + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
