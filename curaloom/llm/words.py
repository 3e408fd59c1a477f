"""Vectorised words, word hashes and shingles over batches of UTF-8 texts.

A word is a run of bytes other than 0x20 and 0x09-0x0D, A-Z lower-cased; in UTF-8 these
bytes never occur inside other characters, so byte runs are character runs.
"""

from __future__ import annotations

import numpy as np

_M = np.uint64(0xD6E8FEB86659FD93)
_GOLD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (xor-shift and multiply, three times)."""
    x = x ^ (x >> np.uint64(32))
    x = x * _M
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xCA9B0A7E9C3D1F57)
    return x ^ (x >> np.uint64(32))


def spread(n: int, seed: int) -> np.ndarray:
    """n pseudo-random odd-or-even 64-bit values by rule, the same everywhere."""
    with np.errstate(over="ignore"):
        return mix(mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_GOLD) + np.uint64(seed)))


IS_SEP = np.zeros(256, bool)
IS_SEP[[0x20, *range(0x09, 0x0E)]] = True
_CASED = spread(256, 11)
_BYTE = _CASED.copy()
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_STEP = np.uint64(0xA24BAED4963EE407)
_POWERS = np.ones(1, np.uint64)
_SEGMENT = 1 << 20


def _powers(n: int) -> np.ndarray:
    """_STEP to the powers 0..n-1 modulo 2**64, kept and doubled as longer words come."""
    global _POWERS
    while len(_POWERS) < n:
        _POWERS = np.concatenate([_POWERS, _POWERS * (_POWERS[-1:] * _STEP)])
    return _POWERS


def _segment(data: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and hash of each word."""
    at = np.flatnonzero(~IS_SEP[data])
    if not at.size:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.empty(at.size, bool)
    first[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=first[1:])
    begin = np.flatnonzero(first)
    length = np.diff(begin, append=at.size)
    place = np.arange(at.size) - np.repeat(begin, length)
    value = values[data[at]] * _powers(int(length.max()))[place]
    return at[begin], length, mix(np.add.reduceat(value, begin) + length.astype(np.uint64) * np.uint64(_GOLD))


def word_spans(texts: list[bytes], cased: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts as one byte array; start, length and 64-bit hash of all words in it, in order; each text's bounds in them.

    cased keeps A-Z apart from a-z.
    """
    values = _CASED if cased else _BYTE
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, lengths, hashes, at = [], [], [], 0
    while at < data.size:
        end = min(at + _SEGMENT, data.size)
        while end < data.size:  # move the cut to just after a separator
            back = np.flatnonzero(IS_SEP[data[max(at, end - 4096) : end]])
            if back.size:
                end = max(at, end - 4096) + int(back[-1]) + 1
                break
            ahead = np.flatnonzero(IS_SEP[data[end : end + _SEGMENT]])
            end = end + int(ahead[0]) + 1 if ahead.size else min(end + _SEGMENT, data.size)
            if ahead.size:
                break
        s, n, h = _segment(data[at:end], values)
        starts.append(s + at)
        lengths.append(n)
        hashes.append(h)
        at = end
    start, length, word = (np.concatenate(x) for x in (starts, lengths, hashes))
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return data, start, length, word, np.searchsorted(start, np.concatenate([[0], np.cumsum(sizes)]))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, in order, and each text's bounds in them (len(texts)+1)."""
    _, _, _, word, bounds = word_spans(texts)
    return word, bounds


def shingle_sets(texts: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of `width` words.

    A text of fewer words has its whole sequence as one shingle; one without words has none.
    """
    h, bounds = word_hashes(texts)
    rolled = np.zeros(max(0, h.size - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * _STEP + h[k : k + rolled.size]
    rolled = mix(rolled + np.uint64(width))
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            x = np.zeros(1, np.uint64)
            for v in h[a:b]:
                x = x * _STEP + v
            out.append(mix(x + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
