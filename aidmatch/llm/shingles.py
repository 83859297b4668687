"""Word shingles of a text as sorted arrays of 64-bit hashes, by numpy over the bytes of the text."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
#: Bytes hashed at once, up to the next white space.
CHUNK = 1 << 20
#: Longer words are hashed by a digest, so that tables of powers stay small.
LONG_WORD = 4096

_U = np.uint64
_chance = np.random.Generator(np.random.PCG64(20))
_BYTE = _chance.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_PLACE = _chance.integers(1, 1 << 63, WORDS, dtype=np.uint64) | _U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables(size: int):
    global _powers, _inverse
    if len(_powers) < size:
        size = max(size, 1 << 16)
        steps = np.full(size, _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps)
        steps[1:] = pow(int(_BASE), -1, 1 << 64)
        _inverse = np.cumprod(steps)


def _hashes(data: bytes) -> np.ndarray:
    """A hash of every word of a piece that starts and ends between words."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_SPACE[raw]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    _tables(len(raw))
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * _powers[:len(raw)], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * _inverse[starts] + (ends - starts).astype(np.uint64) * _PLACE[0])
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        words[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]], digest_size=8).digest(), "little")
    return words


def word_hashes(text: str) -> np.ndarray:
    """A hash of every word, A-Z as lower case; words are runs of anything but space and 0x09 to 0x0D."""
    data = text.encode("utf-8", "surrogatepass").lower()  # bytes lower only A-Z
    if len(data) <= CHUNK:
        return _hashes(data)
    parts, at = [], 0
    while at < len(data):
        end = at + CHUNK
        while end < len(data):
            gap = np.flatnonzero(_SPACE[np.frombuffer(data[end:end + 4096], dtype=np.uint8)])
            if len(gap):
                end += int(gap[0])
                break
            end += 4096
        parts.append(_hashes(data[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(text: str, width: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of up to five words; of a shorter text its whole sequence as one, of no words none."""
    words = word_hashes(text)
    if not len(words):
        return words
    if len(words) < width:
        return mix((words * _PLACE[:len(words)]).sum(keepdims=True) + _U(len(words)))
    n = len(words) - width + 1
    sums = words[:n] * _PLACE[0]
    for k in range(1, width):
        sums += words[k:k + n] * _PLACE[k]
    return np.unique(mix(sums))
