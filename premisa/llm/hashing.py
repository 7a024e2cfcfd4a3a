"""Vectorised hashes of words and byte strings inside texts held in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; arrays of eight bytes for each of them are held.
WORK_BYTES = 1 << 21

# An odd multiplier, its inverse modulo 2**64, and the constants of a published 64-bit finaliser.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    held = _powers.get(base)
    if held is None or len(held) < n:
        size = 1 << max(16, (n - 1).bit_length())
        held = np.full(size, base, dtype=np.uint64)
        held[0] = 1
        with np.errstate(over="ignore"):
            held = np.multiply.accumulate(held)
        _powers[base] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
        x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
        return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """s with s[b] - s[a] a polynomial of data[a:b], shifted by a."""
    with np.errstate(over="ignore"):
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each byte string data[start:end], whatever its place."""
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each text the number of its first word (one more entry than texts)."""
    space = _SPACE[data]
    before = np.ones(len(data) + 1, dtype=bool)  # a word may start here
    before[1:] = space
    before[offsets] = True
    after = np.ones(len(data) + 1, dtype=bool)  # a word may end before this place
    after[:-1] = space
    after[offsets] = True
    starts = np.flatnonzero(~space & before[:-1])
    ends = np.flatnonzero(~space & after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def parts(texts: pa.Array, size: int = WORK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, offsets) for runs of texts of about ``size`` bytes; a null is an empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, dtype=np.uint8) if whole is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n neighbours in an array of word hashes (across texts too; the caller picks)."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        out = words[: len(words) - n + 1].copy()
        for i in range(1, n):
            out = out * np.uint64(BASE) + words[i : len(words) - n + 1 + i]
    return mix(out)
