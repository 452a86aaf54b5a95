"""Vectorised words and hashes over the flat bytes of many texts."""

from __future__ import annotations

from functools import cached_property

import numpy as np

from .util import mix64

_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Words are hashed so many bytes at a time (a longer one alone): the powers are those of a block, and a block stays in the processor's cache.
BLOCK = 1 << 15
WINDOWS = 1 << 13


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(1, n), base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def white(data: np.ndarray) -> np.ndarray:
    """Whether each byte is white space: 0x20, or 0x09 to 0x0D."""
    return (data == 0x20) | (data - np.uint8(9) < 5)  # bytes below 9 wrap around


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (a run of other than white space), and the first word of each text (n + 1)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~white(data)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = offsets[:-1]
    edge = edge[edge < len(data)]
    begin[edge] = inside[edge]  # a text's first byte begins a word though the text before ends in one
    starts = np.flatnonzero(begin)
    last = inside.copy()
    last[:-1] &= begin[1:] | ~inside[1:]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word's bytes: a polynomial in the byte's place within the word, from sums over a block. Words stand in order."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(BLOCK), powers(BLOCK, _INVERSE)
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        stop = max(first + 1, int(np.searchsorted(ends, base + BLOCK, side="right")))
        size = int(ends[stop - 1]) - base
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE.take(data[base : base + size], mode="wrap") * (up[:size] if size <= BLOCK else powers(size)), out=sums[1:])
        at = starts[first:stop] - base
        out[first:stop] = (sums[ends[first:stop] - base] - sums[at]) * down[at]
        first = stop
    return mix64(out + (ends - starts).astype(np.uint64))


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes (order matters); len(h) - k + 1 of them."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    step = np.uint64(1)
    for j in range(k):
        out += h[j : j + n] * step
        step = np.uint64((int(step) * int(_STEP)) & (2**64 - 1))
    return mix64(out)


def window_hashes(h: np.ndarray, size: int, salt: int, step: int, start: np.ndarray) -> np.ndarray:
    """Hash of `size` consecutive word hashes from each chosen start (order matters; an odd step), at one price for any size. Starts ascend."""
    up, down = powers(WINDOWS + size, np.uint64(step)), powers(WINDOWS, np.uint64(pow(step, -1, 2**64)))
    out = np.empty(len(start), np.uint64)
    first = 0
    while first < len(start):
        base = int(start[first])
        stop = int(np.searchsorted(start, base + WINDOWS))
        part = mix64(h[base : base + WINDOWS + size - 1] ^ np.uint64(salt))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        at = start[first:stop] - base
        out[first:stop] = (sums[at + size] - sums[at]) * down[at]
        first = stop
    return mix64(out)


class Line:
    """The words of many texts on one line, each followed by one space."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        inside = np.zeros(len(self.data) + 1, bool)
        np.logical_not(white(self.data), out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])  # a space follows every text, so that words begin and end by turns
        self.starts, self.ends = edges[::2].copy(), edges[1::2].copy()
        #: the first word of each text (n + 1), and where each word begins in `text` (n + 1)
        self.first = np.searchsorted(self.starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        self.at = memoryview(np.concatenate([[0], np.cumsum(self.ends - self.starts + 1)]))

    @cached_property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    @cached_property
    def text(self) -> bytes:
        gap = white(self.data)
        data = np.where(gap, np.uint8(0x20), self.data)
        if self.at[-1] < len(data):
            gap[self.ends] = False
            data = data[~gap]
        return data.tobytes()

    def spaced(self, start: int, stop: int) -> bytes:
        """Words [start, stop), a space after each."""
        return self.text[self.at[start] : self.at[stop]]

    def words(self, start: int, stop: int) -> bytes:
        """Words [start, stop), joined by one space."""
        return self.spaced(start, stop)[:-1]

    def holds(self, spaced: bytes, start: int) -> bool:
        """Whether given words, a space after each, stand at word `start`."""
        return self.text.startswith(spaced, self.at[start])


def places_of(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    """For each hash its place among the known ones, which ascend; len(known) if it is not there. The first bits of a hash tell about where it is."""
    bits = len(known).bit_length() + 2
    counts = np.bincount((known >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    bound = np.append(known, ~np.uint64(0))
    at = (np.cumsum(counts) - counts)[h >> np.uint64(64 - bits)]
    for _ in range(int(counts.max())):
        at += bound[at] < h
    return np.where(bound[at] == h, at, len(known))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    up = (data >= 65) & (data <= 90)
    return np.where(up, data + np.uint8(32), data)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles, lower-cased; fewer words: the whole sequence as one."""
    data = lower_ascii(data)
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    grams = gram_hashes(h, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(grams[a : b - k + 1]))
        elif b > a:
            whole = h[a:b] * powers(b - a, _STEP)
            out.append(mix64(np.array([int(whole.sum(dtype=np.uint64)) ^ (b - a)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
