"""Hashed word shingles of whole texts, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

WORDS = 5
SLICE_BYTES = 2_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_RANDOM = np.random.default_rng(20_240_501)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sort_within(values: np.ndarray, sizes: np.ndarray) -> None:
    """Sort each stretch of ``values`` in place; the stretches follow one another and have the given sizes."""
    start = 0
    for stop in np.cumsum(sizes).tolist():
        if stop - start > 1:
            values[start:stop].sort()
        start = stop


def _words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes other than ASCII white space), and how many words precede each text."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    space = _SPACE[data]
    edge = np.ones(len(data), bool)
    edge[1:] = space[:-1]
    edge[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(edge & ~space)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(bounds), np.int64)
    lengths = np.diff(np.append(starts, len(data)))
    at = np.arange(len(data)) - np.repeat(np.append(0, starts), np.append(starts[0], lengths))
    # A sum of powers is the same for some pairs of long words whatever the base; a mixed number per byte and place is not.
    terms = np.where(space, np.uint64(0), mixed(_BYTES[_LOWER[data]] + at.astype(np.uint64) * _BASE))
    return mixed(np.add.reduceat(terms, starts)), np.searchsorted(starts, bounds)


def _distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, shingle hash), distinct and sorted, of a slice of texts without nulls."""
    texts = pa.concat_arrays([texts.cast(pa.large_binary())])
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if raw is not None else np.zeros(0, np.uint8)
    words, before = _words(data, bounds - bounds[0])
    counts = np.diff(before)
    n = np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))
    owner = np.repeat(np.arange(len(counts)), n)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(before[:-1], n)
    size = np.minimum(counts, WORDS)[owner]
    hashes = size.astype(np.uint64)
    padded = np.append(words, np.zeros(WORDS, np.uint64))
    for step in range(WORDS):
        hashes += np.where(size > step, padded[first + step] * _STEPS[step], np.uint64(0))
    hashes = mixed(hashes)
    sort_within(hashes, n)
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[new], hashes[new]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Each batch (with a column ``text``) in slices of bounded text, with (row of the slice, distinct shingle hash)."""
    for batch in batches:
        sizes = np.array(pa.compute.binary_length(batch["text"]).to_numpy(zero_copy_only=False), np.int64)
        part = np.cumsum(sizes) // SLICE_BYTES
        cuts = np.append(np.flatnonzero(np.diff(part)) + 1, len(sizes))
        start = 0
        for stop in cuts.tolist():
            if stop > start:
                piece = batch.slice(start, stop - start)
                yield piece, *_distinct(piece["text"])
            start = stop
