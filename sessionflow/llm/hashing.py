"""64-bit hashes of words and of windows of words, for whole Arrow columns in numpy.

A hash mixes two polynomials of the contents: one modulo 2^64, and one modulo the prime 2^31 - 1. The first
alone has the same value for some structured words (Thue-Morse words and their complements) whatever
its base; the second has no such words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
PRIME, PRIME_BASE = (1 << 31) - 1, 1_234_567_891
SLICE_BYTES = 1 << 20


def separators(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of the bytes that separate words."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


SPACE = separators((0x20, 0x20), (0x09, 0x0D))
NO_WORD = separators((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    found = np.full(n, base, np.uint64)
    found[:1] = 1
    return np.multiply.accumulate(found)


def in_field(x: np.ndarray) -> np.ndarray:
    """Numbers modulo PRIME, up to a few more than it; two such numbers can be multiplied in 64 bits."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


def field_powers(base: int, n: int) -> np.ndarray:
    found = np.ones(1, np.uint64)
    while len(found) < n:  # the next as many are these times the power that follows them
        found = np.concatenate([found, in_field(found * np.uint64(pow(base, len(found), PRIME)))])
    return found[:n]


def tables(n: int) -> tuple[np.ndarray, ...]:
    """Powers of both bases and of their inverses."""
    inverse = pow(PRIME_BASE, -1, PRIME)
    return (
        powers(BASE, n),
        powers(pow(BASE, -1, 1 << 64), n),
        field_powers(PRIME_BASE, n),
        field_powers(inverse, n),
    )


_tables = tables(1)


def _powers_to(n: int) -> tuple[np.ndarray, ...]:
    global _tables
    if len(_tables[0]) < n:
        _tables = tables(1 << (n - 1).bit_length())
    return _tables


@dataclass
class Words:
    """Words of consecutive texts: hash, first and last byte, and where each text's words begin."""

    rows: slice
    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of values[start:end], equal for equal contents."""
    n = len(values)
    up, down, field_up, field_down = _powers_to(n + 1)
    own = values.astype(np.uint64) + np.uint64(1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(own * up[:n], out=total[1:])
    found = (total[ends] - total[starts]) * down[starts]
    own = own if values.itemsize < 4 else in_field(mixed(own))
    np.cumsum(in_field(own * field_up[:n]), out=total[1:])
    other = in_field(in_field(total[ends] - total[starts]) * field_down[starts])
    other %= np.uint64(PRIME)
    found = mixed(found + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mixed(found ^ other * np.uint64(0x9FB21C651E98DF25))


def words_of(texts: pa.Array, separator: np.ndarray, lower: bool) -> Iterator[Words]:
    """Words of all texts, some megabytes at a time. NULL has none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    everything = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        until = max(
            row + 1, int(np.searchsorted(offsets, offsets[row] + SLICE_BYTES, "right")) - 1
        )
        data = everything[offsets[row] : offsets[until]]
        if lower:
            data = LOWER[data]
        cuts = offsets[row : until + 1] - offsets[row]
        word = np.zeros(len(data) + 2, bool)
        word[1:-1] = ~separator[data]
        begins = word[1:] & ~word[:-1]
        stops = word[:-1] & ~word[1:]
        inner = cuts[1:-1]
        touching = inner[word[inner] & word[inner + 1]]  # a word cannot cross texts
        begins[touching] = True
        stops[touching] = True
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
        yield Words(
            slice(row, until),
            data,
            range_hashes(data, starts, ends),
            starts,
            ends,
            np.searchsorted(starts, cuts),
        )
        row = until


def windows(first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of every window of ``width`` words that lies in one text, and its text's number."""
    counts = np.maximum(np.diff(first) - width + 1, 0)
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][text] + at, text
