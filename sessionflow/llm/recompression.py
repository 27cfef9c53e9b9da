"""Locally consistent parsing of word sequences: rounds that name runs and pairs.

A round first replaces every maximal run of equal symbols by the name of (symbol, length), then every
pair of a left and a right symbol by the name of the pair; a bit of a symbol's hash makes it left or
right in that round. Names are hashes of what they stand for, hence the same in all tasks.

Each symbol carries its context, the words that decided on it: a run or a symbol that is none needs its
neighbours, a left symbol that found no partner needs its right one, and so on. A symbol whose
context lies in a window of words stands at the same place in every equal window, whatever is around.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .hashing import mixed

FAR = 1 << 40


@dataclass
class Symbols:
    """Symbols of one round: name, the words of the context [low, high), text and weight."""

    name: np.ndarray
    low: np.ndarray
    high: np.ndarray
    text: np.ndarray
    weight: np.ndarray  # bytes of its words


def salted(x: np.ndarray, salt: int) -> np.ndarray:
    return mixed(x + np.uint64((salt * 0xA24BAED4963EE407) & ((1 << 64) - 1)))


def start(hashes: np.ndarray, first: np.ndarray, weights: np.ndarray) -> Symbols:
    at = np.arange(len(hashes))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return Symbols(hashes, at, at + 1, text, weights)


def name_runs(x: Symbols) -> Symbols:
    n = len(x.name)
    begins = np.ones(n, bool)
    begins[1:] = (x.name[1:] != x.name[:-1]) | (x.text[1:] != x.text[:-1])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], n) - 1
    length = (last - first + 1).astype(np.uint64)
    name = x.name[first]
    run = length > 1
    name = np.where(run, mixed(salted(name, 1) + length), name)
    text = x.text[first]
    low, high = np.full(len(first), -FAR), np.full(len(first), FAR)
    joined = text[1:] == text[:-1]
    low[1:] = np.where(joined, x.low[last[:-1]], -FAR)
    high[:-1] = np.where(joined, x.high[first[1:]], FAR)
    return Symbols(name, low, high, text, np.add.reduceat(x.weight, first))


def name_pairs(x: Symbols, level: int) -> Symbols:
    n = len(x.name)
    left = (salted(x.name, 1 + level) >> np.uint64(40)) & np.uint64(1) == 1
    joined = np.zeros(n + 1, bool)  # with the symbol before
    joined[1:n] = x.text[1:] == x.text[:-1]
    merges = np.zeros(n + 1, bool)  # with the symbol before
    merges[1:n] = joined[1:n] & left[:-1] & ~left[1:]
    low = x.low.copy()
    high = x.high.copy()
    before = np.concatenate([[-FAR], x.low[:-1]])
    after = np.concatenate([x.high[1:], [FAR]])
    alone_right, alone_left = ~left & ~merges[:n], left & ~merges[1:]
    low[alone_right] = np.where(joined[:n], before, -FAR)[alone_right]
    high[alone_left] = np.where(joined[1:], after, FAR)[alone_left]
    kept = np.flatnonzero(~merges[:n])
    pair = merges[kept + 1]
    second = np.minimum(kept + 1, n - 1)
    name = np.where(
        pair, mixed(salted(x.name[kept], 2) ^ (x.name[second] * np.uint64(3))), x.name[kept]
    )
    weight = x.weight[kept] + np.where(pair, x.weight[second], 0)
    return Symbols(
        name, low[kept], np.where(pair, x.high[second], high[kept]), x.text[kept], weight
    )


@dataclass
class Anchors:
    """Ranges of consecutive windows (numbered by their first words) with one anchor each."""

    name: np.ndarray
    window: np.ndarray
    count: np.ndarray
    low: np.ndarray
    high: np.ndarray


def anchors(
    hashes: np.ndarray, first: np.ndarray, weights: np.ndarray, width: int, rounds: int
) -> Anchors:
    """Anchor of every window of ``width`` words.

    That is a symbol of the highest round with its context in the window, among them the heaviest
    (long words are rare), then that of the greatest hash, then the leftmost. Words are symbols of
    round 0, so every window has one. More rounds than two leave symbols of 20 words no room.
    """
    n = len(hashes)
    windows = np.maximum(np.diff(first) - width + 1, 0)
    full = windows > 0
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, first[:-1][full], 1)
    np.add.at(change, (first[:-1] + windows)[full], -1)
    waits = np.cumsum(change) > 0
    levels = [start(hashes, first, weights)]
    for _ in range(rounds if waits.any() else 0):
        levels.append(name_pairs(name_runs(levels[-1]), len(levels)))
    chosen = np.zeros((3, n + 1), np.int64)
    done = np.zeros(n + 1, bool)
    for x in reversed(levels):
        waiting = np.concatenate([[0], np.cumsum(waits)])
        near = np.flatnonzero(x.high - x.low <= width)
        begin = np.maximum(x.high[near] - width, 0)
        near = near[waiting[x.low[near] + 1] > waiting[begin]]
        # in order of preference: what is written last is best
        near = near[np.lexsort((-x.low[near], salted(x.name[near], 3), x.weight[near]))]
        rank = np.full(n + 1, -1, np.int64)
        low, order = x.low[near], np.arange(len(near))
        reach = width - (x.high[near] - low)
        for back in range(int(reach.max(initial=-1)) + 1):
            use = (reach >= back) & (low >= back)
            here = np.full(n + 1, -1, np.int64)
            here[low[use] - back] = order[use]
            np.maximum(rank, here, out=rank)
        take = waits & (rank >= 0)
        best = near[rank[take]]
        chosen[:, take] = x.name[best].view(np.int64), x.low[best], x.high[best]
        done |= take
        waits &= ~take
    at = np.flatnonzero(done)
    begins = np.ones(len(at), bool)
    begins[1:] = (chosen[:, at[1:]] != chosen[:, at[:-1]]).any(axis=0) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(begins)
    name, low, high = chosen[:, at[begin]]
    return Anchors(
        name.view(np.uint64), at[begin], np.diff(np.append(begin, len(at))), low, high
    )
