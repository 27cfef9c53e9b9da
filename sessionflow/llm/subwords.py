"""What single ids add to the classes of the attention model.

Every id has a vector of its own, added to that of its class where it is an input. Every class of more
than one id ends in a Huffman tree of its ids: P(id | class, context) is the product of the turns on the way
to it, each a logistic function of the model's last layer g. So context tells ids of one class apart at the
cost of their code lengths, not of the vocabulary. Trees start with the counts' shares as biases.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np


def _paths(of: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, nodes, turns, odds): id k turns ``turns[first[k]:first[k + 1]]`` at those nodes; a turn of 1
    has ``odds`` (log) by the weights."""
    size = len(of)
    above, turn, odds = np.full(2 * size, -1), np.zeros(2 * size, np.int8), []
    order = np.argsort(of, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        heap = [(float(weight[k]), int(k)) for k in own]
        heapq.heapify(heap)
        while len(heap) > 1:
            (a, left), (b, right) = heapq.heappop(heap), heapq.heappop(heap)
            node = size + len(odds)
            above[left] = above[right] = node
            turn[left], turn[right] = 1, -1
            odds.append(np.log(a / b))
            heapq.heappush(heap, (a + b, node))
    nodes, turns, now = [], [], np.arange(size)
    while (above[now] >= 0).any():
        turns.append(np.where(above[now] >= 0, turn[now], 0))
        nodes.append(above[now] - size)
        now = np.where(above[now] >= 0, above[now], now)
    turns = np.array(turns, np.int8).reshape(len(nodes), size).T
    nodes = np.array(nodes, np.int64).reshape(len(turns.T), size).T
    first = np.concatenate([[0], np.cumsum((turns != 0).sum(axis=1))])
    return first, nodes[turns != 0], turns[turns != 0].astype(np.float32), np.array(odds)


def summed(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different ``rows``, the sums of their ``values``, and how often each is there."""
    order = np.argsort(rows, kind="stable")
    ordered = rows[order]
    begin = np.flatnonzero(np.concatenate([[len(rows) > 0], ordered[1:] != ordered[:-1]])[: len(rows)])
    if not len(begin):
        return begin, values[:0], begin
    return (
        ordered[begin].astype(np.int64),
        np.add.reduceat(values.take(order, axis=0), begin, axis=0),
        np.diff(np.append(begin, len(rows))),
    )


class Learner:
    """Adagrad on the rows of a table that a step has gradients of; how often each was visited."""

    def __init__(self, table: np.ndarray) -> None:
        self.table, self.squares = table, np.ones_like(table)
        self.visits = np.zeros(len(table), np.int64)

    def step(self, use: np.ndarray, total: np.ndarray, n: np.ndarray, rate: float) -> None:
        """``total``: summed gradients of the rows ``use``, met ``n`` times each."""
        self.visits[use] += n
        squares = self.squares.take(use, axis=0) + total * total
        self.squares[use] = squares
        self.table[use] -= np.float32(rate) * total / np.sqrt(squares)


@dataclass
class Subwords:
    """``before``: vectors by input number, which is an id plus one. ``tree``: vector and bias by node."""

    before: np.ndarray
    tree: np.ndarray
    first: np.ndarray
    nodes: np.ndarray
    turns: np.ndarray

    def __post_init__(self) -> None:
        self.length = np.diff(self.first)
        self.length = self.length.astype(np.min_scalar_type(self.length.max(initial=0)))

    @staticmethod
    def of_counts(of: np.ndarray, weight: np.ndarray, dimension: int) -> Subwords:
        """Trees of the classes ``of`` all ids by their weights; vectors begin as zeros."""
        first, nodes, turns, odds = _paths(of, weight)
        tree = np.zeros((len(odds), dimension + 1), np.float32)
        tree[:, -1] = odds
        # the least type sorts fastest
        nodes = nodes.astype(np.min_scalar_type(max(1, len(odds))))
        return Subwords(np.zeros((len(of) + 2, dimension), np.float32), tree, first, nodes, turns)

    def copy(self) -> Subwords:
        return Subwords(self.before.copy(), self.tree.copy(), self.first, self.nodes, self.turns)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.before.ravel(), self.tree.ravel()])

    def from_flat(self, values: np.ndarray) -> Subwords:
        before, tree = np.split(values.astype(np.float32), [self.before.size])
        return Subwords(
            before.reshape(self.before.shape), tree.reshape(self.tree.shape),
            self.first, self.nodes, self.turns,
        )

    def turned(self, g: np.ndarray, ids: np.ndarray, use: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """Every turn of every id in ``use``: ids with more turns come first in ``order``, and turn d of the
        ``counts[d]`` ids that have it follows turn d - 1. (order, counts, its node, the turn, the log odds
        of taking it, columns of ``g``, a last row of ones below, and of the tree there)."""
        length = self.length.take(ids)
        if use is not None:
            length *= use
        order = np.argsort(np.iinfo(length.dtype).max - length, kind="stable")
        counts = len(ids) - np.cumsum(np.bincount(length))[:-1]
        begin = self.first.take(ids.take(order[: counts[0]] if len(counts) else order[:0]))
        at = np.concatenate([begin[:0], *(begin[:n] + d for d, n in enumerate(counts))])
        own = np.ones((g.shape[0] + 1, len(begin)), g.dtype)
        own[:-1] = np.ascontiguousarray(g.T).take(order[: len(begin)], axis=0).T
        seen = np.concatenate([own[:, :0], *(own[:, :n] for n in counts)], axis=1)
        nodes, turns = self.nodes.take(at), self.turns.take(at)
        rows = np.ascontiguousarray(self.tree.take(nodes, axis=0).T)
        z = (seen * rows).sum(axis=0)
        z *= turns
        return order, counts, nodes, turns, z, seen, rows

    def log_probability(self, g: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log P(id | class, context) of each row of ``g``."""
        order, counts, _, _, z, *_ = self.turned(g.T, ids)
        value = np.minimum(z, 0) - np.log(1 + np.exp(-np.abs(z)))
        found = np.empty(len(ids))
        found[order] = _by_turns(value, counts, len(ids))
        return found

    def gradients(
        self, g: np.ndarray, ids: np.ndarray, use: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(by g, nodes, by the rows of the tree at these nodes): of the summed negative
        ``log_probability`` of the ids in ``use``, by columns of ``g``."""
        order, counts, nodes, turns, z, seen, rows = self.turned(g, ids, use)
        by_z = -turns / (1 + np.exp(np.minimum(z, 80)))
        rows *= by_z
        seen *= by_z
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        by_g = np.ascontiguousarray(_by_turns(rows[:-1], counts, len(ids)).T)
        return by_g.take(place, axis=0).T, nodes, np.ascontiguousarray(seen.T)


def _by_turns(values: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Sums over the turns of each id, in the order of ``Subwords.turned``."""
    total, at = np.zeros((*values.shape[:-1], size), values.dtype), 0
    for n in counts.tolist():
        total[..., :n] += values[..., at : at + n]
        at += n
    return total
