"""A causal self-attention model of token classes in numpy: training and scoring.

One head over a window of CONTEXT + SCORED inputs, of which the last SCORED are queries:

    h = E[c] + P + softmax(q k / sqrt(d), causal) v,   g = h + relu(h A + a) B,   logits = g O + o

With ``Subwords`` an input is E[c] and the vector of its id, and g also tells the ids of a class apart.

Windows overlap by CONTEXT inputs, so each token is scored once, with at least CONTEXT tokens before it
where the text has them. Windows of all texts are scored in one batch; a mask hides later
inputs and places before the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .subwords import Learner, Subwords, summed

CONTEXT, SCORED = 8, 16
WIDTH = CONTEXT + SCORED
DIMENSION, HIDDEN = 8, 16
WINDOWS_AT_ONCE = 256
#: Rate of the rows of ``Subwords``, as a multiple of the other parameters'.
ROW_RATE = 10
NAMES = ("E", "P", "Q", "K", "V", "A", "a", "B", "O", "o")

#: Query t (input CONTEXT + t) sees inputs up to its own.
CAUSAL = np.where(
    np.arange(WIDTH)[None, :] <= CONTEXT + np.arange(SCORED)[:, None], 0.0, -1e9
).astype(np.float32)


@dataclass
class Attention:
    """Parameters by name; class 0 stands before a text, the last input number is the mask."""

    parameters: dict[str, np.ndarray]

    @staticmethod
    def random(classes: int, seed: int) -> Attention:
        rng = np.random.default_rng(seed)
        d, shapes = DIMENSION, {
            "E": (classes + 1, DIMENSION), "P": (WIDTH, DIMENSION),
            "Q": (DIMENSION, DIMENSION), "K": (DIMENSION, DIMENSION), "V": (DIMENSION, DIMENSION),
            "A": (DIMENSION, HIDDEN), "a": (HIDDEN,), "B": (HIDDEN, DIMENSION),
            "O": (DIMENSION, classes), "o": (classes,),
        }
        scale = {"E": 0.5, "P": 0.1, "a": 0.0, "o": 0.0}
        return Attention(
            {
                n: (rng.standard_normal(s) * scale.get(n, d**-0.5)).astype(np.float32)
                for n, s in shapes.items()
            }
        )

    def forward(
        self, inputs: np.ndarray, vectors: np.ndarray | None = None
    ) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Logits of the queries of ``inputs`` (windows, WIDTH); -1 marks places before a text.
        ``vectors`` are those of the inputs' ids."""
        p = self.parameters
        rows = p["E"].take(inputs, axis=0)
        rows += p["P"]
        if vectors is not None:
            rows += vectors
        x, all_rows = rows[:, CONTEXT:], rows.reshape(-1, DIMENSION)
        scale = p["Q"].dtype.type(DIMENSION**-0.5)
        turned = all_rows @ np.hstack([p["K"], p["V"], p["Q"] * scale])
        keys, values, queries = _thirds(turned.reshape(*inputs.shape, -1))
        queries = queries[:, CONTEXT:]
        weights = queries @ keys.transpose(0, 2, 1)
        weights += CAUSAL
        first = np.flatnonzero(inputs[:, 0] < 0)  # only the first window of a text has hidden places
        if len(first):
            weights[first] += np.where(inputs[first] < 0, np.float32(-1e9), np.float32(0))[:, None, :]
        own = np.diagonal(weights[:, :, CONTEXT:], axis1=1, axis2=2)
        if weights.max(initial=0) > 60 or own.min(initial=0) < -60:  # else exp bears it
            weights -= weights.max(axis=2, keepdims=True)
        np.exp(weights, out=weights)
        total = weights.reshape(-1, WIDTH) @ np.ones(WIDTH, weights.dtype)
        mixed = (weights @ values).reshape(-1, DIMENSION)
        mixed /= total[:, None]
        flat = np.ones((DIMENSION + 1, len(mixed)), mixed.dtype)
        np.add(x.reshape(-1, DIMENSION).T, mixed.T, out=flat[:-1])
        inner = np.vstack([p["A"], p["a"]]).T @ flat
        np.maximum(inner, 0, out=inner)
        g = np.ones_like(flat)
        np.add(p["B"].T @ inner, flat[:-1], out=g[:-1])
        logits = np.vstack([p["O"], p["o"]]).T @ g
        return logits.T, {
            "keys": keys, "values": values, "queries": queries, "weights": weights, "total": total,
            "mixed": mixed, "flat": flat, "inner": inner, "g": g, "rows": rows,
        }

    def log_probability(
        self,
        inputs: np.ndarray,
        targets: np.ndarray,
        subwords: Subwords | None = None,
        numbers: np.ndarray | None = None,
        ids: np.ndarray | None = None,
    ) -> np.ndarray:
        """Natural log P(target class) of every query, flat. With ``subwords``, that of the target ``ids``;
        ``numbers`` are the input numbers."""
        vectors = None if subwords is None else subwords.before.take(numbers, axis=0)
        logits, t = self.forward(inputs, vectors)
        logits = logits.T
        logits -= logits.max(axis=0)
        chosen = logits.take(_places(targets))
        np.exp(logits, out=logits)
        chosen = chosen - np.log(logits.sum(axis=0))
        return chosen if subwords is None else chosen + subwords.log_probability(t["g"][:-1].T, ids.ravel())

    def gradients(
        self,
        inputs: np.ndarray,
        targets: np.ndarray,
        use: np.ndarray,
        subwords: Subwords | None = None,
        numbers: np.ndarray | None = None,
        ids: np.ndarray | None = None,
    ) -> dict[str, np.ndarray]:
        """Gradients of the mean negative log probability of the targets in ``use``.

        With ``subwords``, of that of the target ``ids``; ``numbers`` are the input numbers. Then ``before`` are
        the gradients by the inputs' vectors, ``summed`` their sums by input number, and ``nodes`` and ``tree``
        those by rows of the trees.
        """
        p = self.parameters
        logits, t = self.forward(inputs, None if subwords is None else subwords.before.take(numbers, axis=0))
        dtype, use = logits.dtype.type, use.ravel()
        dlogits = logits.T
        dlogits -= dlogits.max(axis=0)
        np.exp(dlogits, out=dlogits)
        each = dtype(1 / max(1, int(use.sum())))
        each_used = use * each
        dlogits *= each_used / dlogits.sum(axis=0)
        np.subtract.at(dlogits.reshape(-1), _places(targets), each_used)
        by_output = (dlogits @ t["g"].T).T
        found = {"O": by_output[:-1], "o": by_output[-1]}
        dg = (dlogits.T @ p["O"].T).T
        if subwords is not None:
            by_g, found["nodes"], by_tree = subwords.gradients(t["g"][:-1], ids.ravel(), use)
            dg += by_g * each
            by_tree *= each
            found["tree"] = by_tree
        found["B"] = t["inner"] @ dg.T
        dinner = p["B"] @ dg
        dinner *= t["inner"] > 0
        by_inner = t["flat"] @ dinner.T
        found["A"], found["a"] = by_inner[:-1], by_inner[-1]
        dg += p["A"] @ dinner
        dh_rows = np.ascontiguousarray(dg.T)
        dh = dh_rows.reshape(len(inputs), SCORED, DIMENSION)
        weights = t["weights"]
        weights /= t["total"].reshape(len(inputs), SCORED, 1)
        by_turned = np.zeros((*inputs.shape, 3 * DIMENSION), dh.dtype)
        dkeys, dvalues, dqueries = _thirds(by_turned)
        np.matmul(weights.transpose(0, 2, 1), dh, out=dvalues)
        dscores = dh @ t["values"].transpose(0, 2, 1)
        # what the softmax takes off is the mean of a query's row by its weights
        mean = (dh_rows * t["mixed"]) @ np.ones(DIMENSION, dtype)
        dscores -= mean.reshape(len(inputs), SCORED, 1)
        dscores *= weights
        np.matmul(dscores, t["keys"], out=dqueries[:, CONTEXT:])
        np.matmul(dscores.transpose(0, 2, 1), t["queries"], out=dkeys)
        by_turned = by_turned.reshape(-1, 3 * DIMENSION)
        rows, scale = t["rows"].reshape(-1, DIMENSION), dtype(DIMENSION**-0.5)
        found["K"], found["V"], found["Q"] = _thirds(rows.T @ by_turned)
        found["Q"] = found["Q"] * scale
        by_input = by_turned @ np.hstack([p["K"], p["V"], p["Q"] * scale]).T
        dx = by_input.reshape(t["rows"].shape)
        dx[:, CONTEXT:] += dh
        found["P"] = dx.sum(axis=0)
        row, values = inputs.ravel(), by_input
        if subwords is not None:
            found["before"] = by_input
            number, values, n = found["summed"] = summed(numbers.ravel(), by_input)
            class_of = np.zeros(len(subwords.before), row.dtype)
            class_of[numbers.ravel()] = row
            row = class_of.take(number)
        size = len(p["E"])
        row = np.where(row < 0, size - 1, row)
        found["E"] = np.stack(
            [np.bincount(row, weights=column, minlength=size) for column in values.T], axis=1
        ).astype(dtype)
        return found

    def copy(self) -> Attention:
        return Attention({n: v.copy() for n, v in self.parameters.items()})

    def flat(self) -> np.ndarray:
        """All parameters, one after the other."""
        return np.concatenate([self.parameters[n].ravel() for n in NAMES])

    def from_flat(self, values: np.ndarray) -> Attention:
        """A model of the same shapes with these parameters."""
        return Attention(self.views(values.astype(np.float32)))

    def views(self, values: np.ndarray) -> dict[str, np.ndarray]:
        """Parts of ``values`` by the names of the parameters."""
        ends = np.cumsum([self.parameters[n].size for n in NAMES])
        parts = zip(NAMES, np.split(values, ends[:-1]))
        return {n: x.reshape(self.parameters[n].shape) for n, x in parts}

    def train(
        self,
        inputs: np.ndarray,
        targets: np.ndarray,
        batches: np.ndarray,
        rates: np.ndarray,
        subwords: Subwords | None = None,
        numbers: np.ndarray | None = None,
        ids: np.ndarray | None = None,
    ) -> tuple[Learner, Learner] | None:
        """Adam on batches of windows, a row of ``batches`` each; targets below 0 are no tokens. The rows
        of ``subwords`` are trained with it, and their learners returned."""
        flat = self.flat()
        self.parameters = self.views(flat)
        first, second = np.zeros_like(flat), np.zeros_like(flat)
        learners = None if subwords is None else (Learner(subwords.before), Learner(subwords.tree))
        for step, (rows, rate) in enumerate(zip(batches, rates.tolist()), 1):
            own = targets.take(rows, axis=0)
            use = own >= 0
            more = ()
            if subwords is not None:
                more = (subwords, numbers.take(rows, axis=0), ids.take(rows, axis=0))
            grads = self.gradients(inputs.take(rows, axis=0), np.maximum(own, 0), use, *more)
            if learners is not None:
                n = np.float32(use.sum())
                for learner, (at, by, met) in (
                    (learners[0], grads["summed"]),
                    (learners[1], summed(grads["nodes"], grads["tree"])),
                ):
                    learner.step(at, by * n, met, ROW_RATE * rate)
            grad = np.concatenate([grads[n].ravel() for n in NAMES])
            first = 0.9 * first + 0.1 * grad
            second = 0.99 * second + 0.01 * grad * grad
            step_by = first / (1 - 0.9**step)
            flat -= (rate * step_by / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return learners


def _thirds(rows: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(rows[..., at : at + DIMENSION] for at in range(0, 3 * DIMENSION, DIMENSION))


def _places(targets: np.ndarray) -> np.ndarray:
    """Where the class of each query is among logits that are given by classes."""
    return targets.ravel().astype(np.int64) * targets.size + np.arange(targets.size)


def window_count(first: np.ndarray) -> int:
    return int((-(-np.diff(first) // SCORED)).sum())


def windows_of(
    classes: np.ndarray, first: np.ndarray, chosen: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Inputs and targets of all texts, or of the ``chosen`` windows: text k is
    classes[first[k]:first[k + 1]].

    Inputs are -1 before the text and 0 at its beginning; targets are places in ``classes``, or -1.
    """
    size = np.diff(first)
    count = -(-size // SCORED)
    before = np.cumsum(count) - count
    chosen = np.arange(count.sum()) if chosen is None else chosen
    text = np.repeat(np.arange(len(size)), count).take(chosen)
    number = chosen - before.take(text)
    begin = first.take(text) + number * SCORED
    heads, tails = np.flatnonzero(number == 0), np.flatnonzero(number == count.take(text) - 1)
    last = first[1:].take(text[tails])[:, None] - 1
    targets = begin[:, None] + np.arange(SCORED)
    source = begin[:, None] + np.arange(-CONTEXT - 1, SCORED - 1)
    source[tails] = np.minimum(source[tails], last - 1)
    targets[tails] = np.where(targets[tails] <= last, targets[tails], -1)
    inputs = classes.take(source, mode="clip")
    inputs[heads, :CONTEXT] = -1
    inputs[heads, CONTEXT] = 0
    return inputs, targets


def scores(
    model: Attention, classes: np.ndarray, first: np.ndarray, subwords: Subwords | None = None,
    of: np.ndarray | None = None,
) -> np.ndarray:
    """Natural log probability of the class of every token of all texts. With ``subwords`` and the classes
    ``of`` all ids, that of every token, which are then given as ids."""
    found = np.zeros(len(classes), np.float64)
    size = np.diff(first)
    count = -(-size // SCORED)
    begin = 0
    upto = np.cumsum(count)
    read = classes
    if subwords is not None:
        read, class_of = classes + 1, input_classes(of)
    while begin < len(size):
        end = max(
            begin + 1,
            int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + 32 * WINDOWS_AT_ONCE, "right")),
        )
        inputs, targets = windows_of(read, first[begin : end + 1])
        for at in range(0, len(inputs), WINDOWS_AT_ONCE):
            some = targets[at : at + WINDOWS_AT_ONCE]
            real = some.ravel() >= 0
            own, numbers, more = classes.take(np.maximum(some, 0)), inputs[at : at + WINDOWS_AT_ONCE], ()
            if subwords is not None:
                more = (subwords, numbers, own)
                numbers, own = class_of.take(numbers), of.take(own)
            values = model.log_probability(numbers, own, *more)
            found[some.ravel()[real]] = values[real]
        begin = end
    return found


def input_classes(of: np.ndarray) -> np.ndarray:
    """Class by input number: that of a text's beginning, those ``of`` all ids, the mask."""
    return np.concatenate([[0], of, [-1]])
