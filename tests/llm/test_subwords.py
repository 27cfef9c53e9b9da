"""Context tells every id from the others, not only classes of ids."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from cases import documents

from sessionflow.llm import attention, attention_lm
from sessionflow.llm.bpe import byte_bpe
from sessionflow.llm.queries import BYTE_RANKS
from sessionflow.llm.subwords import Subwords


def small(seed=0):
    rng = np.random.default_rng(seed)
    of = np.array([2, 3, 3, 3, 3, 4, 4, 4, 1])
    weight = rng.integers(1, 50, len(of)) + 0.5
    subwords = Subwords.of_counts(of, weight, attention.DIMENSION)
    return of, weight, subwords, rng


def test_trees_start_with_the_shares_of_the_counts():
    of, weight, subwords, rng = small()
    ids = np.arange(len(of))
    g = rng.standard_normal((len(of), attention.DIMENSION))
    share = weight / np.bincount(of, weights=weight)[of]
    assert np.allclose(subwords.log_probability(g, ids), np.log(share), atol=1e-5)


def test_every_context_has_a_distribution_over_all_ids():
    of, weight, subwords, rng = small()
    model = attention.Attention.random(5, 1)
    subwords.before = rng.standard_normal(subwords.before.shape).astype(np.float32)
    subwords.tree = rng.standard_normal(subwords.tree.shape).astype(np.float32)
    text = np.array([1, 5, 3, 2, 7])
    given = []
    for last in range(len(of)):
        ids = np.append(text, last)
        given.append(attention.scores(model, ids, np.array([0, len(ids)]), subwords, of)[-1])
    other = text.copy()
    other[-1] = 6  # of the same class as 7
    ids = np.append(other, 3)
    elsewhere = attention.scores(model, ids, np.array([0, len(ids)]), subwords, of)[-1]
    # class 0 stands before texts only and keeps its share
    assert 0 < np.exp(given).sum() < 1
    logits, _ = model.forward(*_last(model, np.append(text, 0), subwords, of))
    share = np.exp(logits - logits.max())
    share = share[len(text)] / share[len(text)].sum()
    assert np.exp(given).sum() == pytest.approx(1 - share[0], abs=1e-5)
    assert abs(elsewhere - given[3]) > 1e-3


def _last(model, ids, subwords, of):
    numbers, _ = attention.windows_of(ids + 1, np.array([0, len(ids)]))
    return attention.input_classes(of)[numbers], subwords.before[numbers]


def test_gradients():
    of, weight, subwords, rng = small()
    model = attention.Attention.random(5, 1)
    model.parameters = {k: v.astype(np.float64) for k, v in model.parameters.items()}
    subwords.before = rng.standard_normal(subwords.before.shape)
    subwords.tree = rng.standard_normal(subwords.tree.shape)
    subwords.turns = subwords.turns.astype(np.float64)
    ids, first = rng.integers(0, len(of), 60), np.array([0, 25, 60])
    numbers, places = attention.windows_of(ids + 1, first)
    inputs, use = attention.input_classes(of)[numbers], places >= 0
    own = ids[np.maximum(places, 0)]

    def loss():
        return -attention.scores(model, ids, first, subwords, of).mean()

    grads = model.gradients(inputs, of[own], use, subwords, numbers, own)
    before, tree = np.zeros_like(subwords.before), np.zeros_like(subwords.tree)
    np.add.at(before, numbers.ravel(), grads["before"])
    np.add.at(tree, grads["nodes"], grads["tree"])
    for table, found in [
        *((model.parameters[n], grads[n]) for n in attention.NAMES),
        (subwords.before, before),
        (subwords.tree, tree),
    ]:
        for _ in range(3):
            at = tuple(int(rng.integers(0, s)) for s in table.shape)
            table[at] += 1e-5
            up = loss()
            table[at] -= 2e-5
            down = loss()
            table[at] += 1e-5
            assert (up - down) / 2e-5 == pytest.approx(float(found[at]), abs=1e-6)


def test_context_tells_ids_of_one_class_apart(spark, monkeypatch):
    """Rare words in fixed pairs: classes alone cannot know the second one."""
    monkeypatch.setattr(attention_lm, "STEPS", 240)
    path, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    rng = np.random.default_rng(1)
    filler = [f" {chr(97 + k)}" for k in range(26)] + [" the", " of", " and", " to", " in", " is"]
    pairs = [" river water", " garden flower", " school teacher", " music guitar"]
    mixed = [" river flower", " garden teacher", " school guitar", " music water"]

    def text(some):
        parts = rng.choice(filler, 60).tolist()
        for _ in range(12):
            parts.insert(int(rng.integers(0, len(parts))), some[int(rng.integers(0, 4))])
        return "".join(parts)

    docs = [(k, text(pairs)) for k in range(800)]
    tail = "".join(p for p in pairs)
    swapped = "".join(p for p in mixed)
    docs += [(10_001, tail), (10_002, swapped)]
    rows = attention_lm.lm_scores(documents(spark, docs), path, pattern).collect()
    score = {r.doc_id: r.score for r in rows}
    assert score[10_001] > score[10_002] + 1


def test_units_of_texts_are_encoded_once_and_as_whole_texts():
    bpe = byte_bpe(public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    rng = np.random.default_rng(2)
    parts = [
        "a", "Bc", "'s", "'", " ", "  ", "\n", "\r\n", "\t", "\x85", "\xa0", " ", " ", "　", "\x1c",
        "é", "ж", "中文", "12", "٢", ".", "!?", "€", "\U0001f600", "​", "the", "А", "\0",
    ]
    texts = [None, "", " ", *("".join(rng.choice(parts, rng.integers(0, 25))) for _ in range(3000))]
    texts += [" ".join(rng.choice(["ab", "cd\n", "x" * 40_000], 60)), " " * 40_000, ""]
    for kind in (pa.string(), pa.large_string()):
        for own in (pa.array(texts, kind), pa.array(["x ", *texts], kind)[1:], pa.array([], kind)):
            ids, sizes = bpe.encode_all(own)
            expected = [bpe.encode(t or "") for t in own.to_pylist()]
            assert sizes.tolist() == [len(x) for x in expected]
            assert np.array_equal(ids, np.concatenate([ids[:0], *expected]))


def test_repeated_units_are_not_encoded_again(monkeypatch):
    bpe = byte_bpe(public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    seen, leaf = [], bpe._leaf
    monkeypatch.setattr(bpe, "_leaf", lambda text: seen.append(len(text)) or leaf(text))
    ids, sizes = bpe.encode_all(pa.array(["one two three four " * 500] * 50))
    assert sum(seen) < 1_000
    assert sizes.tolist() == [len(bpe.encode("one two three four " * 500))] * 50


def test_scores_bear_weights_that_exp_does_not():
    of, weight, subwords, rng = small()
    model = attention.Attention.random(5, 1)
    ids, first = rng.integers(0, len(of), 90), np.array([0, 3, 90])
    for q in (300.0, -300.0):
        model.parameters["Q"] = np.eye(attention.DIMENSION, dtype=np.float32) * q
        model.parameters["K"] = np.eye(attention.DIMENSION, dtype=np.float32)
        found = attention.scores(model, ids, first, subwords, of)
        assert np.isfinite(found).all() and (found < 0).all()
