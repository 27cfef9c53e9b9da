"""Language identification: sums over listed segmentations, and accuracy on held-out texts."""

import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from cases import TEXTS, documents

from sessionflow.llm import language_id
from sessionflow.llm.queries import PIECES, table

PATH = public_tokenizers.path(PIECES)
WORDS = ["the", "question", "ñandú", "文字", "x", "übergrößenträger", "é", "zzzz", "q" * 32, "עברית"]


@pytest.fixture(scope="module")
def pieces():
    return language_id.Pieces(PATH)


def segmentations(pieces, text):
    """Every sequence of piece numbers that spells the text."""
    known = {name: k for k, name in enumerate(pieces.names)}
    ways = [[] for _ in range(len(text) + 1)]
    ways[0] = [()]
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - pieces.depth), end):
            k = known.get(text[start:end])
            if k is None and end - start == 1:
                k = pieces.unknown
            if k is not None:
                ways[end] += [(*w, k) for w in ways[start]]
    return ways[-1]


def test_sums_over_all_segmentations(pieces):
    p = np.random.default_rng(2).random((pieces.count, 3)).astype(np.float32) + 0.01
    words = [w for w in WORDS if len(w) < 12]
    logs = language_id.log_probabilities(pieces, words, p)
    for word, found in zip(words, logs):
        ways = segmentations(pieces, language_id.START + word)
        for k in range(3):
            expected = sum(math.prod(float(p[i, k]) for i in way) for way in ways)
            assert found[k] == pytest.approx(math.log(expected), abs=1e-9)


def test_expected_counts(pieces):
    p = np.random.default_rng(3).random((pieces.count, 2)).astype(np.float32) + 0.01
    words = ["the", "thing", "文字", "ñandú", "the"]
    lang, n = np.array([0, 1, 0, 1, 1]), np.array([3, 1, 2, 5, 4])
    found = language_id.expected_counts(pieces, words, lang, n, p)
    expected = np.zeros_like(found)
    for word, k, times in zip(words, lang, n):
        ways = segmentations(pieces, language_id.START + word)
        weight = [math.prod(float(p[i, k]) for i in way) for way in ways]
        for way, w in zip(ways, weight):
            for i in way:
                expected[i, k] += times * w / sum(weight)
    assert found == pytest.approx(expected)


def test_blocks_change_nothing(pieces, monkeypatch):
    p = np.random.default_rng(4).random((pieces.count, 2)).astype(np.float32)
    whole = language_id.log_probabilities(pieces, WORDS, p)
    model = language_id.Model(["a", "b"], np.array([0.5, 0.5]), p)
    texts = ["the question", None, "", "12 !!", "文字 " * 50, "x"]
    names, scores = language_id.judged(pieces, model, texts)
    monkeypatch.setattr(language_id, "CELLS", 10)
    monkeypatch.setattr(language_id, "TEXT_BLOCK", 5)
    assert (language_id.log_probabilities(pieces, WORDS, p) == whole).all()
    again, others = language_id.judged(pieces, model, texts)
    assert again == names and others == pytest.approx(scores)


def test_least_probabilities_do_not_vanish(pieces):
    p = np.full((pieces.count, 1), language_id.FLOOR, np.float32)
    assert np.isfinite(language_id.log_probabilities(pieces, ["\U00010400" * 32, "q" * 32], p)).all()


def test_rounds_raise_the_likelihood(pieces):
    words = ["the", "thing", "other", "there", "then", "nothing", "ether"]
    lang, n = np.zeros(len(words), np.int64), np.arange(1, len(words) + 1)
    p = np.full((pieces.count, 1), 1 / pieces.count, np.float32)
    before = -math.inf
    for _ in range(4):
        now = (language_id.log_probabilities(pieces, words, p)[:, 0] * n).sum()
        assert now > before
        before = now
        p = language_id.probabilities(language_id.expected_counts(pieces, words, lang, n, p))


def letterless(text):
    return not any(unicodedata.category(c).startswith("L") for c in text or "")


def test_odd_documents(spark):
    docs = documents(spark)
    none = language_id.identified(docs, language_id.trained(docs, PATH), PATH)
    assert Counter(r.lang_pred for r in none.collect()) == {"und": len(TEXTS)}
    rows = [(i, t, ("xx", "yy", None)[k % 3]) for k, (i, t) in enumerate(TEXTS)]
    rows += [(50 + i, "der die das und nicht", "de") for i in range(30)]
    docs = spark.createDataFrame(
        [(*r, 1, "m") for r in rows], "doc_id long, text string, lang string, held_out int, n string"
    )
    model = language_id.trained(docs, PATH)
    assert model.languages == ["de", "xx", "yy"]
    found = language_id.identified(docs, model, PATH).collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    texts = dict((r[0], r[1]) for r in rows if r[0] is not None)
    for r in found:
        name = "" if r.doc_id is None else str(r.doc_id)
        assert r.held_out == (zlib.crc32(name.encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == letterless(texts[r.doc_id])
    empty = documents(spark, [])
    assert language_id.identified(empty, language_id.trained(empty, PATH), PATH).count() == 0


def test_held_out_rows_teach_nothing(spark):
    def learned(lang):
        rows = [(i, "alpha beta gamma" if zlib.crc32(str(i).encode()) % 4 != 2 else "delta", lang
                 if zlib.crc32(str(i).encode()) % 4 == 2 else "aa") for i in range(60)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return language_id.trained(docs, PATH)

    one, other = learned("bb"), learned("cc")
    assert one.languages == other.languages == ["aa"]
    assert one.p == pytest.approx(other.p)


def test_sample_is_bounded_and_covers_every_language(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE", 40)
    rows = [(i, f"text number {i}", "aa") for i in range(3000)] + [(i, "copy", "aa") for i in range(3000)]
    rows += [(i, f"other {i}", "bb") for i in range(7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr(
        "lang", "text", "xxhash64(text) as place"
    )
    sample = language_id.sampled(docs, {"aa": 3001, "bb": 7})
    found = Counter(r.lang for r in sample.collect())
    assert 10 < found["aa"] < 80 and found["bb"] == 7


def test_accuracy_on_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    found = language_id.identified(docs, language_id.trained(docs, PATH), PATH)
    truth = docs.select(docs["doc_id"].alias("id"), "lang")
    rows = found.where("held_out").join(truth, found["doc_id"] == truth["id"]).collect()
    known = [r for r in rows if r.lang is not None and r.lang_pred != "und"]
    assert len(known) > 150
    assert sum(r.lang == r.lang_pred for r in known) / len(known) > 0.97
