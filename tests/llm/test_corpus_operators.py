"""Operators that compare documents with each other, against brute force."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import documents, spaced
from pyspark.sql import functions as F

from sessionflow.llm import attention_lm, components, simhash, substring_dedup
from sessionflow.llm.queries import op6_substring_dedup, op9_simhash, op10_attention_lm, table

SF_DIR = "/root/testdata/sf0.001"


def texts_of(docs):
    return [tuple(r) for r in docs.select("doc_id", "text").collect()]


# --- SimHash --------------------------------------------------------------------------------


def fingerprint(text):
    words = spaced((text or "").encode().lower().decode()) if text else []
    words = [w.lower() for w in (text or "").encode().split()]
    shingles = [words[i : i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_groups(values):
    """Least index of each value's component, by comparing all pairs."""
    values = np.array(values, np.uint64)
    label = np.arange(len(values))
    while True:
        new = label.copy()
        for k in range(len(values)):
            new[k] = label[np.bitwise_count(values ^ values[k]) <= 4].min()
        if np.array_equal(new, label):
            return label
        label = new


@pytest.mark.parametrize("chunk", [simhash.CHUNK, 3])
def test_near_components(spark, chunk):
    for docs in (documents(spark), table(spark, SF_DIR, "documents")):
        rows = texts_of(docs)
        prints = [fingerprint(t) for _, t in rows]
        label = near_groups(prints)
        least = {}
        for (doc_id, _), group in zip(rows, label):
            if doc_id is not None:
                least[group] = min(doc_id, least.get(group, doc_id))
        expected = Counter((i, f, least.get(g)) for (i, _), f, g in zip(rows, prints, label))
        found = simhash.near_components(docs, chunk)
        assert Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in found.collect()) == expected
    assert simhash.near_components(documents(spark, [])).count() == 0


def test_query_formats_fingerprints(spark):
    row = op9_simhash(spark, SF_DIR).where("doc_id = 0").head()
    text = table(spark, SF_DIR, "documents").where("doc_id = 0").head().text
    assert row.fingerprint == f"{fingerprint(text):016x}"


@pytest.mark.parametrize("chunk", [4096, 5])
def test_links_of_random_fingerprints(spark, chunk):
    """Chains of steps of one to four bits anywhere, and strangers."""
    rng = np.random.default_rng(5)
    values = []
    for _ in range(25):
        value = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(12):
            values.append(value)
            for bit in rng.choice(64, int(rng.integers(1, 6)), replace=False):
                value ^= 1 << int(bit)
    values = sorted(set(values))
    label = near_groups(values)
    nodes = spark.createDataFrame([(v - (v >> 63 << 64),) for v in values], "fp long")
    roots = components.connected_components(simhash.near_links(nodes, chunk))
    root = {r.node: r.root for r in roots.collect()}
    groups, expected = {}, {}
    for v, g in zip(values, label):
        signed = v - (v >> 63 << 64)
        groups.setdefault(root.get(signed, signed), set()).add(signed)
        expected.setdefault(g, set()).add(signed)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_every_value_visits_the_homes_of_its_neighbours():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << simhash.BLOCK, 300)
    home, at, anchor = simhash.anchors_of_block(values)
    visits = {k: set(anchor[at == k].tolist()) for k in range(len(values))}
    for k in range(len(values)):
        assert len(visits[k]) == (at == k).sum()
        for bit in range(simhash.BLOCK):
            other = simhash.anchors_of_block(values[k : k + 1] ^ (1 << bit))[0][0]
            assert int(other) in visits[k]
        assert int(home[k]) in visits[k]


def test_one_of_each(spark):
    docs = documents(spark)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # 2, 3, 4 and the NULL row have no words: fingerprint zero; 8 and 9 are copies
    assert ids[2] == 1 and not ids[3] and not ids[4] and ids[8] == 1 and not ids[9]
    assert simhash.one_of_each(documents(spark, [])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(1001, 1400)] + [(7, 7)]
    found = components.connected_components(spark.createDataFrame(links, "a long, b long"))
    root = {r.node: r.root for r in found.collect()}
    assert all(root[i] == 0 for i in range(61)) and all(root[i] == 1000 for i in range(1000, 1400))
    empty = spark.createDataFrame([], "a long, b long")
    assert components.connected_components(empty).count() == 0


# --- repeated passages ----------------------------------------------------------------------


def deduplicated(rows, width=20):
    """By document in order of doc_id; versions of one document share their windows."""
    seen, by_id = {}, {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        by_id.setdefault(doc_id, []).append(text)
    expected = Counter()
    for doc_id, versions in by_id.items():
        windows = []
        for text in versions:
            words = spaced(text)
            windows += [(i, tuple(words[i : i + width])) for i in range(len(words) - width + 1)]
        for i, window in sorted(windows):
            seen.setdefault(window, (doc_id, i))
        for text in versions:
            words = spaced(text)
            gone = [False] * len(words)
            for i in range(len(words) - width + 1):
                if seen[tuple(words[i : i + width])] != (doc_id, i):
                    gone[i : i + width] = [True] * width
            kept = b" ".join(w for w, g in zip(words, gone) if not g)
            expected[doc_id, len(words), sum(gone), kept.decode()] += 1
    return expected


@pytest.mark.parametrize("flush", [substring_dedup.FLUSH_ROWS, 50])
def test_substring_dedup(spark, monkeypatch, flush):
    monkeypatch.setattr(substring_dedup, "FLUSH_ROWS", flush)
    runs = " ".join(["a"] * 45 + ["b"] * 30 + ["a", "b"] * 40 + ["c"] * 19)
    odd = [(30, runs), (31, runs + " c"), (32, "x " + runs), (33, " ".join(["c"] * 20)), (30, "y " + runs)]
    for docs in (documents(spark), table(spark, SF_DIR, "documents"), documents(spark, odd)):
        found = Counter(tuple(r) for r in substring_dedup.kept_words(docs).collect())
        assert found == deduplicated(texts_of(docs))
    assert substring_dedup.kept_words(documents(spark, [])).count() == 0


@pytest.mark.parametrize("width", [1, 2, 5])
def test_other_widths(spark, width):
    docs = documents(spark, [(1, "a b c a b c d e f g"), (2, "c d e f g h a b"), (3, "z")])
    found = Counter(tuple(r) for r in substring_dedup.kept_words(docs, width).collect())
    assert found == deduplicated(texts_of(docs), width)


def test_texts_without_repeats_stay_as_they_are(spark):
    docs = documents(spark)
    done = substring_dedup.without_repeats(docs)
    assert done.columns == docs.columns
    expected = Counter()
    kept = deduplicated(texts_of(docs))
    for r in docs.collect():
        own = spaced(r.text)
        ((_, _, gone, text),) = [
            k
            for k in kept
            if k[0] == r.doc_id and k[1] == len(own) and (k[2] or k[3].encode().split() == own)
        ]
        expected[r.doc_id, text if gone else r.text] += 1
    assert Counter((r.doc_id, r.text) for r in done.collect()) == expected


def test_query_digests(spark):
    row = op6_substring_dedup(spark, SF_DIR).where("n_removed = 0 and n_words > 0").orderBy("doc_id").head()
    text = table(spark, SF_DIR, "documents").where(F.col("doc_id") == row.doc_id).head().text
    assert row.kept_sha256 == hashlib.sha256(b" ".join(spaced(text))).hexdigest()


# --- language model -------------------------------------------------------------------------


def base_scores(rows):
    def tokens(text):
        return [w.lower() for w in (text or "").encode().split()] + [None]

    def out(doc_id):
        return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1

    counts = Counter()
    for doc_id, text in rows:
        if not out(doc_id):
            counts.update(tokens(text))
    total, under = sum(counts.values()), sum(counts.values()) + 0.5 * (len(counts) + 1)
    for doc_id, text in rows:
        own = tokens(text)
        score = sum(math.log10((counts[w] + 0.5) / under) for w in own)
        yield doc_id, out(doc_id), len(own), sum(counts[w] > 0 for w in own), total, score


def test_base_scores(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "STEPS", 20)
    real = table(spark, SF_DIR, "documents")
    from sessionflow.llm.queries import BYTE_RANKS
    import public_tokenizers

    for docs in (documents(spark), real, documents(spark, []), documents(spark, [(1, "held out")])):
        found = attention_lm.lm_scores(
            docs, public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
        ).collect()
        expected = sorted(base_scores(texts_of(docs)), key=lambda r: (str(r[0]), r[2], r[5]))
        found = sorted(found, key=lambda r: (str(r.doc_id), r.n_tokens, r.base_score))
        assert len(found) == len(expected)
        for r, e in zip(found, expected):
            assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:5]
            assert r.base_score == pytest.approx(e[5], rel=1e-9)
            assert r.score < 0


def test_model_learns_and_scores_each_token_once(spark):
    rows = {r.doc_id: r for r in op10_attention_lm(spark, SF_DIR).collect()}
    untrained = -math.log10(50_257)
    held = [r for r in rows.values() if r.held_out]
    subwords = sum(len(r.text) for r in table(spark, SF_DIR, "documents").collect()) / len(rows) / 4
    assert sum(r.score for r in held) / len(held) > untrained * subwords


def test_attention_gradients_and_windows():
    from sessionflow.llm import attention

    rng = np.random.default_rng(0)
    model = attention.Attention.random(7, 1)
    model.parameters = {k: v.astype(np.float64) for k, v in model.parameters.items()}
    classes = rng.integers(1, 7, 90)
    first = np.array([0, 40, 40, 90])
    inputs, places = attention.windows_of(classes, first)
    assert sorted(places[places >= 0].tolist()) == list(range(90))
    targets = np.where(places >= 0, classes[np.maximum(places, 0)], 0)
    use = places >= 0

    def loss():
        return -(model.log_probability(inputs, targets) * use.ravel()).sum() / use.sum()

    grads = model.gradients(inputs, targets, use)
    for name in attention.NAMES:
        at = tuple(int(rng.integers(0, s)) for s in model.parameters[name].shape)
        model.parameters[name][at] += 1e-5
        up = loss()
        model.parameters[name][at] -= 2e-5
        down = loss()
        model.parameters[name][at] += 1e-5
        assert (up - down) / 2e-5 == pytest.approx(float(grads[name][at]), abs=1e-6)
    # later tokens do not change the score of earlier ones
    before = attention.scores(model, classes, first)
    classes[60:90] = 1
    after = attention.scores(model, classes, first)
    assert np.allclose(before[:60], after[:60])
