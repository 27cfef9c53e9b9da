"""Importance resampling against plain sums over features."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, documents, worded

from sessionflow.llm import importance
from sessionflow.llm.hashing import NO_WORD, words_of
from sessionflow.llm.queries import table

SF_DIR = "/root/testdata/sf0.001"


def features(text):
    words = worded(text)
    return [
        zlib.crc32(b" ".join(words[i : i + n])) % 10000
        for n in (1, 2, 3)
        for i in range(len(words) - n + 1)
    ]


def brute_force(docs, target):
    s = Counter(b for _, text in docs for b in features(text))
    t = Counter(b for text in target for b in features(text))
    s_all, t_all = s.total(), t.total()
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (s_all + 10000) / ((s[b] + 1.0) * (t_all + 10000))))
        for b in range(10000)
    ]
    rows = []
    for i, text in docs:
        found = features(text)
        weight = sum(gain[b] for b in found)
        name = f"42:{'' if i is None else i}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(worded(text))])
    enough = [r for r in rows if r[5] >= 20]
    enough.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, row in enumerate(enough[: 5 * len(enough) // 100], 1):
        row[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def checked(spark, docs, target):
    rows = importance.resampled(docs, target)
    assert rows.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    found = Counter(tuple(r) for r in rows.collect())
    assert found == brute_force(
        [tuple(r) for r in docs.select("doc_id", "text").collect()],
        [r.text for r in target.select("text").collect()],
    )
    return found


def test_odd_documents(spark):
    target = table(spark, SF_DIR, "benchmark")
    rows = TEXTS + [(100 + i, " ".join(f"t{j}" for j in range(i % 40))) for i in range(200)]
    checked(spark, documents(spark, rows), target)
    checked(spark, documents(spark), target.limit(0))
    assert not checked(spark, documents(spark, []), target)


def test_real_documents(spark):
    found = checked(spark, table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "benchmark"))
    assert sum(r[4] is not None for r in found) >= 5


def test_ties_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(25))
    rows = [(7, text)] * 150 + [(8, f"{text} x")] * 60 + [(None, text)] * 5
    found = checked(spark, documents(spark, rows), documents(spark))
    assert sorted(r[4] for r in found if r[4]) == list(range(1, 11))


def test_ranks_over_many_ranges(spark):
    rows = spark.range(10_000).selectExpr(
        "id as doc_id", "id % 40 as n_words", "id as n_features", "id as weight",
        "cast(id * 7919 % 611 as long) as score", "id as row",
    )
    ordered = sorted((-r.score, r.doc_id) for r in rows.collect() if r.n_words >= 20)
    expected = {i: k for k, (_, i) in enumerate(ordered[: len(ordered) // 20], 1)}
    found = importance.ranked(rows).collect()
    assert len(found) == 10_000
    assert {r.doc_id: r.rank for r in found if r.rank} == expected


@pytest.mark.parametrize("size", [1, 5, 31, 32, 33, 64, 700, 40_000])
def test_run_buckets(size):
    chooser = random.Random(size)
    texts = [
        " ".join("".join(chooser.choice("abÀ文") for _ in range(chooser.randint(1, size))) for _ in range(9)),
        None, "", "Ab", "x y", "x",
    ]
    found = []
    for w in words_of(pa.array(texts), NO_WORD, True):
        text, bucket = importance.run_buckets(w)
        found += [(w.rows.start + t, b) for t, b in zip(text.tolist(), bucket.tolist())]
    expected = [(k, b) for k, t in enumerate(texts) for b in features(t)]
    assert Counter(found) == Counter(expected)


def test_planes():
    chooser = np.random.default_rng(1)
    for rows in (1, 2, 3, 7, 64):
        counts = chooser.integers(0, 1 << chooser.integers(1, 20), (rows, 10000))
        planes = importance.to_planes(counts)
        assert (importance.from_planes(importance.summed(planes)) == counts.sum(0)).all()
        gains = chooser.integers(-9000, 9000, 10000)
        assert (importance.Gains(gains).weights(planes) == counts @ gains).all()
