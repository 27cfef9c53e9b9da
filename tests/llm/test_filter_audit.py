"""The audit against a simulation of every order, and the solver against the sum over orders."""

import re
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import pytest
from cases import TEXTS, documents, spaced

from sessionflow.llm import filter_audit

DISTINCT = " ".join(f"word{i}" for i in range(60))
ROWS = [
    *TEXTS,
    (20, DISTINCT),
    (21, DISTINCT),
    (19, f"{DISTINCT} $"),
    (22, f"{DISTINCT} $"),
    (23, DISTINCT.upper()),
    (24, f"{DISTINCT} {DISTINCT}"),
    (25, f"{DISTINCT} {DISTINCT} #"),
    (20, DISTINCT),
    (None, DISTINCT),
]
LABELS = [(20, 1, 0), (21, 1, 1), (21, 0, 0), (22, 0, 1), (5, None, 1), (None, 1, 1), (24, 1, None), (99, 1, 1)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def brute_force(docs, known):
    good = {i for i, q, _ in known if q == 1 and i is not None}
    toxic = {i for i, _, t in known if t == 1 and i is not None}
    least = defaultdict(list)
    for i, text, _ in docs:
        if i is not None:
            least[text or ""].append(i)
    rows = []
    for i, text, source in docs:
        text, words = text or "", spaced(text)
        fails = set()
        if len(words) < 50:
            fails.add("A")
        if 100 * len(set(words)) < 65 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
            fails.add("C")
        if set(text) & set("#$%&*|"):
            fails.add("D")
        if i is not None and min(least[text]) < i:
            fails.add("E")
        rows.append((source or "", fails, i in good, i in toxic))
    found, shapley = {}, Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left = [r for r in rows if r[0] == part]
            gone = []
            for step, own in enumerate(order, 1):
                out = [r for r in left if own in r[1]]
                left = [r for r in left if own not in r[1]]
                found[part, "".join(order), step] = (
                    len(left),
                    len(out),
                    sum(own in r[1] for r in gone),
                    sum(r[0] == part and r[1] == {own} for r in rows),
                    sum(r[2] for r in out),
                    sum(r[3] for r in out),
                )
                gone += out
                shapley[part, own] += len(out)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


@pytest.mark.parametrize("rows", [ROWS, [], [(None, None)], [(1, "x")] * 40])
def test_audit(spark, rows):
    docs = [(i, t, (None, "s", "")[k % 3]) for k, (i, t) in enumerate(rows)]
    frame = spark.createDataFrame(
        [(*d, 1, 2, "m") for d in docs],
        "doc_id long, text string, source string, n int, good int, mask string",
    )
    found = filter_audit.audit(frame, labels(spark)).collect()
    expected = brute_force(docs, LABELS)
    assert {tuple(r)[:3]: tuple(r)[3:] for r in found} == expected
    assert len(found) == len(expected)


def test_audit_without_labels(spark):
    found = filter_audit.audit(documents(spark), labels(spark, [])).collect()
    assert len(found) == 600 and not any(r.good_lost or r.toxic_lost for r in found)


@pytest.mark.parametrize("players", [2, 3, 4, 5])
def test_least_squares_gives_the_mean_over_all_orders(players):
    weights = filter_audit.shapley_weights(players)
    orders = list(permutations(range(players)))
    for k in range(players):
        expected = [Fraction(0)] * (1 << players)
        for order in orders:
            before = sum(1 << i for i in order[: order.index(k)])
            expected[before | 1 << k] += Fraction(1, len(orders))
            expected[before] -= Fraction(1, len(orders))
        assert weights[k] == expected
