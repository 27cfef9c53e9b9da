"""Filter interaction audit: what each filter of a set removes, alone, after others and on average.

Every document fails some subset of the five filters, a mask of 32. Documents are counted by part
and mask, and from these counts the removals of all 32 coalitions of filters are tabulated: a
coalition removes the documents whose mask it meets. All reports follow from that table. What a
filter removes at a step of an order is the difference of two coalitions. Its Shapley value is
the solution of a least-squares problem over all coalitions, weighted by the Shapley kernel and
bound to share out the whole removal, whose normal equations are solved in rationals. The equations
have the same left side for every part, so they are solved once, for the 32 unit games, and each
part's solution is an integer combination of its own table.
"""

from __future__ import annotations

import json
from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let, space_words, whole_text
from .store import stored

FILTERS = "ABCDE"
COALITIONS = 1 << len(FILTERS)
ORDERS = factorial(len(FILTERS))
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("removed", "good", "toxic")


# --- the five filters -----------------------------------------------------------------------


def text_mask(text: Column) -> Column:
    """The filters A to D that the text fails, as bits 1, 2, 4 and 8. NULL is an empty text."""

    def of_text(t: Column) -> Column:
        words = let(
            space_words(t),
            lambda w: F.when(F.size(w) < 50, 1).otherwise(0)
            + F.when(100 * F.size(F.array_distinct(w)) < 65 * F.size(w), 2).otherwise(0),
        )
        capitals = F.length(t) - F.length(F.translate(t, CAPITALS, ""))
        return (
            words
            + F.when(100 * capitals > 5 * F.length(t), 4).otherwise(0)
            + F.when(t.rlike(r"[#$%&*|]"), 8).otherwise(0)
        )

    return let(whole_text(text), of_text)


def label_flags(labels: DataFrame) -> DataFrame:
    """(labelled, good, toxic): one row for each doc_id; of several rows, any 1 counts."""
    return (
        labels.where("doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("labelled"))
        .agg(
            F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)).alias("good"),
            F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)).alias("toxic"),
        )
        .where("good = 1 or toxic = 1")
    )


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by source and by the filters they fail.

    Texts become digests in the scan, and repeated rows collapse before they are shuffled. A text
    is not compared with its copies: only the first of them is looked for, the row that has the
    least doc_id of its digest, by a join on digest and doc_id together, so a text that a
    third of all rows share is spread by doc_id. A document without a doc_id has no smaller one
    and is no smaller one.
    """
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
            F.unhex(F.sha2(whole_text(F.col("text")), 256)).alias("digest"),
            text_mask(F.col("text")).alias("mask"),
        )
        .groupBy("doc_id", "part", "digest", "mask")
        .agg(F.count(F.lit(1)).alias("n")),
        "failures",
    )
    first = (
        rows.where("doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("first"))
        .withColumnRenamed("digest", "its")
    )
    known = rows.where("doc_id is not null")
    known = known.join(
        first, (F.col("digest") == F.col("its")) & (F.col("doc_id") == F.col("first")), "left"
    )
    known = known.join(
        label_flags(labels), F.col("doc_id") == F.col("labelled"), "left"
    ).select(
        "part",
        (F.col("mask") + F.when(F.col("first").isNull(), 16).otherwise(0)).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
        "n",
    )
    nameless = rows.where("doc_id is null").select(
        "part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n"
    )
    return known.unionByName(nameless).groupBy("part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n")
    )


# --- coalitions -----------------------------------------------------------------------------


def coalitions(counts: DataFrame) -> DataFrame:
    """(part, n, removals): for each part its documents and, by coalition 0..31, a struct of the
    documents, good and toxic ones that it removes."""
    meets = (F.col("mask").bitwiseAND(F.col("coalition")) != 0).cast("long")
    table = (
        counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(COALITIONS - 1))))
        .groupBy("part", "coalition")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * meets).alias("removed"),
            F.sum(F.col("n") * F.col("good") * meets).alias("good"),
            F.sum(F.col("n") * F.col("toxic") * meets).alias("toxic"),
        )
    )
    entry = F.struct("coalition", *MEASURES)
    # 32 entries for each part, which the sort puts in the order of their numbers
    return table.groupBy("part").agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(entry)).alias("removals")
    )


def solved(matrix: list[list[Fraction]], right: list[list[Fraction]]) -> list[list[Fraction]]:
    """The rows x with matrix * x = right, by elimination."""
    n = len(matrix)
    rows = [[*matrix[i], *right[i]] for i in range(n)]
    for i in range(n):
        pivot = next(k for k in range(i, n) if rows[k][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(n):
            if k != i and rows[k][i]:
                factor = rows[k][i]
                rows[k] = [a - factor * b for a, b in zip(rows[k], rows[i])]
    return [row[n:] for row in rows]


def shapley_weights(players: int) -> list[list[Fraction]]:
    """For each player the weight of every coalition's value in its Shapley value.

    Minimises sum over proper coalitions S of k(S) * (v(S) - v(0) - sum of x over S)^2, where
    k(S) = (n - 1) / (C(n, |S|) |S| (n - |S|)), subject to sum of x = v(all) - v(0). The normal
    equations with a multiplier for the constraint are solved for the unit games v.
    """
    size, full = 1 << players, (1 << players) - 1
    left = [[Fraction(0)] * (players + 1) for _ in range(players + 1)]
    right = [[Fraction(0)] * size for _ in range(players + 1)]
    for s in range(1, full):
        members = [i for i in range(players) if s >> i & 1]
        k = Fraction(
            players - 1, comb(players, len(members)) * len(members) * (players - len(members))
        )
        for i in members:
            for j in members:
                left[i][j] += k
            right[i][s] += k
            right[i][0] -= k
    for i in range(players):
        left[i][players] = left[players][i] = Fraction(1)
    right[players][full] += 1
    right[players][0] -= 1
    return solved(left, right)[:players]


# --- reports --------------------------------------------------------------------------------


def steps() -> list[dict]:
    """Each step of each order: the coalitions before and after it, and its filter's weights in the
    sum over all orders."""
    weights = [[int(w * ORDERS) for w in row] for row in shapley_weights(len(FILTERS))]
    found = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, k in enumerate(order, 1):
            found.append(
                {
                    "filter_order": "".join(FILTERS[i] for i in order),
                    "step": step,
                    "own": 1 << k,
                    "others": COALITIONS - 1 - (1 << k),
                    "before": before,
                    "after": before | 1 << k,
                    "weights": weights[k],
                }
            )
            before |= 1 << k
    return found


STEP = (
    "filter_order string, step int, own int, others int, before int, after int, weights array<long>"
)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (source; NULL: empty string), order of the filters and step.

    A table without documents has no parts and no rows. A doc_id in several rows of ``docs`` counts
    with each; of several rows of ``labels`` any 1 counts; labels without a doc_id are no one's.
    """

    def at(coalition: Column | str | int, measure: str) -> Column:
        c = F.col(coalition) if isinstance(coalition, str) else F.lit(coalition)
        return F.get("removals", c)[measure]

    def here(measure: str) -> Column:
        return at("after", measure) - at("before", measure)

    plan = F.from_json(F.lit(json.dumps(steps())), f"array<struct<{STEP}>>")
    rows = coalitions(failures(docs, labels)).select(
        "part", "n", "removals", F.inline(plan)
    )
    # the sum of removals[c] * weights[c] over the coalitions c
    shapley = reduce(
        lambda a, b: a + b,
        (at(c, "removed") * F.get("weights", F.lit(c)) for c in range(COALITIONS)),
    )
    return rows.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - at("after", "removed")).alias("kept"),
        here("removed").alias("removed"),
        (at("own", "removed") - here("removed")).alias("redundant"),
        (at(COALITIONS - 1, "removed") - at("others", "removed")).alias("unique_fails"),
        here("good").alias("good_lost"),
        here("toxic").alias("toxic_lost"),
        shapley.alias("shapley"),
    )
