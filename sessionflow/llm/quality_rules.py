"""Quality rules whose cutoffs are certified on labelled documents.

Every rule rejects documents whose ratio (symbols per word, share of repeated lines, ...) is at
least a cutoff. A cutoff is used only if an exact binomial test on the labelled good documents
of a stratum shows that it rejects no more than the allowed share of them:

* The candidates of a rule are a fixed grid, so all labelled rows are a holdout for them.
* p = P(Binomial(n, risk) <= k) for k rejected of n good documents is the exact one-sided
  test of "the false rejection rate is above risk" (the Clopper-Pearson bound is below risk
  exactly if p <= level).
* Cutoffs of one rule and stratum are tested from the mildest on, up to the first that fails
  (fixed sequence: no further correction along the grid). Over rules and strata the level is
  divided by the number of such sequences (Bonferroni). The risk is divided by the number of
  rules, so the union of all rules stays within it.
* All cutoffs of a sequence up to its first failure are certified at once, so any of them may be
  taken: the one with the greatest difference between the shares of bad and of good documents
  that it rejects, the mildest of equals. A rule that catches no bad document is not used.

A stratum with too few labels to certify anything keeps what the base rules keep.

Only DataFrame functions are used. NULL text has no words. Rows are judged one by one, so repeated
rows and repeated doc_ids each get their own verdict. A stratum may be NULL. Label rows with NULL
doc_id or NULL quality are no labels; a document is good if its least label is 1.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .columns import SPACES, let, numbers, space_words, whole_text
from .store import stored

WINDOW = 8
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
GRID = 40
MAX_LITERAL_STRATA = 1000


@dataclass(frozen=True)
class Rules:
    """Limits of the rules; ``risk`` is the allowed share of good documents rejected in total,
    ``delta`` the chance that this is exceeded anywhere, ``stratum`` the column of the strata."""

    min_words: int = 20
    max_repeat_percent: int = 30
    risk: float = 0.05
    delta: float = 0.05
    stratum: str = "lang"


#: Each rule's ratio of the measures, all between 0 and 1; NULL where nothing is counted. The division
#: must bear a zero, also for rows that the base rules reject: Spark computes a ratio that stands in
#: a condition twice ahead of it, for every row.
RATIOS = {
    "symbols": lambda m: F.try_divide(m["n_symbols"], m["n_symbols"] + m["n_words"]),
    "lines": lambda m: F.try_divide(m["n_dup_lines"], m["n_dup_lines"] + m["n_single_lines"]),
    "repeats": lambda m: F.try_divide(m["n_repeat_words"], m["n_words"]),
    "capitals": lambda m: F.try_divide(m["n_capitals"], m["word_chars"]),
    "exclamations": lambda m: F.try_divide(
        m["n_exclamations"], m["n_exclamations"] + m["n_words"]
    ),
    "stutters": lambda m: F.try_divide(m["n_stutters"], m["n_words"]),
}


def repeated_words(words: Column) -> Column:
    """Number of words in windows of eight words that occur twice or more in ``words``.

    Equal hashes of windows only tell whether a document has to be looked at; then windows
    are sorted by hash and words, and neighbours are compared by their words.
    """

    def covered(starts: Column) -> Column:
        last = F.size(starts)
        return F.aggregate(
            F.transform(
                starts,
                lambda s, k: F.when(
                    k + 1 < last, F.least(F.lit(WINDOW), F.get(starts, k + 1) - s)
                ).otherwise(F.lit(WINDOW)),
            ),
            F.lit(0),
            lambda total, x: total + x,
        )

    def in_sorted(windows: Column) -> Column:
        def same(a: Column, b: Column) -> Column:
            return F.coalesce((a["h"] == b["h"]) & (a["w"] == b["w"]), F.lit(False))

        twice = F.filter(
            windows,
            lambda x, k: same(x, F.get(windows, k - 1)) | same(x, F.get(windows, k + 1)),
        )
        return let(F.sort_array(F.transform(twice, lambda x: x["i"])), covered)

    def search(window_hashes: Column, w: Column) -> Column:
        rows = F.transform(
            window_hashes,
            lambda h, k: F.struct(h.alias("h"), F.slice(w, k + 1, WINDOW).alias("w"), k.alias("i")),
        )
        return F.when(
            F.size(F.array_distinct(window_hashes)) == F.size(window_hashes), F.lit(0)
        ).otherwise(let(F.sort_array(rows), in_sorted))

    def of_words(w: Column) -> Column:
        return let(
            F.transform(w, lambda x: F.xxhash64(x)),
            lambda hashes: let(
                F.transform(
                    numbers(1, F.size(hashes) - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)),
                ),
                lambda window_hashes: search(window_hashes, w),
            ),
        )

    return let(words, of_words)


def measures(text: Column) -> Column:
    """One struct with all counts of a text."""

    def without(t: Column, characters: str) -> Column:
        return F.length(t) - F.length(F.translate(t, characters, ""))

    def of_text(t: Column) -> Column:
        lines = F.filter(
            F.split(t, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != ""
        )
        return let(
            space_words(t),
            lambda w: let(
                lines,
                lambda kept: F.struct(
                    F.size(w).cast("long").alias("n_words"),
                    F.length(F.concat_ws("", w)).cast("long").alias("word_chars"),
                    without(t, SYMBOLS).cast("long").alias("n_symbols"),
                    (F.size(kept) - F.size(F.array_distinct(kept)))
                    .cast("long")
                    .alias("n_dup_lines"),
                    F.size(F.array_distinct(kept)).cast("long").alias("n_single_lines"),
                    repeated_words(w).cast("long").alias("n_repeat_words"),
                    without(t, CAPITALS).cast("long").alias("n_capitals"),
                    without(t, "!").cast("long").alias("n_exclamations"),
                    F.size(F.filter(w, lambda x, k: x == F.get(w, k - 1)))
                    .cast("long")
                    .alias("n_stutters"),
                ),
            ),
        )

    return let(whole_text(text), of_text)


def base_failed(m: Column, rules: Rules) -> Column:
    return (m["n_words"] < rules.min_words) | (
        100 * m["n_repeat_words"] > rules.max_repeat_percent * m["n_words"]
    )


def step(m: Column, rule: str) -> Column:
    """Number of grid cutoffs (k / GRID, k = 1..GRID) that the ratio reaches."""
    return F.coalesce(F.floor(RATIOS[rule](m) * GRID).cast("int"), F.lit(0))


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(Binomial(n, risk) <= k), summed term by term in logarithms; 1 where k is above the mean,
    where no test can succeed."""
    odds = math.log(risk) - math.log1p(-risk)
    start = F.struct(
        (n * math.log1p(-risk)).cast("double").alias("log_term"), F.lit(0.0).alias("total")
    )

    def add(state: Column, i: Column) -> Column:
        return F.struct(
            (state["log_term"] + F.log((n - i) / (i + 1)) + odds).alias("log_term"),
            (state["total"] + F.exp(state["log_term"])).alias("total"),
        )

    summed = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k.cast("long")), start, add, lambda s: s["total"]
    )
    return F.when(k > risk * n, F.lit(1.0)).otherwise(summed)


def from_step_on(counts: str) -> Column:
    """Sum of the counts (a map by step) from the row's step on."""
    none = F.lit(0).cast("long")
    return F.aggregate(
        numbers(F.col("step"), F.lit(GRID)),
        none,
        lambda total, s: total + F.coalesce(F.try_element_at(F.col(counts), s), none),
    )


def certified_cutoffs(measured: DataFrame, labels: DataFrame, rules: Rules) -> DataFrame:
    """(stratum, rule, cutoff): the best certified grid step of each stratum and rule.

    ``measured`` has doc_id, the stratum column as ``stratum``, and the measures as ``m``.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg((F.min("quality") == 1).alias("is_good"))
    )
    steps = F.explode(
        F.array(
            *(
                F.struct(F.lit(rule).alias("rule"), step(F.col("m"), rule).alias("step"))
                for rule in RATIOS
            )
        )
    )
    # documents that the base rules reject are no false rejections of a cutoff
    histogram = stored(
        measured.where(~base_failed(F.col("m"), rules))
        .join(known, "doc_id")
        .select("stratum", "is_good", steps.alias("r"))
        .groupBy("stratum", "r.rule", "r.step")
        .agg(
            F.count_if(F.col("is_good")).alias("good"), F.count_if(~F.col("is_good")).alias("bad")
        ),
        "quality-histogram",
    )
    sequence = Window.partitionBy("stratum", "rule")
    tested = (
        histogram.groupBy("stratum", "rule")
        .agg(
            F.sum("good").alias("n"),
            F.sum("bad").alias("n_bad"),
            F.map_from_entries(F.collect_list(F.struct("step", "good"))).alias("good"),
            F.map_from_entries(F.collect_list(F.struct("step", "bad"))).alias("bad"),
        )
        .select("*", F.explode(numbers(1, F.lit(GRID))).alias("step"))
        .withColumns({"k": from_step_on("good"), "k_bad": from_step_on("bad")})
    )
    risk = rules.risk / len(RATIOS)
    sequences = max(1, histogram.where("good > 0").select("stratum", "rule").distinct().count())
    judged = tested.withColumn(
        "passed", binomial_tail(F.col("n"), F.col("k"), risk) <= rules.delta / sequences
    )
    mildest_first = sequence.orderBy(F.col("step").desc())
    benefit = F.col("k_bad") / F.col("n_bad") - F.col("k") / F.col("n")
    return (
        judged.withColumn("so_far", F.min(F.col("passed").cast("int")).over(mildest_first))
        .where("so_far = 1 and k_bad > 0 and n > 0")
        .groupBy("stratum", "rule")
        .agg(F.max(F.struct(benefit.alias("benefit"), "step"))["step"].alias("cutoff"))
    )


def with_verdict(measured: DataFrame, cutoffs: DataFrame, rules: Rules) -> DataFrame:
    """``measured`` with base_failed and kept. The cutoffs of up to MAX_LITERAL_STRATA strata are literal
    rows of the plan and broadcast, so nothing is shuffled; a longer list is left to Spark's estimates.
    The condition has one term for each rule, however many strata there are."""
    per_stratum = cutoffs.groupBy(F.col("stratum").alias("its_stratum")).agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cuts")
    )
    few = per_stratum.limit(MAX_LITERAL_STRATA + 1).collect()
    if len(few) <= MAX_LITERAL_STRATA:
        per_stratum = F.broadcast(
            measured.sparkSession.createDataFrame(few, per_stratum.schema)
        )
    rows = measured.join(
        per_stratum, F.col("stratum").eqNullSafe(F.col("its_stratum")), "left"
    ).drop("its_stratum")
    m = F.col("m")
    exceeds = F.lit(False)
    for rule in RATIOS:
        cutoff = F.try_element_at(F.col("cuts"), F.lit(rule))
        exceeds = exceeds | F.coalesce(step(m, rule) >= cutoff, F.lit(False))
    failed = base_failed(m, rules)
    return rows.withColumns({"base_failed": failed, "kept": ~failed & ~exceeds}).drop("cuts")


def measured_documents(docs: DataFrame, rules: Rules) -> DataFrame:
    """doc_id, stratum and measures; the stratum is NULL where ``docs`` has no such column."""
    stratum = F.col(rules.stratum).cast("string") if rules.stratum in docs.columns else F.lit(None)
    return docs.select(
        "doc_id", stratum.cast("string").alias("stratum"), measures(F.col("text")).alias("m")
    )


def measured_rows(docs: DataFrame, rules: Rules) -> DataFrame:
    """``measured_documents`` with all columns of ``docs`` as a struct, so that rows can be kept without
    measuring them again."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    packed = docs.select(row)
    stratum = F.col(f"row.`{rules.stratum}`") if rules.stratum in docs.columns else F.lit(None)
    return packed.select(
        F.col("row.doc_id").alias("doc_id"),
        stratum.cast("string").alias("stratum"),
        measures(F.col("row.text")).alias("m"),
        "row",
    )


def kept_rows(measured: DataFrame, cutoffs: DataFrame, rules: Rules) -> DataFrame:
    """Of ``measured_rows`` those that the rules keep, with their own columns; no shuffle."""
    return with_verdict(measured, cutoffs, rules).where("kept").select("row.*")


def kept_documents(docs: DataFrame, cutoffs: DataFrame, rules: Rules) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns; no shuffle."""
    return kept_rows(measured_rows(docs, rules), cutoffs, rules)
