"""License scans: an exact set-similarity join of text blocks with license templates.

A template is a list of words with the share of them that a block must contain. Blocks are the
whole document for the base phrases (all words) and every window of ``WINDOW`` consecutive words for the
notices, so line breaks and comment signs inside a notice mean nothing. A window that begins at a word of no
template holds no more than the next one, so only the others are looked at. The tokens of both are
ordered by how many documents of the corpus have them, rarest first:

* prefix filter: with |T| tokens of which o are needed, a block meets a template only if it has one
  of the first |T| - o + 1 tokens; so only such blocks are looked at, and they join on those tokens;
* length filter: a block needs o different tokens that templates have at all;
* positional filter: after common tokens at places i and j, at most min(|T| - i, |B| - j) can follow.

Surviving pairs are verified on the whole sets, and base phrases on the places of their words: the
words must stand one after the other.

Only DataFrame functions are used. Templates are a fixed list, so what is broadcast or put into the plan
does not grow. NULL text has no words. Repeated rows keep their number; rows that share a doc_id,
also NULL, are told apart by what was found in them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import let, numbers, whole_text
from .store import stored

#: What stands between words, before letters are lowered. Fixed value.
BETWEEN = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Share of a template's words that a block must have; short templates must be there in full.
THRESHOLD = 0.8
SHORT = 10


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    base: bool = False

    @property
    def words(self) -> list[str]:
        return self.text.split()

    @property
    def tokens(self) -> list[str]:
        return sorted(set(self.words))

    @property
    def needed(self) -> int:
        size = len(self.tokens)
        return size if self.base or size <= SHORT else math.ceil(THRESHOLD * size - 1e-9)


#: The base phrases, and wordings of common license notices.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("cc-by", "licensed under cc by 4 0"),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    Template("cc-by-sa", "licensed under cc by sa 4 0"),
    Template("cc0", "dedicated to the public domain under cc0 1 0 universal"),
    Template("gpl", "this work is licensed under the gnu general public license version 3"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    Template("lgpl", "licensed under the gnu lesser general public license version 3"),
    Template("mit", "released under the mit license"),
    Template("mit", "licensed under the mit license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Template("apache", "licensed under the apache license version 2 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Template("mpl", "subject to the terms of the mozilla public license version 2 0"),
)


#: Words of a block: those of the longest notice.
WINDOW = max(len(x.words) for x in TEMPLATES)


def words(text: Column) -> Column:
    """Words as written; where they begin and end does not depend on the case of letters."""
    return F.filter(F.split(text, BETWEEN), lambda w: w != "")


def lowered(word: Column) -> Column:
    """The word with A-Z lowered, if it has only ASCII characters; else something no template has."""
    low = F.lower(word)
    return F.when(F.octet_length(low) == F.octet_length(word), low).otherwise("")


def token_order(docs: DataFrame, templates: tuple[Template, ...]) -> list[str]:
    """All tokens of the templates by the number of documents that have them, then by name."""
    vocabulary = sorted({t for x in templates for t in x.tokens})
    text = whole_text(F.col("text"))
    found = F.array_distinct(
        F.filter(F.transform(words(text), lowered), lambda w: w.isin(vocabulary))
    )
    counted = (
        docs.select(F.explode(found).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # no more than the tokens of the templates
    )
    n = {row["token"]: row["n"] for row in counted}
    return sorted(vocabulary, key=lambda t: (n.get(t, 0), t))


def prefix(template: Template, order: list[str]) -> list[str]:
    tokens = sorted(template.tokens, key=order.index)
    return tokens[: len(tokens) - template.needed + 1]


def blocks(text: Column, order: list[str], templates: tuple[Template, ...]) -> Column:
    """Blocks of a text that pass the prefix and length filters of any template: whether it is the
    document, the ranks of its tokens in order, and for the document the places of the tokens."""
    tokens = {k: sorted({t for x in templates if x.base == k for t in x.tokens}) for k in (True, False)}
    starts = {k: sorted({t for x in templates if x.base == k for t in prefix(x, order)}) for k in (True, False)}
    least = {k: min(x.needed for x in templates if x.base == k) for k in (True, False)}
    ranks = F.create_map(*(F.lit(x) for k, t in enumerate(order) for x in (t, k)))
    rare = [order.index(t) for t in starts[False]]
    nothing = F.array().cast(
        "array<struct<whole:boolean,tokens:string,places:array<struct<at:bigint,word:string>>>>"
    )

    def joined(found: Column) -> Column:
        return F.array_join(F.transform(F.sort_array(found), lambda x: x.cast("string")), ",")

    def places(low: Column, kind: bool) -> Column:
        return F.filter(
            F.transform(low, lambda x, k: F.struct(k.cast("long").alias("at"), x.alias("word"))),
            lambda x: x["word"].isin(tokens[kind]),
        )

    def document(low: Column) -> Column:
        def block(at: Column) -> Column:
            found = F.array_distinct(F.transform(at, lambda x: F.try_element_at(ranks, x["word"])))
            return F.array(
                F.struct(F.lit(True).alias("whole"), joined(found).alias("tokens"), at.alias("places"))
            )

        return F.when(
            F.exists(low, lambda x: x.isin(starts[True])), let(places(low, True), block)
        ).otherwise(nothing)

    def windows(low: Column) -> Column:
        ranked = F.transform(
            places(low, False),
            lambda x: F.struct(x["at"].alias("at"), F.try_element_at(ranks, x["word"]).alias("rank")),
        )

        def sets(hits: Column) -> Column:
            reached = F.transform(
                hits,
                lambda x, k: F.transform(
                    F.filter(F.slice(hits, k + 1, WINDOW), lambda y: y["at"] < x["at"] + WINDOW),
                    lambda y: y["rank"],
                ),
            )
            kept = F.filter(reached, lambda r: F.exists(r, lambda x: x.isin(rare)))
            kept = F.filter(F.transform(kept, F.array_distinct), lambda r: F.size(r) >= least[False])
            return F.array_distinct(F.transform(kept, joined))

        none = F.array().cast("array<struct<at:bigint,word:string>>")
        found = F.transform(
            let(ranked, sets),
            lambda x: F.struct(F.lit(False).alias("whole"), x.alias("tokens"), none.alias("places")),
        )
        return F.when(F.exists(low, lambda x: x.isin(starts[False])), found).otherwise(nothing)

    return let(
        F.transform(words(text), lowered),
        lambda low: F.struct(
            F.size(low).cast("long").alias("n_words"),
            F.concat(document(low), windows(low)).alias("blocks"),
        ),
    )


def template_rows(docs: DataFrame, order: list[str], templates: tuple[Template, ...]) -> DataFrame:
    """One row for each prefix token of each template."""
    rows = []
    for k, x in enumerate(templates):
        tokens = sorted(order.index(t) for t in x.tokens)
        for i, token in enumerate(prefix(x, order)):
            rows.append((k, x.base, x.label, x.words, tokens, x.needed, i, order.index(token)))
    return docs.sparkSession.createDataFrame(
        rows,
        "template int, whole boolean, label string, t_words array<string>, t_tokens array<int>, "
        "needed int, i int, token int",
    )


def phrase_starts() -> Column:
    """Places where the words of the template stand one after the other."""
    places, phrase = F.col("places"), F.col("t_words")

    def stands(at: Column, k: Column) -> Column:
        return F.forall(
            numbers(0, F.size(phrase) - 1),
            lambda m: F.coalesce(
                (F.get(places, k + m)["word"] == F.get(phrase, m))
                & (F.get(places, k + m)["at"] == at["at"] + m),
                F.lit(False),
            ),
        )

    return F.transform(F.filter(places, stands), lambda x: x["at"])


def license_scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    The score is the greatest share of a template's words found in a block; a base phrase has 1.
    """
    order = token_order(docs, templates)
    scanned = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            blocks(whole_text(F.col("text")), order, templates).alias("s"),
        ).select("doc_id", "s.n_words", "s.blocks", F.xxhash64("s.blocks").alias("key")),
        "license-blocks",
    )
    entries = (
        scanned.where(F.size("blocks") > 0)
        .select("doc_id", "key", "blocks")
        .distinct()
        .select("doc_id", "key", F.posexplode("blocks").alias("block", "b"))
        .select(
            "doc_id",
            "key",
            "block",
            "b.whole",
            "b.places",
            F.split("b.tokens", ",").cast("array<int>").alias("tokens"),
        )
    )
    size, o = F.size("tokens"), F.col("needed")
    candidates = (
        entries.select("*", F.posexplode("tokens").alias("j", "token"))
        .join(F.broadcast(template_rows(docs, order, templates)), ["whole", "token"])
        .where((size >= o) & (F.col("j") <= size - o))
        .where(1 + F.least(F.size("t_tokens") - F.col("i") - 1, size - F.col("j") - 1) >= o)
        .dropDuplicates(["doc_id", "key", "block", "template"])
    )
    share = F.size(F.array_intersect("tokens", "t_tokens")) / F.size("t_tokens")
    verified = (
        candidates.withColumn("share", share)
        .where(F.size(F.array_intersect("tokens", "t_tokens")) >= o)
        .withColumn("starts", F.when(F.col("whole"), phrase_starts()))
        .where(~F.col("whole") | (F.size("starts") > 0))
    )
    found = verified.groupBy("doc_id", "key").agg(
        F.sum(F.when(F.col("whole"), F.size("starts"))).alias("n_base"),
        F.min(F.array_min("starts")).alias("first_word"),
        F.max(F.array_max("starts")).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("whole"), F.col("label")))), ",").alias(
            "base_labels"
        ),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"),
    )
    found = found.withColumnsRenamed({"doc_id": "its_id", "key": "its_key"})
    same = F.col("doc_id").eqNullSafe(F.col("its_id")) & (F.col("key") == F.col("its_key"))
    return scanned.join(found, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
