"""Language identification by unigrams of pieces, summed over all segmentations of a text.

The pieces are those of a public vocabulary that hold lower-case letters only. Every language has a
probability for each piece. A word, with the vocabulary's mark for its start before it, is
any sequence of pieces that spells it, and its probability in a language is the sum over all
such sequences, which a forward algorithm finds place by place. A text's probability is the product
over its words. The piece probabilities are trained by expectation maximisation: expected counts of
pieces over all segmentations, from forward and backward sums, on words of labelled texts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import whole_text
from .store import stored

FOLDS, HELD_OUT = 4, 2
#: Labelled texts of a language that probabilities are fitted on, about; never more than twice as many.
SAMPLE = 3000
#: Different languages that are learned at most; more are an error.
LANGUAGES = 1000
ROUNDS = 4
#: Count that every piece has beforehand, and the least probability.
PRIOR_COUNT, FLOOR = 0.01, 1e-9
UNKNOWN_LANGUAGE = "und"

#: A run of more letters is read as several words.
LONGEST = 32
WORD = regex.compile(rf"\p{{L}}[\p{{L}}\p{{M}}]{{0,{LONGEST - 1}}}")
START = "▁"
PIECE = regex.compile(rf"{START}?[\p{{L}}\p{{M}}]*")
#: Characters of text, and numbers of a table of sums, that are worked on at once.
TEXT_BLOCK, CELLS = 1 << 22, 1 << 22


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


# --- pieces ---------------------------------------------------------------------------------


class Pieces:
    """The vocabulary as a tree of characters, in tables that whole arrays are looked up in."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = (model.id_to_piece(i) for i in range(model.get_piece_size()))
        self.names = sorted({p for p in names if p and PIECE.fullmatch(p) and p == p.lower()})
        #: The piece of any one character that is no piece itself.
        self.unknown = len(self.names)
        self.count = self.unknown + 1
        self.single = np.full(0x110000, self.unknown, np.int32)
        longer = []
        for k, name in enumerate(self.names):
            if len(name) == 1:
                self.single[ord(name)] = k
            else:
                longer.append((name, k))
        letters = sorted({c for name, _ in longer for c in name})
        self.width = len(letters) + 1
        self.letter = np.zeros(0x110000, np.int32)  # 0: in no longer piece
        for k, c in enumerate(letters, 1):
            self.letter[ord(c)] = k
        self.depth = max((len(name) for name, _ in longer), default=1)
        heads = sorted({name[:i] for name, _ in longer for i in range(len(name))}, key=len)
        node = {head: k for k, head in enumerate(heads)}
        column = {c: k for k, c in enumerate(letters, 1)}
        size = max(1, len(heads)) * self.width
        self.child, self.piece = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        for head, k in node.items():
            if head:
                self.child[node[head[:-1]] * self.width + column[head[-1]]] = k
        for name, k in longer:
            self.piece[node[name[:-1]] * self.width + column[name[-1]]] = k

    def matches(self, words: list[str]) -> Matches:
        """All places where pieces stand in the words."""
        text = "".join(f"{START}{w}" for w in words)
        code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        last = np.cumsum(sizes)
        begin = last - sizes
        until = np.repeat(last, sizes)
        letter = self.letter[code]
        starts, lengths, pieces = [np.arange(len(code))], [1], [self.single[code]]
        at, node = starts[0], np.zeros(len(code), np.int32)
        for length in range(1, self.depth + 1):
            inside = at + length <= until[at]
            at, node = at[inside], node[inside]
            key = node * self.width + letter[at + length - 1]
            found, node = self.piece[key], self.child[key]
            there = found >= 0
            if length > 1:
                starts.append(at[there])
                lengths.append(length)
                pieces.append(found[there])
            on = node >= 0
            at, node = at[on], node[on]
        sizes_of = [len(s) for s in starts]
        start, length = np.concatenate(starts), np.repeat(lengths, sizes_of)
        # by place of the end in the word, then by length: no end stands twice in a group
        place = start + length - np.repeat(begin, sizes)[start]
        key = (place * (self.depth + 1) + length).astype(np.uint16)
        order = np.argsort(key, kind="stable")
        key = key[order]
        groups = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
        # word k has one place more than it has characters, its first one before them
        shift = np.repeat(np.arange(len(words)), sizes)[start[order]]
        own = np.arange(len(words))
        return Matches(
            start[order] + shift,
            (start + length)[order] + shift,
            np.concatenate(pieces)[order],
            groups,
            begin + own,
            last + own,
        )


@dataclass
class Matches:
    """Pieces by the places they start and end at, grouped in the order of a forward pass."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    groups: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Sums over all sequences of pieces from a word's first place to each place. ``weight`` has a
        number, or a row of numbers, for each piece found."""
        places = int(self.last[-1]) + 1 if len(self.last) else 0
        total = np.zeros((places, *weight.shape[1:]))
        total[self.first] = 1
        for a, b in zip(self.groups[:-1], self.groups[1:]):
            total[self.end[a:b]] += total[self.start[a:b]] * weight[a:b]
        return total

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """The same from each place to the word's last place."""
        total = np.zeros((int(self.last[-1]) + 1 if len(self.last) else 0, *weight.shape[1:]))
        total[self.last] = 1
        for a, b in zip(self.groups[-2::-1], self.groups[:0:-1]):
            # in a group the starts differ too: they lie one length before different ends
            total[self.start[a:b]] += total[self.end[a:b]] * weight[a:b]
        return total


@cache
def pieces_of(path: str) -> Pieces:
    """Once for each Python worker."""
    return Pieces(path)


def word_blocks(words: list[str], languages: int) -> Iterator[slice]:
    """Slices of ``words`` whose tables of sums stay small."""
    begin, cells = 0, 0
    for k, word in enumerate(words):
        size = (len(word) + 2) * languages
        if cells and cells + size > CELLS:
            yield slice(begin, k)
            begin, cells = k, 0
        cells += size
    if begin < len(words):
        yield slice(begin, len(words))


def log_probabilities(pieces: Pieces, words: list[str], p: np.ndarray) -> np.ndarray:
    """log P(word | language) with the piece probabilities ``p`` (pieces, languages)."""
    found = np.empty((len(words), p.shape[1]))
    for block in word_blocks(words, p.shape[1] * 4):
        m = pieces.matches(words[block])
        found[block] = np.log(m.forward(p[m.piece].astype(np.float64))[m.last])
    return found


# --- training -------------------------------------------------------------------------------


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    #: (pieces, languages)
    p: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; NULL counts as an empty id."""
    name = F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))
    return F.crc32(name) % FOLDS == HELD_OUT


def sampled(rows: DataFrame, shares: dict[str, int]) -> DataFrame:
    """Different texts (lang, text) of each language, about ``SAMPLE``, by hash. ``shares`` has the
    number of different texts of each language."""
    least = -(1 << 63)
    place = F.lit(False)
    for lang, n in shares.items():
        below = least + (1 << 64) * SAMPLE // n if n > SAMPLE else None
        wanted = F.col("lang") == F.lit(lang)
        place = place | (wanted if below is None else wanted & (F.col("place") < F.lit(below)))
    return rows.where(place).groupBy("lang", "place").agg(F.first("text").alias("text"))


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            counts.update((lang, word) for word in words_of(text))
        yield pa.record_batch(
            [
                pa.array([k[0] for k in counts], pa.int32()),
                pa.array([k[1] for k in counts], pa.string()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["lang", "word", "n"],
        )


def expected_counts(
    pieces: Pieces, words: list[str], lang: np.ndarray, n: np.ndarray, p: np.ndarray
) -> np.ndarray:
    """How often each piece stands in the words, ``n`` of each, in its language: the mean over all
    segmentations, by their probability."""
    counts = np.zeros(p.size)
    for block in word_blocks(words, 4):
        m = pieces.matches(words[block])
        own = np.repeat(np.arange(len(m.first)), m.last - m.first + 1)[m.start]
        cell = m.piece.astype(np.int64) * p.shape[1] + lang[block][own]
        weight = p.reshape(-1)[cell].astype(np.float64)
        before, after = m.forward(weight), m.backward(weight)
        share = before[m.start] * weight * after[m.end] * (n[block] / before[m.last])[own]
        counts += np.bincount(cell, share, p.size)
    return counts.reshape(p.shape)


def trained(docs: DataFrame, path: str) -> Model | None:
    """The model of all languages that rows outside the held-out fold name; None without any.

    Labels are counted over all rows. Piece probabilities are fitted on about ``SAMPLE`` different
    texts of each language: their words are counted, and each round of expectation maximisation
    gathers expected counts of pieces, a bounded table, from all those words.
    """
    spark = docs.sparkSession
    rows = docs.where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"),
        whole_text(F.col("text")).alias("text"),
        F.xxhash64(whole_text(F.col("text"))).alias("place"),
    )
    found = (
        rows.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("place", 0.02).alias("texts"))
        .limit(LANGUAGES + 1)
        .collect()
    )
    if len(found) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    if not found:
        return None
    found.sort()
    languages = [r.lang for r in found]
    number = spark.createDataFrame(
        [(r.lang, k) for k, r in enumerate(found)], "its string, number int"
    )
    sample = sampled(rows, {r.lang: r.texts for r in found}).join(
        F.broadcast(number), F.col("lang") == F.col("its")  # at most LANGUAGES rows
    )
    words = stored(
        sample.select(F.col("number").alias("lang"), "text")
        .mapInArrow(counted_words, "lang int, word string, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n")),
        "language-words",
    )
    pieces = pieces_of(path)
    p = np.full((pieces.count, len(languages)), 1 / pieces.count, np.float32)
    for _ in range(ROUNDS):
        p = probabilities(gathered(words, path, p))
    prior = np.array([r.n for r in found], float)
    return Model(languages, prior / prior.sum(), p)


def gathered(words: DataFrame, path: str, p: np.ndarray) -> np.ndarray:
    """Expected counts of the pieces by language over all words."""
    current = words.sparkSession.sparkContext.broadcast(p)  # pieces x languages

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts = pieces_of(path), np.zeros(current.value.shape)
        for batch in batches:
            counts += expected_counts(
                pieces,
                batch["word"].to_pylist(),
                batch["lang"].to_numpy(),
                batch["n"].to_numpy(),
                current.value,
            )
        cell = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array(cell, pa.int64()), pa.array(counts.reshape(-1)[cell])], names=["cell", "n"]
        )

    sums = words.mapInArrow(of_batches, "cell long, n double").groupBy("cell").agg(
        F.sum("n").alias("n")
    ).toArrow()  # at most pieces x languages rows
    counts = np.zeros(p.size)
    counts[sums["cell"].to_numpy()] = sums["n"].to_numpy()
    current.destroy()
    return counts.reshape(p.shape)


def probabilities(counts: np.ndarray) -> np.ndarray:
    smoothed = counts + PRIOR_COUNT
    return np.maximum(smoothed / smoothed.sum(0), FLOOR).astype(np.float32)


# --- prediction -----------------------------------------------------------------------------


def text_blocks(texts: list[str | None]) -> Iterator[slice]:
    begin, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= TEXT_BLOCK:
            yield slice(begin, k + 1)
            begin, size = k + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def judged(pieces: Pieces, model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability."""
    names, scores = [UNKNOWN_LANGUAGE] * len(texts), np.zeros(len(texts))
    for block in text_blocks(texts):
        index: dict[str, int] = {}
        ids, sizes = [], []
        for text in texts[block]:
            found = [index.setdefault(w, len(index)) for w in words_of(text or "")]
            ids += found
            sizes.append(len(found))
        there = np.flatnonzero(sizes)
        if not len(there):
            continue
        logs = log_probabilities(pieces, list(index), model.p)
        first = np.cumsum(sizes) - sizes
        ids = np.array(ids, np.int64)
        total = np.empty((len(there), len(model.languages)))
        for k in range(len(model.languages)):  # one language at a time bounds the memory
            total[:, k] = np.add.reduceat(logs[ids, k], first[there])
        total += np.log(model.prior)
        best = total.argmax(1)
        share = 1 / np.exp(total - total.max(1, keepdims=True)).sum(1)
        for row, k, score in zip((there + block.start).tolist(), best.tolist(), share.tolist()):
            names[row], scores[row] = model.languages[k], score
    return names, scores


def identified(docs: DataFrame, model: Model | None, path: str) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row of ``docs``.

    A text that is NULL or has no letter, and any text where no language was learned, is ``und``
    with score 0. Of equally likely languages the first by name is taken. Rows are judged each by
    their own text, whatever their doc_id.
    """
    broadcast = docs.sparkSession.sparkContext.broadcast(model)  # pieces x languages

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, pieces = broadcast.value, pieces_of(path)
        for batch in batches:
            texts = batch["text"].to_pylist()
            if fitted is None:
                names, scores = [UNKNOWN_LANGUAGE] * len(texts), np.zeros(len(texts))
            else:
                names, scores = judged(pieces, fitted, texts)
            yield pa.record_batch(
                [batch["doc_id"], batch["held_out"], pa.array(names, pa.string()), pa.array(scores)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(
        of_batches, "doc_id long, held_out boolean, lang_pred string, score double"
    )
