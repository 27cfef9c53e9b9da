"""Benchmark decontamination with suffix arrays over shards of the training documents.

Each task batch is a shard. Its suffixes, as numbers of words of the benchmark's vocabulary, are sorted
up to the width of a window; every suffix of every benchmark item is searched in them by
bisection. What is found at consecutive places is one verbatim match, as long as it goes.

A suffix whose first words are not all words of the benchmark can equal no window, so it is not
sorted. Words are compared by 64-bit hashes.

The benchmark is read in blocks of about ``block_bytes`` of text, each broadcast and searched in a pass
over all documents; passes keep rows where they are, so nothing is shuffled however many there are. A
broadcast holds eight bytes a word and eight a different word, no more than six bytes for each byte of text.
Every pass but the last is written, so that no executor ever holds two blocks.

NULL text has no words. An item of fewer words than the window is one window; an item without words has
none. Items with NULL item_id count under the empty id. Repeated item_ids are one item; repeated
documents, and NULL doc_ids, are rows of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import BASE, NO_WORD, Words, words_of
from .store import remove_stored, stored, stored_count

WIDTH = 10
BLOCK_BYTES = 16 << 20
#: Windows whose keys exist at the same time.
AT_ONCE = 1 << 17
PRESENCE_BITS = 20
MATCHES = "array<struct<item_id:bigint,doc_start:bigint,item_start:bigint,n_words:bigint>>"


class TestSuffixes:
    """Windows of a block of benchmark items, in a form to be searched for.

    What is kept is one number for each word and one for each window, beside the vocabulary; the keys
    of windows are built when they are searched, some at a time.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], width: int) -> None:
        self.width = width
        self.items = [item_id for item_id, _ in items]
        hashes, counts = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)]
        for w in words_of(pa.array([t for _, t in items], pa.string()), NO_WORD, True):
            hashes.append(w.hashes)
            counts.append(np.diff(w.first))
        self.bounds = np.cumsum(np.concatenate(counts))
        self.vocabulary, numbers = np.unique(np.concatenate(hashes), return_inverse=True)
        self.numbers = np.append(numbers.astype(np.uint32) + np.uint32(1), np.zeros(width, np.uint32))
        lengths = np.diff(self.bounds)
        n = np.where(lengths > 0, np.maximum(lengths - width, 0) + 1, 0)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.windows = (at + np.repeat(self.bounds[:-1], n)).astype(np.int32)
        self.shortest = int(np.minimum(lengths[lengths > 0], width).min(initial=width))
        self.present = np.zeros(1 << PRESENCE_BITS, bool)
        self.present[self._slot(self.vocabulary)] = True

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - PRESENCE_BITS)).astype(np.int64)

    @staticmethod
    def _ends(first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Slots of windows by their first and last word."""
        mixed = first.astype(np.uint64) * np.uint64(BASE) + last.astype(np.uint64)
        return TestSuffixes._slot(mixed * np.uint64(BASE))

    def places(self, window: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the item, first word in it and length of each of the windows."""
        at = self.windows[window].astype(np.int64)
        item = np.searchsorted(self.bounds, at, "right") - 1
        length = np.minimum(self.bounds[item + 1] - self.bounds[item], self.width)
        return item, at - self.bounds[item], length

    def numbers_of(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary numbers from 1; 0 for words that no item has."""
        found = np.zeros(len(hashes), np.uint32)
        maybe = np.flatnonzero(self.present[self._slot(hashes)])
        at = np.minimum(
            np.searchsorted(self.vocabulary, hashes[maybe]), len(self.vocabulary) - 1
        )
        hit = self.vocabulary[at] == hashes[maybe]
        found[maybe[hit]] = at[hit] + 1
        return found

    def _keys(self, table: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(table.astype(">u4")).view(f"S{4 * self.width}").ravel()

    def search(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(window, word) of every occurrence of a window in the texts of ``w``."""
        none = np.empty(0, np.int64)
        if not len(self.windows) or not len(w.hashes):
            return none, none
        numbers = self.numbers_of(w.hashes)
        stop = numbers == 0
        ends = np.append(np.flatnonzero(stop), len(numbers))
        run = ends[np.searchsorted(ends, np.arange(len(numbers)))]
        text_end = np.repeat(w.first[1:], np.diff(w.first))
        run = np.minimum(run, text_end) - np.arange(len(numbers))
        places = np.flatnonzero(run >= self.shortest)
        if not len(places):
            return none, none
        offsets = np.arange(self.width)
        padded = np.append(numbers, np.zeros(self.width, np.uint32))
        table = padded[places[:, None] + offsets]
        table[offsets >= run[places][:, None]] = 0
        begun = np.zeros(len(self.vocabulary) + 1, bool)
        begun[table[:, 0]] = True
        whole = table[table[:, -1] > 0]
        held = np.zeros(1 << PRESENCE_BITS, bool)
        held[self._ends(whole[:, 0], whole[:, -1])] = True
        keys = self._keys(table)
        order = np.argsort(keys, kind="stable")  # the shard's suffix array
        keys, places = keys[order], places[order]
        windows, found = [none], [none]
        for start in range(0, len(self.windows), AT_ONCE):
            window, at = self._search_some(start, keys, begun, held)
            windows.append(window)
            found.append(places[at])
        return np.concatenate(windows), np.concatenate(found)

    def _search_some(
        self, start: int, keys: np.ndarray, begun: np.ndarray, held: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(window, place among the keys) for AT_ONCE windows from ``start``. Those whose first word begins
        no suffix, or whose first and last word no suffix has, are in none and are not bisected."""
        at = self.windows[start : start + AT_ONCE]
        maybe = np.flatnonzero(begun[self.numbers[at]])
        _, _, length = self.places(start + maybe)
        at = at[maybe]
        use = (length < self.width) | held[self._ends(self.numbers[at], self.numbers[at + self.width - 1])]
        own, at, length = start + maybe[use], at[use], length[use]
        offsets = np.arange(self.width)
        low = self.numbers[at[:, None] + offsets]
        after = offsets >= length[:, None]
        low[after] = 0
        first = np.searchsorted(keys, self._keys(low), "left")
        low[after] = 0xFFFFFFFF
        count = np.searchsorted(keys, self._keys(low), "right") - first
        which = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(own, count), which + np.repeat(first, count)


def longest(window: np.ndarray, place: np.ndarray, tests: TestSuffixes) -> list[dict]:
    """Matches of one document: windows at consecutive places of item and document joined."""
    found: list[dict] = []
    rows = sorted(
        ("" if tests.items[k] is None else str(tests.items[k]), p - at, p, at, n, k)
        for k, at, n, p in zip(*(x.tolist() for x in (*tests.places(window), place)))
    )
    for name, diagonal, p, at, n, k in rows:
        last = found[-1] if found else None
        if last and last["key"] == (name, diagonal) and p <= last["doc_start"] + last["n_words"]:
            end = p + n - last["doc_start"]
            last["n_words"] = max(last["n_words"], end)  # rows of one item_id differ in length
        else:
            found.append(
                {
                    "key": (name, diagonal),
                    "item_id": tests.items[k],
                    "doc_start": p,
                    "item_start": at,
                    "n_words": n,
                }
            )
    return [{k: v for k, v in m.items() if k != "key"} for m in found]


def blocks_of(benchmark: DataFrame, block_bytes: int) -> int:
    total = benchmark.agg(F.sum(F.octet_length(F.col("text").cast("string")))).head()[0] or 0
    return 1 + total // block_bytes


def with_matches(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """(row, text, n_words, matches) of every row: ``row`` has all its other columns,
    ``matches`` the longest verbatim matches of benchmark items, in words."""
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*others).alias("row"),
        F.col("text").cast("string").alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast(MATCHES).alias("matches"),
    )
    schema = f"row {rows.schema['row'].dataType.simpleString()}, text string, n_words long, matches {MATCHES}"
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).distinct()
    n_blocks = blocks_of(items, block_bytes)
    mark = stored_count()
    for block in range(n_blocks):
        # at most about block_bytes of text, whatever the size of the benchmark
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == block)
        tests = spark.sparkContext.broadcast(
            TestSuffixes(sorted(map(tuple, own.collect()), key=repr), width)
        )
        rows = rows.mapInArrow(searched(tests), schema)
        if block + 1 < n_blocks:
            rows = stored(rows, "searched")
            remove_stored(spark, mark, but_last=True)
            tests.destroy()
    return rows


def searched(broadcast):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = broadcast.value
        for batch in batches:
            counts = np.zeros(len(batch), np.int64)
            matches = batch["matches"].to_pylist()
            for w in words_of(batch["text"], NO_WORD, True):
                counts[w.rows] = np.diff(w.first)
                window, place = tests.search(w)
                text = np.searchsorted(w.first, place, "right") - 1
                order = np.argsort(text, kind="stable")
                window, place, text = window[order], place[order], text[order]
                for k in np.unique(text).tolist():
                    a, b = np.searchsorted(text, [k, k + 1])
                    matches[w.rows.start + k] = (matches[w.rows.start + k] or []) + longest(
                        window[a:b], place[a:b] - w.first[k], tests
                    )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["row"],
                    batch["text"],
                    pa.array(counts),
                    pa.array(matches, batch.schema.field("matches").type),
                ],
                names=["row", "text", "n_words", "matches"],
            )

    return of_batches


def n_hit(matches: list[dict] | None) -> int:
    """Words covered by the matches."""
    covered, end = 0, 0
    for start, stop in sorted((m["doc_start"], m["doc_start"] + m["n_words"]) for m in matches or []):
        covered += max(0, stop - max(start, end))
        end = max(end, stop)
    return covered


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matches = batch["matches"].to_pylist()
            hit = [n_hit(m) for m in matches]
            items = [
                sorted({"" if x["item_id"] is None else str(x["item_id"]) for x in m or []})
                for m in matches
            ]
            yield pa.record_batch(
                [
                    batch["doc_id"],
                    batch["n_words"],
                    pa.array(hit, pa.int64()),
                    pa.array([len(x) for x in items], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                    pa.array([n > 0 for n in hit]),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
            )

    rows = with_matches(docs.select(F.col("doc_id").cast("long"), "text"), benchmark, width)
    return rows.select(F.col("row.doc_id").alias("doc_id"), "n_words", "matches").mapInArrow(
        of_batches,
        "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with all their columns."""
    rows = with_matches(docs, benchmark, width).where(F.size("matches") == 0)
    return rows.select(*(F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns))
