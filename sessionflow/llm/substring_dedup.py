"""Repeated passages of words, found by recompression.

Of every window of ``width`` words all but the first occurrence (least doc_id, then earliest start)
are repeats; words covered by a repeat are removed.

1. Rounds of naming runs and pairs give equal windows equal symbols inside. Each window is keyed by its
   anchor symbol and the words on that side of it where the window reaches further. Neighbouring
   windows share their key, so a row stands for several windows.
2. A shuffle by key reveals the keys that occur twice. Only their windows can be repeats.
3. Those windows, and no others, are hashed (96 bits) and shuffled by hash, which verifies which of
   them repeat and which occurrence is first.

Both shuffles move packed columns, one row per task batch and bucket. Within a batch a key or a window is
sent once, whatever its number: copies in the batch are settled there. So no hot
passage reaches one task more often than there are batches. The number of buckets follows the
number of rows, which is counted, so a bucket fits into a task at any size.

Rows with one doc_id are versions of one document: a window that they have at the same start is
one window, and repeated rows get equal results. A row without a doc_id is a document of its own text,
numbered by a hash of it, before all doc_ids; so only equal texts are versions of one. NULL text has no words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import SPACE, Words, mixed, range_hashes, words_of
from .packed import buckets_of, pack, unpack
from .recompression import anchors

WIDTH = 20
ROUNDS = 2
BUCKET_BYTES = 24 << 20
LEAST_BUCKETS = 16
FLUSH_ROWS = 1_000_000
FIRST_ID = -(1 << 63)
#: Numbers for rows without a doc_id, or as many as there are below the least doc_id.
NULL_ROOM = 1 << 62
PACKED = "bucket int, settled boolean, n long, columns binary"


# --- packed columns -------------------------------------------------------------------------


def packed_rows(
    columns: np.ndarray, doc: np.ndarray, bucket: np.ndarray, settled: bool
) -> pa.RecordBatch:
    order = np.lexsort((doc, bucket))  # documents together compress well
    columns, bucket = [c[order] for c in columns], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    pieces = [slice(a, b) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.record_batch(
        [
            pa.array([int(bucket[p.start]) for p in pieces], pa.int32()),
            pa.array([settled] * len(pieces)),
            pa.array([p.stop - p.start for p in pieces], pa.int64()),
            pa.array([pack([c[p] for c in columns]) for p in pieces], pa.binary()),
        ],
        names=["bucket", "settled", "n", "columns"],
    )


def by_document(table: np.ndarray) -> pa.RecordBatch:
    """One row (d, places) for each document in the columns (document, place, number); ``places``
    are its pairs of the other two, as 32-bit numbers. Versions of a document share their places."""
    table, new = sorted_with_new(table, len(table))
    table = table[:, new]
    doc = table[0]
    cuts = np.flatnonzero(np.diff(doc, prepend=doc[:1] - 1))
    pairs = np.ascontiguousarray(table[1:].T.astype(np.uint32))
    offsets = (np.append(cuts, len(doc)) * 8).astype(np.int32)
    places = pa.Array.from_buffers(
        pa.binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(pairs)]
    )
    return pa.record_batch([pa.array(doc[cuts]), places], names=["d", "places"])


def places_of(w: Words, places: list[list[bytes] | None]) -> tuple[np.ndarray, ...]:
    """(text, place, number) of all places of the texts of ``w``."""
    joined = [b"".join(p) if p else b"" for p in places[w.rows]]
    text = np.repeat(np.arange(len(joined)), [len(x) // 8 for x in joined])
    pairs = np.frombuffer(b"".join(joined), np.uint32).reshape(-1, 2).astype(np.int64)
    return text, pairs[:, 0], pairs[:, 1]


def of_buckets(
    settle: Callable[[np.ndarray], np.ndarray],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows by document of every bucket: the settled ones, and those that ``settle`` picks.

    Batches come ordered by bucket. Settled and picked columns are (document, place, number).
    """

    def finish(rows: list[np.ndarray], settled: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found = list(settled)
        if rows:
            found.append(settle(np.concatenate(rows, axis=1)))
        table = np.concatenate(found, axis=1) if found else np.empty((3, 0), np.int64)
        if table.shape[1]:
            yield by_document(table)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, settled = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != now:
                    yield from finish(rows, settled)
                    now, rows, settled = row["bucket"], [], []
                table = unpack(row["columns"], row["n"])
                (settled if row["settled"] else rows).append(table)
        yield from finish(rows, settled)

    return of_batches


def sorted_with_new(columns: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray]:
    """Columns in order, and where the first ``keys`` of them change."""
    columns = columns[:, np.lexsort(columns[::-1])]
    new = np.ones(columns.shape[1], bool)
    new[1:] = (columns[:keys, 1:] != columns[:keys, :-1]).any(axis=0)
    return columns, new


# --- keys of windows ------------------------------------------------------------------------


def window_keys(w: Words, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, count) of ranges of windows with equal keys."""
    a = anchors(w.hashes, w.first, w.ends - w.starts, width, ROUNDS)
    room = width - (a.high - a.low)
    right = (room + 1) // 2
    turn = np.clip(a.high - width + right, a.window, a.window + a.count)  # from it on: right side
    begin, end = [a.window, turn], [turn, a.window + a.count]
    low = [a.low - (room - right) - 1, a.low]
    high = [a.high, a.high + right]
    keys, starts, counts = [], [], []
    for side in (0, 1):
        use = end[side] > begin[side]
        words = range_hashes(w.hashes, low[side][use], high[side][use])
        keys.append(words * np.uint64(2 * side + 1) ^ a.name[use])
        starts.append(begin[side][use])
        counts.append((end[side] - begin[side])[use])
    return tuple(np.concatenate(x) for x in (keys, starts, counts))


def window_hashes(w: Words, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    other = (w.hashes >> np.uint64(17)) * np.uint64(0x9FB21C651E98DF25) ^ w.hashes
    return (
        range_hashes(w.hashes, starts, starts + width),
        range_hashes(other, starts, starts + width) >> np.uint64(32),
    )


def gathered(pieces: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    """Tables of columns, joined until they have FLUSH_ROWS rows."""
    waiting, rows = [], 0
    for piece in pieces:
        waiting.append(piece)
        rows += piece.shape[1]
        if rows >= FLUSH_ROWS:
            yield np.concatenate(waiting, axis=1)
            waiting, rows = [], 0
    if rows:
        yield np.concatenate(waiting, axis=1)


def sent_and_settled(
    sent: np.ndarray, doc: np.ndarray, settled: np.ndarray, n_buckets: int
) -> Iterator[pa.RecordBatch]:
    """Packed rows: those that meet others at their bucket, and those that only pass through."""
    yield packed_rows(sent, doc, buckets_of(sent[0], n_buckets), False)
    if settled.shape[1]:
        # they meet no others, so copies of one passage are spread by document
        bucket = buckets_of(mixed(settled[0].view(np.uint64)), n_buckets)
        yield packed_rows(settled, settled[0], bucket, True)


def key_rows(width: int, n_buckets: int) -> Callable:
    """Packed (key, document, first window, count); a key that a batch has twice is settled."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            ids = batch["d"].to_numpy()
            for w in words_of(batch["text"], SPACE, False):
                keys, start, count = window_keys(w, width)
                text = np.searchsorted(w.first, start, "right") - 1
                yield np.stack(
                    [keys.view(np.int64), ids[w.rows][text], start - w.first[text], count]
                )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(pieces(batches)):
            table, new = sorted_with_new(table, 1)
            twice = twice_or_more(new)
            sent = table[:, new]
            yield from sent_and_settled(sent, sent[1], table[1:, twice], n_buckets)

    return of_batches


def twice_or_more(new: np.ndarray) -> np.ndarray:
    """Rows of groups of two or more, from where groups begin."""
    found = ~new
    found[:-1] |= ~new[1:]
    return found


def keys_twice(columns: np.ndarray) -> np.ndarray:
    """Places of keys that several batches have."""
    columns, new = sorted_with_new(columns, 1)
    return columns[1:, twice_or_more(new)]


def window_rows(width: int, n_buckets: int) -> Callable:
    """Packed (hash, second hash, document, start) of candidate windows. Of windows that a batch has
    several times the first is sent; the others are settled as repeats."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            ids = batch["d"].to_numpy()
            places = batch["candidates"].to_pylist()
            for w in words_of(batch["text"], SPACE, False):
                text, start, count = places_of(w, places)
                end = np.maximum(w.first[1:] - width + 1, w.first[:-1])[text]
                start = w.first[text] + start
                change = np.zeros(len(w.hashes) + 1, np.int64)  # a version may be shorter
                np.add.at(change, np.minimum(start, end), 1)
                np.add.at(change, np.minimum(start + count, end), -1)
                at = np.flatnonzero(np.cumsum(change) > 0)
                one, two = window_hashes(w, at, width)
                text = np.searchsorted(w.first, at, "right") - 1
                yield np.stack(
                    [one.view(np.int64), two.view(np.int64), ids[w.rows][text], at - w.first[text]]
                )

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in gathered(pieces(batches)):
            table, new, again = first_and_again(table)
            sent, settled = table[:, new], table[:, again]
            yield from sent_and_settled(sent, sent[2], settled[[2, 3, 1]], n_buckets)

    return of_batches


def first_and_again(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted columns, the first occurrence of each window, and all others. A version of the first
    occurrence (same document and start) is none of the others."""
    columns, new = sorted_with_new(columns, 2)
    first = columns[2:, new][:, np.cumsum(new) - 1]
    return columns, new, (columns[2:] != first).any(axis=0)


def repeats(columns: np.ndarray) -> np.ndarray:
    """(document, start, second hash) of all windows but the first of each."""
    columns, _, again = first_and_again(columns)
    return columns[:, again][[2, 3, 1]]


# --- documents ------------------------------------------------------------------------------


def shuffled(rows: DataFrame, n_buckets: int) -> DataFrame:
    return rows.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")


def with_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``docs`` (columns d, text and others) with ``repeats``: packed (start, second hash) of each
    repeated window of the document, as an array of binaries, or NULL."""
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n_buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    candidates = (
        shuffled(docs.select("d", "text").mapInArrow(key_rows(width, n_buckets), PACKED), n_buckets)
        .mapInArrow(of_buckets(keys_twice), "d long, places binary")
        .groupBy("d")
        .agg(F.collect_list("places").alias("candidates"))
    )
    # both joins read all columns, so they share one shuffle of the documents
    found = (
        shuffled(docs.join(candidates, "d", "left").mapInArrow(window_rows(width, n_buckets), PACKED), n_buckets)
        .mapInArrow(of_buckets(repeats), "d long, places binary")
        .groupBy("d")
        .agg(F.collect_list("places").alias("repeats"))
    )
    return docs.join(found, "d", "left")


def removed_mask(w: Words, places: list[list[bytes] | None], width: int) -> np.ndarray:
    """Which words of ``w`` a repeated window covers."""
    text, start, check = places_of(w, places)
    use = start <= np.diff(w.first)[text] - width
    at, check = (w.first[text] + start)[use], check[use]
    at = at[window_hashes(w, at, width)[1].view(np.int64) == check]
    cover = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + width, -1)
    return np.cumsum(cover)[:-1] > 0


def kept_text(w: Words, k: int, mask: np.ndarray, text: bytes) -> bytes:
    """Words of text ``k`` that stay, joined by one space."""
    words = text.split()
    gone = mask[w.first[k] : w.first[k + 1]]
    if gone.any():
        words = [words[i] for i in np.flatnonzero(~gone).tolist()]
    return b" ".join(words)


def numbered(docs: DataFrame) -> Column:
    """The document's number: its doc_id, or one fixed by the text that is less than all doc_ids."""
    doc_id = F.col("doc_id").cast("long")
    least = docs.agg(F.min(doc_id)).head()[0]
    room = NULL_ROOM if least is None else max(1, min(NULL_ROOM, least - FIRST_ID))
    own = F.pmod(F.xxhash64(F.col("text").cast("string")), F.lit(room).cast("long"))
    return F.coalesce(doc_id, F.lit(FIRST_ID).cast("long") + own).alias("d")


def kept_words(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row: ``kept`` are its words without the repeats,
    joined by one space."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch["repeats"].to_pylist()
            texts = batch["text"].cast(pa.binary()).to_pylist()
            counts, removed, kept = [], [], []
            for w in words_of(batch["text"], SPACE, False):
                mask = removed_mask(w, places, width)
                covered = np.concatenate([[0], np.cumsum(mask)])[w.first]
                counts += np.diff(w.first).tolist()
                removed += np.diff(covered).tolist()
                kept += [
                    kept_text(w, k, mask, text or b"") for k, text in enumerate(texts[w.rows])
                ]
            yield pa.record_batch(
                [
                    batch["doc_id"],
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    rows = docs.select(
        numbered(docs), F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")
    )
    return with_repeats(rows, width).mapInArrow(
        of_batches, "doc_id long, n_words long, n_removed long, kept string"
    )


def without_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``docs`` with all columns. A text with repeated passages becomes its kept words,
    joined by one space; other texts stay as they are."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch["repeats"].to_pylist()
            texts = batch["text"].cast(pa.binary()).to_pylist()
            for w in words_of(batch["text"], SPACE, False):
                mask = removed_mask(w, places, width)
                covered = np.diff(np.concatenate([[0], np.cumsum(mask)])[w.first])
                for k in np.flatnonzero(covered).tolist():
                    row = w.rows.start + k
                    texts[row] = kept_text(w, k, mask, texts[row])
            yield pa.record_batch(
                [pa.array(texts, pa.binary()).cast(pa.string()), batch["rest"]],
                names=["text", "rest"],
            )

    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(
        numbered(docs),
        F.col("text").cast("string").alias("text"),
        F.struct(*(F.col(f"`{c}`") for c in others)).alias("rest"),
    )
    kind = rows.schema["rest"].dataType.simpleString()
    done = with_repeats(rows, width).mapInArrow(of_batches, f"text string, rest {kind}")
    return done.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in docs.columns))
