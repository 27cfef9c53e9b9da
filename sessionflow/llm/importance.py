"""Importance resampling towards a target distribution, on bit-sliced bucket counts.

A document's runs of one to three words fall into 10,000 buckets. Its bucket counts are kept as
planes of 10,000 bits: plane i holds bit i of every count. Corpus totals are sums of such planes by
bitwise addition, and a document's weight is the sum over count planes i and gain planes j of
2^(i+j) times the number of bits that both have, planes of positive gains counted plus and those of
negative gains minus. All of it is exact in integers.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hashing import NO_WORD, Words, windows, words_of
from .store import stored

BUCKETS = 10000
PLANE = BUCKETS // 8
RUNS = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Documents whose counts are held open at once.
BLOCK = 64
#: Words of more bytes are hashed one by one.
LONG_WORD = 32


# --- buckets of word runs -------------------------------------------------------------------


@cache
def byte_table() -> np.ndarray:
    """What one byte does to a CRC-32 (polynomial 0xEDB88320, reflected)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table


def moved(crc: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by its values for each byte."""
    found = tables[0][crc & 255] ^ tables[1][crc >> 8 & 255]
    return found ^ tables[2][crc >> 16 & 255] ^ tables[3][crc >> 24]


@cache
def zero_bytes(power: int) -> np.ndarray:
    """What 2^power zero bytes do to a CRC-32, as four tables by byte."""
    if power:
        half = zero_bytes(power - 1)
        return moved(half.reshape(-1), half).reshape(4, 256)
    values = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return byte_table()[values & 255] ^ values >> 8


def after_bytes(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The CRCs when n bytes follow, but for those bytes' own CRC."""
    found = crc.copy()
    for power in range(int(n.max(initial=0)).bit_length()):
        there = np.flatnonzero(n >> power & 1)
        found[there] = moved(found[there], zero_bytes(power))
    return found


def word_crcs(w: Words) -> np.ndarray:
    """CRC-32 of each word, one byte of all words at a time."""
    lengths = w.ends - w.starts
    order = np.argsort(-lengths, kind="stable")
    size, starts = lengths[order], w.starts[order]
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    table = byte_table()
    long = int(np.searchsorted(-size, -LONG_WORD, "left"))  # words of more bytes come first
    for i in range(min(int(size.max(initial=0)), LONG_WORD)):
        n = int(np.searchsorted(-size, -i, "left"))  # words of more than i bytes
        if n > long:
            old = crc[long:n]
            crc[long:n] = table[(old ^ w.data[starts[long:n] + i]) & 255] ^ old >> 8
    crc ^= np.uint32(0xFFFFFFFF)
    for k in range(long):
        crc[k] = zlib.crc32(w.data[starts[k] : starts[k] + size[k]])
    found = np.empty_like(crc)
    found[order] = crc
    return found


def run_buckets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all runs of one to three words, by the CRC-32 of the words joined by a space.

    The CRC of two strings in a row is that of the first, moved over the length of the second,
    xor that of the second.
    """
    lengths = w.ends - w.starts
    crc = word_crcs(w)
    space = np.full(len(crc), zlib.crc32(b" "), np.uint32)
    spaced = after_bytes(space, lengths) ^ crc  # of a space and the word
    texts, buckets, run = [], [], crc
    for n in range(1, RUNS + 1):
        first, text = windows(w.first, n)
        if n > 1:
            longer = np.zeros_like(run)
            last = first + n - 1
            longer[first] = after_bytes(run[first], lengths[last] + 1) ^ spaced[last]
            run = longer
        texts.append(text)
        buckets.append((run[first] % np.uint32(BUCKETS)).astype(np.int64))
    return np.concatenate(texts), np.concatenate(buckets)


# --- planes ---------------------------------------------------------------------------------


def to_planes(counts: np.ndarray) -> np.ndarray:
    """Planes of the last axis of nonnegative ``counts``: (..., planes, bytes)."""
    shape, flat = counts.shape, counts.reshape(-1)
    there = np.flatnonzero(flat)
    values = flat[there]
    n = max(1, int(values.max(initial=0)).bit_length())
    planes = np.empty((n, *shape[:-1], shape[-1] // 8), np.uint8)
    for i in range(n):
        bits = np.zeros(len(flat), np.uint8)
        bits[there[values >> i & 1 == 1]] = 1
        planes[i] = np.packbits(bits).reshape(planes.shape[1:])
    return np.moveaxis(planes, 0, -2)


def from_planes(planes: np.ndarray) -> np.ndarray:
    """The numbers behind (planes, bytes)."""
    bits = np.unpackbits(planes, axis=-1).astype(np.int64)
    return (bits << np.arange(len(planes))[:, None]).sum(0)


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of numbers in planes (..., planes, bytes), bucket by bucket, by full adders."""
    n = max(a.shape[-2], b.shape[-2]) + 1
    total = np.zeros((*a.shape[:-2], n, a.shape[-1]), np.uint8)
    carry = np.zeros_like(total[..., 0, :])
    for i in range(n - 1):
        x = a[..., i, :] if i < a.shape[-2] else np.zeros_like(carry)
        y = b[..., i, :] if i < b.shape[-2] else np.zeros_like(carry)
        either = x ^ y
        total[..., i, :] = either ^ carry
        carry = x & y | either & carry
    total[..., n - 1, :] = carry
    return total if carry.any() else total[..., :-1, :]


def summed(planes: np.ndarray) -> np.ndarray:
    """The sum over the first axis, halving it in each step."""
    while len(planes) > 1:
        half = len(planes) // 2
        rest = planes[2 * half :]
        planes = added(planes[:half], planes[half : 2 * half])
        if len(rest):
            wide = np.zeros((1, *planes.shape[1:]), np.uint8)
            wide[:, : rest.shape[1]] = rest[:, : wide.shape[1]]
            planes = np.concatenate([planes, wide])
    return planes[0]


class Gains:
    """Gains of the buckets as planes of their sizes, positive ones apart from negative ones."""

    def __init__(self, gains: np.ndarray) -> None:
        self.positive = to_planes(np.maximum(gains, 0))
        self.negative = to_planes(np.maximum(-gains, 0))

    def weights(self, planes: np.ndarray) -> np.ndarray:
        """Sums of gains of documents, given as (documents, planes, bytes)."""
        found = np.zeros(len(planes), np.int64)
        for sign, gains in ((1, self.positive), (-1, self.negative)):
            for i in range(planes.shape[1]):
                for j in range(len(gains)):
                    both = np.bitwise_count(wide(planes[:, i] & gains[j]))
                    found += sign * (both.sum(axis=1, dtype=np.int64) << (i + j))
        return found


def wide(planes: np.ndarray) -> np.ndarray:
    """The bytes as 16-bit numbers, of which there is a whole number."""
    return planes.view(np.uint16)


# --- tables ---------------------------------------------------------------------------------

COUNTED = "doc_id long, n_words long, planes binary"


def counted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document with its number of words and its count planes, one plane after the other."""
    for batch in batches:
        for w in words_of(batch["text"], NO_WORD, True):
            ids = batch["doc_id"].slice(w.rows.start, w.rows.stop - w.rows.start)
            text, bucket = run_buckets(w)
            order = np.argsort(text, kind="stable")
            text, bucket = text[order], bucket[order]
            n = np.diff(w.first)
            for begin in range(0, len(n), BLOCK):
                end = min(begin + BLOCK, len(n))
                lo, hi = np.searchsorted(text, [begin, end])
                counts = np.bincount(
                    (text[lo:hi] - begin) * BUCKETS + bucket[lo:hi],
                    minlength=(end - begin) * BUCKETS,
                ).reshape(-1, BUCKETS)
                most = counts.max(axis=1)
                planes = to_planes(counts)
                blobs = [
                    p[: max(1, m.bit_length())].tobytes() for p, m in zip(planes, most.tolist())
                ]
                yield pa.record_batch(
                    [
                        ids.slice(begin, end - begin),
                        pa.array(n[begin:end].astype(np.int64)),
                        pa.array(blobs, pa.binary()),
                    ],
                    names=["doc_id", "n_words", "planes"],
                )


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, planes) of every row of ``docs``."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(counted_rows, COUNTED)


def plane_blocks(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their planes, documents with equally many planes together, some at a time."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)
    sizes = np.diff(offsets) // PLANE
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for begin in range(0, len(rows), BLOCK):
            some = rows[begin : begin + BLOCK]
            at = offsets[some][:, None] + np.arange(size * PLANE)
            yield some, data[at].reshape(len(some), size, PLANE)


def total_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, n): bucket counts of all documents of a task."""
    total = np.zeros((1, PLANE), np.uint8)
    for batch in batches:
        for _, planes in plane_blocks(batch["planes"]):
            total = added(total, summed(planes))
    counts = from_planes(total)
    there = np.flatnonzero(counts)
    yield pa.record_batch(
        [pa.array(there, pa.int32()), pa.array(counts[there], pa.int64())],
        names=["bucket", "n"],
    )


def bucket_totals(counted: DataFrame) -> np.ndarray:
    """Count of each bucket over all documents; at most 10,000 rows reach the driver."""
    rows = (
        counted.select("planes")
        .mapInArrow(total_rows, "bucket int, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    totals = np.zeros(BUCKETS, np.int64)
    for bucket, n in rows:
        totals[bucket] = n
    return totals


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(p / q)) with p and q the smoothed shares of a bucket in target and source."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
            for s, t in zip(source.tolist(), target.tolist())
        ],
        np.int64,
    )


def draw(doc_id: Column) -> Column:
    """A Gumbel number for each doc_id, in thousandths; NULL counts as an empty id."""
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of documents given by their planes."""
    broadcast = rows.sparkSession.sparkContext.broadcast(gains)  # 10,000 numbers

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced = Gains(broadcast.value)
        for batch in batches:
            weights = np.zeros(batch.num_rows, np.int64)
            for some, planes in plane_blocks(batch["planes"]):
                weights[some] = sliced.weights(planes)
            yield pa.record_batch(
                [batch["doc_id"], batch["n_words"], pa.array(weights)],
                names=["doc_id", "n_words", "weight"],
            )

    features = F.lit(0).cast("long")
    for n in range(RUNS):
        features = features + F.greatest(F.col("n_words") - n, F.lit(0))
    return rows.mapInArrow(of_batches, "doc_id long, n_words long, weight long").select(
        "doc_id",
        "n_words",
        features.alias("n_features"),
        "weight",
        (F.col("weight") + draw(F.col("doc_id"))).alias("score"),
    )


def ranked(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``rows`` with ``rank``: 1, 2, ... for the highest ``percent`` of the scores of documents with
    enough words, NULL for others.

    Documents are dealt out by ranges of (score, doc_id), and written, so that the ranges stay what
    they are. The sizes of the ranges, one number each, tell where every range begins, and only
    ranges that hold drawn documents are ordered, each by a task of its own. ``row`` makes repeated
    rows different, so that they spread over ranges too.
    """
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row")]
    enough = F.col("n_words") >= LEAST_WORDS
    dealt = stored(
        rows.where(enough).repartitionByRange(*order).withColumn("range", F.spark_partition_id()),
        "ranges",
    )
    sizes = sorted(tuple(r) for r in dealt.groupBy("range").count().collect())
    drawn = percent * sum(n for _, n in sizes) // 100
    begins, so_far = [], 0
    for part, n in sizes:
        if so_far < drawn:
            begins.append((part, so_far))
        so_far += n
    unranked = F.lit(None).cast("long")
    last = begins[-1][0] if begins else -1
    result = rows.where(~enough).unionByName(
        dealt.where(F.col("range") > last).drop("range")
    ).withColumn("rank", unranked)
    if begins:
        first = rows.sparkSession.createDataFrame(begins, "of int, before long")
        place = F.row_number().over(Window.partitionBy("range").orderBy(*order))
        top = (
            dealt.where(F.col("range") <= last)
            .withColumn("place", place)
            .join(F.broadcast(first), F.col("range") == F.col("of"))  # a row for each range
            .withColumn("rank", F.col("before") + F.col("place"))
            .withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
        )
        result = result.unionByName(top.select(*result.columns))
    return result


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``.

    ``target`` has the texts whose distribution is wanted. A NULL text has no words, weight 0 and is
    never drawn. Rows of one doc_id share their random number and are ranked each; rows without
    a doc_id come after others of their score. Without documents the result is empty, without a
    target every bucket's share in it is the same.
    """
    planes = stored(counted(docs), "planes")
    target_rows = counted(target.select(F.lit(0).alias("doc_id"), "text"))
    gains = bucket_gains(bucket_totals(planes), bucket_totals(target_rows))
    rows = stored(
        weighed(planes, gains).withColumn("row", F.monotonically_increasing_id()), "weights"
    )
    return ranked(rows, percent).select("doc_id", "n_features", "weight", "score", "rank")
