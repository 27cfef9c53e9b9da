"""SimHash near-duplicates by anchor points of a covering code.

Fingerprints that differ in at most four of 64 bits differ in at most one bit of the first
block of 21 bits, or at most one of the second, or in none of the last 22 (otherwise they would
differ in 2 + 2 + 1 bits). So a block's threshold is 1, 1 and 0.

Anchors of a block of 21 bits are the words of a code: fifteen bits of a Hamming code (covering
radius 1) and six plain bits (radius 0). A fingerprint is at home at the anchor that covers it and
visits every anchor within radius plus threshold of it, fourteen or fifteen of them. If y differs from x in
at most one bit of the block, y visits the home of x. Anchors of the last block are all its values.

Homes and visitors that meet at an anchor are compared on all 64 bits. Only a spanning forest of the
links that a task finds leaves it, never all pairs of a group. An anchor with more visitors than
``chunk`` is cut into a grid of chunks of homes by chunks of visitors, each a group of its own.

Equal fingerprints are one node, whatever their number. NULL text has no words, like an empty one:
fingerprint zero, linked like any other. NULL doc_ids and repeated rows take part; the
component id is the least doc_id that is not NULL.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import free_name
from .components import connected_components, forest
from .store import stored

SHINGLE = 4
SEED = 42
BITS = 4
CODED, PLAIN = 15, 6
BLOCK = CODED + PLAIN
CHUNK = 4096
PAIRS_AT_ONCE = 1 << 22


def fingerprint(text: bytes) -> int:
    """SimHash of the text's shingles of four words, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[: 1 - SHINGLE].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[s:e], SEED) for s, e in zip(starts, (ends[SHINGLE - 1 :] - 1).tolist())],
        dtype="<u8",
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    majority = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(majority, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row; ``fp`` is the fingerprint as a signed 64-bit number."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in batch["text"]],
                dtype=np.uint64,
            )
            yield pa.record_batch(
                [batch["doc_id"], pa.array(found.view(np.int64))], names=["doc_id", "fp"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(of_batches, "doc_id long, fp long")


# --- anchors --------------------------------------------------------------------------------


def syndromes(values: np.ndarray) -> np.ndarray:
    """Syndrome of 15-bit words: the position (from 1) of the bit to flip to reach the code, or 0."""
    found = np.zeros_like(values)
    for bit in range(CODED):
        found ^= np.where((values >> bit) & 1, bit + 1, 0)
    return found


def anchors_of_block(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Home anchor of each 21-bit value; and index and anchor of every visit."""
    coded, plain = values & ((1 << CODED) - 1), values >> CODED
    error = syndromes(coded)
    fix = np.where(error > 0, 1 << np.maximum(error - 1, 0), 0)
    home = (coded ^ fix) | (plain << CODED)
    at, anchors = [np.arange(len(values))], [home]
    for bit in range(PLAIN):
        at.append(np.arange(len(values)))
        anchors.append(home ^ (1 << (CODED + bit)))
    off = np.flatnonzero(error > 0)  # a code word has no other within distance two
    for bit in range(1, CODED + 1):
        other = error[off] ^ bit
        use = (other > bit) & (other <= CODED)
        rows = off[use]
        at.append(rows)
        anchors.append(
            coded[rows] ^ (1 << (bit - 1)) ^ (1 << (other[use] - 1)) | (plain[rows] << CODED)
        )
    return home, np.concatenate(at), np.concatenate(anchors)


def anchor_rows(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, fp, home) of every home and every visit of the fingerprints."""
    bits = fp.view(np.uint64)
    keys, own, home = [], [], []

    def add(block: int, anchor: np.ndarray, whose: np.ndarray, at_home: bool) -> None:
        keys.append(anchor | (block << 24))
        own.append(whose)
        home.append(np.full(len(whose), at_home))

    for block in (0, 1):
        values = ((bits >> np.uint64(block * BLOCK)) & np.uint64((1 << BLOCK) - 1)).astype(np.int64)
        homes, at, visited = anchors_of_block(values)
        add(block, homes, fp, True)
        add(block, visited, fp[at], False)
    rest = (bits >> np.uint64(2 * BLOCK)).astype(np.int64)
    add(2, rest, fp, True)
    add(2, rest, fp, False)
    return np.concatenate(keys), np.concatenate(own), np.concatenate(home)


def replicated(nodes: DataFrame) -> DataFrame:
    """(key, fp, home) for the distinct fingerprints ``nodes`` (column fp)."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, fp, home = anchor_rows(np.asarray(batch["fp"]))
            yield pa.record_batch(
                [pa.array(key), pa.array(fp), pa.array(home)], names=["key", "fp", "home"]
            )

    return nodes.select("fp").mapInArrow(of_batches, "key long, fp long, home boolean")


def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= BITS


def links_in_groups(
    group: np.ndarray, fp: np.ndarray, home: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links of homes and visitors of equal ``group`` (sorted)."""
    visit = ~home
    visitors, visiting = fp[visit], group[visit]
    homes, living = fp[home], group[home]
    first = np.searchsorted(visiting, living, "left")
    count = np.searchsorted(visiting, living, "right") - first
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    done = 0
    ends = np.cumsum(count)
    while done < len(homes):
        until = max(
            done + 1,
            int(np.searchsorted(ends, (ends[done - 1] if done else 0) + PAIRS_AT_ONCE, "right")),
        )
        n = count[done:until]
        a = np.repeat(homes[done:until], n)
        index = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[done:until], n)
        b = visitors[index]
        linked = (a < b) & near(a, b)  # the pair also meets at the home of the other
        x, y = forest(a[linked], b[linked])
        left.append(x)
        right.append(y)
        done = until
    return forest(np.concatenate(left), np.concatenate(right))


def links_of_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of batches that come ordered by key and part; an unfinished group waits."""
    names = ("key", "part", "fp", "home")
    rest = [np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool)]

    def found(rows: list[np.ndarray]) -> pa.RecordBatch:
        key, part, fp, home = rows
        change = np.ones(len(key), bool)
        change[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
        a, b = links_in_groups(np.cumsum(change), fp, home)
        return pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    for batch in batches:
        rows = [
            np.concatenate([kept, batch[name].to_numpy(zero_copy_only=False)])
            for kept, name in zip(rest, names)
        ]
        if not len(rows[0]):
            continue
        same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])
        start = int(np.argmax(same))
        if start:
            yield found([x[:start] for x in rows])
        rest = [x[start:] for x in rows]
    if len(rest[0]):
        yield found(rest)


def near_links(nodes: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints connected by steps of at most four bits."""
    rows = replicated(nodes)
    hot = stored(
        rows.groupBy("key")
        .agg(
            F.count_if(F.col("home")).alias("homes"), F.count_if(~F.col("home")).alias("visitors")
        )
        .where(F.col("visitors") > chunk)
        .select(
            "key",
            F.ceil(F.col("homes") / chunk).cast("int").alias("n_i"),
            F.ceil(F.col("visitors") / chunk).cast("int").alias("n_j"),
        ),
        "hot-anchors",
    )
    one = F.lit(1)
    n_i, n_j = F.greatest(F.coalesce("n_i", one), one), F.greatest(F.coalesce("n_j", one), one)
    own = F.xxhash64("fp")
    parts = F.when(
        F.col("home"),
        F.transform(F.sequence(F.lit(0), n_j - 1), lambda j: F.pmod(own, n_i) * n_j + j),
    ).otherwise(
        F.transform(F.sequence(F.lit(0), n_i - 1), lambda i: i * n_j + F.pmod(own, n_j))
    )
    dealt = rows.join(hot, "key", "left").select(
        "key", F.explode(parts).alias("part"), "fp", "home"
    )
    return (
        dealt.repartition("key", "part")
        .sortWithinPartitions("key", "part")
        .mapInArrow(links_of_sorted, "a long, b long")
    )


def near_components(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    fps = stored(fingerprints(docs), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = connected_components(near_links(nodes, chunk))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least_id"
    )
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_node = rooted.join(ids, "root").select("fp", "component_id")
    return fps.join(of_node, "fp")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their components, with all columns.

    A doc_id names a document: what stays is the rows of each component's least doc_id, and of
    rows with equal doc_id and text one. A component without any doc_id keeps its rows.
    """
    found = near_components(docs)
    kept = free_name(docs, "kept_id")
    keep = (
        found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .select(F.col("doc_id").alias(kept))
        .distinct()
    )
    rows = docs.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col(kept)), "left_semi")
    return rows.dropDuplicates(["doc_id", "text"])
