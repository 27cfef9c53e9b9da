"""Token ids in files of shuffled planes.

A file holds the ids of consecutive documents. Blocks of ``BLOCK`` ids are transposed into byte planes
(all lowest bytes, all second bytes, ...) or bit planes, each compressed with zstandard; planes
without a set bit are left out. Behind the blocks stand the document table (doc_id, number of ids), packed the
same way, and the chunk index: offset, number of ids and plane sizes of every block, so any block can
be read alone.

Documents are dealt to files by ranges of doc_id, so files in order hold ids in ascending order of doc_id;
rows of one doc_id are ordered by a hash of the text and the text. Long runs of one doc_id are split over files. A
file is written under a name of its own and then moved, and its content depends on its rows alone, so
a task that runs twice leaves the same file.

Texts are encoded word by word: the tokenizer's normalizer and split pattern never look across white space
(which the tests check on whole texts), so a worker asks the tokenizer once for each different word and
keeps the answers, up to ``CACHE`` of them.

NULL text is empty and has only the end id. NULL doc_ids come first. An empty table has no files' rows.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import SPACE, Words, words_of

MAGIC = b"IDPL"
BLOCK = 1 << 16
CACHE = 2_000_000
END_ID = 1
FILE_BYTES = 48 << 20
FILES = "part int, path string, n_docs long, n_ids long"


# --- planes ---------------------------------------------------------------------------------


def planes_of(values: np.ndarray, bits: bool) -> list[bytes]:
    """Compressed planes of unsigned numbers, lowest first; empty planes are empty bytes."""
    table = values.view(np.uint8).reshape(len(values), values.itemsize)
    if bits:
        table = np.unpackbits(table, axis=1, bitorder="little")
    found = []
    for plane in table.T:
        if not plane.any():
            found.append(b"")
            continue
        raw = np.packbits(plane) if bits else np.ascontiguousarray(plane)
        found.append(zstandard.ZstdCompressor(level=3).compress(raw.tobytes()))
    return found


def values_of(planes: list[bytes], n: int, dtype: str, bits: bool) -> np.ndarray:
    table = np.zeros((n, len(planes)), np.uint8)
    for k, plane in enumerate(planes):
        if plane:
            raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(plane), np.uint8)
            table[:, k] = np.unpackbits(raw, count=n) if bits else raw
    if bits:
        table = np.packbits(table, axis=1, bitorder="little")
    return np.ascontiguousarray(table).view(dtype).ravel()


class Writer:
    """Writes ids to an open binary file, block by block."""

    def __init__(self, file, bits: bool = False, block: int = BLOCK) -> None:
        self.file, self.bits, self.block = file, bits, block
        self.waiting: list[np.ndarray] = []
        self.n_waiting, self.n_ids, self.offset = 0, 0, len(MAGIC)
        self.index: list[list] = []
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        file.write(MAGIC)

    def add(self, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> None:
        self.ids += doc_ids
        self.lengths += lengths
        self.waiting.append(ids.astype("<u4"))
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block:
            ids = np.concatenate(self.waiting)
            whole = len(ids) - len(ids) % self.block
            for at in range(0, whole, self.block):
                self._write(ids[at : at + self.block])
            self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def _write(self, values: np.ndarray) -> None:
        planes = planes_of(values, self.bits)
        self.index.append([self.offset, len(values), [len(p) for p in planes]])
        for plane in planes:
            self.file.write(plane)
            self.offset += len(plane)

    def close(self) -> None:
        if self.n_waiting:
            self._write(np.concatenate(self.waiting))
        blocks = len(self.index)
        null = np.array([i is None for i in self.ids], "<u8")
        for column in (
            np.array([i or 0 for i in self.ids], "<i8").view("<u8"),
            null,
            np.array(self.lengths, "<u8"),
        ):
            self._write(column)
        foot = json.dumps(
            {"bits": self.bits, "chunks": self.index[:blocks], "documents": self.index[blocks:]}
        ).encode()
        foot = zstandard.ZstdCompressor().compress(foot)
        self.file.write(foot)
        self.file.write(struct.pack("<Q", len(foot)) + MAGIC)


class Reader:
    """Reads a file of ``Writer`` from a random access file."""

    def __init__(self, file) -> None:
        self.file = file
        size = file.size()
        file.seek(size - 12)
        length, magic = struct.unpack("<Q4s", file.read(12))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        file.seek(size - 12 - length)
        foot = json.loads(zstandard.ZstdDecompressor().decompress(file.read(length)))
        self.bits, self.chunks = foot["bits"], foot["chunks"]
        ids, null, lengths = (self._read(entry, "<u8") for entry in foot["documents"])
        self.lengths = lengths.astype(np.int64)
        self.doc_ids = [None if n else i for i, n in zip(ids.view("<i8").tolist(), null.tolist())]

    def _read(self, entry: list, dtype: str) -> np.ndarray:
        offset, n, sizes = entry
        self.file.seek(offset)
        planes = [self.file.read(size) if size else b"" for size in sizes]
        return values_of(planes, n, dtype, self.bits)

    def chunk(self, k: int) -> np.ndarray:
        """The ids of block ``k``."""
        return self._read(self.chunks[k], "<u4")

    def documents(self) -> Iterator[tuple[int | None, int, Iterator[np.ndarray]]]:
        """(doc_id, first id in this file, pieces of its ids); pieces are to be read in order."""
        at, k, ids = 0, -1, np.empty(0, np.uint32)

        def pieces(n: int) -> Iterator[np.ndarray]:
            nonlocal k, ids
            while n:
                if not len(ids):
                    k += 1
                    ids = self.chunk(k)
                yield ids[:n]
                n, ids = n - len(ids[:n]), ids[n:]

        for doc_id, n in zip(self.doc_ids, self.lengths.tolist()):
            yield doc_id, at, pieces(n)
            at += n


# --- encoding -------------------------------------------------------------------------------


class WordEncoder:
    """Ids of words, asked of the tokenizer once and kept in sorted arrays."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        if len(self.known) + len(hashes) > CACHE:
            self._forget()
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.array([len(x) for x in ids], np.int64)
        begin = np.cumsum(size) - size + len(self.pool)
        self.pool = np.concatenate([self.pool, np.array([i for x in ids for i in x], np.uint32)])
        at = np.searchsorted(self.known, hashes)
        self.begin = np.insert(self.begin, at, begin)
        self.size = np.insert(self.size, at, size)
        self.known = np.insert(self.known, at, hashes)

    def encode(self, w: Words) -> tuple[list[int], np.ndarray]:
        """Number of ids of each text, and the ids of all, an end id after each text."""
        hashes, one, which = np.unique(w.hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, hashes)
        found = at < len(self.known)
        found[found] = self.known[at[found]] == hashes[found]
        if not found.all():
            if len(self.known) + (~found).sum() > CACHE:
                self._forget()
                found[:] = False
            data, new = w.data.tobytes(), one[~found]
            words = [
                data[a:b].decode() for a, b in zip(w.starts[new].tolist(), w.ends[new].tolist())
            ]
            self._learn(hashes[~found], words)
            at = np.searchsorted(self.known, hashes)
        begin, size = self.begin[at][which], self.size[at][which]
        upto = np.cumsum(size)
        flat = self.pool[
            np.arange(size.sum()) - np.repeat(upto - size, size) + np.repeat(begin, size)
        ]
        ends = np.concatenate([[0], upto])[w.first[1:]]
        ids = np.insert(flat, ends, END_ID)
        return (np.diff(ends, prepend=0) + 1).tolist(), ids


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def file_system(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def written(docs: DataFrame, path: str, tokenizer: str, bits: bool = False) -> list:
    """Encode ``docs`` into files under ``path``; the list of files in order (part, path, n_docs, n_ids)."""

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        system, folder = file_system(path)
        name, own = f"part-{part:06d}.idpl", f".{uuid.uuid4().hex}"
        encoder, writer = word_encoder(tokenizer), None
        with system.open_output_stream(f"{folder}/{own}") as file:
            writer = Writer(file, bits)
            for batch in batches:
                ids = batch["doc_id"].to_pylist()
                for w in words_of(batch["text"], SPACE, False):
                    writer.add(ids[w.rows], *encoder.encode(w))
            writer.close()
        system.move(f"{folder}/{own}", f"{folder}/{name}")
        yield pa.record_batch(
            [
                pa.array([part], pa.int32()),
                pa.array([name]),
                pa.array([len(writer.ids)], pa.int64()),
                pa.array([writer.n_ids], pa.int64()),
            ],
            names=["part", "path", "n_docs", "n_ids"],
        )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    system, folder = file_system(path)
    system.create_dir(folder)
    order = ("doc_id", F.xxhash64("text"), "text")
    files = (
        rows.repartitionByRange(max(least, 1 + size // FILE_BYTES), *order[:2])
        .sortWithinPartitions(*order)
        .mapInArrow(of_partition, FILES)
    )
    return sorted(files.collect())  # one row for each file


def read_back(spark, path: str, files: list) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""

    def of_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = file_system(path)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{folder}/{row['path']}") as file:
                    found = []
                    for doc_id, at, pieces in Reader(file).documents():
                        crc, n = 0, 0
                        for ids in pieces:
                            crc, n = zlib.crc32(ids.astype("<u4").tobytes(), crc), n + len(ids)
                        found.append((doc_id, row["base"] + at, n, crc))
                yield pa.record_batch(
                    [pa.array(list(c), pa.int64()) for c in zip(*found)] if found
                    else [pa.array([], pa.int64())] * 4,
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    rows, base = [], 0
    for file in files:
        if file["n_docs"]:
            rows.append((file["path"], base))
        base += file["n_ids"]
    listed = spark.createDataFrame(rows, "path string, base long")
    return listed.repartition(max(1, len(rows))).mapInArrow(
        of_files, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
