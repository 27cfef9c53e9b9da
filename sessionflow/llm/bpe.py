"""Byte-level BPE as a monoid: halves of a text are encoded on their own and joined at the seam.

Two facts make a join exact while it looks only at the neighbourhood of the seam:

* Between a character that is no white space and white space the split pattern always has a
  boundary, whatever stands around. So ids left of the last such place before the seam and right
  of the first one after it never change. A join re-encodes what lies between the two, in windows
  that double until both are found.
* In one long match of the pattern (a run of letters, say) a sequence of tokens is the encoding
  if every two neighbours are the encoding of their bytes. A join re-encodes 4, 8, 16, ... tokens on
  either side until the pairs at both edges of the window hold; all other pairs held before.

Decoding joins the bytes of the halves.

NULL text is the empty text: no ids. Rows are encoded one by one; repeated rows and repeated or NULL
doc_ids are kept as they are. A text of any length is held once with its ids in one task.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 1 << 14
PIECE_LEAF = 256
ROWS_AT_ONCE = 256
#: Text whose units are looked up at once.
UNITS_BYTES = 2 << 20
ENCODED = "doc_id long, n_tokens long, ids binary"
#: Characters of the property White_Space, which \\s of the split pattern means. Fixed values.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Kinds of bytes: ASCII white space, those that no character of WHITE ends with, the others.
BLANK, SOLID, EITHER = 2, 1, 0
_ENDS_OF_WHITE = {*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF}
KIND = bytes(
    BLANK if k in b"\t\n\v\f\r " else EITHER if k in _ENDS_OF_WHITE else SOLID for k in range(256)
)
LAST_CUT = regex.compile(r"(?r)(?<=[\p{L}\p{N}.,;:!?])(?=[ \n])")
FIRST_CUT = regex.compile(r"(?<=[\p{L}\p{N}.,;:!?])(?=[ \n])")


class ByteBpe:
    """Encoder and decoder for a file of ranks and a split pattern."""

    def __init__(self, path: str, pattern: str, leaf: int = LEAF) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.core = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe
        self.spaced = {rank for token, rank in ranks.items() if token[:1] == b" "}
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)
        inside = pattern.replace(r"[^\s", f"[^{WHITE}").replace(r"\S", f"[^{WHITE}]")
        self.pieces = regex.compile(inside.replace(r"\s", f"[{WHITE}]"))
        self.leaf = leaf

    def begins_word(self, token: int) -> bool:
        """Whether a token begins with a space."""
        return token in self.spaced

    # --- encoding ---------------------------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        return self._encode(text, 0, len(text))

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``encode`` of all texts, one after the other, and how many ids each has. NULL is the empty text.

        Texts are cut before white space that follows something else, where the split pattern has a boundary
        and no look-ahead crosses. Units between cuts that are there again within some megabytes are
        encoded once.
        """
        upto = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        found, at = [(np.empty(0, np.uint32), np.empty(0, np.int64))], 0
        while at < len(texts):
            so_far = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, so_far + UNITS_BYTES, "right")))
            found.append(self._encode_some(texts[at:to]))
            at = to
        ids, sizes = zip(*found)
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = np.frombuffer(data.tobytes().translate(KIND), np.uint8)
        cut = np.zeros(len(data) + 1, bool)
        np.equal(kind[1:] * 2 + kind[:-1], 2 * BLANK + SOLID, out=cut[1 : len(data)])
        cut[offsets] = True  # of empty texts, too
        begin = np.flatnonzero(cut)
        count = np.diff(np.searchsorted(begin, offsets))
        buffers = [None, pa.py_buffer(begin.astype(np.int64)), pa.py_buffer(data)]
        units = pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, buffers).dictionary_encode()
        which, units = units.indices.to_numpy(), units.dictionary
        ids, length = self._encode_units(units)
        first = (np.cumsum(length) - length).astype(np.int32)
        sizes = length.take(which)
        upto = np.cumsum(sizes)
        at = np.repeat(first.take(which) - (upto - sizes).astype(np.int32), sizes)
        at += np.arange(len(at), dtype=np.int32)
        upto = np.concatenate([[0], upto]).take(np.concatenate([[0], np.cumsum(count)]))
        return ids.take(at), np.diff(upto)

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, one after the other, and how many each has. Those that begin with white space
        and end with something else are encoded as one text, the others on their own."""
        offsets = np.frombuffer(units.buffers()[1], np.int64)[: len(units) + 1]
        data = np.frombuffer(units.buffers()[2] or b"", np.uint8)[: offsets[-1]]
        kind = np.frombuffer(data.tobytes().translate(KIND), np.uint8)
        size = np.diff(offsets)
        plain = (kind.take(offsets[:-1]) == BLANK) & (kind.take(offsets[1:] - 1) == SOLID)
        length = np.zeros(len(units), np.int64)
        own = [self.encode(u.decode()) for u in units.filter(pa.array(~plain)).to_pylist()]
        length[~plain] = [len(x) for x in own]
        ids = self.encode(data[np.repeat(plain, size)].tobytes().decode())
        ends = np.cumsum(size[plain])
        length[plain] = np.diff(np.searchsorted(np.cumsum(self.lengths.take(ids)), ends), prepend=-1)
        found = np.empty(int(length.sum()), np.uint32)
        joined = np.repeat(plain, length)
        found[joined], found[~joined] = ids, np.concatenate([ids[:0], *own])
        return found, length

    def _encode(self, text: str, start: int, end: int) -> np.ndarray:
        if end - start <= self.leaf:
            return self._leaf(text[start:end])
        seam = (start + end) // 2
        return self._join(
            text, start, seam, end, self._encode(text, start, seam), self._encode(text, seam, end)
        )

    def _leaf(self, text: str) -> np.ndarray:
        return np.frombuffer(self.core.encode_to_tiktoken_buffer(text, set()), np.uint32)

    def _join(
        self, text: str, start: int, seam: int, end: int, left: np.ndarray, right: np.ndarray
    ) -> np.ndarray:
        a, b = self._cuts(text, start, seam, end)
        keep_left = self._tokens(left[::-1], len(text[a:seam].encode()))
        keep_right = self._tokens(right, len(text[seam:b].encode()))
        middle = text[a:b]
        again = self._leaf(middle) if b - a <= 2 * self.leaf else self._by_pieces(middle)
        return np.concatenate([left[: len(left) - keep_left], again, right[keep_right:]])

    def _cuts(self, text: str, start: int, seam: int, end: int) -> tuple[int, int]:
        """Last certain boundary up to the seam and first one from it on, or the ends."""
        width = 64
        while True:
            low, high = max(start, seam - width), min(end, seam + width)
            before = LAST_CUT.search(text, low, seam + 1)
            after = FIRST_CUT.search(text, seam, high)
            if (before or low == start) and (after or high == end):
                return before.start() if before else start, after.start() if after else end
            width *= 2

    def _tokens(self, ids: np.ndarray, size: int) -> int:
        """How many of the first ids make up exactly ``size`` bytes."""
        if size == 0:
            return 0
        return int(np.searchsorted(np.cumsum(self.lengths[ids[:size]]), size)) + 1

    def _by_pieces(self, text: str) -> np.ndarray:
        return np.concatenate(
            [np.empty(0, np.uint32)]
            + [self.encode_piece(m.encode()) for m in self.pieces.findall(text)]
        )

    def encode_piece(self, piece: bytes) -> np.ndarray:
        """Ids of one match of the pattern."""
        if len(piece) <= PIECE_LEAF:
            return np.array(self.core.encode_single_piece(piece), np.uint32)
        half = len(piece) // 2
        left, right = self.encode_piece(piece[:half]), self.encode_piece(piece[half:])
        n = 4
        while True:
            i, j = max(0, len(left) - n), min(len(right), n)
            window = self._bytes(left[i:]) + self._bytes(right[:j])
            if i == 0 and j == len(right) or len(window) <= 2 * PIECE_LEAF:
                again = np.array(self.core.encode_single_piece(window), np.uint32)
            else:
                again = self.encode_piece(window)
            if (i == 0 or self._fits(left[i - 1], again[0])) and (
                j == len(right) or self._fits(again[-1], right[j])
            ):
                return np.concatenate([left[:i], again, right[j:]])
            n *= 2

    def _fits(self, a: int, b: int) -> bool:
        return self.core.encode_single_piece(self._bytes(np.array([a, b]))) == [a, b]

    # --- decoding ---------------------------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= self.leaf:
            return self._bytes(ids)
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])

    def _bytes(self, ids: np.ndarray) -> bytes:
        return self.core.decode_bytes(ids.tolist())


@lru_cache(maxsize=4)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One encoder for each file and Python worker."""
    return ByteBpe(path, pattern)


def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what is made of one stays small."""
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def encode_batches(path: str, pattern: str):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in pieces_of(batches):
            ids = [bpe.encode(t or "").astype("<u4") for t in batch["text"].to_pylist()]
            yield pa.record_batch(
                [
                    batch["doc_id"],
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                ],
                names=["doc_id", "n_tokens", "ids"],
            )

    return of_batches


def decode_batches(path: str, pattern: str):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path, pattern)
        for batch in pieces_of(batches):
            texts = [
                None if x is None else bpe.decode(np.frombuffer(x, "<u4"))
                for x in batch["ids"].to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())],
                names=[*batch.schema.names, "decoded"],
            )

    return of_batches


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row; ``ids`` are little-endian unsigned 32-bit numbers."""
    return texts_of(docs).mapInArrow(encode_batches(path, pattern), ENCODED)


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``rows`` of ``encoded`` with ``decoded``, the bytes that the ids stand for. NULL ids: NULL."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(decode_batches(path, pattern), f"{fields}, decoded binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``decoded`` of ``encoded``, both in one Python worker of a task."""
    encode, decode = encode_batches(path, pattern), decode_batches(path, pattern)
    return texts_of(docs).mapInArrow(
        lambda batches: decode(encode(batches)), f"{ENCODED}, decoded binary"
    )


def digests(rows: DataFrame) -> DataFrame:
    """Digests of the ids and of the decoded bytes of ``decoded`` rows."""
    return rows.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
