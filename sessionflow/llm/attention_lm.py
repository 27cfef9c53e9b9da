"""Scores of texts by a causal self-attention model over subword ids, and by word counts.

The model: P(id) = P(class | ids before) P(id | class, ids before). Ids are byte-level BPE ids, and one end of
each text.
The most frequent ids are classes of their own; the others are grouped by the company they keep (which
frequent ids stand near them, so languages part), by whether they begin a word and by
frequency. Both factors come from one self-attention model over the ids, the second through a tree of each
class (``subwords``), trained in numpy on all windows of all training documents: in each of ROUNDS rounds every
chunk trains the shared parameters on its next share of windows, and they are averaged by tokens, those of
single ids and nodes by how often they were met, exactly, so in any order. The company and what the trees
start with are counted over all training documents.

The base: each word's count over all training documents. Documents are read once, in chunks of bounded size as
they lie in their files: a chunk is one row of a table, with the ids of its texts and its different words,
packed. A chunk asks for each of its different words once, so a frequent word, whatever its share, is one
entry for each chunk. Questions and answers travel as packed columns by bucket of words; the chunks
themselves stay where they are, and only the numbers of their words meet the answers.

Documents with crc32(doc_id) mod 5 = 1 are held out: nothing is learned from them. NULL doc_id counts as the
empty text there. NULL text has no words, only the end. Repeated rows are scored, and counted, as often as
they are there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .attention import DIMENSION, Attention, input_classes, scores, window_count, windows_of
from .bpe import ByteBpe, byte_bpe
from .hashing import SPACE, words_of
from .packed import buckets_of, pack, unpack
from .store import stored
from .subwords import Subwords

FOLDS, HELD_OUT = 5, 1
#: Text of a chunk, and least number and text of a bucket of words.
CHUNK_BYTES = 16 << 20
LEAST_BUCKETS, BUCKET_BYTES = 12, 32 << 20
FREQUENT, GROUPS, TIERS = 30, 4, 2
CLASSES = 2 + FREQUENT + GROUPS * 2 * TIERS
#: Every chunk takes at least STEPS steps over all rounds, of LEAST_BATCH to BATCH windows.
STEPS, BATCH, SEED = 600, 256, 7
ROUNDS, LEAST_BATCH = 6, 32
PIECE_IDS = 1 << 17
FIXED_POINT, LOW_BITS = 1 << 24, 20
LOG10 = 1 / np.log(10)


# --- chunks ---------------------------------------------------------------------------------

CHUNK = (
    "chunk long, doc_ids array<long>, held array<boolean>, n_words array<long>, n_ids array<long>, "
    "different array<long>, words binary, counts binary, which binary, ids binary"
)


def id_kind(bpe: ByteBpe) -> type:
    return np.uint16 if len(bpe.lengths) <= 1 << 16 else np.uint32


def packed_ids(ids: np.ndarray) -> bytes:
    """Ids by byte planes, compressed."""
    planes = np.ascontiguousarray(ids.view(np.uint8).reshape(-1, ids.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked_ids(blob: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    ids = np.empty((len(planes) // size, size), np.uint8)
    for k, plane in enumerate(planes.reshape(size, -1)):
        ids[:, k] = plane
    return ids.view(kind).ravel()


def chunk_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a chunk, and where each text's words begin."""
    hashes, first, at = [np.empty(0, np.uint64)], [np.zeros(1, np.int64)], 0
    for w in words_of(texts, SPACE, True):
        hashes.append(w.hashes)
        first.append(w.first[1:] + at)
        at += len(w.hashes)
    return np.concatenate(hashes), np.concatenate(first)


def chunk_row(bpe: ByteBpe, n_buckets: int, number: int, chunk: pa.RecordBatch) -> dict:
    """A chunk's different words in order of their buckets, with how often its training texts have them,
    the numbers of its words among them, and the ids of its texts."""
    hashes, first = chunk_words(chunk["text"])
    words, which = np.unique(hashes, return_inverse=True)
    bucket = buckets_of(words, n_buckets)
    order = np.argsort(bucket, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    which = place[which]
    learned = np.repeat(~chunk["held_out"].to_numpy(zero_copy_only=False), np.diff(first))
    counts = np.bincount(which[learned], minlength=len(words)).astype(np.int64)
    ids, n_ids = bpe.encode_all(chunk["text"])
    return {
        "chunk": number,
        "doc_ids": chunk["doc_id"].to_pylist(),
        "held": chunk["held_out"].to_pylist(),
        "n_words": np.diff(first),
        "n_ids": n_ids,
        "different": np.bincount(bucket, minlength=n_buckets),
        "words": pack([words[order]]),
        "counts": pack([counts]),
        "which": pack([which.astype(np.int64)]),
        "ids": packed_ids(ids.astype(id_kind(bpe))),
    }


def chunk_rows(path: str, pattern: str, n_buckets: int):
    """One row for some megabytes of text, numbered by task and order."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, number = byte_bpe(path, pattern), TaskContext.get().partitionId() << 32
        for batch in batches:
            upto = np.cumsum([len(t.as_buffer() or b"") for t in batch["text"]])
            at = 0
            while at < batch.num_rows:
                so_far = upto[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(upto, so_far + CHUNK_BYTES, "right")))
                row = chunk_row(bpe, n_buckets, number, batch.slice(at, to - at))
                yield pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, CHUNK_TYPE)
                at, number = to, number + 1

    return of_batches


CHUNK_TYPE = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("n_words", pa.list_(pa.int64())),
        ("n_ids", pa.list_(pa.int64())),
        ("different", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("counts", pa.binary()),
        ("which", pa.binary()),
        ("ids", pa.binary()),
    ]
)


def in_chunks(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The table of chunks, which all that follows reads."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = rows.select("doc_id", (F.crc32(name) % FOLDS == HELD_OUT).alias("held_out"), "text")
    n_buckets = max(LEAST_BUCKETS, size // BUCKET_BYTES)
    return stored(rows.mapInArrow(chunk_rows(path, pattern, n_buckets), CHUNK), "chunks")


# --- word counts ----------------------------------------------------------------------------


def questions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a chunk and how often its training documents have them, packed by bucket."""
    for batch in batches:
        for row in batch.to_pylist():
            size = np.array(row["different"], np.int64)
            total = int(size.sum())
            columns = np.concatenate([unpack(row[c], total) for c in ("words", "counts")])
            use, upto = np.flatnonzero(size), np.cumsum(size)
            yield pa.record_batch(
                [
                    pa.array(np.full(len(use), row["chunk"])),
                    pa.array(use, pa.int32()),
                    pa.array(size[use]),
                    pa.array([pack(columns[:, upto[b] - size[b] : upto[b]]) for b in use], pa.binary()),
                ],
                names=["chunk", "bucket", "n", "columns"],
            )


def answers(table: pa.Table) -> pa.Table:
    """Counts over all chunks, for the words of each chunk as they were asked; how many words of
    the bucket were learned and how often stands in its first row."""
    rows = table.to_pylist()
    asked = [unpack(r["columns"], r["n"]) for r in rows]
    words, which = np.unique(np.concatenate([a[0] for a in asked]), return_inverse=True)
    own = np.concatenate([a[1] for a in asked])
    total = np.zeros(len(words), np.int64)
    np.add.at(total, which, own)
    ends = np.cumsum([r["n"] for r in rows])
    found = np.split(total[which], ends[:-1])
    rest = [0] * (len(rows) - 1)
    return pa.table(
        {
            "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
            "bucket": pa.array([r["bucket"] for r in rows], pa.int32()),
            "n": pa.array([r["n"] for r in rows], pa.int64()),
            "columns": pa.array([pack([x]) for x in found], pa.binary()),
            "distinct": pa.array([int((total > 0).sum()), *rest], pa.int64()),
            "tokens": pa.array([int(total.sum()), *rest], pa.int64()),
        }
    )


def word_counts(chunks: DataFrame) -> DataFrame:
    """Answers to the words of every chunk."""
    packed = "chunk long, bucket int, n long, columns binary"
    asked = chunks.select("chunk", "different", "words", "counts").mapInArrow(questions, packed)
    # a bucket has its share of the words of all chunks, and their number grows with the text
    return stored(
        asked.groupBy("bucket").applyInArrow(answers, f"{packed}, distinct long, tokens long"),
        "word-counts",
    )


# --- subwords -------------------------------------------------------------------------------


def with_ends(
    ids: np.ndarray, sizes: np.ndarray, end: int, kind: type = np.int64
) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts, each with its end, and where they begin."""
    upto = np.cumsum(sizes)
    first = np.concatenate([[0], upto + np.arange(1, len(sizes) + 1)]).astype(np.int64)
    return np.insert(ids.astype(kind), upto, end), first


def pieces(ids: np.ndarray, sizes: np.ndarray, end: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``with_ends`` of some of the texts after the other."""
    upto = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(upto, upto[at] + PIECE_IDS, "right")) - 1)
        yield with_ends(ids[upto[at] : upto[to]], sizes[at:to], end)
        at = to


TRAINING = ("chunk", "held", "n_ids", "ids")


def chunks_in(
    batches: Iterator[pa.RecordBatch], kind: type
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number, ids, sizes) of the training texts of each chunk."""
    for batch in batches:
        for row in zip(*(batch[c] for c in TRAINING)):
            chunk, held, sizes, ids = (x.as_py() for x in row)
            learned, sizes = ~np.array(held, bool), np.array(sizes, np.int64)
            ids = unpacked_ids(ids, kind)[np.repeat(learned, sizes)]
            yield chunk, ids, sizes[learned]


def id_rows(size: int, kind: type):
    """How often the training texts of some chunks have each id."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for _, ids, _ in chunks_in(batches, kind):
            total += np.bincount(ids, minlength=size)
        use = np.flatnonzero(total)
        yield pa.record_batch([pa.array(use), pa.array(total[use])], names=["id", "n"])

    return of_batches


def company_rows(frequent: np.ndarray, end: int, kind: type):
    """How often each id is in the windows of some chunks, and the frequent ids in its windows."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.full(end + 1, -1)
        number[frequent] = np.arange(len(frequent))
        number = np.concatenate([[-1], number, [-1]])  # by id plus one; -1 is the last
        weight = np.zeros(end + 1, np.int64)
        total = np.zeros((len(frequent), end + 1))
        for _, chunk, sizes in chunks_in(batches, kind):
            for ids, first in pieces(chunk, sizes, end):
                inputs, targets = windows_of(ids + 1, first)
                row, column = np.nonzero(targets >= 0)
                own = ids[targets[row, column]]
                near = np.zeros((len(frequent), len(inputs)))
                for part in (number[inputs], np.where(targets < 0, -1, number[ids[targets] + 1])):
                    r, c = np.nonzero(part >= 0)
                    at = part[r, c] * len(inputs) + r
                    near += np.bincount(at, minlength=near.size).reshape(near.shape)
                weight += np.bincount(own, minlength=end + 1)
                for k in range(len(frequent)):
                    total[k] += np.bincount(own, weights=near[k][row], minlength=end + 1)
        use = np.flatnonzero(weight)
        flat = total[:, use].astype(np.int64)
        yield pa.record_batch(
            [pa.array(use), pa.array(weight[use]), *map(pa.array, flat)],
            names=["id", "n", *(f"f{k}" for k in range(len(frequent)))],
        )

    return of_batches


def company_counts(
    chunks: DataFrame, frequent: np.ndarray, end: int, kind: type
) -> tuple[np.ndarray, np.ndarray]:
    """``company_rows`` of all training documents: (ids, frequent ids), and how often ids are there."""
    names = ["n", *(f"f{k}" for k in range(len(frequent)))]
    found = (
        chunks.mapInArrow(
            company_rows(frequent, end, kind), ", ".join(f"{n} long" for n in ["id", *names])
        )
        .groupBy("id")
        .agg(*(F.sum(n).alias(n) for n in names))
        .toArrow()  # no more than the tokenizer's ids
    )
    at = found["id"].to_numpy()
    weight, total = np.zeros(end + 1), np.zeros((end + 1, len(frequent)))
    weight[at] = found["n"].to_numpy()
    for k, n in enumerate(names[1:]):
        total[at, k] = found[n].to_numpy()
    return total, weight


def company(total: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Group of each id: k-means over the shares of the frequent ids in the windows it is in.

    Ids that no window has with a frequent one join the largest group.
    """
    size = len(weight)
    seen = np.flatnonzero(total.sum(axis=1) > 0)
    weight = weight[seen]
    x = np.sqrt(total[seen] / total[seen].sum(axis=1, keepdims=True))
    centres = [np.average(x, axis=0, weights=weight)] if len(seen) else []
    while 0 < len(centres) < GROUPS + 1:  # the farthest, by weight, is the next centre
        far = np.min([((x - c) ** 2).sum(axis=1) for c in centres], axis=0)
        centres.append(x[np.argmax(far * np.sqrt(weight))])
    group = np.zeros(size, np.int64)
    if len(seen):
        centre = np.array(centres[1:])
        for _ in range(30):
            near_to = ((x[:, None] - centre) ** 2).sum(axis=2).argmin(axis=1)
            for k in range(GROUPS):
                if weight[near_to == k].sum() > 0:
                    centre[k] = np.average(x[near_to == k], axis=0, weights=weight[near_to == k])
        largest = np.bincount(near_to, weights=weight, minlength=GROUPS).argmax()
        group[:] = largest
        group[seen] = near_to
    return group


def by_frequency(n: np.ndarray) -> np.ndarray:
    """Ids without the end, the most frequent first."""
    return np.argsort(-n[:-1], kind="stable")


class Classes:
    """Classes of ids and their trees, from the counts of all training documents."""

    def __init__(
        self, bpe: ByteBpe, n: np.ndarray, total: np.ndarray, weight: np.ndarray
    ) -> None:
        self.end = len(bpe.lengths)
        self.of = np.zeros(self.end + 1, np.int64)
        order = by_frequency(n)
        self.of[self.end] = 1
        self.of[order[:FREQUENT]] = 2 + np.arange(FREQUENT)
        rest = order[FREQUENT:]
        group = company(total, weight)[rest]
        begins = np.array([bpe.begins_word(int(k)) for k in rest])
        for k in range(GROUPS):
            own = np.flatnonzero(group == k)
            mass = np.cumsum(n[rest[own]] + 0.5)
            tier = np.minimum((mass * TIERS / mass[-1:]).astype(np.int64), TIERS - 1)
            self.of[rest[own]] = 2 + FREQUENT + (k * TIERS + tier) * 2 + begins[own]
        self.subwords = Subwords.of_counts(self.of, n + 0.5, DIMENSION)


# --- training -------------------------------------------------------------------------------


def plan(count: int, steps: int) -> tuple[int, int]:
    """Steps a round and windows a step that visit each of ``count`` windows over all rounds."""
    steps = max(-(-steps // ROUNDS), -(-count // (ROUNDS * BATCH)))
    return steps, min(BATCH, max(LEAST_BATCH, -(-count // (ROUNDS * steps))))


def visited(count: int, chunk: int, number: int, steps: int, batch: int) -> np.ndarray:
    """Windows of a chunk in round ``number``: the next share of their random order."""
    order = np.random.default_rng([SEED, chunk]).permutation(count)
    size = steps * batch
    return order[np.arange(number * size, (number + 1) * size) % count]


def trained_rows(
    model: Attention,
    of: np.ndarray,
    kind: type,
    number: int,
    least: int,
    subwords: Subwords | None = None,
):
    """(place of a parameter, its value in fixed point, weight) after a round. The model's parameters come
    first, weighed by the tokens of the chunk, then those of ``subwords`` that it met, by how often."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of = input_classes(of).astype(np.int8)
        for chunk, all_ids, sizes in chunks_in(batches, kind):
            if not len(sizes):
                continue
            ids, first = with_ends(all_ids, sizes, len(of) - 1, np.int32)
            count = window_count(first)
            steps, batch = plan(count, least)
            rows, which = np.unique(
                visited(count, chunk, number, steps, batch), return_inverse=True
            )
            numbers, places = windows_of(ids + 1, first, rows)  # of this round only
            targets = np.where(places >= 0, ids[places], -1)
            inputs = class_of[numbers]
            numbers[numbers < 0] = len(of) + 1
            progress = (number + np.arange(steps) / steps) / ROUNDS
            own, more = model.copy(), ()
            if subwords is not None:
                its = subwords.copy()
                numbers = numbers.astype(np.min_scalar_type(len(of) + 1))
                more = (its, numbers, np.maximum(targets, 0))
            learners = own.train(
                inputs,
                np.where(targets >= 0, of[targets], -1).astype(np.int8),
                which.reshape(steps, batch),
                0.01 * np.minimum(1, 2 * (1 - progress)),
                *more,
            )
            at = len(own.flat())
            yield parameter_rows(np.arange(at), own.flat(), len(all_ids) + len(sizes))
            for learner in learners or ():
                met, width = np.flatnonzero(learner.visits), learner.table.shape[1]
                place = at + met[:, None] * width + np.arange(width)
                yield parameter_rows(
                    place.ravel(), learner.table[met].ravel(), np.repeat(learner.visits[met], width)
                )
                at += learner.table.size

    return of_batches


def parameter_rows(place: np.ndarray, value: np.ndarray, n: np.ndarray | int) -> pa.RecordBatch:
    fixed = np.round(value.astype(np.float64) * FIXED_POINT).astype(np.int64)
    weight = np.broadcast_to(np.asarray(n, np.int64), place.shape)
    return pa.record_batch(
        [pa.array(place.astype(np.int32)), pa.array(fixed), pa.array(weight)],
        names=["place", "value", "n"],
    )


def trained(chunks: DataFrame, classes: Classes, kind: type) -> tuple[Attention, Subwords]:
    """The attention model of the ids, trained on all windows of the chunks."""
    model, subwords = Attention.random(CLASSES, SEED), classes.subwords
    size = len(model.flat())
    # sums of whole numbers, so the average does not depend on the order of chunks; in two parts of their
    # bits, so they do not overflow
    weighted = F.col("value") * F.col("n")
    high, low = F.sum(F.shiftright(weighted, LOW_BITS)), F.sum(weighted.bitwiseAND((1 << LOW_BITS) - 1))
    total = high.cast("double") * (1 << LOW_BITS) + low.cast("double")
    for number in range(ROUNDS):
        found = (
            chunks.mapInArrow(
                trained_rows(model, classes.of, kind, number, STEPS, subwords),
                "place int, value long, n long",
            )
            .groupBy("place")
            .agg((total / F.sum("n")).alias("value"))
            .toArrow()  # no more rows than parameters
        )
        flat = np.concatenate([model.flat(), subwords.flat()]).astype(np.float64)
        flat[found["place"].to_numpy()] = found["value"].to_numpy() / FIXED_POINT
        model, subwords = model.from_flat(flat[:size]), subwords.from_flat(flat[size:])
    return model, subwords


# --- scores ---------------------------------------------------------------------------------


def lm_scores(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    chunks = in_chunks(docs, path, pattern)
    counts = word_counts(chunks)
    held = F.transform("held", lambda h: (~h).cast("int"))
    texts = chunks.agg(F.sum(F.aggregate(held, F.lit(0), lambda a, b: a + b))).head()[0] or 0
    totals = counts.agg(F.sum("distinct"), F.sum("tokens")).head()
    distinct, tokens = (totals[0] or 0) + (texts > 0), (totals[1] or 0) + texts
    bpe = byte_bpe(path, pattern)
    end, kind = len(bpe.lengths), id_kind(bpe)
    learned = chunks.select(*TRAINING)
    ids = learned.mapInArrow(id_rows(end, kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = ids.toArrow()  # no more than the tokenizer's ids
    counted = np.zeros(end + 1)
    counted[found["id"].to_numpy()] = found["n"].to_numpy()
    counted[end] = texts
    total, weight = company_counts(learned, by_frequency(counted)[:FREQUENT], end, kind)
    classes = Classes(bpe, counted, total, weight)
    model, subwords = trained(learned, classes, kind)
    under = np.log10(tokens + 0.5 * (distinct + 1))

    def by_counts(left: pa.Table, right: pa.Table) -> pa.Table:
        """Base scores of the texts of a chunk, from its words and the answers in order of buckets."""
        row = left.to_pylist()[0]
        n_words = np.array(row["n_words"], np.int64)
        answered = sorted(right.to_pylist(), key=lambda r: r["bucket"])
        count = np.concatenate(
            [np.empty(0, np.int64), *(unpack(r["columns"], r["n"])[0] for r in answered)]
        )
        which = unpack(row["which"], int(n_words.sum()))[0]
        owner = np.repeat(np.arange(len(n_words)), n_words)
        log = np.log10(count + 0.5) - under
        base = np.bincount(owner, weights=log[which], minlength=len(n_words))
        known = np.bincount(owner, weights=count[which] > 0, minlength=len(n_words))
        return pa.table(
            {
                "chunk": pa.array(np.full(len(n_words), row["chunk"])),
                "place": pa.array(np.arange(len(n_words), dtype=np.int32)),
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "held_out": pa.array(row["held"], pa.bool_()),
                "n_tokens": pa.array(n_words + 1),
                "n_known": pa.array(known.astype(np.int64) + (texts > 0)),
                "train_tokens": pa.array(np.full(len(n_words), tokens), pa.int64()),
                "base_score": pa.array(base + np.log10(texts + 0.5) - under),
            }
        )

    def by_attention(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores of the texts of each chunk, some texts at a time."""
        for batch in batches:
            for chunk, sizes, blob in zip(*(batch[c] for c in ("chunk", "n_ids", "ids"))):
                sizes = np.array(sizes.as_py(), np.int64)
                found = [np.empty(0)]
                for own, begin in pieces(unpacked_ids(blob.as_py(), kind), sizes, end):
                    value = scores(model, own, begin, subwords, classes.of) * LOG10
                    whose = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
                    found.append(np.bincount(whose, weights=value, minlength=len(begin) - 1))
                yield pa.record_batch(
                    [
                        pa.array(np.full(len(sizes), chunk.as_py())),
                        pa.array(np.arange(len(sizes), dtype=np.int32)),
                        pa.array(np.concatenate(found)),
                    ],
                    names=["chunk", "place", "score"],
                )

    asked = chunks.select("chunk", "doc_ids", "held", "n_words", "which")
    answered = counts.select("chunk", "bucket", "n", "columns")
    base = (
        asked.groupBy("chunk")
        .cogroup(answered.groupBy("chunk"))
        .applyInArrow(
            by_counts,
            "chunk long, place int, doc_id long, held_out boolean, n_tokens long, n_known long, "
            "train_tokens long, base_score double",
        )
    )
    scored = chunks.select("chunk", "n_ids", "ids").mapInArrow(
        by_attention, "chunk long, place int, score double"
    )
    return base.join(scored, ["chunk", "place"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )
