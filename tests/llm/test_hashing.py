"""Words that a polynomial modulo 2^64 cannot tell apart."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from cases import documents

from sessionflow.llm import attention_lm, bitplane, decontaminate, hashing, substring_dedup
from sessionflow.llm.queries import BYTE_RANKS, WORD_TOKENIZER
from sessionflow.sources import new_work_path

MORSE = "".join("ab"[k.bit_count() % 2] for k in range(1024))
COMPLEMENT = MORSE.translate(str.maketrans("ab", "ba"))


def test_thue_morse_words_differ():
    (w,) = hashing.words_of(pa.array([f"{MORSE} {COMPLEMENT}", MORSE]), hashing.SPACE, False)
    assert w.hashes[0] != w.hashes[1] and w.hashes[0] == w.hashes[2]
    for size in (2048, 4096):
        word = "".join("ab"[k.bit_count() % 2] for k in range(size))
        other = word.translate(str.maketrans("ab", "ba"))
        (w,) = hashing.words_of(pa.array([word, other, f"x {word}"]), hashing.SPACE, False)
        assert len(set(w.hashes.tolist())) == 3


def test_windows_of_structured_hashes_differ():
    one, other = np.uint64(3), np.uint64(1 << 63)
    values = np.array([one if c == "a" else other for c in MORSE + COMPLEMENT])
    a, b = hashing.range_hashes(values, np.array([0, 1024]), np.array([1024, 2048]))
    assert a != b


@pytest.mark.parametrize("size", [1, 7, 300, 5000])
def test_equal_contents_have_equal_hashes_at_any_place(size):
    rng = np.random.default_rng(size)
    for kind in (np.uint8, np.uint64):
        part = rng.integers(0, 255, size).astype(kind)
        values = np.concatenate([part, rng.integers(0, 255, 37).astype(kind), part, part[:-1]])
        starts = np.array([0, size + 37, 2 * size + 37])
        a, b, c = hashing.range_hashes(values, starts, starts + [size, size, size - 1])
        assert a == b and a != c


def test_powers_in_the_field():
    found = hashing.field_powers(hashing.PRIME_BASE, 1000).tolist()
    assert [x % hashing.PRIME for x in found] == [
        pow(hashing.PRIME_BASE, k, hashing.PRIME) for k in range(1000)
    ]


ROWS = [(1, f"{MORSE} one"), (2, f"{COMPLEMENT} two"), (3, MORSE), (4, COMPLEMENT)]


def test_token_files(spark):
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path(WORD_TOKENIZER))
    path = new_work_path(spark, "ids")
    files = bitplane.written(documents(spark, ROWS), path, public_tokenizers.path(WORD_TOKENIZER))
    found = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in bitplane.read_back(spark, path, files).collect()}
    for i, text in ROWS:
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert found[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_repeats_and_leaks(spark):
    tail = " ".join(f"w{i}" for i in range(19))
    rows = [(1, f"{MORSE} {tail}"), (2, f"{COMPLEMENT} {tail}"), (3, f"{MORSE} {tail}")]
    docs = documents(spark, rows)
    found = {r.doc_id: r.n_removed for r in substring_dedup.kept_words(docs).collect()}
    assert found == {1: 0, 2: 0, 3: 20}
    items = spark.createDataFrame([(1, COMPLEMENT)], "item_id long, text string")
    found = {r.doc_id: r.n_hit for r in decontaminate.contamination(docs, items).collect()}
    assert found == {1: 0, 2: 1, 3: 0}


def test_counts(spark, monkeypatch):
    monkeypatch.setattr(attention_lm, "STEPS", 6)
    rows = attention_lm.lm_scores(
        documents(spark, [(k, MORSE) for k in (1, 2, 3, 4)] + [(5, COMPLEMENT)]),
        public_tokenizers.path(BYTE_RANKS),
        public_tokenizers.PATTERN,
    ).collect()
    learned = {r.doc_id for r in rows if not r.held_out}
    for r in rows:  # known by its own count, not by that of the other word
        same = {5} if r.doc_id == 5 else {1, 2, 3, 4}
        assert r.n_known == 1 + bool(learned & same)
