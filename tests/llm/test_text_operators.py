"""Row-wise operators against brute force, on odd documents and on the driver's small table."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from cases import TEXTS, documents, spaced, worded

from sessionflow.llm import bitplane, bpe, decontaminate, licenses
from sessionflow.llm.queries import BYTE_RANKS, WORD_TOKENIZER, table
from sessionflow.sources import new_work_path

SF_DIR = "/root/testdata/sf0.001"
PATH, PATTERN = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def inputs(spark):
    real = table(spark, SF_DIR, "documents")
    return [documents(spark), documents(spark, []), real]


def test_bpe_joins_are_exact_at_any_seam(reference):
    parts = ["a", "e", "th", "the", " ", "  ", "\n", "'", "s", "re", "'ll", "1", "23", "!", "..", "é", "\x1c", "\x85", "\xa0", "文字", "😀", "\t", "　"]
    chooser = random.Random(3)
    small = bpe.ByteBpe(PATH, PATTERN, leaf=3)
    for _ in range(1500):
        text = "".join(chooser.choice(parts) for _ in range(chooser.randint(0, 60)))
        ids = small.encode(text)
        assert ids.tolist() == reference.encode_ordinary(text), repr(text)
        assert small.decode(ids) == text.encode()
    for letters in ("ab", "thein", "文字汉语", "aeiou"):
        piece = "".join(chooser.choice(letters) for _ in range(2500))
        assert small.encode_piece(piece.encode()).tolist() == reference.encode_ordinary(piece)


def test_bpe_of_documents(spark, reference):
    for docs in inputs(spark):
        rows = bpe.decoded(bpe.encoded(docs, PATH, PATTERN), PATH, PATTERN)
        found = Counter(tuple(r) for r in bpe.digests(rows).collect())
        rows = bpe.round_trip(docs, PATH, PATTERN)
        assert found == Counter(tuple(r) for r in bpe.digests(rows).collect())
        expected = Counter()
        for r in docs.select("doc_id", "text").collect():
            text = r.text or ""
            ids = reference.encode_ordinary(text)
            expected[
                r.doc_id,
                len(ids),
                hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest(),
            ] += 1
        assert found == expected


def test_decoding_null_ids(spark):
    rows = spark.createDataFrame([(1, None)], "doc_id long, ids binary")
    assert bpe.decoded(rows, PATH, PATTERN).head().decoded is None


@pytest.mark.parametrize("bits", [False, True])
def test_bitplane_files(spark, bits):
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path(WORD_TOKENIZER))
    for docs in inputs(spark):
        path = new_work_path(spark, "ids")
        files = bitplane.written(docs, path, public_tokenizers.path(WORD_TOKENIZER), bits)
        found = bitplane.read_back(spark, path, files).collect()
        rows = [
            (r.doc_id, [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1])
            for r in docs.select("doc_id", "text").collect()
        ]
        crc = Counter((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in rows)
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == crc
        in_order = sorted(found, key=lambda r: r.start)
        assert [r.start for r in in_order] == list(
            np.cumsum([0, *(r.n_tokens for r in in_order)])[:-1]
        )
        ids = [-1 if r.doc_id is None else r.doc_id for r in in_order]
        assert ids == sorted(ids)


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 200])
def test_planes_and_single_chunks(tmp_path, bits, n):
    import pyarrow as pa

    ids = np.random.default_rng(n).integers(0, 1 << 20, n).astype(np.uint32)
    with open(tmp_path / "f", "wb") as file:
        writer = bitplane.Writer(file, bits, block=64)
        writer.add([None, 5, 1 << 40], [n, 0, 0], ids)
        writer.close()
    reader = bitplane.Reader(pa.OSFile(str(tmp_path / "f")))
    assert reader.doc_ids == [None, 5, 1 << 40]
    assert len(reader.chunks) == -(-n // 64)
    for k in reversed(range(len(reader.chunks))):
        assert reader.chunk(k).tolist() == ids[64 * k : 64 * k + 64].tolist()


def test_a_file_that_is_none(tmp_path):
    import pyarrow as pa

    (tmp_path / "f").write_bytes(b"0" * 40)
    with pytest.raises(ValueError, match="token ids"):
        bitplane.Reader(pa.OSFile(str(tmp_path / "f")))


# --- decontamination ------------------------------------------------------------------------

ITEMS = [
    (1, " ".join(f"passage{i}" for i in range(20))),
    (2, "One"),
    (3, None),
    (4, "..."),
    (5, " ".join(f"PASSAGE{i}," for i in range(30, 45))),
    (5, "other words passage0"),
    (None, "brown fox"),
    (7, "of of of of of of of of of of of of"),
]


def contaminated(docs, items, width=10):
    windows = {}
    for item_id, text in items:
        words = worded(text)
        n = min(width, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows.setdefault(tuple(words[i : i + n]), set()).add(item_id)
    expected = Counter()
    for doc_id, text in docs:
        words, hit, found = worded(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(words) - n + 1):
                if own := windows.get(tuple(words[i : i + n])):
                    found |= own
                    hit.update(range(i, i + n))
        names = sorted({"" if i is None else str(i) for i in found})
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        expected[doc_id, len(words), len(hit), len(names), digest, bool(hit)] += 1
    return expected


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 150])
def test_decontamination(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(decontaminate, "with_matches", _with_blocks(block_bytes))
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    real = table(spark, SF_DIR, "documents")
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
    for docs, own, rows in (
        (documents(spark), ITEMS, benchmark),
        (documents(spark), [], benchmark.limit(0)),
        (documents(spark, []), ITEMS, benchmark),
        (real, items, table(spark, SF_DIR, "benchmark")),
    ):
        texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        found = Counter(tuple(r) for r in decontaminate.contamination(docs, rows).collect())
        expected = contaminated(texts, own)
        assert found == expected
        clean = decontaminate.clean_documents(docs, rows)
        assert clean.columns == docs.columns
        assert Counter(r.doc_id for r in clean.collect()) == Counter(
            k[0] for k, n in expected.items() for _ in range(n) if not k[-1]
        )


def _with_blocks(block_bytes):
    original = decontaminate.with_matches

    def limited(docs, benchmark, width=decontaminate.WIDTH):
        return original(docs, benchmark, width, block_bytes)

    return limited


@pytest.mark.parametrize("letters", [(3, 9), (1, 1)])
def test_a_broadcast_is_bounded_by_the_text_of_its_block(letters):
    import pickle

    chooser = np.random.default_rng(5)
    items, size = [], 0
    while size < 2 << 20:
        lengths = chooser.integers(letters[0], letters[1] + 1, 400)
        text = " ".join("".join(map(chr, chooser.integers(97, 123, n))) for n in lengths)
        items.append((len(items), text))
        size += len(text)
    tests = decontaminate.TestSuffixes(items, 10)
    assert len(tests.windows) == len(items) * 391
    assert len(pickle.dumps(tests, pickle.HIGHEST_PROTOCOL)) < 6 * size + (2 << 20)


def test_windows_are_searched_some_at_a_time(monkeypatch):
    import pyarrow as pa

    from sessionflow.llm.hashing import NO_WORD, words_of

    chooser = random.Random(7)
    letters = lambda n: " ".join(chooser.choices("abc", k=n))
    items = [(k, letters(chooser.choice([0, 1, 2, 3, 4, 12]))) for k in range(60)]
    texts = [letters(chooser.randint(0, 60)) for _ in range(40)]
    monkeypatch.setattr(decontaminate, "AT_ONCE", 7)
    tests = decontaminate.TestSuffixes(items, 4)
    (w,) = words_of(pa.array(texts), NO_WORD, True)
    window, place = tests.search(w)
    item, at, length = tests.places(window)
    found = Counter(zip(item.tolist(), at.tolist(), length.tolist(), place.tolist()))
    expected = Counter()
    for k, (_, text) in enumerate(items):
        own = text.split()
        n = min(4, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            for t, document in enumerate(texts):
                there = document.split()
                for j in range(len(there) - n + 1):
                    if there[j : j + n] == own[i : i + n]:
                        expected[k, i, n, int(w.first[t]) + j] += 1
    assert found == expected


def test_longest_matches_and_their_places(spark):
    rows = decontaminate.with_matches(
        documents(spark, [(1, f"x y {' '.join(f'passage{i}' for i in range(18))} z")]),
        spark.createDataFrame(ITEMS[:1], "item_id long, text string"),
    )
    (match,) = rows.head().matches
    assert (match.item_id, match.doc_start, match.item_start, match.n_words) == (1, 2, 0, 18)


# --- licenses -------------------------------------------------------------------------------


def scanned(doc_id, text):
    words = worded(text)
    starts, base, labels, score = [], set(), set(), 0.0
    for template in licenses.TEMPLATES:
        phrase = [w.encode() for w in template.words]
        if template.base:
            own = [i for i in range(len(words)) if words[i : i + len(phrase)] == phrase]
            if own:
                starts += own
                base.add(template.label)
                labels.add(template.label)
                score = 1.0
            continue
        for at in range(len(words)):
            shared = len(set(words[at : at + licenses.WINDOW]) & set(phrase))
            if shared >= template.needed:
                labels.add(template.label)
                score = max(score, shared / len(set(phrase)))
    return (
        doc_id,
        len(words),
        len(starts),
        min(starts, default=None),
        max(starts, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
    )


NOTICES = [
    (20, "x\nPermission is HEREBY granted, free of charge, to any person obtaining a copy of this thing"),
    (21, "Licensed under the Apache License, Version 2.0; cc by-nc 4.0 GENERAL public-LICENSE"),
    (22, "general public\nlicense, and general public notlicense"),
    (23, "Kelvin general public license İ all rightsé reserved all rights reserved all rights reserved"),
]


WRAPPED = {
    "bsd": "/*\n * Redistribution and use in source and binary forms, with or without\n"
    " * modification, are permitted provided that the following conditions are met:\n */",
    "apache": "# Licensed under the Apache License,\n# Version 2.0 (the \"License\");\n# you may not use this file",
    "lgpl": "-- licensed under the GNU Lesser\n-- General Public License\n--\n-- version 3 or later",
    "gpl": "// You can redistribute it\r\n// and/or modify\r\n// it under the terms of the GNU General\n"
    "//\n// Public License as published",
    "mit": "Permission is hereby granted,\n\nfree of charge, to any\nperson obtaining a copy\nof this software",
    "mpl": "; This file is subject to the terms of the Mozilla\n; Public License, version\n; 2.0.",
}


def test_license_scan(spark):
    wrapped = [(30 + k, text) for k, text in enumerate(WRAPPED.values())]
    for docs in [*inputs(spark), documents(spark, NOTICES * 2 + wrapped)]:
        found = Counter(tuple(r) for r in licenses.license_scan(docs).collect())
        expected = Counter(scanned(*r) for r in docs.select("doc_id", "text").collect())
        assert found == expected


def test_wrapped_notices_are_found(spark):
    rows = [(k, f"code here\n{text}\nmore code") for k, text in enumerate(WRAPPED.values())]
    found = {r.doc_id: r.labels.split(",") for r in licenses.license_scan(documents(spark, rows)).collect()}
    for k, label in enumerate(WRAPPED):
        assert label in found[k]


def test_words_of_a_notice_far_apart_are_none(spark):
    gap = " x" * licenses.WINDOW
    rows = [(1, f"released under the{gap} MIT license"), (2, f"released{gap[:-6]} under the MIT license")]
    found = {r.doc_id: (r.labels, r.score) for r in licenses.license_scan(documents(spark, rows)).collect()}
    assert found == {1: ("", 0.0), 2: ("", 0.0)}
    near = " x" * (licenses.WINDOW - 5)
    (row,) = licenses.license_scan(documents(spark, [(1, f"released{near} under the MIT license")])).collect()
    assert (row.labels, row.score) == ("mit", 1.0)


def test_many_notices_in_a_long_text(spark):
    notices = list(WRAPPED.values())
    text = "\n".join(f"{notices[i % 6]}\n file{i}" for i in range(6000))
    (row,) = licenses.license_scan(documents(spark, [(1, text)])).collect()
    assert tuple(row) == scanned(1, text)


def test_words_by_space_are_those_of_the_contract(spark):
    from sessionflow.llm.columns import space_words

    docs = documents(spark)
    for r in docs.select("text", space_words(docs["text"]).alias("w")).collect():
        assert [w.encode() for w in r.w] == spaced(r.text)
    assert len(TEXTS) == docs.count()
