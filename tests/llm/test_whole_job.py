"""What must follow the whole input: nothing is learned from a part of it, no case is left out."""

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from cases import PASSAGE, documents
from pyspark.sql import functions as F

from sessionflow.llm import attention_lm, bitplane, decontaminate, html_extract, substring_dedup
from sessionflow.llm.bpe import byte_bpe
from sessionflow.llm.queries import BYTE_RANKS, WORD_TOKENIZER
from sessionflow.sources import new_work_path


# --- language model -------------------------------------------------------------------------


def test_company_and_training_cover_all_training_documents(spark):
    path, pattern = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
    bpe = byte_bpe(path, pattern)
    end, kind = len(bpe.lengths), attention_lm.id_kind(bpe)
    docs = documents(spark, [(i, f"text {i} of {i * 7} the") for i in range(2500)])
    shards = attention_lm.in_chunks(docs, path, pattern).select(*attention_lm.TRAINING)
    learned = docs.where("crc32(cast(doc_id as string)) % 5 <> 1")
    expected = Counter(i for r in learned.collect() for i in [*bpe.encode(r.text).tolist(), end])
    frequent = np.array([i for i, _ in expected.most_common(5) if i != end])
    total, weight = attention_lm.company_counts(shards, frequent, end, kind)
    assert {i: int(weight[i]) for i in np.flatnonzero(weight)} == dict(expected)
    assert total[end].sum() > 0
    model = attention_lm.Attention.random(attention_lm.CLASSES, 1)
    of = np.ones(end + 1, np.int64)
    tokens = (
        shards.mapInArrow(
            attention_lm.trained_rows(model, of, kind, 0, 6), "place int, value long, n long"
        )
        .where("place = 0")
        .agg(F.sum("n"))
        .head()[0]
    )
    assert tokens == sum(expected.values())


@pytest.mark.parametrize("count", [1, 40, 5_000, 300_000])
def test_rounds_visit_every_window(count):
    steps, batch = attention_lm.plan(count, attention_lm.STEPS)
    rounds = [
        attention_lm.visited(count, 3, r, steps, batch) for r in range(attention_lm.ROUNDS)
    ]
    assert len(np.unique(np.concatenate(rounds))) == count
    assert batch <= attention_lm.BATCH and steps * attention_lm.ROUNDS >= attention_lm.STEPS


# --- token files ----------------------------------------------------------------------------


def test_added_tokens_are_those_of_whole_texts(spark):
    import tokenizers

    path = public_tokenizers.path(WORD_TOKENIZER)
    tokenizer = tokenizers.Tokenizer.from_file(path)
    end, start = "<|endoftext|>", "<|startoftext|>"
    texts = [
        f"a {end} b", f"{start} a", f"a{end}b {start}{end} x{start}", f"\n{end}\t{end}", end,
        "<|ENDOFTEXT|> <|endof text|> <|endoftext|", f"É{end}é {start} x", f"e{end}́ {end}'s don{end}'t 12{end}3",
    ]
    docs = documents(spark, list(enumerate(texts)))
    target = new_work_path(spark, "ids")
    files = bitplane.written(docs, target, path)
    found = {r.doc_id: r for r in bitplane.read_back(spark, target, files).collect()}
    for k, text in enumerate(texts):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, bitplane.END_ID]
        assert found[k].n_tokens == len(ids)
        assert found[k].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())


# --- main text of pages ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "source, texts",
    [
        ("<html><head><title>T</title><p>One<p>Two", ["One", "Two"]),
        ("<head><meta charset=utf-8><link rel=a><style>p {}</style><div>One</div>", ["One"]),
        ("<head><title>T</title>\n <script>x</script> One <b>more</b>", ["One more"]),
        ("<head><noscript><p>no</p></noscript><template><p>no</p></template><h1>One</h1>", ["One"]),
        ("<head><title>T</title></head><body><p>One</p><head><p>Two</p>", ["One", "Two"]),
        ("<head><title>T</title><body><p>One</p>", ["One"]),
    ],
)
def test_an_open_head_ends_where_the_body_begins(source, texts):
    assert [words for _, words in html_extract.parsed(source).blocks] == texts


# --- repeated passages ----------------------------------------------------------------------


@pytest.mark.parametrize("least", [3, -(1 << 62) - 9, -(1 << 63) + 1_000_000])
def test_rows_without_an_id_are_documents_of_their_own(spark, least):
    rows = [(None, f"{PASSAGE} end {i}") for i in range(9)] + [(None, f"{PASSAGE} end 0")]
    docs = documents(spark, [*rows, (least, f"own {PASSAGE}"), (None, None)])
    found = substring_dedup.kept_words(docs).collect()
    assert [r.n_removed for r in found if r.doc_id == least] == [60]
    null = Counter((r.n_words, r.n_removed, r.kept) for r in found if r.doc_id is None and r.n_words)
    texts = {k for k in null if k[1] == 0}
    assert len(texts) == 1 and len(null) == 9 and sum(null.values()) == 10
    assert sorted(null.values()) == [1] * 8 + [2]  # equal texts get equal results
    assert all(k[1] >= 60 for k in null if k not in texts)
    done = substring_dedup.without_repeats(docs)
    assert done.columns == docs.columns and done.where("doc_id is null").count() == 11
    assert done.where(F.col("text").contains("passage30")).count() in (1, 2)


# --- decontamination ------------------------------------------------------------------------


@pytest.mark.parametrize("item_id", [5, None])
@pytest.mark.parametrize("turn", [1, -1])
def test_a_short_row_of_an_item_does_not_shorten_its_match(item_id, turn):
    words = " ".join(f"w{i}" for i in range(10))
    tests = decontaminate.TestSuffixes([(item_id, words), (item_id, "w0 w1 w2")][::turn], 10)
    (w,) = decontaminate.words_of(pa.array([f"x {words} y"]), decontaminate.NO_WORD, True)
    matches = decontaminate.longest(*tests.search(w), tests)
    assert [(m["doc_start"], m["n_words"]) for m in matches] == [(1, 10)]
    assert decontaminate.n_hit(matches) == 10


def test_copies_of_a_passage_are_spread_by_document(spark):
    """Copies that a task has settled itself do not meet at one bucket."""
    line = " ".join(f"w{i}" for i in range(20))
    rows = spark.range(8000).selectExpr("id as d", f"'{line}' as text").coalesce(1)
    packed = rows.mapInArrow(substring_dedup.key_rows(20, 16), substring_dedup.PACKED)
    sums = packed.where("settled").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r.bucket: r.n for r in sums.collect()}
    assert len(found) == 16 and max(found.values()) < 2 * sum(found.values()) / 16
    kept = substring_dedup.kept_words(rows.selectExpr("d as doc_id", "text"))
    assert kept.where("n_removed = 20").count() == 7999
