"""Quality rules, classifier, page extraction and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import documents, spaced
from pyspark.sql import functions as F

import corpus_pipeline
from sessionflow.llm import html_extract, nbsvm, quality_rules
from sessionflow.llm.queries import op2_html_extract, op4_quality_rules, op5_nbsvm, table
from sessionflow.llm.store import stored

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SYMBOL = re.compile(r"[#*$%&|<>]")


# --- quality rules --------------------------------------------------------------------------


def measured(text):
    words = spaced(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {i + k for own in places.values() if len(own) > 1 for i in own for k in range(8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if spaced(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
    chars = sum(len(w.decode()) for w in words)
    return len(words), chars, len(SYMBOL.findall(text or "")), repeated, len(again), failed


def test_measures_of_odd_and_real_documents(spark):
    rules = quality_rules.Rules()
    lines = [(40, "a b\n\na b\n \na b \nc\nc"), (41, "x y z " * 9), (42, " ".join("abcdefgh") + " q " + " ".join("abcdefgh"))]
    for docs in (documents(spark), documents(spark, lines), table(spark, SF_DIR, "documents")):
        rows = quality_rules.measured_documents(docs, rules)
        found = rows.withColumn("failed", quality_rules.base_failed(F.col("m"), rules)).select(
            "doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "failed"
        )
        expected = Counter((r.doc_id, *measured(r.text)) for r in docs.collect())
        assert Counter(tuple(r) for r in found.collect()) == expected


def test_binomial_tail_is_exact(spark):
    rows = [(n, k) for n in (1, 7, 50, 400, 3000) for k in (0, 1, 3, n // 50) if k <= n]
    frame = spark.createDataFrame(rows, "n long, k long")
    for risk in (0.01, 0.2):
        tail = quality_rules.binomial_tail(F.col("n"), F.col("k"), risk)
        for n, k, p in frame.withColumn("p", tail).collect():
            exact = sum(
                math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(risk) + (n - i) * math.log1p(-risk))
                for i in range(k + 1)
            )
            assert p == pytest.approx(1.0 if k > risk * n else exact, rel=1e-9)


def certified(spark, n_good, n_wrong, n_bad, stratum="en"):
    """Cutoffs of documents of which some good ones have many symbols."""
    clean = " ".join(f"word{i}" for i in range(40))
    noisy = " ".join(f"word{i}$$" for i in range(40))
    rows = [(i, clean, stratum) for i in range(n_good)]
    rows += [(n_good + i, noisy, stratum) for i in range(n_wrong + n_bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = [(i, int(i < n_good + n_wrong)) for i in range(len(rows))] + [(None, 1), (0, None)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    rules = quality_rules.Rules()
    held = stored(quality_rules.measured_documents(docs, rules), "measured")
    cutoffs = quality_rules.certified_cutoffs(held, labels, rules)
    return docs, rules, held, cutoffs


@pytest.mark.parametrize("n_wrong", [0, 1, 6, 40])
def test_cutoffs_follow_the_exact_test(spark, n_wrong):
    docs, rules, held, cutoffs = certified(spark, 1200, n_wrong, 30)
    n = 1200 + n_wrong
    risk, level = rules.risk / 6, rules.delta / 6
    tail = sum(math.comb(n, i) * risk**i * (1 - risk) ** (n - i) for i in range(n_wrong + 1))
    found = {r.rule: r.cutoff for r in cutoffs.collect()}
    # the noisy documents have two symbols a word: step 26 of 40
    assert found == ({"symbols": 26} if tail <= level else {})
    kept = quality_rules.kept_documents(docs, cutoffs, rules)
    assert kept.columns == docs.columns
    assert kept.count() == (1200 if tail <= level else 1230 + n_wrong)


def test_few_labels_and_null_strata_certify_nothing(spark):
    _, rules, held, cutoffs = certified(spark, 100, 0, 20)
    assert cutoffs.count() == 0
    assert quality_rules.with_verdict(held, cutoffs, rules).where("kept").count() == 120
    _, _, _, cutoffs = certified(spark, 1200, 0, 20, stratum=None)
    assert {r.stratum for r in cutoffs.collect()} == {None}


def test_many_strata_are_joined_with_the_same_result(spark, monkeypatch):
    _, rules, held, cutoffs = certified(spark, 1200, 0, 20, stratum=None)
    few = sorted(map(str, quality_rules.with_verdict(held, cutoffs, rules).collect()))
    monkeypatch.setattr(quality_rules, "MAX_LITERAL_STRATA", 0)
    assert sorted(map(str, quality_rules.with_verdict(held, cutoffs, rules).collect())) == few


def test_documents_without_words_when_strata_share_a_rule(spark, tmp_path):
    clean = " ".join(f"word{i}" for i in range(40))
    noisy = {lang: " ".join(f"word{i}{'$' * n}" for i in range(40)) for lang, n in (("en", 2), ("de", 3))}
    rows = [(text, lang) for lang in noisy for text in [clean] * 1200 + [noisy[lang]] * 30]
    rows = [(i, *r) for i, r in enumerate(rows)]
    labels = [(i, int(text == clean)) for i, text, _ in rows]
    odd = [(text, lang) for text in (None, "", " \t\n ", clean, noisy["de"]) for lang in ("en", "de", "fr", None)]
    rows += [(9000 + i, *r) for i, r in enumerate(odd)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    found = {r.doc_id: r.kept for r in op4_quality_rules(spark, str(tmp_path)).collect()}
    words = {clean, *noisy.values()}
    assert found == {i: text == clean or (text in words and lang not in noisy) for i, text, lang in rows}


@pytest.mark.parametrize("n_strata", [1, 200])
def test_cutoffs_of_every_stratum_apply(spark, monkeypatch, n_strata):
    clean = " ".join(f"word{i}" for i in range(40))
    noisy = " ".join(f"word{i}$$" for i in range(40))
    names = [f"s{i}" for i in range(n_strata)] + [None]
    rows = [(i, text, name) for i, (text, name) in enumerate((t, s) for t in (clean, noisy, None) for s in [*names, "other"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    cuts = [(name, rule, 26 + k % 2) for k, name in enumerate(names) for rule in quality_rules.RATIOS]
    cutoffs = spark.createDataFrame(cuts, "stratum string, rule string, cutoff int")
    # the noisy documents reach step 26, so they stay where the cutoff is 27
    mild = {"other"} | {name for k, name in enumerate(names) if k % 2}
    expected = {i for i, text, name in rows if text == clean or (text == noisy and name in mild)}
    for most in (quality_rules.MAX_LITERAL_STRATA, 0):
        monkeypatch.setattr(quality_rules, "MAX_LITERAL_STRATA", most)
        kept = quality_rules.kept_documents(docs, cutoffs, quality_rules.Rules())
        assert {r.doc_id for r in kept.collect()} == expected


def test_rules_on_empty_tables_and_clashing_names(spark):
    rules = quality_rules.Rules()
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for docs in (documents(spark), documents(spark, [])):
        held = stored(quality_rules.measured_documents(docs, rules), "measured")
        cutoffs = quality_rules.certified_cutoffs(held, labels, rules)
        kept = quality_rules.kept_documents(docs, cutoffs, rules)
        assert kept.columns == docs.columns
        assert Counter(r.doc_id for r in kept.collect()) == Counter(
            r.doc_id for r in docs.collect() if not measured(r.text)[-1]
        )


def test_rules_query(spark):
    found = {r.doc_id: r for r in op4_quality_rules(spark, SF_DIR).collect()}
    for r in table(spark, SF_DIR, "documents").collect():
        own = found.pop(r.doc_id)
        assert tuple(own)[1:7] == measured(r.text)
        assert not (own.kept and own.base_failed)
    assert not found


# --- classifier -----------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    found = op5_nbsvm(spark, LARGER).join(table(spark, LARGER, "labels"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    turned = labels.withColumn(
        "quality",
        F.when(nbsvm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")),
    )
    one, two = (nbsvm.trained(docs, x) for x in (labels, turned))
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias
    assert (one.slope, one.shift) == (two.slope, two.shift)


@pytest.mark.parametrize("labels", [[], [(1, 1), (5, 1)], [(1, 0)], [(1, 1), (10, 0), (None, 0), (5, None)]])
def test_classifier_on_odd_documents(spark, labels):
    docs = documents(spark)
    model = nbsvm.trained(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    found = nbsvm.scored(docs, model).collect()
    assert Counter(r.doc_id for r in found) == Counter(r.doc_id for r in docs.collect())
    assert all(0 <= r.score <= 1 for r in found)
    nine = {r.score for r in found if r.doc_id == 9}
    assert len(nine) == 1
    assert nbsvm.scored(documents(spark, []), model).count() == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    """Against projected gradient ascent on the same dual."""
    rng = np.random.default_rng(2)
    rows = [np.sort(rng.choice(30, 6, replace=False)) for _ in range(40)]
    labels = np.array([int(3 in r or 7 in r) for r in rows])
    ratios = rng.normal(size=30)
    original = nbsvm.EPOCHS
    nbsvm.EPOCHS = 3000
    try:
        weights, bias = nbsvm.dual_coordinate_descent(rows, labels, ratios)
    finally:
        nbsvm.EPOCHS = original
    x = np.zeros((40, 31))
    for k, r in enumerate(rows):
        x[k, r] = ratios[r] / math.sqrt(len(r))
    x[:, 30] = 1
    y = np.where(labels, 1.0, -1.0)
    upper = nbsvm.PENALTY * 0.5 / np.array([(labels == v).mean() for v in (0, 1)])[labels]
    gram = (x * y[:, None]) @ (x * y[:, None]).T
    alpha = np.zeros(40)
    for _ in range(60_000):
        alpha = np.clip(alpha + (1 - gram @ alpha) / np.linalg.norm(gram, 2), 0, upper)
    w = (alpha * y) @ x
    assert np.allclose(weights, w[:30] * ratios, atol=1e-4) and bias == pytest.approx(w[30], abs=1e-4)


# --- pages ----------------------------------------------------------------------------------


def test_pages_give_their_articles(spark):
    found = {r.page_id: r for r in op2_html_extract(spark, LARGER).collect()}
    pages = table(spark, LARGER, "pages").collect()
    assert len(found) == len(pages)
    import html

    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split())
            for b in re.split(r"</?(?:h1|p)>", article)
        ]
        text = "\n\n".join(b for b in blocks if b)
        assert (found[p.page_id].text, found[p.page_id].n_chars) == (text, len(text))


STORY = "The council met on Tuesday and agreed after a long debate to rebuild the old bridge."
SITE = """<html><head><title>T</title></head><body><div id="cookie-banner"><p>We use cookies on this site.</p></div>
<div class="container"><div class="post-content"><h1>Bees &amp; trees</h1><p>Bees live in   trees and
eat what they find, which is a lot in summer.</p><div class="advert"><p>Buy honey now, it is very cheap today.</p></div>
<p>In winter they sleep<br>and dream of summer, as far as anybody knows.</p></div>
<section class="comments"><h3>Two comments</h3><p>I like bees very much, they are so nice to have.</p></section></div>
<aside><p>Other things that you may want to read about.</p></aside><form><label>Mail</label><p>Write to us if you like.</p></form>
<script>var x = "<p>no</p>";</script><footer><p>&copy; Bees</p></footer></body></html>"""


def test_other_layouts_and_broken_pages(spark):
    rows = [
        (1, "u", SITE),
        (2, None, None),
        (3, "u", ""),
        (4, "u", "<p>"),
        (5, "u", "<!-- only a comment"),
        (None, "u", "<html><body><article><p>One<p>Two &lt;b&gt; &#233;&nbsp;x<li>three</article>"),
        (7, "u", "<script>never closed <p>no</p>"),
        (7, "u", "</div></p>" * 50),
        (8, "u", "<div>" * 3000 + "deep" + "</div>" * 3000),
        (9, "u", "<a href='>'>x</a> 1 < 2 <"),
        (10, "u", f"<body><ul><li><a href=/>Home</a></li></ul><div><h2>B</h2><p>{STORY}</p><ul><li>one thing</li></ul></div>"),
        (11, "u", f"<header><h2>Site</h2></header><article><header><h1>H</h1></header><p>{STORY}</p><ul class='comment-list'><li><p>{STORY}</p></li></ul><aside>{STORY}</aside></article>"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    model = html_extract.trained(table(spark, LARGER, "pages"))
    found = html_extract.extracted(pages, model).collect()
    assert Counter(r.page_id for r in found) == Counter(r[0] for r in rows)
    text = {r.page_id: r.text for r in found}
    assert text[1] == (
        "Bees & trees\n\nBees live in trees and eat what they find, which is a lot in summer.\n\n"
        "In winter they sleep and dream of summer, as far as anybody knows."
    )
    assert text[None] == "One\n\nTwo <b> é x\n\nthree"
    assert [text[k] for k in (2, 3, 4, 5)] == [""] * 4
    assert text[10] == f"B\n\n{STORY}\n\none thing" and text[11] == f"H\n\n{STORY}"
    assert all(r.n_chars == len(r.text) for r in found)
    # no page at all: the hand-labelled ones remain
    html_extract.trained(pages.limit(0))


def test_marginals_equal_enumeration():
    page = html_extract.parsed("<div><p>Some text here</p><ul><li>a</li></ul></div>")
    counts = Counter()
    for source in html_extract.LABELLED_PAGES:
        own = html_extract.parsed(source)
        counts.update(html_extract.counted(own, html_extract.labels_by_marks(own)))
    model = html_extract.TreeModel.fitted(counts)
    n, values = len(page.tag), html_extract.features(page)
    total, content = 0.0, np.zeros(n)
    for code in range(1 << n):
        label = [code >> k & 1 for k in range(n)]
        weight = 1.0
        for k in range(n):
            for value in values[k]:
                weight *= model.emission[value][label[k]]
            if k:
                weight *= model.edge[label[page.parent[k]]][label[k]]
        total += weight
        content += weight * np.array(label)
    assert np.allclose(model.marginals(page), content / total)


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark):
    from test_corpus_operators import deduplicated, fingerprint, near_groups
    from test_text_operators import contaminated

    rows = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    kept = {r.doc_id for r in op4_quality_rules(spark, SF_DIR).where("kept").collect()}
    assert all(not measured(rows[i])[-1] for i in kept)
    ids = sorted(kept)
    label = near_groups([fingerprint(rows[i]) for i in ids])
    ids = [i for k, i in enumerate(ids) if label[k] == k]
    texts = {}
    for (i, _, gone, text) in deduplicated([(i, rows[i]) for i in ids]):
        texts[i] = text if gone else rows[i]
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
    dirty = {k[0] for k in contaminated(list(texts.items()), items) if k[-1]}
    expected = {i: t for i, t in texts.items() if i not in dirty}
    assert 0 < len(expected) < len(rows)
    import os

    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    result = corpus_pipeline.run(spark, SF_DIR)
    left = [n for n in set(os.listdir(shared)) - before if "hot-anchors" in n or "stage" in n or "labels" in n]
    assert len(left) == 1 and "stage-byte_bpe" in left[0]
    found = result.collect()
    assert {r.doc_id: r.text for r in found} == expected and len(found) == len(expected)
    assert all(r.n_tokens == len(r.ids) // 4 for r in found)


def test_stages_keep_the_columns_and_take_odd_tables(spark):
    for docs in (documents(spark), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, SF_DIR).columns == docs.columns
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), f"test-{name}")
    assert docs.where("doc_id = 6").count() <= 1


# --- pages whose markup misleads ------------------------------------------------------------

BEES = "<h1>Bees</h1>" + "".join(
    f"<p>The bees of hill number {i} came back in spring and found the meadow full of flowers.</p>" for i in range(8)
)
MENU = "<ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li></ul>"
BLOCKS_OF_BEES = ["Bees"] + [
    f"The bees of hill number {i} came back in spring and found the meadow full of flowers." for i in range(8)
]


@pytest.fixture(scope="module")
def tree_model(spark):
    return html_extract.trained(table(spark, LARGER, "pages"))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><form id='aspnetForm'><div class='menu'>{MENU}</div><div>{BEES}</div></form></body>",
        f"<body class='no-search-form has-sidebar'><nav>{MENU}</nav><div>{BEES}</div></body>",
        f"<body><div id='page-with-sidebar'><nav>{MENU}</nav><div class='content'>{BEES}</div></div></body>",
        f"<body><nav>{MENU}</nav><div title='hidden gems' data-id='social-12' data-role=comments>{BEES}</div></body>",
        f"<body><nav>{MENU}</nav><main>{BEES}</main><div class='comments'><p>{'I like bees. ' * 90}</p></div></body>",
        f"<body><table><tr><td class=nav>{MENU}</td><td>{BEES}</td></tr></table></body>",
    ],
)
def test_misleading_hints(tree_model, page):
    assert html_extract.main_text(page, tree_model).split("\n\n") == BLOCKS_OF_BEES


def test_tags_are_read_up_to_their_end(tree_model):
    page = (
        f"<main>{BEES}<p>See <a href=\"x\"\">link</a> and <b data-t=it's>bold</b>, <i title='a > b' x = \"<p>\">it</i>"
        " 1 < 2 & <3</p></main><div"
    )
    found = html_extract.main_text(page, tree_model).split("\n\n")
    assert found == [*BLOCKS_OF_BEES, "See link and bold, it 1 < 2 & <3"]
    cues = [html_extract.cue_of(a)[0] for a in (
        " title='hidden gems'", " data-id=social-12", " aria-label='comments'", " hidden", " CLASS=nav",
        " x = y class = 'share'", " id=\"post\"", " class", " =class='nav'",
    )]
    assert cues == ["none", "none", "none", "bad", "bad", "bad", "good", "none", "bad"]


@pytest.mark.parametrize(
    "page",
    [
        "<div>x" * 200_000,
        "<p><button>" + "<div>x" * 100_000,
        "<b>" * 100_000 + "x<hr>" * 100_000,
        "<header>x" * 100_000,
        "<ul><li>x" * 100_000,
        "<i>x" * 100_000 + "</u></i>" * 100_000,
        "<a b=" * 50_000,
        "<a b='" * 2_001,
    ],
)
def test_deep_and_broken_pages_take_seconds(tree_model, page):
    import time

    begin = time.monotonic()
    html_extract.main_text(page, tree_model)
    assert time.monotonic() - begin < 30
