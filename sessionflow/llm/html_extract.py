"""Main text of web pages by a tree-structured graphical model over DOM elements.

Each element is a binary variable, part of the article or not. Factors are P(features | label) of its
own features and, on every edge, P(label | label of the parent). Messages go upward from the leaves and
downward from the root (sum-product), which on a tree gives exact marginals; blocks of text
whose element has a marginal above one half are the main text.

The tables are counted, with pseudo-counts, from labelled pages: a small set labelled by hand, and the pages
of the corpus that contain exactly one ``article``, whose HTML semantics label their elements. Both sets
weigh the same however large the corpus is. The corpus is counted in Spark; what reaches the driver
is one row per feature value and label, of a fixed list.

NULL html is an empty page. Each row is read by itself: repeated pages and NULL ids are kept.
Unclosed, stray and unknown tags are read as browsers read them; markup without text yields the
empty string. Hints are ignored on an element that encloses nearly the whole page, its first heading or
main part included: a form around everything says nothing. Words of hints are English only.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .html_pages import LABELLED_PAGES

#: Fixed values of HTML: elements without content, elements whose content is no text of the page,
#: elements that leave a head open, elements that form blocks, and elements that stop the search for an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math head select".split())
IN_HEAD = frozenset(
    "base basefont bgsound head html link meta noframes noscript script style template title".split()
)
OPAQUE = frozenset("script style textarea title iframe".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
SCOPE = frozenset("html table td th caption button object".split())
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
#: Words in class, id and role that hint at what an element is. Fixed values.
GOOD = frozenset("article body content entry main page post story text".split())
BAD = frozenset(
    "ad ads adv advert advertisement adverts alert author banner bar breadcrumb breadcrumbs comment "
    "comments complementary consent contentinfo cookie cookies copyright disclaimer discussion feedback "
    "foot footer form gdpr head header hidden legal links login masthead menu message modal nav navbar "
    "navigation newsletter notice overlay pager pagination popup promo promotion rail reader recommended "
    "related replies reply response review search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe tags teaser toolbar topbar widget".split()
)
TAGS = frozenset(
    "a article aside b blockquote body button code dd div dl dt em figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header html i label li main nav ol p pre section span strong table tbody td th tr ul".split()
)
#: Pseudo-counts of (other, article): hints mean what they say, and nothing in an element that is no
#: part of the article is part of it again.
PRIOR = {"cue=good": (0.5, 5.0), "cue=bad": (500.0, 0.05)} | {
    f"tag={t}": (30.0, 0.1) for t in ("aside", "button", "footer", "form", "header", "label", "nav")
} | {f"tag={t}": (0.02, 10.0) for t in ("article", "main")}
#: Weight of the features: those of text and plain tags are much alike among neighbours.
WEIGHT = {"tag": 0.25, "cue": 1.0, "size": 0.1, "links": 0.5}
#: No hint is no evidence, and lists and containers are in menus and in articles alike.
SILENT = frozenset({"cue=none", "tag=div", "tag=li", "tag=ol", "tag=ul"})
EDGE_PRIOR = ((1.0, 0.001), (1.0, 1.0))
#: After "=" a quoted value, or one up to white space; elsewhere quotes mean nothing, as in browsers.
VALUE = r"\s*+(?>\"[^\"]*\"|'[^']*'|[^\s>]*+)"
MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>=]+|={VALUE})*+)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
#: An element with this share of the page's text encloses the page if the main part is in it too; with
#: more than ALL it does in any case.
MOST, ALL = 0.8, 0.98
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Elements in document order (parents first) and blocks of text with their elements."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    cue: list[str] = field(default_factory=list)
    marks: list[str] = field(default_factory=list)
    own: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)


def cue_of(attributes: str) -> tuple[str, str]:
    """Hint of an element's attributes, and its label in labelled pages."""
    cue, mark = "none", ""
    for name, *values in ATTRIBUTE.findall(attributes):
        value = "".join(values)
        name = name.lower()
        if name in ("data-main", "data-other"):
            mark = name[5:]
        elif name == "hidden" or name == "aria-hidden" and value == "true":
            cue = "bad"
        elif name == "style":
            if "display:none" in value.replace(" ", ""):
                cue = "bad"
        elif name in ("class", "id", "role"):
            words = {w.lower() for w in TOKEN.findall(value)}
            if words & BAD:
                cue = "bad"
            elif words & GOOD and cue == "none":
                cue = "good"
    return cue, mark


def parsed(source: str) -> Page:
    page = Page()
    stack: list[int] = []
    raw = 0  # open elements whose text does not count
    # what the stack holds: its elements by tag, the nearest block of each, open paragraphs by scope
    opened: Counter = Counter()
    nearest: list[int] = []
    paragraphs = [0]
    text: list[str] = []
    position, hidden_until = 0, ""

    def add(tag: str, attributes: str) -> None:
        cue, mark = cue_of(attributes) if attributes else ("none", "")
        page.parent.append(stack[-1] if stack else -1)
        page.tag.append(tag)
        page.cue.append(cue)
        page.marks.append(mark)
        page.own.append(0)
        page.linked.append(0)

    def end_block() -> None:
        words = " ".join(html.unescape("".join(text)).split())
        text.clear()
        if words:
            page.blocks.append((nearest[-1], words))

    def push() -> None:
        n, tag = len(page.tag) - 1, page.tag[-1]
        stack.append(n)
        nearest.append(n if tag in BLOCKS or not nearest else nearest[-1])
        opened[tag] += 1
        if tag in SCOPE:
            paragraphs.append(0)
        paragraphs[-1] += tag == "p"

    def pop() -> str:
        nonlocal raw
        tag = page.tag[stack.pop()]
        opened[tag] -= 1
        raw -= tag in RAW
        if tag in SCOPE:
            paragraphs.pop()
        paragraphs[-1] -= tag == "p"
        return tag

    def say(piece: str) -> None:
        if page.tag[stack[-1]] == "head" and piece.strip(" \t\n\f\r"):
            close("head")
        if raw or not piece:
            return
        text.append(piece)
        size = len(piece.strip())
        if size:
            page.own[stack[-1]] += size
            if any(page.tag[n] == "a" for n in stack[-4:]):
                page.linked[stack[-1]] += size

    def close(tag: str) -> None:
        if tag in BLOCKS:
            end_block()
        while len(stack) > 1:
            found = pop()
            if found in BLOCKS and found != tag:
                # text after its last inner block is its own or that of the nearest block in it
                end_block()
            nearest.pop()
            if found == tag:
                return

    def open_in_scope(tags: set[str]) -> str | None:
        if not any(opened[tag] for tag in tags):
            return None
        for n in reversed(stack):
            if page.tag[n] in tags:
                return page.tag[n]
            if page.tag[n] in SCOPE or page.tag[n] in ("ul", "ol", "dl"):
                return None
        return None

    add("html", "")
    push()
    for m in MARK.finditer(source):
        if hidden_until:
            if not (m[1] and m[2].lower() == hidden_until):
                continue
            position = m.start()
            hidden_until = ""
        say(source[position : m.start()])
        position = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("html", "body"):
                continue
            if opened[tag]:
                close(tag)
            continue
        if tag == "html" or tag == "head" and len(stack) > 1:
            continue
        if page.tag[stack[-1]] == "head" and tag not in IN_HEAD:
            close("head")
        if tag == "br":
            say(" ")
            text.append(" ")
        if tag in BLOCKS:
            if paragraphs[-1]:
                close("p")
            end_block()
        if other := open_in_scope(CLOSED_BY[tag]) if tag in CLOSED_BY else None:
            close(other)
        if tag == "body" and raw:
            while len(stack) > 1:
                pop()
                nearest.pop()
        if tag in VOID:  # a slash at the end of other tags means nothing in HTML
            continue
        add(tag, m[3])
        push()
        if tag in RAW:
            raw += 1
        if tag in OPAQUE:
            hidden_until = tag
    if not hidden_until:
        say(source[position:])
    end_block()
    return page


# --- model ----------------------------------------------------------------------------------


def enclosing(page: Page, whole: list[int]) -> list[bool]:
    """Whether an element encloses the page, by its share of the text (``whole``) and by whether the first
    heading or main part lies in it."""
    size = len(page.tag)
    last = list(range(size))  # the last element inside each
    for n in range(size - 1, 0, -1):
        last[page.parent[n]] = max(last[page.parent[n]], last[n])
    main = next(
        (
            n
            for n, tag in enumerate(page.tag)
            if tag in ("h1", "main") or page.cue[n] != "bad" and tag == "article" or page.cue[n] == "good"
        ),
        -1,
    )
    return [
        page.tag[n] in ("html", "body")
        or whole[n] > ALL * whole[0]
        or whole[n] >= MOST * whole[0] and n < main <= last[n]
        for n in range(size)
    ]


def features(page: Page) -> list[tuple[str, ...]]:
    """Feature values of each element: tag, hint, amount of text, share of it in links."""
    whole, linked = page.own.copy(), page.linked.copy()
    for n in range(len(whole) - 1, 0, -1):
        whole[page.parent[n]] += whole[n]
        linked[page.parent[n]] += linked[n]
    around = enclosing(page, whole)
    inner = [False] * len(page.tag)  # in an article, main or section
    found = []
    for n, tag in enumerate(page.tag):
        p = page.parent[n]
        if p >= 0:
            inner[n] = inner[p] or page.tag[p] in ("article", "main", "section")
        size = sum(page.own[n] > limit for limit in (0, 20, 80, 300))
        share = 0 if not whole[n] else 1 + min(2, 3 * linked[n] // whole[n])
        if tag == "header" and inner[n] or tag == "form" and around[n]:
            tag = "div"  # an article's own head, not the page's; a form around the page
        cue = "none" if around[n] and page.cue[n] == "bad" else page.cue[n]
        found.append(
            (
                f"tag={tag if tag in TAGS else 'other'}",
                f"cue={cue}",
                f"size={size}",
                f"links={share}",
            )
        )
    return found


def labels_by_marks(page: Page) -> list[int]:
    """Labels of hand-labelled pages; what encloses the article belongs to it."""
    label = [0] * len(page.tag)
    for n, mark in enumerate(page.marks):
        inherited = label[page.parent[n]] if n else 0
        label[n] = {"main": 1, "other": 0, "": inherited}[mark]
    return with_enclosing(page, label)


def labels_by_semantics(page: Page) -> list[int] | None:
    """Labels of a page with exactly one ``article``, or None."""
    if page.tag.count("article") != 1:
        return None
    label = [0] * len(page.tag)
    for n, tag in enumerate(page.tag):
        inside = tag == "article" or n > 0 and label[page.parent[n]]
        other = tag in ("nav", "aside", "footer", "form") or page.cue[n] == "bad"
        label[n] = int(bool(inside) and not other)
    return with_enclosing(page, label)


def with_enclosing(page: Page, label: list[int]) -> list[int]:
    """Labels in which whatever encloses a part of the article is part of it."""
    found = label.copy()
    for n in range(len(label) - 1, 0, -1):
        if found[n]:
            found[page.parent[n]] = 1
    found[0] = 1
    return found


def counted(page: Page, label: list[int]) -> Counter:
    counts: Counter = Counter()
    for n, values in enumerate(features(page)):
        for value in values:
            counts[value, label[n]] += 1
        if n:
            counts[f"parent={label[page.parent[n]]}", label[n]] += 1
    return counts


@dataclass
class TreeModel:
    """P(feature value | label) as weights of both labels, and P(label | label of the parent)."""

    emission: dict[str, tuple[float, float]]
    edge: tuple[tuple[float, float], tuple[float, float]]

    @staticmethod
    def fitted(counts: dict[tuple[str, int], float]) -> TreeModel:
        groups = {
            "tag": [f"tag={t}" for t in (*sorted(TAGS), "other")],
            "cue": [f"cue={c}" for c in ("bad", "good", "none")],
            "size": [f"size={k}" for k in range(5)],
            "links": [f"links={k}" for k in range(4)],
        }
        emission = {}
        for group, values in groups.items():
            amounts = {}
            for value in values:
                prior = PRIOR.get(value, (1.0, 1.0))
                amounts[value] = [counts.get((value, y), 0.0) + prior[y] for y in (0, 1)]
            sums = [sum(a[y] for a in amounts.values()) for y in (0, 1)]
            for value, a in amounts.items():
                weight = 1.0 if value in PRIOR else WEIGHT[group]
                weight = 0.0 if value in SILENT else weight
                emission[value] = tuple((a[y] / sums[y]) ** weight for y in (0, 1))
        edge = []
        for y in (0, 1):
            a = [counts.get((f"parent={y}", z), 0.0) + EDGE_PRIOR[y][z] for z in (0, 1)]
            edge.append((a[0] / sum(a), a[1] / sum(a)))
        return TreeModel(emission, tuple(edge))

    def marginals(self, page: Page) -> list[float]:
        """P(element is part of the article) of every element, by sum-product."""
        (e00, e01), (e10, e11) = self.edge
        n = len(page.tag)
        up0, up1 = [1.0] * n, [1.0] * n  # own features times messages of children
        to0, to1 = [1.0] * n, [1.0] * n  # message to the parent
        for k, values in enumerate(features(page)):
            for value in values:
                a, b = self.emission[value]
                up0[k] *= a
                up1[k] *= b
        for k in range(n - 1, 0, -1):
            scale = 1.0 / (up0[k] + up1[k])
            a, b = up0[k] * scale, up1[k] * scale
            up0[k], up1[k] = a, b
            to0[k], to1[k] = e00 * a + e01 * b, e10 * a + e11 * b
            p = page.parent[k]
            scale = 1.0 / (to0[k] + to1[k])
            up0[p] *= to0[k] * scale
            up1[p] *= to1[k] * scale
            if up0[p] + up1[p] < 1e-100:
                up0[p], up1[p] = up0[p] * 1e100, up1[p] * 1e100
        total = up0[0] + up1[0]
        belief0, belief1 = [up0[0] / total] * n, [up1[0] / total] * n
        for k in range(1, n):
            p = page.parent[k]
            # what the parent believes without this element's own message
            a, b = belief0[p] / to0[k], belief1[p] / to1[k]
            x, y = up0[k] * (a * e00 + b * e10), up1[k] * (a * e01 + b * e11)
            belief0[k], belief1[k] = x / (x + y), y / (x + y)
        return belief1


def main_text(source: str, model: TreeModel) -> str:
    page = parsed(source)
    if not page.blocks:
        return ""
    belief = model.marginals(page)
    return "\n\n".join(words for at, words in page.blocks if belief[at] > 0.5)


def trained(pages: DataFrame) -> TreeModel:
    """The model of the hand-labelled pages and the pages of the corpus that label themselves."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for source in batch["html"].to_pylist():
                page = parsed(source or "")
                if (label := labels_by_semantics(page)) is not None:
                    counts.update(counted(page, label))
        keys = list(counts)
        yield pa.record_batch(
            [
                pa.array([k for k, _ in keys], pa.string()),
                pa.array([y for _, y in keys], pa.int32()),
                pa.array([counts[k] for k in keys], pa.int64()),
            ],
            names=["value", "label", "n"],
        )

    corpus = (
        pages.select(F.col("html").cast("string"))
        .mapInArrow(of_batches, "value string, label int, n long")
        .groupBy("value", "label")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most two rows for each value of a fixed list
    )
    hand: Counter = Counter()
    for source in LABELLED_PAGES:
        page = parsed(source)
        hand.update(counted(page, labels_by_marks(page)))
    mass = sum(r["n"] for r in corpus)
    scale = sum(hand.values()) / mass if mass else 0.0
    totals = {k: float(v) for k, v in hand.items()}
    for r in corpus:
        key = (r["value"], r["label"])
        totals[key] = totals.get(key, 0.0) + scale * r["n"]
    return TreeModel.fitted(totals)


def extracted(pages: DataFrame, model: TreeModel) -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source or "", model) for source in batch["html"].to_pylist()]
            yield pa.record_batch(
                [
                    batch["page_id"],
                    batch["url"],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    )
    return rows.mapInArrow(of_batches, "page_id long, url string, text string, n_chars long")
