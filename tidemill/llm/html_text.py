"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is read as a sequence of words and tags. Words score positive, less so in links
and list items; tags score negative, by how seldom their kind occurs within the content
of labelled pages. The content is the contiguous stretch with the largest sum, found in
one scan. Elements that never are content (menus, footers, scripts and the like) give no
words to the sequence, and none to the text of the stretch. Nor do those that a class,
id or role, `form` or `header` mark as something else, unless they hold so much of the
page that they must be its wrapper, or a heading of the content.

Weights are counted on a bounded sample of pages that label their content themselves by
an `article` or `main` element; extraction covers the whole of every page. There and
elsewhere the scan alone chooses: words in such an element count a quarter more.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import column, free_name

# Elements by their part in a page.
RAW = ("script", "style", "textarea", "title", "xmp", "noframes", "iframe", "noembed")
NEVER = (
    "head nav footer aside script style noscript template svg math canvas select button"
    " iframe object embed applet audio video map dialog menu title textarea noframes noembed xmp datalist"
).split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCK = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " search section summary table tbody td tfoot th thead title tr ul"
).split()
CONTENT = ("article", "main")
# Elements, and words in a class, id or role, that mark a part of the page's layout; pages
# are wrapped in such elements, too.
LAYOUT_TAGS = ("form", "header")
LAYOUT = frozenset(
    (
        "sidebar sidebars menu menus nav navbar navigation footer header masthead banner notice notices alert"
        " popup modal overlay signup login widget widgets toolbar form search complementary contentinfo"
    ).split()
)
# Words that say what is in an element, and that it is no content.
MARKS = frozenset(
    (
        "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promos promotion"
        " breadcrumb breadcrumbs cookie cookies consent gdpr notification newsletter subscribe subscription share"
        " sharing social related recommended teaser teasers pagination pager comment comments commentlist respond"
        " reply replies disqus discussion"
    ).split()
)
# Beside such a word a mark tells the page's state, or is the content's own part.
STATES = frozenset("has with without no not open opened closed collapsed expanded".split())
OWN = {"header": frozenset("entry post article story content".split()), "search": frozenset("result results".split())}
# Share of the page's score from which an element is its wrapper, by the kind of its mark.
WRAPPER = {1: 0.5, 2: 0.95}

# A tag is given up at the next `<` outside quotes, then at the next one anywhere, so no
# place is read more than a few times however broken a page is.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>?",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Page:
    """The sequence of a page: texts and tags in order.

    `tags` is None for a text. `weak` marks texts in links and list items, `barred` what
    lies in elements that are no content, `labelled` what lies in the page's own label.
    """

    texts: list[str] = field(default_factory=list)
    tags: list[str | None] = field(default_factory=list)
    weak: list[bool] = field(default_factory=list)
    barred: list[bool] = field(default_factory=list)
    labelled: list[bool] = field(default_factory=list)

    def add(self, text: str, tag: str | None, weak: bool, barred: bool, labelled: bool) -> None:
        self.texts.append(text)
        self.tags.append(tag)
        self.weak.append(weak)
        self.barred.append(barred)
        self.labelled.append(labelled)

    def rows(self) -> list[tuple[str, str | None, bool, bool, bool]]:
        return list(zip(self.texts, self.tags, self.weak, self.barred, self.labelled, strict=True))


def _marked(attributes: str) -> int:
    """2 if class, id or role say that an element is no content, 1 if part of the layout."""
    kind = 0
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return 2
        if name not in ("class", "id", "role"):
            continue
        for term in value.split():
            parts = set(_PART.findall(term))
            if not STATES.isdisjoint(parts):
                continue
            if not MARKS.isdisjoint(parts):
                return 2
            if any(parts.isdisjoint(OWN.get(m, ())) for m in parts & LAYOUT):
                kind = 1
    return kind


def _settle(page: Page, inner: list[int], above: list[int], kinds: list[int]) -> None:
    """Bar what lies in marked elements, but for those that are the page's wrapper.

    `inner` is the innermost marked element of each item, `above` the one around each of
    these, -1 for none. An element of the layout is measured against all that lies in no
    element of the other kind, or against the whole page.
    """
    size = [0.0] * len(page.texts)
    for i, text in enumerate(page.texts):
        if page.tags[i] is None and not page.barred[i]:
            size[i] = _words(text) * (DEFAULT.weak if page.weak[i] else DEFAULT.word)
    strong = [False] * len(kinds)
    for k, up in enumerate(above):
        strong[k] = kinds[k] == 2 or up >= 0 and strong[up]
    held, plain = [0.0] * len(kinds), [0.0] * len(kinds)
    all_plain = 0.0
    for k, s in zip(inner, size, strict=True):
        is_plain = k < 0 or not strong[k]
        all_plain += s * is_plain
        if k >= 0:
            held[k] += s
            plain[k] += s * is_plain
    for k in range(len(kinds) - 1, -1, -1):
        if above[k] >= 0:
            held[above[k]] += held[k]
            plain[above[k]] += plain[k]
    total = sum(size)
    bars = [False] * len(kinds)
    for k, up in enumerate(above):
        wraps = held[k] > WRAPPER[2] * total or kinds[k] == 1 and plain[k] > WRAPPER[1] * all_plain
        bars[k] = not wraps or up >= 0 and bars[up]
    page.barred = [b or k >= 0 and bars[k] for b, k in zip(page.barred, inner, strict=True)]


def read_page(source: str, by_marks: bool = True) -> Page:
    """Split a page into texts and tags; broken markup is taken as browsers would."""
    page = Page()
    # Names of open elements, whether they bar, and whether they are marked.
    open_: list[tuple[str, bool, bool]] = []
    names: Counter[str] = Counter()
    inner: list[int] = []
    above: list[int] = []
    kinds: list[int] = []
    mark = -1
    bars = links = content = 0

    def add(text: str, tag: str | None, weak: bool) -> None:
        page.add(text, tag, weak, bars > 0, content > 0)
        inner.append(mark)

    def close() -> str:
        nonlocal bars, links, content, mark
        gone, barring, marked = open_.pop()
        names[gone] -= 1
        bars -= barring
        links -= gone in ("a", "li")
        content -= gone in CONTENT
        if marked:
            mark = above[mark]
        return gone

    at = 0
    while True:
        found = _TOKEN.search(source, at)
        text = source[at : found.start() if found else len(source)]
        if text:
            add(text, None, links > 0)
        if not found:
            if kinds:
                _settle(page, inner, above, kinds)
            return page
        at = found.end()
        name = (found[2] or found[5] or "").lower()
        if not name:
            continue
        attributes = found[3] or found[6] or ""
        if found[1] or found[4]:
            if names[name]:
                while close() != name:
                    pass
            add("", "/" + name, False)
            continue
        if name == "p" or name in BLOCK:
            # A block ends an open paragraph, as does a list item its predecessor.
            ends = "li" if name == "li" else "p"
            if open_ and open_[-1][0] == ends:
                close()
        add("", name, False)
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b", re.I).search(source, at)
            at = end.start() if end else len(source)
        kind = 0
        if by_marks and name not in ("html", "body", *CONTENT):
            kind = _marked(attributes) if attributes else 0
            # The header of the content is its heading.
            if name in LAYOUT_TAGS and not (name == "header" and content):
                kind = max(kind, 1)
        if attributes.rstrip().endswith("/") and name in ("svg", "path", "math"):
            continue
        open_.append((name, name in NEVER, kind > 0))
        names[name] += 1
        if kind:
            above.append(mark)
            kinds.append(kind)
            mark = len(kinds) - 1
        bars += name in NEVER
        links += name in ("a", "li")
        content += name in CONTENT


def _words(text: str) -> int:
    return len(text.split())


@dataclass(frozen=True)
class Weights:
    """Score of a word, of a word in a link or list item, and of tags by kind."""

    word: float = 1.0
    weak: float = 0.3
    tags: dict[str, float] = field(default_factory=dict)

    def of(self, tag: str) -> float:
        return self.tags.get(tag) or SCALE * math.log(_expected(tag))


# How many pages' worth of tags the expectation counts for, and what surprise costs.
PRIOR, SCALE, DEAREST = 20.0, 0.4, -6.0
# What words in an `article` or `main` element count for, against the same words elsewhere.
LABEL = 1.25


def _expected(tag: str) -> float:
    """Expected share of a tag kind within content, before any page was seen."""
    name = tag.lstrip("/")
    if name in ("p", "br", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figure", "figcaption", "img"):
        return 0.95
    if name in ("html", "body", "head", *CONTENT, *LAYOUT_TAGS, *NEVER):
        return 0.02
    if name in BLOCK:
        return 0.7 if name in ("li", "ul", "ol", "dl", "dt", "dd", "td", "th", "tr", "tbody", "table") else 0.4
    return 0.9


# Used where no page labels its content.
DEFAULT = Weights()


def learn(pages: list[str]) -> Weights:
    """Weights from pages that label their content.

    A tag kind costs the surprise of meeting it within content, with a bound; a word in
    a link or list item is worth the share of such words that are content.
    """
    inside, outside, weak = Counter(), Counter(), [0, 0]
    for source in pages:
        page = read_page(source)
        if not any(page.labelled):
            continue
        for text, tag, is_weak, barred, labelled in page.rows():
            if barred:
                continue
            if tag is not None:
                (inside if labelled else outside)[tag] += 1
            elif is_weak:
                weak[labelled] += _words(text)

    def cost(tag: str) -> float:
        seen = inside[tag] + outside[tag]
        share = (inside[tag] + PRIOR * _expected(tag)) / (seen + PRIOR)
        return max(DEAREST, SCALE * math.log(share))

    share = (weak[1] + 3 * DEFAULT.weak) / (weak[0] + weak[1] + 3)
    return Weights(weak=max(0.02, share), tags={t: cost(t) for t in inside | outside})


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """First and past-last place of the contiguous stretch with the largest sum."""
    best = total = 0.0
    first = start = end = 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, first, end = total, start, i + 1
    return first, end


def main_text(source: str | None, weights: Weights) -> str:
    """Blocks of the content, white space within them made single, joined by two \\n.

    Empty for null or a page without words. Character references are decoded after the
    markup is gone. If marks bar the whole page, forms and headers among them, they are
    set aside.
    """
    for by_marks in (True, False):
        page = read_page(source or "", by_marks)
        rows = page.rows()
        scores = []
        for text, tag, weak, barred, labelled in rows:
            if tag is not None:
                scores.append(0.0 if barred else weights.of(tag))
            elif barred:
                scores.append(0.0)
            else:
                word = weights.weak if weak else weights.word
                scores.append(_words(text) * word * (LABEL if labelled else 1.0))
        first, end = best_stretch(scores)
        blocks: list[list[str]] = [[]]
        for i in range(first, end):
            tag = page.tags[i]
            if tag is None:
                if not page.barred[i]:
                    blocks[-1].append(page.texts[i])
            elif tag.lstrip("/") in BLOCK:
                blocks.append([])
            elif tag == "br":
                blocks[-1].append(" ")
        texts = (" ".join(html.unescape("".join(b)).split()) for b in blocks)
        text = "\n\n".join(t for t in texts if t)
        if text:
            return text
    return ""


def fit_sample(pages: DataFrame, sample: int = 1000, source: str = "html") -> Weights:
    """Weights from at most `sample` pages with a label, by the lowest hash of the page."""
    html_ = column(source)
    labelled = pages.select(html_.alias("html"), F.xxhash64(html_).alias("order"))
    labelled = labelled.filter(F.col("html").rlike(r"(?i)<(article|main)[\s>]"))
    # Hashes are compared first, so only the sample's own pages leave the tasks.
    lowest = labelled.select("order").distinct().orderBy("order").limit(sample).collect()
    if not lowest:
        return DEFAULT
    rows = labelled.filter(F.col("order") <= lowest[-1]["order"]).dropDuplicates(["order"])
    return learn([r["html"] for r in sorted(rows.collect(), key=lambda r: r["order"])])


def extract(pages: DataFrame, weights: Weights, source: str = "html") -> DataFrame:
    """`pages` with text and n_chars; other columns of those names are replaced."""

    @F.pandas_udf("string")
    def pull(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([main_text(h, weights) for h in batch], dtype=object)

    others = [column(c) for c in pages.columns if c.lower() not in ("text", "n_chars")]
    held = free_name(pages, "pulled")
    out = pages.withColumn(held, pull(column(source)))
    return out.select(*others, F.col(held).alias("text"), F.length(held).cast("long").alias("n_chars"))
