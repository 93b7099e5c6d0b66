"""Main text of web pages: the maximum-scoring run of words and tags.

A page is read as a sequence of tags and of text runs. Each word of a run scores
by where it stands (zone, link, block) and each tag by its name and zone: the
log odds that such words belong to the article, learnt from labelled pages. Words
of an article score positive, tags never do. One linear scan finds the run with
the highest sum; its text, without the zones in it that are never article, is the
main text.

Zones follow elements and the words of class, id and role: menus, headers,
footers, sidebars, notices, adverts, forms, comments and what is hidden are
dropped zones; ``article`` and ``main`` are the article's; where a page has such
an element the rest is outside, else plain. Labelled pages are the layouts of
``html_layouts`` (marked by hand) and those of the table that name their article
(up to about ``SAMPLE`` of them, by a hash of the url), each side counting half.

Defined results: a null or empty html, or one without a positive run, gives an
empty text of 0 characters; character references are decoded once; white space
(as ``str.split`` takes it) becomes one space; a tag or comment that the page's
end cuts off is dropped, and so is an unclosed script or style; of equal sums the
run that ends first; rows with equal ids are read each; an empty table gives no
rows; further columns stay unread; a page is held whole, about 40 bytes a byte.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm.common import byte_chunks, table
from recoengine.llm.html_layouts import LAYOUTS, MARK

SAMPLE = 5_000
#: Bounds of a feature's log odds, and the least that a tag costs.
LARGEST = 4.0
TAG_COST = 0.02

# Fixed values of HTML: elements without content, with raw content, and those
# that don't break a line.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe noembed noframes xmp svg math template".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
                    "sub sup time tt u var wbr").split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption div section body".split())

#: Elements that are zones of their own.
ZONE_TAGS = {"nav": "menu", "menu": "menu", "header": "header", "footer": "footer", "aside": "sidebar", "form": "form", "button": "form",
             "select": "form", "label": "form", "fieldset": "form", "dialog": "notice", "object": "hidden", "canvas": "hidden",
             "audio": "hidden", "video": "hidden", "article": "article", "main": "article"}
#: Words of class, id and role that name a zone, whatever stands beside them.
STRONG = {"advert": "ad ads advert adverts advertisement advertising adslot sponsor sponsored promo promoted banner",
          "comments": "comment comments commentlist disqus respond replies",
          "notice": "cookie cookies consent gdpr popup modal alert notice newsletter subscribe paywall",
          "sidebar": "related recommended recommendations teaser teasers share sharing social widget widgets",
          "hidden": "hidden invisible"}
#: Words that name a zone unless a word of ``CONTENT`` stands beside them.
WEAK = {"menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar toc", "header": "header masthead topbar",
        "footer": "footer foot copyright legal colophon", "sidebar": "sidebar aside complementary rail",
        "form": "form login search signup"}
CONTENT = frozenset("article content post entry story main text page wrapper container has with".split())
ZONE_OF = {w: (z, strong) for words, strong in ((STRONG, True), (WEAK, False)) for z, line in words.items() for w in line.split()}
BODY_WORDS = frozenset("articlebody".split())
OPEN_ZONES = ("article", "outside", "plain")

TOKEN = re.compile(r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+)(>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.S)
NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDES = re.compile(r"""\shidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
PARTS = re.compile(r"[a-z]+")


def _zone(name: str, attributes: str, parent: str) -> str:
    """Zone of an element within that of its parent."""
    if name in ("html", "body"):
        return parent
    if parent not in OPEN_ZONES and not (parent == "form" and name in ("article", "main")):
        return parent
    found = ZONE_TAGS.get(name)
    if name == "header" and parent == "article":  # an article's own title
        found = None
    if attributes:
        if HIDES.search(attributes):
            return "hidden"
        for _, *value in NAMES.findall(attributes):
            for token in "".join(value).lower().split():
                parts = PARTS.findall(token)
                if token in BODY_WORDS:
                    found = "article"
                    continue
                for part in parts:
                    zone, strong = ZONE_OF.get(part, (None, False))
                    if zone and (strong or not CONTENT.intersection(parts)):
                        return zone
    return found or parent


class Page:
    """Tags and text runs of a page: for each its text (None for a tag), its
    number of words (0), its features, and whether a block ends before it."""

    def __init__(self, source: str, marked: str | None = None) -> None:
        self.texts: list[str | None] = []
        self.words: list[int] = []
        self.features: list[tuple[str, str, str]] = []
        self.breaks: list[bool] = []
        self.labels: list[bool] = []
        stack: list[tuple[str, str, bool, bool, str]] = []  # name, zone, in a link, marked, block
        held: Counter[str] = Counter()
        top = ("", "plain", False, False, "body")
        at, pending = 0, False

        def text(part: str) -> None:
            nonlocal pending
            part = html.unescape(part) if "&" in part else part
            n = len(part.split())
            self.texts.append(part)
            self.words.append(n)
            self.features.append((top[1], "link" if top[2] else "free", top[4]))
            self.breaks.append(pending)
            self.labels.append(top[3])
            pending = False

        while m := TOKEN.search(source, at):
            if m.start() > at:
                text(source[at:m.start()])
            at = m.end()
            name = m[2]
            if not name:
                continue
            name = name.lower()
            if not m[4]:  # cut off by the end
                break
            inline = name in INLINE
            pending = pending or not inline
            zone, attributes = top[1], m[3]
            if m[1]:
                if held[name]:
                    while True:
                        gone = stack.pop()
                        held[gone[0]] -= 1
                        if gone[0] == name:
                            break
                    top = stack[-1] if stack else ("", "plain", False, False, "body")
                zone = top[1] if top[1] not in OPEN_ZONES else zone
            elif name in RAW:
                if not attributes.endswith("/") or name not in ("svg", "math"):
                    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
                    at = close.end() if close else len(source)
            elif name not in VOID:
                zone = _zone(name, attributes, top[1])
                top = (name, zone, top[2] or name == "a", top[3] or bool(marked and marked in attributes),
                       name if name in BLOCKS else top[4])
                stack.append(top)
                held[name] += 1
            self.texts.append(None)
            self.words.append(0)
            self.features.append((zone, "tag", name if name in BLOCKS or name in ZONE_TAGS or name in ("a", "ul", "ol", "table", "br") else "other"))
            self.breaks.append(False)
            self.labels.append(top[3])
        else:
            if at < len(source):
                text(source[at:])
        if any(w and f[0] == "article" for w, f in zip(self.words, self.features)):
            self.features = [("outside", *f[1:]) if f[0] == "plain" else f for f in self.features]

    def counts(self, own_labels: bool) -> Counter:
        """((kind, value), of the article or not): words, and tags as one each."""
        out: Counter = Counter()
        for n, f, marked in zip(self.words, self.features, self.labels):
            is_tag = f[1] == "tag"
            inside = f[0] == "article" if own_labels else marked and f[0] in OPEN_ZONES
            for kind, value in (("all", ""), ("zone", f[0]), ("link" if not is_tag else "tag", f[1] if not is_tag else f[2]),
                                *([] if is_tag else [("block", f[2])])):
                out[("tags " if is_tag else "words ") + kind, value, inside] += 1 if is_tag else n
        return out


class Weights:
    """Log odds by feature from counts; each table of counts has the same say."""

    def __init__(self, *counts: Counter) -> None:
        share: Counter = Counter()
        for c in counts:
            for side in ("words", "tags"):
                total = sum(n for (kind, _, _), n in c.items() if kind == f"{side} all")
                for (kind, value, inside), n in c.items():
                    if kind.startswith(side) and total:
                        share[kind, value, inside] += n / total
        self.odds: dict[tuple[str, str], float] = {}
        for kind, value, _ in share:
            side = kind.split()[0]
            odds = math.log((share[kind, value, True] + 1e-3) / (share[kind, value, False] + 1e-3))
            prior = math.log((share[f"{side} all", "", True] + 1e-3) / (share[f"{side} all", "", False] + 1e-3))
            self.odds[kind, value] = odds if kind.endswith("all") else max(-LARGEST, min(LARGEST, odds - prior))
        self.known: dict[tuple[str, str, str], float] = {}

    def of(self, feature: tuple[str, str, str]) -> float:
        if feature not in self.known:
            zone, link, block = feature
            get = lambda kind, value: self.odds.get((kind, value), 0.0)
            if link == "tag":
                self.known[feature] = min(-TAG_COST, get("tags all", "") + get("tags zone", zone) + get("tags tag", block))
            else:
                self.known[feature] = (get("words all", "") + get("words zone", zone) + get("words link", link) + get("words block", block)
                                       if zone in OPEN_ZONES else -LARGEST)
        return self.known[feature]


def best_run(scores: list[float]) -> tuple[int, int]:
    """[start, end) with the highest positive sum; (0, 0) if there is none."""
    best, found, here, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if here <= 0:
            here, start = 0.0, i
        here += s
        if here > best:
            best, found = here, (start, i + 1)
    return found


def main_text(source: str | None, weights: Weights) -> str:
    page = Page(source or "")
    start, end = best_run([weights.of(f) * max(n, 1) if t is None or n else 0.0
                           for t, n, f in zip(page.texts, page.words, page.features)])
    parts: list[str] = []
    for i in range(start, end):
        if page.breaks[i]:
            parts.append(" ")
        if page.texts[i] is not None and page.features[i][0] in OPEN_ZONES:
            parts.append(page.texts[i])
    return " ".join("".join(parts).split())


def layout_counts() -> Counter:
    return sum((Page(p, MARK).counts(False) for p in LAYOUTS), Counter())


def page_counts(pages: DataFrame, sample: int = SAMPLE) -> Counter:
    """Counts of pages that name their article; a bounded number of rows, of
    features and not of pages, reaches the driver."""
    names_it = F.col("html").rlike(r"(?i)<(article|main)[\s>]")
    known = pages.where(names_it).select("url", "html")
    every = max(1, known.count() // sample)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for chunk in byte_chunks(batches, "html"):
            for source in chunk.column("html").to_pylist():
                total.update(Page(source).counts(True))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _, _ in keys], pa.string()), pa.array([v for _, v, _ in keys], pa.string()),
             pa.array([i for _, _, i in keys], pa.bool_()), pa.array([total[k] for k in keys], pa.int64())], ["kind", "value", "inside", "n"])

    some = known.where(F.pmod(F.xxhash64("url", "html"), F.lit(every)) == 0).select("html")
    sums = some.mapInArrow(kernel, "kind string, value string, inside boolean, n long").groupBy("kind", "value", "inside").agg(F.sum("n").alias("n"))
    return Counter({(r["kind"], r["value"], r["inside"]): r["n"] for r in sums.collect()})


def learnt(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    return Weights(layout_counts(), page_counts(pages, sample))


def extracted(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "html"):
            texts = [main_text(x, weights) for x in chunk.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([chunk.column("page_id"), chunk.column("url"), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return pages.select("page_id", "url", "html").mapInArrow(
        kernel, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extracted(pages, learnt(pages))
