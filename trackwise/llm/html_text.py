"""Main text of web pages by tag-path ratios.

A page is read tag by tag into blocks of text, each with its path of open block
elements from the root (an element with its first class). Elements that are never
article text (scripts, styles, navigation, footers, asides, forms, hidden parts, and
containers whose class, role or, outside a marked article, id names an advert, notice,
sidebar, menu or comments) are left out. Over the rest, text length, punctuation and link
text are summed per path; a path's ratio is its text per block, fused with its punctuation
per block and lowered by its share of link text. The ratio is smoothed with that of the
element that the path stands in (taken over all text in it), so a heading or a short
paragraph follows its article, unless the path is mostly links (or a container right in the
body with text of its own). The path of the greatest ratio times its share of the page's text is
the best one, where the page marks an article (article, main, role=main) with the paths in it
raised by ARTICLE_WEIGHT. Content is what stands in the element of the best path, links too
(where that is the body: what is not mostly links), or in the marked article around it; else
what is not mostly links and stands right in an element around that one; and every path
whose ratio reaches THRESHOLD of the best one's (ARTICLE_WEIGHT times that beside a marked article). All
blocks of these paths are kept whole. A marked article decides nothing by itself: where the
text stands outside of it, the ratios choose that.

Character references are decoded; white space inside a block becomes one space;
blocks are trimmed and joined in page order by a line feed. <br> is white space.
A null or empty page has the text ''. Unclosed and stray tags are tolerated (a
new paragraph closes the last one; an end tag without its element is skipped).
Repeated rows give repeated results; null keys and urls are kept; an empty table gives
an empty result; columns beside key, url and html are ignored. Long pages are read
whole, one at a time; equal ratios are decided by the first path of the page.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

THRESHOLD = 0.2
ARTICLE_WEIGHT = 8

# HTML element names by kind.
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes svg annotation annotation-xml".split())
#: of these, what goes on to the end of the page without an end tag; the start tag of any other is then skipped alone
ENDLESS = frozenset("script style textarea title xmp".split())
#: of these, what may stand in itself, and what '/>' ends
NESTED, CLOSED = frozenset(("svg", "template")), frozenset(("svg", "annotation", "annotation-xml"))
DROPPED = frozenset("head nav footer aside form button select menu dialog object audio video canvas map".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label mark
    q rb rp rt ruby s samp small span strike strong sub sup time tt u var wbr br source track picture
    math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup
    munder mover munderover mmultiscripts mprescripts mtable mtr mtd none""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACED = frozenset(("br", "img", "hr"))
#: an opening element closes the last of these, unless one of its HOLDERS is nearer
CLOSES = {**dict.fromkeys(("dd", "dt"), frozenset(("dd", "dt"))), **dict.fromkeys(("td", "th"), frozenset(("td", "th"))),
          "li": frozenset(("li",)), "tr": frozenset(("tr",)), "option": frozenset(("option",))}
HOLDERS = {**dict.fromkeys(("dd", "dt"), frozenset(("dl",))), **dict.fromkeys(("td", "th"), frozenset(("tr", "table"))),
           "li": frozenset(("ul", "ol", "menu")), "tr": frozenset(("table", "tbody", "thead", "tfoot")),
           "option": frozenset(("select",))}
PAGE = frozenset("html body main article".split())
# Parts of class names, ids and roles of what is not article text.
NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adbox adslot sponsor sponsored promo promotion
    banner sidebar comment comments commentlist disqus respond reply replies reviews discussion cookie cookies consent
    gdpr notice notices alert announcement disclaimer popup modal overlay newsletter subscribe subscription signup social share sharing related recommended
    recommendations breadcrumb breadcrumbs pagination pager menu nav navbar navigation navigate footer masthead toolbar
    widget login search contentinfo complementary dialog""".split())
# With what else a name may stand in one class ("site-footer", "ad-box-2"); a class with any
# other word ("social-impact", "related-work") says something else.
BESIDE = frozenset("""site page post entry global main top bottom left right center inner outer box block area section
    wrap wrapper container content holder list item items link links bar panel row col column group module unit zone slot
    head header title body primary secondary mobile desktop fixed sticky large small big news web text img image icon
    google fb facebook twitter user reader new recent popular my your""".split())
#: elements that names are looked up for
CONTAINERS = frozenset("div section ul ol dl table article header center fieldset details figure td th".split())
# A class that begins so tells the state of an element ("with-sidebar");
# a header so named is the article's own.
STATES = frozenset("has with without no is show hide js".split())
OWN = frozenset("article entry post story content".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|(?<![\w=-])(hidden)(?![\w=-])""")
PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")
SPACE = re.compile(r"\s+")


def _named(token: str, in_article: bool) -> bool:
    """Whether a class, id or role names what is not article text."""
    parts = [x for x in re.split(r"[^a-z0-9]+", token) if x and not x.isdigit()]
    if not parts or parts[0] in STATES:
        return False
    if "header" in parts and not in_article and OWN.isdisjoint(parts) and all(x in NAMES or x in BESIDE for x in parts):
        return True
    return not NAMES.isdisjoint(parts) and all(x in NAMES or x in BESIDE for x in parts)


def _marked(tag: str, attributes: str, in_article: bool) -> tuple[bool, bool, str]:
    """(not article text, marks the article, first class) by the attributes."""
    off, main, first = False, False, ""
    for name, a, b, c, hidden in ATTRIBUTE.findall(attributes):
        value = (a or b or c).lower()
        name = name.lower()
        if hidden or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            off = True
        elif name == "role" and value == "main":
            main = True
        elif name in ("class", "id", "role") and tag in CONTAINERS:
            tokens = value.split()
            if name == "class" and tokens:
                first = tokens[0]
            # an article's own classes describe it; an id inside it, or of a cell, says what the part is about
            if (name != "id" or not in_article and tag not in ("td", "th")) and (tag != "article" or name == "class" and in_article):
                off |= any(_named(t, in_article) for t in tokens)
    return off, main, first


def _ends(page: str, tag: str) -> dict[int, int]:
    """Where each RAW element of a kind is over, by the place of its start tag; without those that have no end tag."""
    ends, opened = {}, []
    for m in re.compile(rf"""<!--.*?(?:-->|\Z)|<script\b.*?(?:</script\s*>|\Z)|<(/?){re.escape(tag)}(?:[\s/](?:[^>"']|"[^"]*"|'[^']*')*)?>""",
                        re.I | re.S).finditer(page):
        if m.group(1) == "":
            if not (tag in CLOSED and m.group().endswith("/>")):
                opened.append(m.start())
        elif m.group(1) and opened:
            ends[opened.pop()] = m.end()
            if tag not in NESTED:
                opened.clear()
    return ends


def blocks_of(page: str) -> list[tuple[tuple, str, int, bool, tuple]]:
    """(path, text, characters of link text, inside the marked article, numbers of the elements
    on the path) of the page's blocks."""
    blocks: list = []
    stack: list[tuple[str, bool, bool, str, int]] = []    # (element, left out, in the article, element and class, number)
    opened = 0
    parts: list[str] = []
    links, in_link = 0, 0
    ends: dict[str, dict[int, int]] = {}

    def flush() -> None:
        nonlocal parts, links
        if parts:
            text = SPACE.sub(" ", "".join(parts)).strip()
            if text:
                blocks.append((tuple(e[3] for e in stack), text, min(links, len(text)), bool(stack) and stack[-1][2],
                               tuple(e[4] for e in stack)))
            parts, links = [], 0

    def add(text: str) -> None:
        nonlocal links
        if text and not (stack and stack[-1][1]):
            text = entities.unescape(text)
            parts.append(text)
            if in_link:
                links += len(text)

    at = 0
    while True:
        m = TAG.search(page, at)
        if not m:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            continue
        if m.group(1):
            if tag in INLINE:
                in_link = 0 if tag == "a" else in_link
                if tag in SPACED:
                    add(" ")
                continue
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            flush()
            if depth is not None:
                del stack[depth:]
            continue
        if tag in RAW:
            if tag in CLOSED and m.group().endswith("/>"):
                continue
            if tag in ENDLESS:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            else:
                if tag not in ends:
                    ends[tag] = _ends(page, tag)
                at = ends[tag].get(m.start(), at)
            continue
        if tag in INLINE:
            in_link = 1 if tag == "a" else in_link
            if tag in SPACED:
                add(" ")
            continue
        flush()
        in_link = 0
        if tag in VOID:
            continue
        if stack and stack[-1][0] == "p":
            stack.pop()
        if tag in CLOSES:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in HOLDERS[tag]:
                    break
                if stack[i][0] in CLOSES[tag]:
                    del stack[i:]
                    break
        off, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        marked, main, named = _marked(tag, m.group(3), article)
        header = tag == "header" and not article
        opened += 1
        stack.append((tag, off or marked or tag in DROPPED or header, article or main or tag in ("article", "main"),
                      f"{tag}.{named}" if named else tag, opened))
    flush()
    return blocks


def ratio(n: int, chars: int, marks: int, links: int) -> float:
    """Text per block, fused with punctuation per block and lowered by the share of link text."""
    return chars / n * (1 + marks / n) * (1 - 0.9 * links / chars)


def path_ratios(blocks: list) -> tuple[dict[tuple, float], dict[tuple, list[int]], set[tuple]]:
    """(smoothed ratio, sums: blocks, characters, marks, link characters) of every path,
    and the paths in a marked article."""
    paths: dict[tuple, list[int]] = {}
    elements: dict[tuple, list[int]] = {}
    marked: dict[tuple, int] = {}
    for path, text, links, in_article, _ in blocks:
        sums = (1, len(text), len(PUNCTUATION.findall(text)), links)
        for table, k in ((paths, path), *((elements, path[:i]) for i in range(len(path)))):
            s = table.setdefault(k, [0, 0, 0, 0])
            for i, v in enumerate(sums):
                s[i] += v
        marked[path] = marked.get(path, 0) + (len(text) if in_article else -len(text))
    inside = {p for p, v in marked.items() if v > 0}
    smooth = {}
    for p, s in paths.items():
        own = ratio(*s)
        if p and s[3] <= 0.5 * s[1] and not _loose(p):
            own = (own + ratio(*elements[p[:-1]])) / 2
        smooth[p] = own
    return smooth, paths, inside


def _loose(path: tuple) -> bool:
    """A container with text of its own right in the page: no part of what stands around it."""
    return path[-1].split(".")[0] in ("div", "section") and all(e.split(".")[0] in ("html", "body") for e in path[:-1])


def main_text(page: str | None) -> str:
    blocks = blocks_of(page or "")
    if not blocks:
        return ""
    smooth, paths, inside = path_ratios(blocks)
    weight = lambda p: ARTICLE_WEIGHT if p in inside else 1
    best = max(smooth, key=lambda p: smooth[p] * weight(p) * paths[p][1])
    holder, whole = best[:-1], best in inside
    page_wide = all(e.split(".")[0] in ("html", "body") for e in holder)
    chosen = {ids[-2] for path, _, _, _, ids in blocks if path == best and len(ids) > 1}

    def content(path: tuple, in_article: bool, ids: tuple) -> bool:
        if whole and in_article or smooth[path] >= THRESHOLD * smooth[best] * (weight(best) if path not in inside else 1):
            return True
        if not page_wide and not chosen.isdisjoint(ids):
            return True
        links = paths[path][3] > 0.5 * paths[path][1]
        return not whole and not links and not _loose(path) and path[:-1] == holder[:len(path) - 1] or (
            page_wide and not links and not _loose(path))

    return "\n".join(text for path, text, _, in_article, ids in blocks if content(path, in_article, ids))


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text) of every row."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))

    def run(batches):
        for batch in batches:
            texts = [main_text(batch.column("html")[i].as_py()) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(texts, pa.string())],
                                             ["key", "url", "text"])

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, f"key {types['key']}, url {types['url']}, text string"
                           ).withColumnsRenamed({"key": key, "url": url})


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn("n_chars", F.length("text").cast("long"))
