import random
import re
from html.parser import HTMLParser

import pytest

from trackwise.llm.html_text import blocks_of, main_text, op6_html_extraction, path_ratios

CASES = {
    "<article><h1>T &amp; U</h1><p>One\n  two<br>three</p><footer>no</footer></article><p>out</p>": "T & U\nOne two three",
    "<nav><a href=x>menu</a></nav><article><p><b>Bold.<p>next &am</p></article>": "Bold.\nnext &am",
    "<body><div class=ad>buy</div><div id=main><p>Some text, here.<p>More.</div><div class='comments'><p>hi, all.</p></div>": "Some text, here.\nMore.",
    "<script>var a='<p>x</p>'</script><style>p{}</style><p>a &lt; b &#233; &copy 1 < 2</p><!-- <p>c</p> -->": "a < b é © 1 < 2",
    "<p>cut <": "cut <", "": "", "plain": "plain", "<p></p>": "", "<p hidden>x</p><p>y</p>": "y",
    "<div class='page with-sidebar'><div class='entry-header'><h1>T</h1></div><p>Text, with marks.</p><div class='site-header'>S</div></div>": "T\nText, with marks.",
    "<table><tr><td class=menu><p>Home<td class=text><p>Some text, here.<ul><li>a<ul><li>b</ul><li>c</ul></table>": "Some text, here.\na\nb\nc",
    "<article><p>x</p><form><p>mail</p></form><aside>s</aside><ul><li>a<li>b</ul></article>": "x\na\nb",
    "<header>Site</header><main><p>x y.</p></main><div id=cookie-banner>ok</div>": "x y.",
    "<body><ul><li><a href=1>one</a><li><a href=2>two</a></ul><div><p>A sentence, with commas, that is long enough.</p></div>": "A sentence, with commas, that is long enough.",
}


@pytest.mark.parametrize("page", CASES)
def test_pages(page):
    assert main_text(page) == CASES[page]


def test_long_page_is_whole():
    paras = [f"Paragraph {i}, with &lt;some&gt; text." for i in range(20_000)]
    page = "<div class=nav>n</div><article>" + "".join(f"<p>{p}" for p in paras)
    assert main_text(page) == "\n".join(p.replace("&lt;", "<").replace("&gt;", ">") for p in paras)


LONG = "A sentence, with commas, that is long; " * 5 + "end."


@pytest.mark.parametrize("start", ["", "<body>", "<html><head><title>t</title></head><body>"])
def test_blocks_right_in_the_body_are_kept(start):
    links = "<div><a href=1>one</a> <a href=2>two</a></div>"
    page = f"{start}{links}<h1>Title</h1><p>{LONG}</p><h2>Sub</h2><ul><li>short</li></ul><table><tr><td>cell</table><blockquote>said</blockquote>"
    assert main_text(page).split("\n") == ["Title", LONG, "Sub", "short", "cell", "said"]
    assert main_text(f"{start}{links}<h1>Title</h1><div><p>{LONG}</p><ul><li>short</li></ul></div>").split("\n") == ["Title", LONG, "short"]


RAW = {
    "<p>a<svg viewBox='0 0'/> b</p><p>c</p>": "a b\nc",
    "<article><p>a <math><mi>x</mi><mo>=</mo><mn>2</mn></math> b</p><math/><p>c</p></article>": "a x=2 b\nc",
    "<article><p>a</p><noscript><p>b</p><p>c</p></article>": "a\nb\nc",
    "<article><noscript><p>a</p><noscript>no</noscript><p>b</p><template><p>c</p></article>": "a\nb\nc",
    "<p>a<svg><g/><svg><text>no</text></svg><!-- <svg> --><text>no</text></svg> b</p>": "a b",
    "<p>a</p><template><template>no</template>no<script>'</template>'</script></template><p>b</p>": "a\nb",
    "<p>a</p><script>s = '<svg>'; <p>no</p>": "a",
    "<p>a <math><semantics><mi>x</mi><annotation encoding='TeX'>no</annotation></semantics></math></p>": "a x",
}


@pytest.mark.parametrize("page", RAW)
def test_elements_without_an_end_tag_and_formulas(page):
    assert main_text(page) == RAW[page]


P1 = "The first paragraph tells, in some words, what the page is about; it has marks."
P2 = "A second one goes on, with commas, and with a number of further words to read."
ART = f"<p>{P1}</p><p>{P2}</p>"
#: pages whose text the names and elements alone don't tell, with the text expected
RATIOS = {
    # without a marked article: short parts without names around the text
    f"<body><div><div>Example Inc</div></div><div class=x>{ART}</div></body>": [P1, P2],
    f"<body><div class=top><span>Welcome back</span></div><div class=x>{ART}</div><div class=low><p>All rights kept</p></div>": [P1, P2],
    f"<div class=a><ul><li><a href=1>One story</a><li><a href=2>Another story</a></ul></div><div class=b><h1>Title</h1>{ART}</div>": ["Title", P1, P2],
    f"<div class=b><div class=c>{ART}</div></div><div class=d><div class=e>Hits today</div></div>": [P1, P2],
    f"<table><tr><td class=l><p>Go</p></td><td class=r>{ART}</td></tr></table>": [P1, P2],
    f"<div class=b><h2>Head</h2>{ART}<ol><li>point</li></ol></div><div class=z><div>v 1</div></div>": ["Head", P1, P2, "point"],
    f"<div class=b><section>{ART}</section><h3>More</h3></div>": [P1, P2, "More"],
    f"<div class=t><a href=1>a link to read</a></div><div class=b><blockquote>{P1}</blockquote>{ART}</div>": [P1, P1, P2],
    # a marked article: what stands beside it is far below
    f"<body><div class=pre>Short line</div><article>{ART}</article><div class=post>Another line</div>": [P1, P2],
    f"<body><main><h1>T</h1>{ART}</main><p>out</p>": ["T", P1, P2],
    f"<div role=main><div>{ART}</div><div><p>kept too</p></div></div><div class=z>z</div>": [P1, P2, "kept too"],
    f"<article>{ART}<ul><li><a href=1>Ref one</a><li><a href=2>Ref two</a></ul></article>": [P1, P2, "Ref one", "Ref two"],
    f"<article><h1><a href=1>Linked title</a></h1>{ART}</article>": ["Linked title", P1, P2],
    f"<article><section><h2>A</h2>{ART}</section><section><h2>B</h2><p>short</p></section></article>": ["A", P1, P2, "B", "short"],
    # the marked article is a teaser: the text stands elsewhere
    f"<body><div class=text>{ART}{ART}</div><article><h3>Teaser</h3><p>Other story.</p></article>": [P1, P2, P1, P2],
    f"<body><div class=text><h1>T</h1>{ART}{ART}</div><div class=list><article><p>One.</p></article><article><p>Two.</p></article></div>": ["T", P1, P2, P1, P2],
    # names of headings, paragraphs, items and cells, and of what sections are about
    f"<article><h2 id=related-work>Related work</h2>{ART}<h2 id=search>Search</h2><p id=notice-1>Notice this.</p></article>": ["Related work", P1, P2, "Search", "Notice this."],
    f"<article><section class=social-impact>{ART}</section><section id=comments-on-law><p>x</p></section></article>": [P1, P2, "x"],
    f"<div class=b><h1 id=menu>T</h1>{ART}<ul><li id=ad>item</li></ul></div>": ["T", P1, P2, "item"],
    f"<article><div class=related-work><p>{P2}</p></div><p class=comment>{P1}</p></article>": [P2, P1],
    # what the names do tell
    f"<article>{ART}<div class=ad>buy</div><ul class='share-links'><li>f</ul></article>": [P1, P2],
    f"<article>{ART}<section class='post-comments'><p>{P1}</p></section></article>": [P1, P2],
    f"<body><div id=sidebar-left><p>{P1}</p></div><div class=c>{ART}</div><div class='site-footer'><p>{P2}</p></div>": [P1, P2],
    f"<body><div class='cookie-notice box'><p>{P1}</p></div><article>{ART}</article><div class=newsletter-box>{P2}</div>": [P1, P2],
    f"<body><div role=navigation><p>{P1}</p></div><div class=c>{ART}</div><div class=ad-slot-2>{P2}</div>": [P1, P2],
    f"<div class=no-sidebar>{ART}</div>": [P1, P2],
    f"<header class=site-header><p>{P1}</p></header><div class=article-header><h1>T</h1></div><div class=c>{ART}</div>": [P1, P2],
    f"<body>{ART}<h2>Sub</h2><div><a href=1>one</a> <a href=2>two</a></div></body>": [P1, P2, "Sub"],
    f"<body><center><p>{P1}</p></center></body>": [P1],
    "<body><p>tiny</p></body>": ["tiny"],
    "<body><a href=1>only</a></body>": ["only"],
    f"<body><div><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></div><div>{ART}<ul><li><a href=3>Source</a></ul></div></body>": [P1, P2, "Source"],
}


@pytest.mark.parametrize("page", RATIOS)
def test_ratios_choose_the_text(page):
    assert main_text(page).split("\n") == RATIOS[page]


def test_the_ratio_step_decides_pages():
    """Without the ratios, what is not left out by name would stay: the pages above tell the difference."""
    every = {page: [block[1] for block in blocks_of(page)] for page in RATIOS}
    assert sum(every[page] != RATIOS[page] for page in RATIOS) >= 10


class Dom(HTMLParser):
    """A plain list of (path, text) of well-formed pages, read with the standard parser."""

    def __init__(self, page):
        super().__init__()
        self.path, self.found = [], []
        self.feed(page)

    def handle_starttag(self, tag, attrs):
        if tag not in ("b", "a"):
            named = dict(attrs).get("class", "").split()
            self.path.append(f"{tag}.{named[0]}" if named and tag == "div" else tag)

    def handle_endtag(self, tag):
        if tag not in ("b", "a"):
            self.path.pop()

    def handle_data(self, data):
        if data.strip():
            self.found.append((tuple(self.path), data.strip()))


def test_ratios_against_a_plain_dom_list():
    rng = random.Random(6)
    for _ in range(60):
        page = "".join(f"<div class={c}>" + "".join(f"<{t}>{' '.join(rng.choices(['word', 'more,', 'end.', 'x'], k=rng.randint(1, 30)))}</{t}>"
                       for t in rng.choices(["p", "h2", "blockquote"], k=rng.randint(1, 6))) + "</div>" for c in rng.choices("uvw", k=4))
        dom = Dom(page).found
        blocks = blocks_of(page)
        assert [(p, t) for p, t, *_ in blocks] == dom
        smooth, _, _ = path_ratios(blocks)
        mean = lambda texts: sum(map(len, texts)) / len(texts) * (1 + sum(len(re.findall("[.,]", t)) for t in texts) / len(texts))
        for path in {p for p, _ in dom}:
            own = mean([t for p, t in dom if p == path])
            element = mean([t for p, t in dom if p[:len(path) - 1] == path[:-1] and len(p) >= len(path)])
            assert smooth[path] == pytest.approx((own + element) / 2)


def test_query_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = op6_html_extraction(spark, sf).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    assert len(rows) == len(pages) and rows[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    for r in rows:
        assert r["text"] == main_text(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"]) and r["url"] == pages[r["page_id"]]["url"]
