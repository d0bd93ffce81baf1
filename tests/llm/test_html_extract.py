import html
import itertools
import math
import re
from collections import Counter

import pytest

from folioforge.llm import html_extract as hx
from folioforge.llm.store import Scratch


def text(page, noisy=()):
    return "\n".join(b.text for b in hx.choose(hx.blocks_of(page), set(noisy)))


CASES = [
    ("<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B</h1><p>One\n two<p><b>Three<br>four</article><footer>f</footer>", "A & B\nOne two\nThree four"),
    ("<body><div class='sidebar'><p>s</p></div><div id=content><p>x &lt; y &#233; &nbsp;z</p><div class=comments><p>c</p></div></div>", "x < y é z"),
    ("<body><main><h2>H</h2><ul><li>a<li>b</ul><form><p>f</p></form><script>var p='</p><p>no';</script><p>c<!-- <p>no</p> --></p></main>", "H\na\nb\nc"),
    ("<p>plain</p><p><a href=x>only link</a></p> tail", "plain\ntail"),
    ("<body><header><h1>Site</h1></header><div class='cookie-notice'>ok?</div><article class='post'><header><h1>Title</h1></header><div class=share>s</div><p>t <b>bold</b>er</p><table><tr><td>1<td>2</table></article>", "Title\nt bolder\n1\n2"),
    ("<article><p>cut off here <b", "cut off here"),
    ("<article><p>a<script>b()</script>b</p><p hidden>h</p><p style='display: none'>i</p></article>", "ab"),
    ("<article><p>A</p><p>long enough text</p></article><article class=comment><p>" + "c " * 50 + "</p></article>", "A\nlong enough text"),
    ("a < b and c > d", "a < b and c > d"),
    ("<body><div class=text><p>one</p></div><div class=promo><p>buy</p></div><div class=text><p>two is longer</p></div><section class=content><p>three</p></section>", "one\ntwo is longer\nthree"),
    ("<article><p>a</p></article><aside><p>x</p></aside><article><p>bb</p></article>", "a\nbb"),
    ("<main><h1>H</h1><article><p>a</p></article><p>after</p></main><footer>f</footer>", "H\na\nafter"),
    (None, ""),
    ("", ""),
    ("<nav>only menu</nav>", ""),
    ("<div class='Ad'>x</div><DIV><P>UP</P></DIV>", "UP"),
]


@pytest.mark.parametrize("page,want", CASES)
def test_pages(page, want):
    assert text(page) == want


def brute(page):
    """The generator's pages have one article of headings and paragraphs."""
    m = re.search(r"<article>(.*?)(</article>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)[^>]*>", m[1]) if m else []
    return "\n".join(t for t in (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks) if t)


def test_whole_small_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in hx.extract(spark, pages).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == brute(r.html), r.page_id
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url


def test_style_tree_removes_repeated_branches_without_telling_names(spark):
    rows = [(i, f"http://h.org/{i}", f"<body><div class=x1><p>Same words everywhere {i % 2}</p></div><div class=x2><p>Page {i} says {i * 7}</p></div></body>") for i in range(40)]
    rows += [(100 + i, f"http://few.org/{i}", "<body><div class=x1><p>Same</p></div></body>") for i in range(3)]
    got = {r.page_id: r.text for r in hx.extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Page {i} says {i * 7}" for i in range(40)) and got[101] == "Same"


def plain_importance(pages):
    """Importance of each branch of one host by loops over its distinct pages."""
    merged = {}
    for blocks in {"\n".join(b.text for b in x): x for x in map(hx.blocks_of, pages)}.values():
        for branch in {k for b in blocks for k in hx.branches(b.key)}:
            mine = [b for b in blocks if branch in hx.branches(b.key)]
            shape = [k for k, _ in itertools.groupby(b.key[len(branch) :] for b in mine)]
            merged.setdefault(branch, []).append((tuple(shape), {b.text for b in mine}))
    out = {}
    for branch, seen in merged.items():
        m, shapes, texts = len(seen), Counter(s for s, _ in seen), Counter(t for _, x in seen for t in x)
        if m == 1:
            out[branch] = 1.0
            continue
        shape = -sum(n / m * math.log(n / m, m) for n in shapes.values())
        text = 1 - sum(math.log(n, m) for n in texts.values()) / len(texts)
        out[branch] = (1 - hx.GAMMA ** len(shapes)) * shape + hx.GAMMA ** len(shapes) * text
    return out


def test_importance_matches_loops(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").where("url like '%blog%'").collect()]
    pages += pages[:3] + [f"<div class=a><p>{i % 3}<p>{i % 4}<h2>{i}</h2></div><div class=b>x</div>" * (1 + i % 2) for i in range(12)]
    df = spark.createDataFrame([("h", p) for p in pages], "host string, html string")
    got = {r.branch: r.importance for r in hx.importance(spark, df, Scratch(spark, "t")).collect()}
    want = plain_importance(pages)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def site(pages):
    return [(i, f"http://h.org/{i}", p) for i, p in enumerate(pages)]


def test_tree_decides_where_nothing_else_tells(spark, monkeypatch):
    head = "<table class=q1><tr><td>All goods are shipped within a week of the order and may be sent back</td></tr></table>"
    pages = [f"<body>{head}<div class=q2><p>Story {i} begins</p><p>and goes on {i * 7} times</p></div><div class=q3><b>House rule {i % 2}</b></div></body>" for i in range(40)]
    df = spark.createDataFrame(site(pages) + [(100 + i, f"http://few.org/{i}", pages[i]) for i in range(3)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in hx.extract(spark, df).collect()}
    assert all(got[i] == f"Story {i} begins\nand goes on {i * 7} times" for i in range(40))
    assert got[101].startswith("All goods") and got[101].endswith("House rule 1")  # too few pages
    monkeypatch.setattr(hx, "LEAST", 0.0)
    without = {r.page_id: r.text for r in hx.extract(spark, df).collect()}
    assert all(without[i] != got[i] for i in range(40))


def test_copies_of_an_article_stay(spark):
    page = "<body><nav><a href=x>menu {0}</a></nav><article><p>Copied text</p></article><footer>{0}</footer></body>"
    copies = [page.format(i) for i in range(60)]
    others = [p.replace("Copied text", f"Own text {i}</p><p>Second {i}") for i, p in enumerate(copies[:50])]
    got = lambda pages: [r.text for r in hx.extract(spark, spark.createDataFrame(site(pages), "page_id long, url string, html string")).orderBy("page_id").collect()]
    assert set(got(copies)) == {"Copied text"}
    assert got(copies + others) == ["Copied text"] * 60 + [f"Own text {i}\nSecond {i}" for i in range(50)]


def test_repeated_region_beside_the_article_goes(spark):
    pages = [f"<body><div class=text><p>Page {i} says {i * 7}</p></div><div class=content><p>Same {i % 2}</p></div><div class=text><p>and {i}</p></div></body>" for i in range(40)]
    got = {r.page_id: r.text for r in hx.extract(spark, spark.createDataFrame(site(pages), "page_id long, url string, html string")).collect()}
    assert all(got[i] == f"Page {i} says {i * 7}\nand {i}" for i in range(40))


def test_edge_cases(spark):
    long = "<article>" + "<p>w</p>" * 20_000 + "<div>" * 3000 + "deep"
    df = spark.createDataFrame([(1, None, None, "a"), (2, "u", "", "b"), (2, "u", "", "b"), (3, "http://x/", long, "c")], "page_id long, url string, html string, host string")
    got = {r.page_id: r for r in hx.extract(spark, df).collect()}
    assert got[1].text == got[2].text == "" and got[3].text == "\n".join(["w"] * 20_000 + ["deep"])
    assert hx.extract(spark, df).columns == ["page_id", "url", "text", "n_chars"] and hx.extract(spark, df.limit(0)).collect() == []
