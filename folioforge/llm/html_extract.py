"""Main text of web pages: merged site style trees and the entropy of their branches."""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import Scratch
from .url_filter import host_of
from .words import small

#: A branch is noise on a host if its importance is below LEAST; branches on fewer distinct pages than PAGES say
#: nothing (so texts that each stand on two pages are never noise). An element's presentation weighs 1 - GAMMA**l against its content, l being the number of its presentations.
LEAST, PAGES, GAMMA = 0.6, 8, 0.9
#: The hosts' noisy branches are broadcast only up to this many.
BROADCAST_ROWS = 200_000

# Fixed values of HTML: elements without content, with raw content, never shown, and starting a block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp plaintext".split())
HIDDEN = frozenset("script style template noscript head title iframe svg math canvas audio video object embed map datalist".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CHROME = frozenset("nav aside footer form button select option menu dialog fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog form menu menubar toolbar".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of class and id names that mark what is not the article.
CHROME_WORDS = frozenset(
    "nav navbar navigation menu menus submenu header masthead topbar footer foot sidebar side aside ad ads adv advert adverts advertisement advertising adsense adbox banner promo promotion "
    "sponsor sponsored cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
    "recommendations comment comments commentlist disqus reply replies respond discussion breadcrumb breadcrumbs pagination pager widget widgets search toolbar skip copyright legal disclaimer "
    "tags taglist form hidden print".split()
)
MAIN_WORDS = frozenset("article content main post entry story body text maintext articlebody".split())
#: An element whose start ends an open one of the same kind.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
PARTS = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Names of branches keep short numbers; longer ones number pages, not kinds of branches.
BRANCH_NAMES = re.compile(r"[A-Za-z]+(?:\d{1,2}(?!\d))?")


@dataclass(slots=True)
class Element:
    tag: str
    key: str
    noise: bool
    main: int  # 0: none, 1: by name, 2: main, 3: article
    link: bool


@dataclass(slots=True)
class Block:
    key: str
    noise: bool
    main: int
    heading: bool
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def names_of(attributes: str) -> tuple[set[str], dict[str, str]]:
    a = {k.lower(): v[1:-1] if v[:1] in "\"'" else v for k, v in ATTRIBUTE.findall(attributes)}
    words = {w.lower() for k in ("class", "id") if k in a for w in NAME_WORDS.findall(entities.unescape(a[k]))}
    return words, a


def blocks_of(page: str | None) -> list[Block]:
    """The page's text blocks in order, each with the branch of the style tree that it hangs on."""
    root = Element("", "", False, 0, False)
    stack, out, current = [root], [], None
    page = page or ""

    def close() -> None:
        nonlocal current
        if current is not None:
            current.text = " ".join(entities.unescape("".join(current.parts)).split())
            if current.text:
                out.append(current)
            current = None

    def add(raw: str) -> None:
        nonlocal current
        top = stack[-1]
        if current is None:
            if not raw.strip():
                return
            at = next(e for e in reversed(stack) if e.tag not in INLINE)
            current = Block(at.key, top.noise, at.main, any(e.tag in HEADINGS for e in stack[-4:]))
        elif top.noise and not current.noise:
            return
        current.parts.append(raw)
        if top.link:
            current.linked += len(raw.strip())

    def end(k: int) -> None:
        while len(stack) > k:
            gone = stack.pop()
            if gone.tag not in INLINE:
                close()

    at = 0
    while at < len(page):
        m = PARTS.search(page, at)
        if m is None:
            add(page[at:])
            break
        if m.start() > at:
            add(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            k = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
            if k and not (tag in INLINE and any(e.tag not in INLINE for e in stack[k + 1 :])):
                end(k)
            elif tag == "p":
                close()
            continue
        if tag == "br":
            if current is not None:
                current.parts.append(" ")
            continue
        if tag in VOID:
            if tag not in INLINE:
                close()
            continue
        block = tag not in INLINE and tag not in RAW
        if block:
            p = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p" or stack[i].tag not in INLINE), 0)
            if p and stack[p].tag == "p":
                end(p)
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in CLOSES.get(tag, ()):
                    end(i)
                    break
                if stack[i].tag not in INLINE and stack[i].tag not in ("p", "tr"):
                    break
            while stack[-1].tag in INLINE:  # an unclosed inline element ends with its block
                stack.pop()
            close()
        words, attr = names_of(m[3]) if m[3].strip() else (set(), {})
        top = stack[-1]
        style = attr.get("style", "").replace(" ", "").lower()
        role = attr.get("role", "").lower()
        hidden = tag in HIDDEN or re.search(r"(^|\s)hidden(\s|$|=)", m[3]) is not None or "display:none" in style or "visibility:hidden" in style or attr.get("aria-hidden") == "true"
        kind = 3 if tag == "article" or attr.get("itemprop", "").lower() == "articlebody" else 2 if tag == "main" or role == "main" else 1 if tag in ("div", "section", "td") and words & MAIN_WORDS else 0
        chrome = tag in CHROME or role in CHROME_ROLES or (tag not in ("html", "body") and bool(words & CHROME_WORDS) and kind < 2) or (tag == "header" and top.main < 2)
        if tag == "article" and words & (CHROME_WORDS - {"header", "side", "text"}):
            chrome = True
        main = max(top.main, kind) if not chrome else top.main
        key = top.key if not block else f"{top.key}/{tag}" + "".join(f".{w}" for k in ("class", "id") for w in sorted(set(BRANCH_NAMES.findall(attr.get(k, "")))))
        noise = top.noise or hidden or chrome
        if tag in RAW:
            done = re.compile(rf"</{tag}\s*>|\Z", re.I).search(page, at)
            if not (hidden or noise) and tag in ("xmp", "plaintext"):
                add(page[at : done.start()])
            at = done.end()
            continue
        stack.append(Element(tag, key, noise, main, top.link or tag == "a"))
    end(1)
    close()
    return out


def branches(key: str) -> Iterator[str]:
    """The branches that a block hangs on, from below the body to its own."""
    parts = key.split("/")
    for k in range(2, len(parts) + 1):
        if parts[k - 1] not in ("html", "body"):
            yield "/".join(parts[:k])


def choose(blocks: list[Block], noisy: frozenset[str] | set[str]) -> list[Block]:
    """The article's blocks: first without the host's noisy branches, then without what names mark as other text.

    Where a region is marked as the article's only such regions stay; without any, all text but links stays. A page
    of which so nothing is left (its host has nothing but copies of it) is judged by names alone.
    """

    def by_names(left: list[Block]) -> list[Block]:
        left = [b for b in left if not b.noise]
        if any(b.main for b in left):
            return [b for b in left if b.main]
        return [b for b in left if b.linked < 0.8 * max(1, len(b.text)) or b.heading]

    if noisy:
        known: dict[str, bool] = {}
        for b in blocks:
            if b.key not in known:
                known[b.key] = any(k in noisy for k in branches(b.key))
        left = by_names([b for b in blocks if not known[b.key]])
        if left:
            return left
    return by_names(blocks)


def digest(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def page_nodes(blocks: list[Block]) -> tuple[list[str], list[bool], list[int]]:
    """Rows of the page's style tree: each branch with its presentation (the run of what hangs on it), and with each content."""
    shapes: dict[str, list[str]] = {}
    contents: dict[str, set[int]] = {}
    for x in blocks:
        content = digest(x.text)
        for k in branches(x.key):
            below = x.key[len(k) :]
            runs = shapes.setdefault(k, [])
            if not runs or runs[-1] != below:
                runs.append(below)
            contents.setdefault(k, set()).add(content)
    key, style, node = [], [], []
    for k, runs in shapes.items():
        key += [k] * (1 + len(contents[k]))
        style += [True] + [False] * len(contents[k])
        node += [digest(" ".join(runs)), *sorted(contents[k])]
    return key, style, node


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in small(batches, 200):
        whole, rows = [], []
        for page in b.column("html").to_pylist():
            blocks = blocks_of(page)
            whole.append(digest("\n".join(x.text for x in blocks)))
            rows.append(page_nodes(blocks))
        yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(whole, pa.int64()), *(pa.array([r[i] for r in rows], pa.list_(t)) for i, t in enumerate((pa.string(), pa.bool_(), pa.int64())))], names=["host", "whole", "branch", "style", "node"])


def importance(spark: SparkSession, pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``host, branch, pages, importance`` of the hosts' merged style trees (``pages``: host, html).

    The trees of a host's distinct pages are merged by the elements' tags and names. Over the m pages of a branch

    - its presentation's importance is the entropy of what hangs on it, -sum p log_m p;
    - a content (a block's text) on n pages has the entropy log_m n, and the branch's content importance is 1 less
      the mean entropy of its distinct contents, so that many copies of one page weigh no more than one;
    - both are mixed by the number l of its presentations: (1 - g**l) presentation + g**l content, g = GAMMA.

    All sums are made before the shuffle, by host, branch and node, so a host with most of the pages is no single task.
    """
    rows = scratch.save(pages.select("host", "html").mapInArrow(_tree, "host string, whole long, branch array<string>, style array<boolean>, node array<long>").where("size(branch) > 0"))
    rows = rows.dropDuplicates(["host", "whole"]).select("host", F.explode(F.arrays_zip("branch", "style", "node")).alias("x")).select("host", "x.branch", "x.style", "x.node")
    each = rows.groupBy("host", "branch", "style", "node").agg(F.count(F.lit(1)).cast("double").alias("n"))
    of = lambda style, x: F.sum(F.when(F.col("style") == style, x))
    n, one = F.col("n"), F.lit(1.0)
    tree = each.groupBy("host", "branch").agg(of(True, n).alias("m"), of(True, one).alias("l"), of(True, n * F.log(n)).alias("s"), of(False, one).alias("k"), of(False, F.log(n)).alias("t"))
    presentation = 1 - F.col("s") / F.col("m") / F.log("m")
    content = 1 - F.col("t") / F.col("k") / F.log("m")
    mixed = F.when(F.col("m") > 1, presentation + F.pow(F.lit(GAMMA), "l") * (content - presentation)).otherwise(1.0)
    return tree.select("host", "branch", F.col("m").cast("long").alias("pages"), mixed.alias("importance"))


def noisy_branches(spark: SparkSession, pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``host, noisy``: the branches of low importance of each host that has any."""
    tree = importance(spark, pages, scratch)
    return scratch.save(tree.where((F.col("pages") >= PAGES) & (F.col("importance") < LEAST)).groupBy("host").agg(F.collect_list("branch").alias("noisy")))


TEXT = "page_id bigint, url string, text string, n_chars bigint"


def extract(spark: SparkSession, pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages`` (page_id, url, html; other columns are ignored).

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one
    line feed. What is never shown goes. Then branches of low importance on the host's merged style tree go (see
    ``importance``), then what HTML's elements, roles or names mark as menus, headers, footers, sidebars, notices,
    adverts, forms or comments; this alone decides on hosts with few pages, and on a page of which the tree would leave
    nothing, because copies of a page do not make it noise. Where elements, roles or names mark regions as the article's,
    all of them are kept in page order, and text outside of them goes. Null and empty pages and pages without an
    article's text give an empty text; null urls have an empty host; repeated rows give equal texts; pages of any length
    are read whole; an empty table gives an empty result.
    """
    scratch = scratch or Scratch(spark, "html")
    base = pages.select("page_id", "url", F.coalesce(host_of(F.col("url").cast("string")), F.lit("")).alias("host"), F.col("html").cast("string").alias("html"))
    noisy = noisy_branches(spark, base, scratch)
    if noisy.count() <= BROADCAST_ROWS:
        noisy = F.broadcast(noisy)

    @F.pandas_udf("string")
    def main_text(html, noisy):  # noqa: ANN001, ANN202
        import pandas as pd

        return pd.Series(["\n".join(b.text for b in choose(blocks_of(h), set(n) if n is not None else frozenset())) for h, n in zip(html, noisy)], dtype=object)

    out = base.join(noisy, "host", "left").select("page_id", "url", main_text("html", "noisy").alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
