"""Main text of web pages: parts named as boilerplate go, and so do subtrees that a host repeats over many pages.

Each page is read into blocks of text, each with the elements it stands in. Every element's subtree is hashed from its
tags, classes and text. Spark counts, per host, on how many pages with different text a subtree stands; a subtree
found on many is the site's template and is deleted wherever it stands on that host.
"""

from __future__ import annotations

import html
import re
import sys
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from xxhash import xxh3_64_intdigest

from tapelake.llm.common import settle, whole_text

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noframes template svg math".split())
BREAKS = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
#: Elements that never hold the article.
DROPPED = RAW | frozenset("head nav header footer aside form button select option menu dialog fieldset audio video canvas object".split())
#: Names that mark an element as boilerplate, where they are a whole class or id, alone or with the words below around them.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "breadcrumb breadcrumbs sidebar aside header masthead footer copyright cookie cookies consent gdpr notice notices popup "
    "modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist "
    "commentform respond disqus reply replies pagination pager skip widget toolbar".split()
)
BEFORE = "site main page top bottom left right primary secondary global sub mobile div wp post".split()
AFTER = (
    "area bar block body bottom box button buttons container content form group icons inner item items link links list panel section "
    "slot text title top unit wrap wrapper".split()
)
NAME = re.compile(r"(?:(?:{0})[-_]+)*(?:{1})(?:[-_]+(?:{1}|{2}|\d+(?:x\d+)?))*".format(*("|".join(sorted(w)) for w in (BEFORE, MARKS, AFTER))))
#: Names of one comment; only these make comments of article and main.
COMMENT = re.compile(r"(?:div-)?comments?(?:-body|-\d+)?")
#: Elements that hold other articles than the page's own, such as teasers, if that one is outside.
SIDE = frozenset("nav aside footer menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
FORM, PARAGRAPH = re.compile(r"<form\b", re.I), re.compile(r"<(?:p|h1)\b", re.I)
#: An open p ends where one of these starts; an open li, dd and so on where one of its kind does.
CLOSES_P = BREAKS - {"br", "body", "html", "head", "option", "legend", "summary", "td", "th", "tr", "tbody", "thead", "tfoot"}
SAME_KIND = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
}
MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
ARTICLES = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|noscript|iframe|template|svg|math)\b.*?</\1\b"
    r"|<(article|main)(?![^\s/>])([^>\"']*(?:\"[^\"]*\"[^>\"']*|'[^']*'[^>\"']*)*)>", re.S | re.I
)


@dataclass(eq=False)
class Element:
    tag: str
    sign: str = ""
    dropped: bool = False
    main: bool = False
    side: bool = False  #: may hold articles that are not the page's own
    named: bool = False  #: dropped for a name or role, not for its tag alone
    parent: Element | None = None
    in_main: bool = False  #: is or stands in an article or main element
    in_article: bool = False
    holder: Element | None = None  #: the nearest element that breaks text, itself included; the root if there is none
    pieces: list[str] = field(default_factory=list)  #: what a holder's hash is made of
    hash: int = 0

    def put_in(self, parent: Element) -> None:
        self.parent = parent
        self.in_main = self.main or parent.in_main
        self.in_article = self.tag == "article" or parent.in_article
        self.holder = self if self.tag in BREAKS else parent.holder


@dataclass
class Block:
    """Text between two breaks, and the innermost element it stands in."""

    text: str
    within: Element


def element(tag: str, attributes: str, unwanted: frozenset[str] = DROPPED) -> Element:
    sign, dropped, side, comment = "", False, tag in SIDE, False
    if attributes:
        for name, *values in ATTRIBUTE.findall(attributes):
            value = "".join(values).lower()
            name = name.lower()
            if name in ("class", "id"):
                sign += f" {name}={value}"
                names = value.split()
                dropped = dropped or any(map(NAME.fullmatch, names))
                comment = comment or any(map(COMMENT.fullmatch, names))
            elif name == "role":
                dropped = dropped or value in ROLES
            elif name == "hidden" and not value:
                dropped = side = True
    main, named = tag in ("article", "main"), dropped or comment
    dropped = comment if main else (named or tag in unwanted) and tag not in ("html", "body")
    return Element(tag, sign, dropped, main, side or comment, named)


def own_articles(page: str) -> list[int]:
    """Where the page's article and main elements open, those that are comments left out."""
    return [m.start() for m in ARTICLES.finditer(page) if m[2] and not element(m[2].lower(), m[3]).dropped]


def edges_of(tag: str) -> re.Pattern:
    return re.compile(rf"<(/?){re.escape(tag)}(?![^\s/>])[^>]*>", re.I)


def ends_of(page: str, tag: str) -> dict[int, int]:
    """Where the elements of a tag end, by where they start; those never closed are left out."""
    ends, opened = {}, []
    for edge in edges_of(tag).finditer(page):
        if not edge[1]:
            opened.append(edge.start())
        elif opened:
            ends[opened.pop()] = edge.end()
    return ends


def blocks(page: str, unwanted: frozenset[str] = DROPPED) -> list[Block]:
    """The page's blocks outside dropped elements, with hashes of all elements around them that break text."""
    root = Element("")
    root.holder = root
    stack, out, pending = [root], [], []
    at = drops = 0
    standing: Counter[str] = Counter()  # tags on the stack
    ends: dict[str, dict[int, int]] = {}
    never_closed: set[str] = set()
    articles: list[int] | None = None

    def flush() -> None:
        text = " ".join(html.unescape("".join(pending)).split()) if pending else ""
        pending.clear()
        if text:
            out.append(Block(text, stack[-1]))
            stack[-1].holder.pieces.append(text)

    def close(down_to: int) -> None:
        nonlocal drops
        while len(stack) > down_to:
            if stack[-1].tag in BREAKS:
                flush()
            done = stack.pop()
            drops -= done.dropped
            standing[done.tag] -= 1
            if done.tag in BREAKS:
                done.hash = xxh3_64_intdigest("\x1f".join([done.tag, done.sign, *done.pieces]).encode("utf-8", "surrogatepass"))
                done.pieces.clear()
                stack[-1].holder.pieces.append(f"\x1e{done.hash:x}")

    size = len(page)
    while at < size:
        found = MARKUP.search(page, at)
        if found is None:
            if not drops:
                pending.append(page[at:])
            break
        if found.start() > at and not drops:
            pending.append(page[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                flush()
            elif standing[tag]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close(k)
                        break
            continue
        if tag in RAW:  # no markup inside; passed over as a whole
            end = None
            if not found[3].endswith("/") and tag not in never_closed:
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                if end is None:
                    never_closed.add(tag)
            if end is not None:
                at = end.end()
            elif tag in ("script", "style", "textarea", "title") and not found[3].endswith("/"):
                at = size
            continue
        if tag in CLOSES_P and standing["p"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close(k)
                    break
                if stack[k].tag in ("table", "td", "th", "button", "div", "article", "section", "li", "blockquote"):
                    break
        if tag in SAME_KIND:
            kinds, until = SAME_KIND[tag]
            low = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in until:
                    break
                if stack[k].tag in kinds:
                    low = k
            if low:
                close(low)
        if tag in BREAKS:
            flush()
        if tag not in VOID:
            new = element(tag, found[3], unwanted)
            new.put_in(stack[-1])
            if new.dropped and tag == "header" and not new.named and new.in_article:
                new.dropped = False  # the article's own title
            if new.dropped:
                if tag not in ends:
                    ends[tag] = ends_of(page, tag)
                past = ends[tag].get(found.start(), 0)
                if articles is None:
                    articles = own_articles(page)
                held = bisect(articles, (past or size) - 1) - bisect(articles, at - 1)
                if held and not new.main and not (new.side and past and held < len(articles)):
                    new.dropped = False  # the article is in it
                elif past:
                    at = past
                    continue
            stack.append(new)
            standing[tag] += 1
            drops += new.dropped
    flush()
    close(1)
    return out


def main_blocks(page: str) -> list[Block]:
    """Blocks of the article: where a page marks articles or a main part, only what stands in these. Where nothing is left
    of a page with paragraphs, forms are read as well, as some sites put whole pages into one."""
    found = blocks(page)
    if not found and FORM.search(page) and PARAGRAPH.search(page):
        found = blocks(page, DROPPED - {"form"})
    return [b for b in found if b.within.in_main] or found


def around(found: list[Block]) -> Iterator[Element]:
    """The elements that break text around the blocks, each once."""
    seen = set()
    for b in found:
        e = b.within
        while e is not None and id(e) not in seen:
            seen.add(id(e))
            if e.tag in BREAKS:
                yield e
            e = e.parent


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def template_key(host: str, subtree: int) -> int:
    """One number for a subtree on a host; subtree 0 stands for the host itself."""
    return signed(xxh3_64_intdigest(f"{subtree:x} {host}".encode("utf-8", "surrogatepass")))


def candidates(found: list[Block]) -> set[int]:
    """Hashes of the elements that may be templates: those that break text, but not the article as such."""
    return {e.hash for e in around(found) if not e.main and e.tag not in ("html", "body")}


def page_subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(key, host_key, body, page)`` for each host and candidate subtree of each page; body stands for the page's text."""
    for batch in batches:
        out = []
        for host, page, number in zip(batch["host"].to_pylist(), batch["html"].to_pylist(), batch["page"].to_pylist()):
            found = main_blocks(page)
            body = signed(xxh3_64_intdigest("\n".join(b.text for b in found).encode("utf-8", "surrogatepass")))
            own = template_key(host, 0)
            out.append((own, own, body, number))
            out += [(template_key(host, h), own, body, number) for h in candidates(found)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 4, list(SUBTREES))


SUBTREES = ("key", "host_key", "body", "page")


def remaining(host: str, page: str, templates) -> str:
    """The page's blocks outside templates, joined."""
    found = main_blocks(page)
    if not len(templates):
        return " ".join(b.text for b in found)
    gone = {h for h in candidates(found) if template_key(host, h) in templates}
    out: dict[int, bool] = {}  # whether an element is, or stands in, a template
    kept = []
    for b in found:
        path, e = [], b.within
        while e is not None and id(e) not in out:
            path.append(e)
            e = e.parent
        inside = e is not None and out[id(e)]
        for e in reversed(path):
            out[id(e)] = inside = inside or e.hash in gone
        if not inside:
            kept.append(b.text)
    return " ".join(kept)


def template_keys(found: DataFrame, least_pages: int, share: float) -> DataFrame:
    """``(key)`` of subtrees on many pages of their host. Pages of the same text count once. The distinct pairs and the
    counts are combined before each shuffle, so a popular host or subtree is no hot spot."""
    seen = found.select("key", "host_key", "body").distinct()
    counts = seen.groupBy("key", "host_key").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    hosts = counts.filter(F.col("key") == F.col("host_key")).select("host_key", F.col("pages").alias("all"))
    often = counts.filter(F.col("key") != F.col("host_key")).join(hosts, "host_key")
    return often.filter(F.col("pages") >= share * F.col("all")).select("key")


def main_text(pages: DataFrame, least_pages: int = 20, share: float = 0.5, most_shared: int = 500_000) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for each row of ``pages(page_id, url, html)``.

    Left out are elements named as boilerplate by tag, role, or a whole class or id, unless they hold an article or main
    element that is no comment (a header inside the page's article holds its title and stays; nav, aside, footer, hidden and comment elements: the only ones of the page); where a page has an article or main element,
    everything outside these; and subtrees found on at least ``least_pages`` pages of their host with different texts, if
    that is at least ``share`` of such pages. Character references are decoded, white space in a block becomes one space,
    and blocks are joined in page order by one space. Null and empty pages give an empty text; forms are read only where a page with
    paragraphs would be empty otherwise. Pages without a host, from
    a null url say, are taken as one host. Repeated rows give repeated rows and count once; other columns are not read.

    Up to ``most_shared`` template subtrees go to the tasks as numbers of eight bytes; more are joined to the pages.
    """
    rows = pages.select("page_id", "url", whole_text("html").alias("html")).withColumn("host", host_of("url"))
    rows = rows.withColumn("page", F.xxhash64("host", "html"))
    found = rows.select("host", "html", "page").mapInArrow(page_subtrees, ", ".join(f"{c} long" for c in SUBTREES))
    often = settle(template_keys(found, least_pages, share), "templates")
    if often.count() <= most_shared:
        shared = pages.sparkSession.sparkContext.broadcast(often.toPandas()["key"].to_numpy())

        @F.pandas_udf(StringType())
        def text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            known = set(shared.value.tolist())
            for hosts, htmls in batches:
                yield pd.Series([remaining(h, p, known) for h, p in zip(hosts, htmls)], dtype=object)

        done = rows.withColumn("text", text("host", "html"))
    else:
        own = found.select("key", "page").distinct().join(often, "key").groupBy("page").agg(F.collect_set("key").alias("gone"))

        @F.pandas_udf(StringType())
        def text(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for hosts, htmls, gone in batches:
                yield pd.Series([remaining(h, p, set() if g is None else set(g)) for h, p, g in zip(hosts, htmls, gone)], dtype=object)

        done = rows.join(own, "page", "left").withColumn("text", text("host", "html", "gone"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def host_of(url: str) -> Column:
    """What stands between the first :// and the path, A-Z in lower case; empty without one."""
    host = F.regexp_extract(F.coalesce(F.col(url).cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
