"""Main text of web pages: page structure first, then removal of the templates that a site repeats."""

from __future__ import annotations

import html
import json
import re
from urllib.parse import urlsplit

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import materialize

# A subtree is a template of its host from so many pages on, if they are such a share of the host's pages.
MIN_PAGES, MIN_SHARE = 5, 0.05
# Pages holding templates whose numbers are broadcast, 32 MB of them; beyond that all waiting texts are shuffled.
MARKED = 1 << 22

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<open>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</(?P<close>[a-zA-Z][^\s/>]*)[^>]*>|<[!?/][^>]*>"
    # a tag that the end of the page, or a stray quote, leaves open
    r"|<(?P<stray>[a-zA-Z][^\s/>]*)(?P<rest>[^>]*)(?:>|\Z)|</[^>]*\Z|<!.*\Z", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_SPACE = re.compile(r"\s+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
                   "h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
# never part of the article
DROPPED = frozenset("nav aside footer header form button select menu dialog head object audio video canvas".split()) | RAW
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus "
    "footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion "
    "recommended related replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe tags toolbar widget widgets".split())
# an end tag that may be left out: what opens inside closes what
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "body": {"head"}}
_HOLDS = frozenset("ul ol dl table article main section div body html".split())
# in an article these are no templates: parts of a line, cells of a table, and what holds the article
_PARTS = frozenset("b i em strong a span code q cite u s sub sup small mark td th article main".split())


class Element:
    __slots__ = ("tag", "names", "dropped", "main", "hash", "mark", "texted")

    def __init__(self, tag: str, names: frozenset, dropped: bool, main: bool) -> None:
        self.tag, self.names, self.dropped, self.main, self.mark, self.texted = tag, names, dropped, main, None, False
        self.hash = xxhash.xxh64(tag.encode())


def _names(attrs: str) -> tuple[frozenset, frozenset, bool]:
    if "=" not in attrs and "hidden" not in attrs:
        return frozenset(), frozenset(), False
    names, roles, hidden = set(), set(), False
    for key, a, b, c in _ATTRIBUTE.findall(attrs):
        key = key.lower()
        if key in ("class", "id"):
            for token in (a or b or c).lower().split():
                names.add(token)
                names.update(re.split(r"[-_]+", token))
        elif key == "role":
            roles.update((a or b or c).lower().split())
        elif key == "hidden":
            hidden = True
    return frozenset(names), frozenset(roles), hidden


def read_page(page: str) -> tuple[list[tuple[str, bool, bool, list[Element]]], list[Element]]:
    """Blocks ``(text, dropped, main, ancestors)`` in page order, and all elements that hold text.

    A block ends where a block element begins or ends. ``dropped`` blocks lie in an element that is no
    article by its tag, role, class or id; ``main`` blocks lie in an article or main element.
    """
    stack: list[Element] = []
    blocks, elements, line = [], [], []
    at = 0

    def flush() -> None:
        text = _SPACE.sub(" ", "".join(line)).strip()
        line.clear()
        if text:
            data = text.encode()
            for e in stack:
                e.hash.update(data)
                e.texted = True
            blocks.append((text, any(e.dropped for e in stack), any(e.main for e in stack), list(stack)))

    def pop() -> None:
        e = stack.pop()
        if e.texted:
            e.mark = xxhash.xxh64_intdigest(e.hash.digest() + e.tag.encode()) - (1 << 63)
            elements.append(e)
            if stack:
                stack[-1].hash.update(e.hash.digest())

    for m in _MARKUP.finditer(page):
        if m.start() < at:
            continue
        if m.start() > at:
            line.append(html.unescape(page[at:m.start()]))
        at = m.end()
        tag = m["open"] or m["stray"]
        if tag:
            tag = tag.lower()
            attrs = m["attrs"] or m["rest"] or ""
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
                line.append(" ")
                continue
            if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    line.append(" ")
                continue
            if tag in BLOCKS:
                flush()
                # a block closes an open paragraph, whatever inline elements are open inside
                depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == "p" or stack[k].tag in _HOLDS), None)
                if depth is not None and stack[depth].tag == "p":
                    while len(stack) > depth:
                        pop()
                shut = CLOSES.get(tag)
                if shut:
                    depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag in shut or stack[k].tag in _HOLDS), None)
                    if depth is not None and stack[depth].tag in shut:
                        while len(stack) > depth:
                            pop()
            names, roles, hidden = _names(attrs)
            dropped = tag in DROPPED or hidden or not DROPPED_NAMES.isdisjoint(names) or not DROPPED_ROLES.isdisjoint(roles)
            stack.append(Element(tag, names, dropped and tag not in ("html", "body"), tag in ("article", "main") or "main" in roles))
        elif m["close"]:
            tag = m["close"].lower()
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k].tag == tag), None)
            if tag in BLOCKS:
                flush()
            if depth is not None:
                while len(stack) > depth:
                    pop()
    if at < len(page):
        line.append(html.unescape(page[at:]))
    flush()
    while stack:
        pop()
    return blocks, elements


def _host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").netloc or "").lower()
    except ValueError:
        return ""


def page_blocks(page: str) -> tuple[list[tuple[str, list[int]]], list[int]]:
    """The blocks that page structure keeps, each with the marks of the subtrees it could be a template
    with, and the marks of all subtrees of the page."""
    out, marks, _ = page_parts(page)
    return out, marks


def page_parts(page: str) -> tuple[list[tuple[str, list[int]]], list[int], list[tuple[int, int]]]:
    """What :func:`page_blocks` gives, and ``(mark, article)`` of the subtrees that articles hold.

    If a page has an article, only what lies in articles is kept, and of its subtrees all but parts of lines
    and cells of tables can be templates. ``article`` hashes what is kept of the innermost article around.
    """
    blocks, elements = read_page(page)
    kept = [b for b in blocks if not b[1]]
    inside = any(b[2] for b in kept)
    if inside:
        kept = [b for b in kept if b[2]]
    out, held, around = [], {}, {}
    for text, _, _, above in kept:
        first = next((k for k, e in enumerate(above) if e.main), -1) if inside else -1
        could = [e for e in above[first + 1:] if not (inside and e.tag in _PARTS) and e.tag not in ("html", "body")]
        out.append((text, [e.mark for e in could]))
        if inside:
            article = None
            for e in above:
                if e.main:
                    article = e
                    held.setdefault(article, xxhash.xxh64()).update(text.encode() + b"\n")
                elif article is not None and e.tag not in _PARTS:
                    around[e] = article
    votes = {(e.mark, held[a].intdigest() - (1 << 63)) for e, a in around.items()}
    return out, sorted({e.mark for e in elements}), sorted(votes)


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """``(page_id, url, text)`` per row of ``pages``: the blocks of the article, one per line.

    One pass reads each page, keeps what its structure marks as the article, and hashes all element
    subtrees. Spark counts per host the pages that hold a subtree, and for subtrees in articles the different
    articles that do, so copies of an article have one vote; kept blocks inside a subtree that recurs on many
    pages of the host, or in many of its articles, are removed. Pages whose kept blocks lie in no such
    candidate are final after the pass.

    Character references are decoded, white space inside a block is one space, nothing else is dropped or
    capped. Null and empty pages have the empty text; a null or malformed url belongs to the host with no
    name. Repeated rows are pages of their own. No rows: no result. Other columns are ignored.
    """

    def read(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                tool = zstandard.ZstdCompressor(level=3)
                hosts, final, packed, could, marks, votes, inside = [], [], [], [], [], [], []
                for url, page in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    kept, all_marks, held = page_parts(page or "")
                    hosts.append(_host(url))
                    marks.append(all_marks)
                    votes.append([{"mark": m, "article": a} for m, a in held])
                    inside.append(bool(held))
                    done = not any(m for _, m in kept)
                    final.append("\n".join(t for t, _ in kept) if done else None)
                    asks = [] if done else sorted({m for _, ms in kept for m in ms})
                    at_ask = {m: i for i, m in enumerate(asks)}
                    could.append(asks)
                    packed.append(None if done else tool.compress(json.dumps([[t, [at_ask[m] for m in ms]] for t, ms in kept]).encode()))
                vote = pa.list_(pa.struct([("mark", pa.int64()), ("article", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(3), part.column(0), part.column(1), pa.array(hosts), pa.array(final, pa.string()), pa.array(packed, pa.binary()), pa.array(could, pa.list_(pa.int64())), pa.array(marks, pa.list_(pa.int64())),
                     pa.array(votes, vote), pa.array(inside, pa.bool_())],
                    ["row", "page_id", "url", "host", "text", "packed", "could", "marks", "votes", "inside"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    source = pages.select("page_id", "url", "html").withColumn("row", F.monotonically_increasing_id())
    parsed = materialize(source.mapInArrow(
        read, f"row long, page_id {kinds['page_id']}, url string, host string, text string, "
              "packed binary, could array<bigint>, marks array<bigint>, "
              "votes array<struct<mark: bigint, article: bigint>>, inside boolean"), "pages")
    sizes = parsed.groupBy("host").agg(F.count("*").alias("pages"))
    seen = parsed.select("host", F.explode("marks").alias("mark")).groupBy("host", "mark").agg(F.count("*").alias("n"))
    many = seen.where(F.col("n") >= min_pages).join(sizes, "host").where(F.col("n") >= min_share * F.col("pages"))
    votes = parsed.select("host", F.explode("votes").alias("vote")).select("host", "vote.*").distinct()
    articles = votes.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    held = votes.groupBy("host", "mark").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    held = held.join(articles, "host").where(F.col("n") >= min_share * F.col("articles"))
    many = many.select("host", "mark", F.lit(False).alias("inside")).unionByName(held.select("host", "mark", F.lit(True).alias("inside")))

    def drop(batches):
        tool = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, out = batch.slice(at, 500), []
                for packed, asks, found in zip(*(part.column(i).to_pylist() for i in (2, 3, 4))):
                    hit = set(found or ())
                    gone = {i for i, m in enumerate(asks) if m in hit}
                    out.append("\n".join(t for t, ms in json.loads(tool.decompress(packed)) if gone.isdisjoint(ms)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, pa.string())], ["page_id", "url", "text"])

    # texts travel compressed
    waiting = parsed.where("text is null")
    asked = waiting.select("row", "host", "inside", F.explode("could").alias("mark"))
    hits = asked.join(many, ["host", "mark", "inside"]).groupBy("row").agg(F.collect_list("mark").alias("hits"))
    hits, waiting = materialize(hits, "hits"), waiting.select("row", "page_id", "url", "packed", "could")
    if hits.count() <= MARKED:  # pages with no template stay where they are
        marked = F.broadcast(hits.select("row"))
        rest = waiting.join(marked, "row", "left_semi").join(hits, "row").unionByName(
            waiting.join(marked, "row", "left_anti"), allowMissingColumns=True)
    else:
        rest = waiting.join(hits, "row", "left")
    rest = rest.drop("row").mapInArrow(drop, f"page_id {kinds['page_id']}, url string, text string")
    return parsed.where("text is not null").select("page_id", "url", "text").unionByName(rest)
