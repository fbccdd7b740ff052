"""Main text of web pages by site style trees."""

from __future__ import annotations

import functools
import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.shared import blank, stored, up_to
from martloom.llm.url_filter import split_url

DECAY = 0.9
LEAST_PAGES = 5
LEAST_IMPORTANCE = 0.2
BROADCAST_BRANCHES = 200_000  # low branches, about 5 MB; above that pages and branches meet in a shuffle

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg xmp select".split())
BLOCKS = frozenset(
    "html body main article section nav header footer aside form div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead "
    "tbody tfoot tr td th caption blockquote pre figure figcaption address details summary fieldset legend hr center "
    "dialog menu".split())
CLOSES_P = BLOCKS - frozenset("html body td th tr thead tbody tfoot caption li dt dd legend summary figcaption".split())
# An opening tag ends an open one of these, inside the nearest container.
ENDS = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"),
        "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
ENDS = {tag: (frozenset(a.split()), frozenset(b.split())) for tag, (a, b) in ENDS.items()}
NOISE_TAGS = frozenset("nav footer aside form button label dialog menu head object canvas".split())
NOISE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice "
    "popup modal newsletter subscribe subscription signup login menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer copyright comment comments disqus reply replies respond related share social pagination pager "
    "search widget".split())
HEADER_NAMES = frozenset("header masthead topbar".split())  # noise outside articles
COMMENTS = frozenset("comment comments reply replies".split())
MAIN_NAMES = frozenset("articlebody article-body post-content entry-content main-content article-content".split())
OTHER, MAIN, ARTICLE = 0, 1, 2
LEAST_PROSE = 200  # characters in paragraphs that make a form or a branch with a noise name text


def _hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text)
    return value - (1 << 64) if value >> 63 else value


class Noise:
    """An element that looks like noise, the one around it, and what it holds.  `firm`
    is noise in any case, `weak` may be text by its paragraphs."""

    __slots__ = ("above", "level", "firm", "weak", "held", "prose", "links", "chars")

    def __init__(self, above: Noise | None, level: int, firm: bool, weak: bool):
        self.above, self.level, self.firm, self.weak = above, level, firm, weak
        self.held, self.prose, self.links, self.chars = [0, 0, 0], 0, 0, 0

    def chain(self) -> Iterator[Noise]:
        at: Noise | None = self
        while at:
            yield at
            at = at.above

    def stays(self, top: int, total: int) -> bool:
        """Whether it is none: it wraps most of the article, or is mostly paragraphs."""
        wraps = top > self.level and 2 * self.held[top] > total
        return not self.firm and (wraps or (self.weak and self.prose >= LEAST_PROSE and 2 * self.links < self.chars))


class Node:
    """An open element: its style path, the nearest element around it that looks like noise, how
    near to the article it is, whether it is in a paragraph or link, and the styles of its children so far."""

    __slots__ = ("tag", "path", "noise", "level", "prose", "link", "children")

    def __init__(self, tag: str, path: str, noise: Noise | None, level: int, prose: bool = False, link: bool = False):
        self.tag, self.path, self.noise, self.level = tag, path, noise, level
        self.prose, self.link, self.children = prose, link, []


def _open(tag: str, attrs: str, parent: Node) -> Node:
    names = [value for found in ATTRIBUTE.findall(attrs) for value in "".join(found[1:]).split()] if attrs else []
    tokens = {t.lower() for name in names for t in TOKEN.findall(name)}
    lower = {name.lower() for name in names}
    by_tag = by_name = False
    if tag in ("article", "main"):
        by_name = bool(lower & COMMENTS)
    elif tag not in ("html", "body"):
        by_tag = tag in NOISE_TAGS or (parent.level == OTHER and tag == "header")
        by_name = bool(tokens & NOISE_NAMES) or (parent.level == OTHER and bool(tokens & HEADER_NAMES))
    level = ARTICLE if tag == "article" or lower & MAIN_NAMES else MAIN if tag == "main" or "main" in lower else OTHER
    style = tag + "".join(f".{t}" for t in sorted(tokens))
    parent.children.append(style)
    noise = parent.noise
    if by_tag or by_name:
        noise = Noise(noise, max(parent.level, OTHER if by_tag else level), by_name and bool(lower & COMMENTS),
                      tag == "form" or not by_tag)
    return Node(tag, f"{parent.path}>{style}", noise, max(level, parent.level), parent.prose or tag == "p", parent.link or tag == "a")


def parse(page: str | None) -> tuple[list[tuple[Node, str]], list[Node]]:
    """Text blocks of a page outside noise, in order, and its block elements outside noise.

    Tags that are left open end where their container ends or a block may not contain
    the next one; character references are decoded; white space in a block becomes one space.
    What looks like noise is judged at the end of the page, by what it holds.
    """
    page = page or ""
    root = Node("", "", None, OTHER)
    stack, found_blocks, nodes, text = [root], [], [], []
    totals = [0, 0, 0]

    def flush() -> None:
        if text:
            owner = next(n for n in reversed(stack) if n.tag in BLOCKS or n is root)
            found_blocks.append((owner, text.copy()))
            text.clear()

    def add(node: Node, piece: str) -> None:
        text.append((node.noise, piece))
        chars = len(piece.strip())
        if not node.noise:
            totals[node.level] += chars
        elif chars and not any(n.firm for n in node.noise.chain()):
            totals[node.level] += chars
            for n in node.noise.chain():
                n.held[node.level] += chars
                n.chars += chars
                n.links += chars * node.link
                n.prose += chars * (node.prose and not node.link)

    def close(index: int) -> None:
        if any(n.tag in BLOCKS for n in stack[index:]):
            flush()
        del stack[index:]

    at = 0
    while True:
        found = MARKUP.search(page, at)
        end = found.start() if found else len(page)
        if end > at:
            add(stack[-1], page[at:end])
        if not found:
            break
        at = found.end()
        tag = (found["tag"] or found["tag2"] or "").lower()
        if not tag:
            continue
        if found["end"] or found["end2"]:
            inline = tag not in BLOCKS
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if inline and stack[i].tag in BLOCKS:
                    break
            continue
        if tag in RAW:
            done = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = done.end() if done else len(page)
            continue
        if tag in CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in BLOCKS:
                    break
        if tag in ENDS:
            ended, container = ENDS[tag]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ended:
                    close(i)
                    break
                if stack[i].tag in container:
                    break
        if tag in BLOCKS:
            flush()
        elif tag == "br":
            add(stack[-1], " ")
        if tag not in VOID:
            node = _open(tag, found["attrs"] or found["attrs2"] or "", stack[-1])
            stack.append(node)
            if tag in BLOCKS:
                nodes.append(node)
    flush()
    top = max((level for level in (OTHER, MAIN, ARTICLE) if totals[level]), default=OTHER)

    @functools.cache
    def is_noise(noise: Noise | None) -> bool:
        return noise is not None and (not noise.stays(top, totals[top]) or is_noise(noise.above))

    blocks = []
    for owner, pieces in found_blocks:
        words = html.unescape("".join(piece for noise, piece in pieces if not is_noise(noise))).split()
        if words:
            blocks.append((owner, " ".join(words)))
    return blocks, [node for node in nodes if not is_noise(node.noise)]


def page_styles(page: str | None) -> list[tuple[int, int, bool]]:
    """(path, value, is_text) of a page's part of the style tree: for every style path one
    value that stands for the styles of its children, and a value for each different text in it."""
    blocks, nodes = parse(page)
    styles: dict[str, list[str]] = {}
    for node in nodes:
        kinds = styles.setdefault(node.path, [])
        kinds += [c for i, c in enumerate(node.children) if not i or node.children[i - 1] != c]
    texts = {(node.path, text) for node, text in blocks}
    for path, _ in texts:
        styles.setdefault(path, [])
    out = [(_hash(path), _hash("|".join(kinds)), False) for path, kinds in styles.items()]
    return out + [(_hash(path), _hash(text), True) for path, text in texts]


def main_text(page: str | None, low: frozenset[int] | set[int] = frozenset()) -> str:
    """The blocks of the article, without one of the main element, without both of the page, joined by
    one space; all but those of branches in `low`.  An article that is for the most part in `low` stays whole."""
    blocks, _ = parse(page)
    level = max((node.level for node, _ in blocks), default=OTHER)
    near = [(text, _hash(node.path) in low) for node, text in blocks if node.level == level]
    if level and 2 * sum(len(text) for text, is_low in near if is_low) >= sum(len(text) for text, _ in near):
        return " ".join(text for text, _ in near)
    return " ".join(text for text, is_low in near if not is_low)


def low_branches(
    pages: DataFrame, least_pages: int = LEAST_PAGES, least_importance: float = LEAST_IMPORTANCE,
) -> DataFrame:
    """(host, path) of the style tree branches of little importance.

    The pages of a host are merged by style path.  With m pages that have a path, the
    presentation importance is the entropy to base m of its child styles, the content
    importance one less the mean entropy of its texts (a text on n pages has
    log n / log m: the same text on all pages says nothing).  With l child styles they
    combine as (1 - d^l) presentation + d^l content.  Paths on fewer than `least_pages`
    pages are not judged.  Counts add up before the shuffle, so a hot host is no hot task.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url, page in zip(batch["url"], batch["html"]):
                host = split_url(url)[0]
                out += [(host, *row) for row in page_styles(page)]
            yield pd.DataFrame(out, columns=["host", "path", "value", "is_text"])

    values = pages.select("url", "html").mapInPandas(
        rows, "host string, path long, value long, is_text boolean").groupBy("host", "path", "value", "is_text").count()
    of_paths = values.groupBy("host", "path").agg(
        F.sum(F.when(~F.col("is_text"), F.col("count"))).alias("m"),
        F.count(F.when(~F.col("is_text"), 1)).alias("l"),
        F.sum(F.when(~F.col("is_text"), F.col("count") * F.log("count"))).alias("style_sum"),
        F.avg(F.when(F.col("is_text"), F.log("count"))).alias("text_mean"))
    of_m = F.log("m")
    presentation = F.when(F.col("m") > 1, 1 - F.col("style_sum") / (F.col("m") * of_m)).otherwise(1.0)
    content = F.when(F.col("text_mean").isNull(), 0.0).when(F.col("m") > 1, 1 - F.col("text_mean") / of_m).otherwise(1.0)
    share = F.pow(F.lit(DECAY), F.col("l"))
    return of_paths.filter(F.col("m") >= least_pages).withColumn(
        "importance", (1 - share) * presentation + share * content).filter(
        F.col("importance") < least_importance).select("host", "path")


def _extract_by_join(pages: DataFrame, low: DataFrame) -> DataFrame:
    """page_id, url, text, where low branches are too many to broadcast.

    Every page gets the low ones among its own branches, found by (host, path), so neither
    a page nor a task holds all branches of a host.  Pages of a host with the same html share them.
    """

    @F.pandas_udf("string")
    def host_of(urls: pd.Series) -> pd.Series:
        return pd.Series([split_url(u)[0] for u in urls], dtype=object)

    def paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for host, digest, page in zip(rows["host"], rows["digest"], rows["html"]):
                out += [(host, digest, path) for path in {_hash(node.path) for node, _ in parse(page)[0]}]
            yield pd.DataFrame(out, columns=["host", "digest", "path"])

    @F.pandas_udf("string")
    def text_without(htmls: pd.Series, lows: pd.Series) -> pd.Series:
        return pd.Series([main_text(h, frozenset(x) if x is not None else frozenset()) for h, x in zip(htmls, lows)], dtype=object)

    keyed = pages.select("page_id", "url", "html", host_of("url").alias("host"), F.sha2(blank(F.col("html")), 256).alias("digest"))
    own = keyed.select("host", "digest", "html").mapInPandas(paths, "host string, digest string, path long").distinct()
    lows = stored(own.join(low, ["host", "path"], "left_semi").groupBy("host", "digest").agg(
        F.collect_set("path").alias("low")), "low-by-page")
    return keyed.join(lows, ["host", "digest"], "left").select("page_id", "url", text_without("html", "low").alias("text"))


def extract(
    pages: DataFrame, least_pages: int = LEAST_PAGES, least_importance: float = LEAST_IMPORTANCE,
) -> DataFrame:
    """One row per row of pages: page_id, url, text, n_chars.

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
    comments are noise by element, class, id or role, unless they wrap the article or are
    mostly paragraphs.  Of what is left the article (else the main element, else the page)
    is the text, without its branches of little importance in the style tree of the host.
    Null and empty html give empty text.
    A short list of low branches is broadcast; a longer one is joined by host and path.
    """
    low = stored(low_branches(pages, least_pages, least_importance), "low-branches")
    if up_to(low, BROADCAST_BRANCHES):
        by_host: dict[str, set[int]] = {}
        for row in low.collect():
            by_host.setdefault(row["host"], set()).add(row["path"])
        known = pages.sparkSession.sparkContext.broadcast(by_host)

        @F.pandas_udf("string")
        def text_of(urls: pd.Series, htmls: pd.Series) -> pd.Series:
            return pd.Series([main_text(h, known.value.get(split_url(u)[0], frozenset())) for u, h in zip(urls, htmls)])

        out = pages.select("page_id", "url", text_of("url", "html").alias("text"))
    else:
        out = _extract_by_join(pages, low)
    return out.withColumn("n_chars", F.length("text").cast("long"))
