import math

import duckdb
import pandas as pd
import pytest

from martloom.llm import site_style, url_filter
from tests.llm.common import rows_of

URLS = [
    None, "", "no scheme", "http://", "http://Example.ORG/es/1", "https://a.example.org/en/12", "https://example.org/en/2",
    "http://x.org", "http://x.org?q=/", "http://X.com/fr/1#casino", "http://y.com/de/", "http://com/de/", "http://acom/de/",
    "http://casino-win.net/", "http://mycasino.net/", "http://free-bets.net", "http://free.net/free", "http://FREE.net/Bets",
    "http://é.net/casinoé", "http://h.net:80/de/?u=http://porn", "http://a.b://c/", "://k.org/",
]


def test_urls_are_the_oracle(spark):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)], "page_id long, url string, verdict string")
    got = url_filter.judge_urls(pages).select("page_id", "host", "path", "rule", "verdict").toPandas()
    con = duckdb.connect()
    con.register("pages", pd.DataFrame({"page_id": range(len(URLS)), "url": URLS}))
    want = con.execute(url_filter.oracle()).df()
    assert got.sort_values("page_id").astype(str).values.tolist() == want.sort_values("page_id").astype(str).values.tolist()
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


@pytest.mark.parametrize("url, rule, verdict", [
    ("http://example.org/es/1", "example.org/es/", "block"), ("http://a.example.org/es", "org/", "allow"),
    ("http://example.org/en/10", "example.org/en/1", "block"), ("http://x.org", None, "allow"),
    ("http://porn.org/", "org/", "allow"), ("http://porn.net/", None, "block"), ("http://sex.net/sex", None, "allow")])
def test_longest_rule_then_terms(spark, url, rule, verdict):
    row = url_filter.judge_urls(spark.createDataFrame([(1, url)], "page_id long, url string")).first()
    assert (row["rule"], row["verdict"]) == (rule, verdict)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li>Home<li>About</ul></nav><div class="cookieBanner">We use cookies</div>
<article class="post"><header><h1>A &amp; B</h1></header><p>One <b>t</b>wo&nbsp; three<br>four<p>Five
<div class="ad-slot">Buy</div><form><label>Mail</label></form><ul><li>six<li>seven</ul><!-- no > comment -->
<section id="comments"><article class="comment"><p>Nice!</p></article></section></article>
<aside>Side</aside><footer>&copy; 2024</footer></body></html>"""


def test_article_without_the_rest():
    assert site_style.main_text(PAGE) == "A & B One two three four Five six seven"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain &lt;text&gt;  here", "plain <text> here"), ("<p>a<p>b", "a b"), ("<article>open <b>end", "open end"),
    ("<main><p>m</p></main><div>x</div>", "m"), ("<article>a</article><p>x</p><article>b</article>", "a b"),
    ("<article>1 < 2 &am</article>", "1 < 2 &am"), ("<script>never closed", ""), ("<article><p class='x>y'>q</p></article", "q"),
    ("<article><p class='broken>q</p>r</article>", "q r"), ("<body><div>only</div></body>", "only")])
def test_broken_pages(page, text):
    assert site_style.main_text(page) == text


PROSE = "A paragraph of some length that is a part of the article and not of its surroundings. " * 4


@pytest.mark.parametrize("wrapper", [
    "<form>", "<div class='layout no-sidebar'>", "<div id=menu-wrapper>", "<div class='has-comments'>", "<aside>", "<head>"])
def test_wrappers_of_the_article_are_no_noise(wrapper):
    page = f"<body>{wrapper}<nav>Menu</nav><div class=ad>Buy</div><article><p>Text of it</p></article><label>Mail</label>"
    assert site_style.main_text(page) == "Text of it"
    beside = f"<article><p>{PROSE}</p></article>{wrapper}<article><p>Teaser</p></article></div>"
    assert site_style.main_text(beside) == PROSE.strip()


@pytest.mark.parametrize("name", ["related-work", "share-prices"])
def test_paragraphs_under_a_noise_name_stay(name):
    links = f"<div class=related><p><a href=x>{PROSE}</a></p></div>"
    page = f"<article><p>One</p><section class={name}><p>{PROSE}</p></section>{links}<div class=share>Send</div>"
    assert site_style.main_text(page) == f"One {PROSE.strip()}"
    assert site_style.main_text(f"<form><p>{PROSE}</p><label>Mail</label></form>") == PROSE.strip()
    assert site_style.main_text(f"<article>A</article><div class=comments><article>{PROSE}</article></div>") == "A"


def test_branches_that_repeat_on_a_host_go(spark, monkeypatch):
    rows = [(i, f"http://h.net/{i}", f"<body><div class=top>Always the same</div><div class=body>Text number {i}</div></body>")
            for i in range(40)] + [(100, "http://one.net/", "<div class=top>Always the same</div>"), (101, None, None), (101, None, None),
            (7, "http://h.net/7", None), (102, "http://h.net/x", "<body><div class=top>Always the same</div><article>A</article></body>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = [(i, f"http://h.net/{i}", f"Text number {i}", len(f"Text number {i}")) for i in range(40)] + [
        (100, "http://one.net/", "Always the same", 15), (101, None, "", 0), (101, None, "", 0), (7, "http://h.net/7", "", 0),
        (102, "http://h.net/x", "A", 1)]
    assert sorted(rows_of(site_style.extract(pages)), key=str) == sorted(want, key=str)
    monkeypatch.setattr(site_style, "BROADCAST_BRANCHES", 0)
    assert sorted(rows_of(site_style.extract(pages)), key=str) == sorted(want, key=str)
    assert site_style.extract(pages.limit(0)).count() == 0


def test_articles_stay_however_often_they_repeat(spark):
    pages = spark.createDataFrame([(i, "http://h.net/", "<article><p>Same text</p></article>") for i in range(30)],
                                  "page_id long, url string, html string")
    assert {r.text for r in site_style.extract(pages).collect()} == {"Same text"}


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_what_repeats_inside_articles_goes(spark, monkeypatch, broadcast):
    monkeypatch.setattr(site_style, "BROADCAST_BRANCHES", broadcast)
    page = "<article><div class=related><p>{0}</p></div><p>{1}</p><div class=box>Read the full story</div></article>"
    pages = spark.createDataFrame([(i, "http://h.net/", page.format(PROSE, f"{PROSE} number {i} " * 2)) for i in range(40)] + [
        (99, "http://h.net/", page.format("", "A"))], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in site_style.extract(pages).collect()}
    assert got == {**{i: " ".join(f"{PROSE} number {i} ".split() * 2) for i in range(40)}, 99: "A Read the full story"}


def _importance(pages: list[str | None], path: int) -> float:
    """Of one branch of a host, from the pages themselves."""
    parts = [{(value, is_text) for at, value, is_text in site_style.page_styles(page) if at == path} for page in pages]
    parts = [part for part in parts if part]
    kinds = [next(value for value, is_text in part if not is_text) for part in parts]
    texts = {value for part in parts for value, is_text in part if is_text}
    m = len(parts)
    if m == 1:
        return 1.0
    styles = set(kinds)
    shown = -sum(kinds.count(k) / m * math.log(kinds.count(k) / m, m) for k in styles)
    said = 1 - sum(math.log(sum((t, True) in part for part in parts), m) for t in texts) / len(texts) if texts else 0.0
    share = site_style.DECAY ** len(styles)
    return (1 - share) * shown + share * said


def test_style_tree_alone_removes_what_repeats_on_a_host(spark, monkeypatch):
    for names in ("NOISE_TAGS", "NOISE_NAMES", "HEADER_NAMES"):
        monkeypatch.setattr(site_style, names, frozenset())
    menus = ["<ul><li>Home</li><li>News</li></ul>", "<ul><li>Home</li><li>Sport</li></ul>"]
    htmls = [
        f"<body><nav>{menus[i % 8 == 0]}</nav><div class=notice>We use cookies</div><div class=story><p>Story {i}</p>"
        f"{'<blockquote>said</blockquote>' * (i % 3)}<p>Ends at {i * i}</p></div><footer>Since 1999</footer></body>" for i in range(48)]
    rows = [(i, f"http://h.net/{i}", page) for i, page in enumerate(htmls)] + [(99, "http://rare.net/", htmls[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    paths = {path for page in htmls for path, _, _ in site_style.page_styles(page)}
    low = {path for path in paths if _importance(htmls, path) < site_style.LEAST_IMPORTANCE}
    got = site_style.low_branches(pages).collect()
    assert low and {r["host"] for r in got} == {"h.net"} and {r["path"] for r in got} == low
    texts = {r.page_id: r.text for r in site_style.extract(pages).collect()}
    assert all("cookies" not in t and "1999" not in t and "Home" not in t for i, t in texts.items() if i < 99)
    assert all(f"Story {i}" in texts[i] and f"Ends at {i * i}" in texts[i] for i in range(48))
    assert "cookies" in texts[99]  # one page of a host tells nothing
