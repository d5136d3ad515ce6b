"""Operators 5 and 6: main text of pages, and address lists."""

import datetime as dt
import html
import re

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import types as T

from kestrel.llm import line_blocks, queries, url_lists
from kestrel.llm.line_blocks import main_text
from llm.conftest import prose

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("html", T.StringType())])


def same_rows(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


# ---- 5 ----------------------------------------------------------------------------------------

def article_of(page):
    """Heading and paragraphs of the pages of the test tables, whose articles are marked."""
    body = page.split("<article>", 1)[1].split("</article>", 1)[0]
    blocks = re.split(r"</?(?:h1|p)>", body)
    texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in blocks]
    return "\n\n".join(t for t in texts if t)


def test_op5_on_pages(spark):
    for sf in (SF_SMALL, "/root/testdata/sf0.1"):
        pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()
        want = [(p.page_id, p.url, t, len(t)) for p in pages for t in [article_of(p.html)]]
        same_rows(queries.op5_line_blocks(spark, sf).collect(), want)


def test_op5_odd(spark, table_dir):
    odd = [(1, "u", None), (2, "u", ""), (None, None, "  \n "), (4, None, "plain &amp; simple\n text"),
           (5, "u", "<p>a<p>b"), (5, "u", "<p>a<p>b"), (6, "u", "<script>x" * 3), (7, "u", "<!-- open <p>gone"),
           (8, "u", "<p>1 < 2 &lt; 3</p>"), (9, "u", "<nav>only a menu</nav>"), (10, "u", "<p>" + prose(1, 40000)),
           (11, "u", "<p title='a > b'>x</p"), (12, "u", "<<p>>y</p>")]
    df = spark.createDataFrame(odd, PAGES)
    got = {r.page_id: r.text for r in queries.op5_line_blocks(spark, table_dir(pages=df)).collect()}
    assert len(got) == 12 and got[1] == got[2] == got[None] == got[6] == got[7] == got[9] == ""
    assert got[4] == "plain & simple text" and got[5] == "a\n\nb" and got[8] == "1 < 2 < 3"
    assert got[10] == prose(1, 40000) and got[11] == "x"
    clash = line_blocks.extract(df.withColumnRenamed("url", "text"))
    assert clash.columns == ["page_id", "text"]
    assert line_blocks.extract(df.limit(0)).count() == 0


PARAS = [prose(i, 60) for i in range(4)]
MENU = "<ul>" + "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(9)) + "</ul>"


@pytest.mark.parametrize("before, after", [
    ("<nav>" + MENU + "</nav><header><p>Site name and a motto</p></header>", "<footer><p>All rights</p></footer>"),
    (MENU + '<div class="cookie-banner"><p>' + prose(50, 40) + "</p></div>",
     '<aside><p>' + prose(51, 30) + '</p></aside><div id="comments"><p>' + prose(52, 50) + "</p></div>"),
    ('<form><p>' + prose(53, 30) + '</p><input name="q"></form><style>p{}</style>',
     '<div class="sidebar"><div>' + prose(54, 30) + '</div></div><p>Copyright 2024</p>'),
    ('<div role="navigation">' + MENU + '</div><div class="ad"><p>' + prose(55, 25) + "</p></div>",
     '<section class="related-posts"><a href="x">' + prose(56, 20) + "</a></section><script>" + prose(57, 50) + "</script>"),
])
@pytest.mark.parametrize("wrap", ["article", "main", "div"])
def test_boilerplate_goes(before, after, wrap):
    body = "<h1>The headline</h1>" + "".join(f"<p>{p}</p>" for p in PARAS)
    page = f"<html><head><title>t</title></head><body>{before}<{wrap}>{body}</{wrap}>{after}</body></html>"
    assert main_text(page) == "\n\n".join(["The headline", *PARAS])


def test_advert_inside_an_article():
    page = ("<article><header><h1>Head</h1></header><p>one  two\n three&nbsp;&eacute;</p><div class='advert'><p>buy</p></div>"
            "<p>a<b>b</b>c<br>d</p><ul><li>item <a href='x'>link</a></li></ul><div class='comments'><p>first!</p></div></article>"
            "<p>" + prose(1, 200) + "</p>")
    assert main_text(page) == "Head\n\none two three é\n\nabc d\n\nitem link"


def test_unclosed_container_ends_at_the_article():
    assert main_text("<body><div class=ad><p>buy now<article><p>text of it</p></article></body>") == "text of it"


def test_sums_decide_on_given_pages(spark, monkeypatch):
    """Without the sums, menus of the given pages stay; with them, only the article does."""
    pages = [r[0] for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("html").collect()]
    unmarked = [re.sub(r"<(/?)article>", r"<\1div>", p) for p in pages]
    want = [article_of(p) for p in pages]
    assert [main_text(p) for p in pages] == want and [main_text(p) for p in unmarked] == want
    monkeypatch.setattr(line_blocks, "cut", lambda weight, level: [(0, len(weight), True)])
    monkeypatch.setattr(line_blocks, "_whole_run", lambda found, a, b: (a, b))
    monkeypatch.setattr(line_blocks.Line, "menu", False)
    changed = [main_text(p) != w for p, w in zip(unmarked, want)]
    assert all(changed)


def test_links_of_marked_articles():
    page = ("<p>outside</p><article><h1>Head</h1><p>x</p><p><a href='u'>a link</a></p></article><ul><li>1<li>2<li>3</ul>"
            "<article><p>second</p></article>")
    assert main_text(page) == "Head\n\nx\n\na link\n\nsecond"
    inner = "".join(f"<li><a href='{i}'>part {i}</a></li>" for i in range(5))
    for menu in (f"<ul>{inner}</ul>", f"<nav>{inner}</nav>", f'<div class="social-links">{inner}</div>'):
        assert main_text(f"<article><h1>Head</h1><p>{PARAS[0]}</p>{menu}<p>{PARAS[1]}</p>{menu}</article>") == "\n\n".join(
            ["Head", *PARAS[:2]])
    assert main_text("<article><p><a href='x'>only a link</a></p></article>") == "only a link"


AD = '<div class="advert"><p>' + prose(60, 30) + "</p></div>"


@pytest.mark.parametrize("page, want", [
    (f"<div><p>{PARAS[0]}</p></div>{AD}<div><p>The end.</p></div>", [PARAS[0], "The end."]),
    (f"<div><p>{PARAS[0]}</p><p><a href='x'>Read the whole report</a></p></div>", [PARAS[0], "Read the whole report"]),
    (f"<article><p>{PARAS[0]}</p><p><a href='x'>Read the whole report</a></p></article>", [PARAS[0], "Read the whole report"]),
    (f"<div><p>{PARAS[0]}</p></div>{AD}<div><p>So it was.</p></div>{AD}<div><p>{PARAS[1]}</p></div>", [PARAS[0], "So it was.", PARAS[1]]),
    (f'<article><div class="article-header"><h1>Title</h1></div><p>{PARAS[0]}</p></article>', ["Title", PARAS[0]]),
    (f'<article><p>{PARAS[0]}</p><div class="social-history"><p>{PARAS[1]}</p></div></article>', PARAS[:2]),
    (f'<div><div class="entry-header"><h1>Title</h1></div><p>{PARAS[0]}</p></div>', ["Title", PARAS[0]]),
    (f'<div><p>{PARAS[0]}</p></div><div class="site-footer-2"><p>{PARAS[1]}</p></div>', PARAS[:1]),
])
def test_no_text_is_lost(page, want):
    assert main_text(f"<html><body><nav>{MENU}</nav>{page}<footer><p>{PARAS[3]}</p></footer></body></html>") == "\n\n".join(want)


@pytest.mark.parametrize("lengths", [[900, 900, 900, None, 350], [60, 6000, 500, 5000, 70, 120], [20, None, 6000, None, 15],
                                     [900, "links", 20], [12, 9, None, 7], [900, None, None, 30, 30, "links", 30]])
@pytest.mark.parametrize("wrap", ["body", "div", "section"])
def test_unmarked_pages_lose_no_paragraph(lengths, wrap):
    other = {None: '<div class="advert"><p>' + prose(60, 30) + "</p><div>buy</div></div>", "links": MENU}
    texts = {i: prose(i, n)[:n - 1].replace(" ", "x") + "." for i, n in enumerate(lengths) if isinstance(n, int)}
    body = "".join(f"<p>{texts[i]}</p>" if i in texts else other[n] for i, n in enumerate(lengths))
    page = f"<nav>{MENU}</nav><{wrap}>{body}</{wrap}><footer><p>{prose(61, 20)}</p></footer>"
    assert main_text(page) == "\n\n".join(texts.values())


# ---- 6 ----------------------------------------------------------------------------------------

def test_op6_on_pages(spark):
    for sf in (SF_SMALL, "/root/testdata/sf0.01"):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
        same_rows(queries.op6_url_lists(spark, sf).collect(), con.execute(queries.ORACLE["op6_url_lists"]).fetchall())


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def test_op6_odd(spark, table_dir):
    urls = ["http://A.b.Example.com:80/x/y/z/w?q#f", "//user:pw@h.org/", "https://h.org", None, "", "no address", "http://",
            "http://localhost/a//b/", "https://h.org.", "ftp://1.2.3.4/x"]
    caps = spark.createDataFrame([(i, u, day(5), "k") for i, u in enumerate(urls)] + [(2, urls[2], day(5), "k"), (99, urls[0], None, "k")],
                                 "id long, url string, fetch_day date, value string")
    ent = spark.createDataFrame([("example.com", day(1), True), ("a.b.example.com/x/y", day(5), True), ("h.org", day(2), True),
                                 ("h.org", day(4), False), ("h.org", day(4), True), ("localhost/a", day(6), True), (None, day(1), True),
                                 ("1.2.3.4", None, True), ("1.2.3.4/x", day(0), True), ("1.2.3.4/x", day(0), True),
                                 ("a.b.example.com", day(1), False)], "value string, day date, added boolean")
    got = url_lists.listed_captures(caps, ent)
    rows = {r.id: (r.n_listed, r.first_listed, r.listed) for r in got.collect()}
    assert rows[0] == (2, "a.b.example.com/x/y", True) and rows[9] == (1, "1.2.3.4/x", True)
    assert all(rows[i] == (0, None, False) for i in (1, 2, 3, 4, 5, 6, 7, 8, 99))
    assert got.count() == len(urls) + 2 and got.columns == [*caps.columns, "n_listed", "first_listed", "listed"]
    assert url_lists.listed_captures(caps.limit(0), ent).count() == 0
    assert {r.listed for r in url_lists.listed_captures(caps, ent.limit(0)).collect()} == {False}
    empty = spark.createDataFrame([], PAGES)
    assert queries.op6_url_lists(spark, table_dir(pages=empty)).count() == 0


def test_deep_paths_and_domains(spark):
    """Against every prefix and parent domain, built in plain Python."""
    hosts = ["h.org", "a.h.org", "x.y.a.h.org", "x.y.a.h.org.uk", "b.org"]
    paths = ["", "/a", "/a/b/c/d", "/a/b/c/d/e", "/a/b/c/d/e/f/g/h/i/j/k", "/a/b/c/x/e", "/a//c/d/e"]
    caps = [(i, "https://" + h + p, day(3 + i % 3)) for i, (h, p) in enumerate((h, p) for h in hosts for p in paths)]
    ents = [("h.org/a/b/c/d", 1), ("h.org/a/b/c/d/e/f/g/h/i", 4), ("a.h.org", 1), ("a.h.org/a/b/c/d/e", 2), ("h.org", 5),
            ("y.a.h.org.uk", 1), ("org.uk", 4), ("x.y.a.h.org/a//c/d", 1), ("b.org/a/b/c/d/e/f/g/h/i/j/k", 1)]

    def listed(url, on):
        host, _, path = url.removeprefix("https://").partition("/")
        labels, steps = host.split("."), path.split("/") if path else []
        keys = {".".join(labels[-k:]) for k in range(2, len(labels) + 1)} | {
            "/".join([host, *steps[:k]]) for k in range(1, len(steps) + 1) if steps[k - 1]}
        return sorted(v for v, d in ents if v in keys and day(d) <= on)

    got = url_lists.listed_captures(spark.createDataFrame(caps, "id long, url string, fetch_day date"),
                                    spark.createDataFrame([(v, day(d), True) for v, d in ents], "value string, day date, added boolean"))
    want = [(i, u, on, len(hit), hit[0] if hit else None, bool(hit)) for i, u, on in caps for hit in [listed(u, on)]]
    same_rows(got.collect(), want)


def test_intervals(spark):
    ent = spark.createDataFrame([("v", day(d), a) for d, a in ((1, True), (3, False), (3, False), (4, False), (6, True), (7, True))],
                                "value string, day date, added boolean")
    same_rows(url_lists.validity_intervals(ent).collect(),
              [("v", day(1), day(3)), ("v", day(6), day(7)), ("v", day(7), None)])
