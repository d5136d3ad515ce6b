"""Main-text extraction by the distribution of text over line blocks.

1. *Strip.*  A page becomes a list of lines: every block-level tag ends a line,
   inline tags vanish, character references are decoded, white space becomes one
   space.  Scripts, styles, comments and the parts that markup names as headers,
   footers, sidebars, notices, adverts, forms or reader comments are
   removed; they leave empty lines if the text on their two sides stands in
   different containers, so an advert inside a text does not cut it.
2. *Sum.*  Each line weighs its characters outside links, on every page; all text of a
   menu (``nav`` and parts named so) counts as a link.  A block's sum runs over a sliding
   window of ``WINDOW`` lines.
3. *Cut.*  A surge point is where the sum rises from nothing, and a dive point where it falls to
   nothing again; what lies between is a run.  Menus and lists of links have no sums, so they
   end runs and are no part of one.  A run's title stays with it, and so do fewer than
   ``WINDOW`` paragraphs that are links at its two ends, in its container.
4. *Choose.*  If the page marks an article or main part, the runs with lines in it are kept, and of
   them those lines.  Else a run is kept if a sum in it reaches the level; a shorter one if it stands
   in the container of a kept line that reaches the level alone, or if nothing but removed
   parts lies between it and a kept run and it reads like a sentence.

The level is ``LEVEL`` characters, or one character on pages whose sums nowhere reach it, so
the length of other paragraphs does not matter.  Nothing is capped.  Each page
is one row of work: no shuffle.

Edge cases: null or empty html, and pages without text, give the empty text; a very long page is
held whole in its task, and the time is linear in its length; repeated rows each give their
row and an empty table gives none.  Unclosed elements end at the parent's end, an unclosed container
at the article or page end; text outside any tag is a line.  Output columns replace columns of
the same name.
"""

from __future__ import annotations

import html as _html
import re
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from kestrel.session import ship_package

WINDOW = 3
#: A run of lines is a text if a block sum in it reaches this many characters.
LEVEL = 50

# Element names of HTML by their role, and words that name boilerplate.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary "
    "table tbody td tfoot th thead title tr ul".split())
MENU_TAGS = frozenset("nav menu".split())
SKIPPED = frozenset(
    "footer aside form head title button select option label input iframe object canvas svg math audio "
    "video map dialog noscript template fieldset".split())
RAW = frozenset("script style textarea xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE = frozenset(("article", "main"))
CONTAINERS = frozenset(("div", "section", "td", *ARTICLE))
#: Words that name a removed part wherever a class or id begins or ends with them.
STRONG = frozenset(
    "advert adverts advertisement advertising adsense sponsor sponsored sponsors cookie cookies gdpr comment comments commentlist "
    "disqus newsletter".split())
#: Words that do so alone, or beside words that only place or shape a part.
WEAK = frozenset(
    "ad ads banner banners promo promotion promoted consent notice notices alert popup modal overlay "
    "header masthead footer foot colophon sidebar sidebars aside widget widgets rail "
    "respond replies reply discussion subscribe subscription signup login search copyright".split())
MENUS = frozenset(
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager toolbar topbar share sharing social related "
    "recommended".split())
PLACES = frozenset(
    "site page global top bottom left right upper lower primary secondary first last inner outer wrap wrapper container box bar "
    "block area section module panel slot zone list links link item items buttons icons text posts articles stories form".split())
ROLES = frozenset("banner contentinfo complementary search form dialog alert alertdialog".split())
MENU_ROLES = frozenset("navigation menu menubar".split())
SENTENCE_ENDS = tuple(".!?…:\"'»”’)")
NOTICES = ("copyright", "©", "(c)")

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                  r"|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_NAMED = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z0-9]+")


def _named(value: str, words: frozenset) -> bool:
    """Does a class or id token name such a part: by one word, or by words that otherwise only place it?"""
    for token in value.split():
        parts = _WORD.findall(token)
        if token in words or any(p in words for p in parts) and all(p in words or p in PLACES or p.isdigit() for p in parts):
            return True
    return False


def kind_of(name: str, attrs: str, in_article: bool) -> str:
    """``gone`` for a removed part, ``menu`` for links, or the empty string."""
    if name in SKIPPED:
        return "gone"
    if name in MENU_TAGS:
        return "menu"
    if name == "header":
        return "" if in_article else "gone"  # an article's own header holds its title
    if name in ("html", "body", *ARTICLE) or not attrs.strip():
        return ""
    found = ""
    for key, value in _NAMED.findall(attrs):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" and not value or key == "aria-hidden" and value == "true":
            return "gone"
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return "gone"
        if key == "role":
            if value in ROLES:
                return "gone"
            found = "menu" if value in MENU_ROLES else found
        if key in ("class", "id"):
            if _named(value, WEAK) or any(p in STRONG for t in value.split() for p in (*_WORD.findall(t)[:1], *_WORD.findall(t)[-1:])):
                return "gone"
            found = "menu" if _named(value, MENUS) else found
    return found


class Line(NamedTuple):
    """A line; ``weight`` counts its characters outside links, ``gap`` is an empty line for a removed part."""
    text: str
    weight: int = 0
    heading: bool = False
    paragraph: bool = False
    menu: bool = False
    article: bool = False
    container: int = 0
    gap: bool = False


def lines(page: str) -> list[Line]:
    """The lines of a page.  A removed part or a menu between two containers leaves a window of
    empty lines, so that blocks on its two sides do not meet."""
    out: list[Line] = []
    within: list[tuple[str, int]] = []  # open containers
    menus: list[tuple[str, int]] = []  # open menu elements and how many of their name are open inside
    opened = linked = links = heading = paragraph = article = 0
    removed = False  # something since the last line
    words: list[str] = []
    skip: list[str] = []  # open elements since the removed container, it first
    at, n = 0, len(page)

    def end():
        nonlocal linked, removed
        text = " ".join("".join(words).split())
        if text:
            here = within[-1][1] if within else 0
            if removed and out and out[-1].container != here:
                out.extend([Line("", container=here, article=bool(article), gap=True)] * WINDOW)
            removed = False
            out.append(Line(text, 0 if menus else max(0, len(text) - linked), bool(heading), bool(paragraph), bool(menus),
                            bool(article), here))
        words.clear()
        linked = 0

    def put(raw):
        nonlocal linked
        if not skip and raw:
            text = _html.unescape(raw)
            words.append(text)
            if links:
                linked += len(" ".join(text.split()))

    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            put(page[at:])
            break
        put(page[at:m.start()])
        at = m.end()
        closing, name, attrs = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if name in RAW:
            if not closing:
                stop = re.compile(rf"</{name}", re.I).search(page, at)
                at = stop.start() if stop else n
            continue
        if skip:
            if name in ARTICLE and not closing and not article or name in ("body", "html") and closing:
                skip.clear()  # the container was never closed
                end()
            elif closing:
                if name in skip:
                    del skip[len(skip) - 1 - skip[::-1].index(name):]
                    if not skip:
                        end()
                elif name in ARTICLE and article:
                    skip.clear()
                    end()
                if not (name in ARTICLE and not skip):
                    continue
            else:
                if name not in VOID and name in (skip[0], "div", "section", "ul", "table"):
                    skip.append(name)
                continue
        if menus and (name in ARTICLE or name in ("body", "html")):
            end()
            menus.clear()  # never closed
        if menus and name == menus[-1][0]:
            if closing:
                end()
                menus[-1] = (name, menus[-1][1] - 1)
                if not menus[-1][1]:
                    menus.pop()
                    removed = True
            elif name not in VOID:
                menus[-1] = (name, menus[-1][1] + 1)
        if closing:
            if name in CONTAINERS:
                end()
                if any(name == c for c, _ in within):
                    while within.pop()[0] != name:
                        pass
            if name in ARTICLE:
                article = max(0, article - 1)
            elif name == "a":
                links = max(0, links - 1)
            elif name in BLOCKS:
                end()
                paragraph = 0
                if name[0] == "h" and name[1:].isdigit():
                    heading = 0
            continue
        if name == "br":
            words.append(" ")
            continue
        kind = "" if name in VOID or menus else kind_of(name, attrs, bool(article))
        if kind == "gone" or menus and name in SKIPPED:
            end()
            removed = True
            skip.append(name)
            continue
        if kind == "menu":
            end()
            removed = True
            menus.append((name, 1))
        if name in CONTAINERS:
            end()
            opened += 1
            within.append((name, opened))
        if name in ARTICLE:
            end()
            article += 1
        elif name == "a":
            links = 1
        elif name in BLOCKS:
            end()
            heading = int(name[0] == "h" and name[1:].isdigit())
            paragraph = int(name == "p")
            links = 0
    end()
    return out


def block_sums(weight: list[int]) -> list[int]:
    """Sum of every window of ``WINDOW`` lines, by its first line."""
    return [sum(weight[i:i + WINDOW]) for i in range(len(weight))]


def cut(weight: list[int], level: float) -> list[tuple[int, int, bool]]:
    """(surge, dive, does a block sum reach ``level``) of every run of lines with positive sums."""
    block = block_sums(weight)
    out: list[tuple[int, int, bool]] = []
    i = 0
    while i < len(block):
        start = i
        while i < len(block) and block[i] > 0:
            i += 1
        if i > start:
            out.append((start, i, max(block[start:i]) >= level))
        i += 1
    return out


def _whole_run(found: list[Line], first: int, last: int) -> tuple[int, int]:
    """A run without the links before its first and after its last line of text, but with its title
    and with less than a window of link paragraphs at its ends."""
    def text(i):
        return 2 * found[i].weight >= max(1, len(found[i].text))

    while first < last and not text(first):
        first += 1
    while last > first and not text(last - 1):
        last -= 1
    if first == last:
        return first, last

    def more(step, i):
        """Link paragraphs from ``i`` on, if they are fewer than a window and nothing else follows in the container."""
        n, home = 0, found[i - step].container
        while 0 <= i < len(found) and found[i].container == home and not found[i].weight and found[i].paragraph and not found[i].menu:
            i, n = i + step, n + 1
        return n if n < WINDOW and not (0 <= i < len(found) and found[i].container == home and not found[i].weight
                                        and found[i].text and not found[i].heading) else 0
    last += more(1, last)
    first -= more(-1, first - 1)
    if first and found[first - 1].heading:
        first -= 1
    return first, last


def _sentence(run: list[Line]) -> bool:
    text = [x.text for x in run if x.text]
    return all(t.endswith(SENTENCE_ENDS) and not t.lower().startswith(NOTICES) for t in text)


def main_text(page: str | None) -> str:
    """Text between the surge and dive points of ``page``, lines joined by an empty line."""
    found = lines(page or "")
    marked = any(x.article and x.text and not x.menu for x in found)
    weight = [x.weight for x in found]
    most = max((w for x, w in zip(found, block_sums(weight)) if x.article or not marked), default=0)
    level = LEVEL if most >= LEVEL else 1
    runs = [(*_whole_run(found, a, b), strong) for a, b, strong in cut(weight, level)]
    runs = [r for r in runs if r[0] < r[1]]
    if marked:
        inside = [i for a, b, _ in runs for i in range(a, b) if found[i].article]
        if not inside:  # an article of links only
            inside = [i for i, x in enumerate(found) if x.article and not x.menu]
        return "\n\n".join(found[i].text for i in dict.fromkeys(inside) if found[i].text and not found[i].menu)
    full = {found[i].container for a, b, strong in runs if strong for i in range(a, b) if weight[i] >= level}
    keep = [strong or all(found[i].container in full for i in range(a, b) if found[i].text) for a, b, strong in runs]
    for order in (range(1, len(runs)), range(len(runs) - 2, -1, -1)):  # neighbours behind, then in front
        for k in order:
            near = k - 1 if order.step > 0 else k + 1
            a, b = min(runs[k], runs[near])[1], max(runs[k], runs[near])[0]
            if keep[near] and not keep[k] and a < b and all(found[i].gap for i in range(a, b)):
                keep[k] = _sentence(found[runs[k][0]:runs[k][1]])
    return "\n\n".join(x.text for (a, b, _), kept in zip(runs, keep) if kept for x in found[a:b] if x.text and not x.menu)


def extract(df: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """``df`` without ``html_col`` and with ``out``, the main text of each page."""
    ship_package(df.sparkSession)
    kept = [c for c in df.columns if c not in (html_col, out)]
    schema = T.StructType([*df.select(*kept).schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = pa.array([main_text(p.as_py()) for p in b.column(html_col)], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), texts], names=[*kept, out])

    return df.select(*kept, html_col).mapInArrow(run, schema)
