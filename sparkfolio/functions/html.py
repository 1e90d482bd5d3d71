"""HTML operators as Arrow-batched pandas UDFs over the standard library's parser."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from sparkfolio.functions.scalars import date_span, long_date_span, strip

# Elements without content, and what is no content of a page: tags, classes and ids.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
DROP_TAGS = frozenset(["script", "style", "nav", "footer", "header", "iframe", "noscript", "svg", "form", "aside"])
DROP_CLASSES = frozenset([
    "nav", "footer", "header", "menu", "sidebar", "cookie", "breadcrumb", "share", "social", "ad", "newsletter", "popup", "modal",
    "overlay", "announcement", "promo", "banner", "widget", "related", "recommended", "tags", "comments", "pagination",
])
DROP_IDS = frozenset(["menu", "footer", "header"])
# Where content is looked for first, and how long it must be; parts of image urls that decorate, and that picture.
CONTAINER_TAGS = ("main", "article")
CONTAINER_CLASSES = ("content", "exhibition-content")
LEAST_CONTAINER, LEAST_PAGE = 300, 200
IMAGE_NOISE = "logo|icon|avatar|pixel|tracking|badge|nav|footer"
IMAGE_TYPES = r"\.jpg|\.jpeg|\.png|\.webp"


def _batched(kind: str):
    """A pandas UDF made at its first use, when a session exists."""

    def wrap(f):
        def call(*columns):
            return pandas_udf(f, kind)(*columns)

        call.__doc__ = f.__doc__
        return call

    return wrap


class _Tree(HTMLParser):
    """Elements and text runs in order; unclosed tags close with their parents.

    Of each element the one around it, and the span of the elements and runs
    inside it, so a page takes time and memory in proportion to its length,
    however deep its tags nest.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[int] = []
        self.open: Counter[str] = Counter()
        self.elements: list[tuple[str, dict]] = []
        self.parents: list[int | None] = []
        self.spans: list[tuple[int, int]] = []
        self.first_runs: list[int] = []
        self.runs: list[str] = []

    def handle_starttag(self, tag, attrs):
        self.elements.append((tag, {k: v or "" for k, v in reversed(attrs)}))
        self.parents.append(self.stack[-1] if self.stack else None)
        self.spans.append((len(self.elements), len(self.runs)))
        self.first_runs.append(len(self.runs))
        if tag not in VOID:
            self.stack.append(len(self.elements) - 1)
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        while self.open[tag]:
            if self._leave() == tag:
                return

    def _leave(self) -> str:
        """Close the innermost element; its tag."""
        i = self.stack.pop()
        self.spans[i] = (len(self.elements), len(self.runs))
        tag = self.elements[i][0]
        self.open[tag] -= 1
        return tag

    def handle_data(self, data):
        if not self.stack or self.elements[self.stack[-1]][0] not in ("script", "style", "template"):
            self.runs.append(data)

    def close(self):
        super().close()
        while self.stack:
            self._leave()

    def dropped(self) -> set[int]:
        """Elements that are no content."""
        out = set()
        for i, (tag, a) in enumerate(self.elements):
            if tag in DROP_TAGS or (tag != "body" and (not DROP_CLASSES.isdisjoint(_classes(a)) or a.get("id") in DROP_IDS)):
                out.add(i)
        return out

    def runs_in(self, element: int) -> list[str]:
        return self.runs[self.first_runs[element] : self.spans[element][1]]

    def runs_outside(self, gone: set[int]) -> list[str]:
        """Text runs that no element of ``gone`` holds."""
        out, at = [], 0
        for i in sorted(gone):
            out += self.runs[at : self.first_runs[i]]
            at = max(at, self.spans[i][1])
        return out + self.runs[at:]

    def text_in(self, element: int) -> str:
        """The stripped text runs inside an element, joined."""
        return "".join(t.strip() for t in self.runs_in(element))

    def inside(self, element: int) -> range:
        return range(element + 1, self.spans[element][0])

    def around(self, element: int) -> Iterator[int]:
        """The elements that hold an element, innermost first."""
        while (element := self.parents[element]) is not None:
            yield element


def _classes(a: dict) -> list[str]:
    return a.get("class", "").split()


def tidy(text: str) -> str:
    """Lines and double-space phrases, each stripped, blanks dropped, joined by newlines."""
    chunks = (phrase.strip() for line in text.splitlines() for phrase in line.strip().split("  "))
    return "\n".join(x for x in chunks if x)


def _parse(page: str | None) -> _Tree:
    tree = _Tree()
    tree.feed(page or "")
    tree.close()
    return tree


def clean_text(page: str | None) -> str:
    """Readable text: the first container of 300 characters or more, else the page without navigation and the like.

    The meta description comes first before a container, and before a page's text under 200 characters.
    """
    tree = _parse(page)
    metas = [a.get("content", "").strip() for t, a in tree.elements if t == "meta" and a.get("name") == "description"]
    meta = metas[0] if metas else ""
    tests = [
        *((lambda t, a, x=x: t == x) for x in CONTAINER_TAGS),
        lambda t, a: a.get("role") == "main",
        *((lambda t, a, x=x: x in _classes(a)) for x in CONTAINER_CLASSES),
    ]
    for test in tests:
        first = next((i for i, (t, a) in enumerate(tree.elements) if test(t, a)), None)
        if first is not None:
            text = tidy("\n".join(tree.runs_in(first)))
            if len(text) >= LEAST_CONTAINER:
                return f"{meta}\n{text}" if meta else text
    text = tidy("\n".join(tree.runs_outside(tree.dropped())))
    return f"{meta}\n{text}" if meta and len(text) < LEAST_PAGE else text


def fragment_text(page: str | None) -> str | None:
    """Text runs of a fragment on lines of their own, stripped as a whole; null without any."""
    return "\n".join(_parse(page).runs).strip() or None


@_batched("string")
def clean_html(pages: pd.Series) -> pd.Series:
    return pages.map(clean_text)


@_batched("string")
def html_to_text(pages: pd.Series) -> pd.Series:
    return pages.map(fragment_text)


def _attributes(page: str | None, base: str | None, tag: str, name: str) -> list[dict]:
    out = []
    for t, a in _parse(page).elements:
        if t == tag and name in a:
            try:
                out.append({"raw": a[name].strip(), "url": urljoin(base or "", a[name].strip())})
            except ValueError:
                continue
    return out


@_batched("array<struct<raw:string,url:string>>")
def anchors(pages: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([_attributes(p, b, "a", "href") for p, b in zip(pages, bases, strict=True)])


@_batched("array<struct<raw:string,url:string>>")
def images(pages: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([_attributes(p, b, "img", "src") for p, b in zip(pages, bases, strict=True)])


@_batched("string")
def title_key(titles: pd.Series) -> pd.Series:
    """NFKC, trimmed, lower case; no built-in function normalises Unicode."""
    return titles.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).strip().lower())


# Parts of class names that label a card, and elements whose text is no label.
CARD_PARTS = ("teaser", "card")
LABEL_PARTS = ("category", "type", "meta", "label", "tag")
NO_LABELS = ("h3", "h4", "p")
DEFAULT_TAGS = ["Exhibitions"]


def cards(page: str | None, base: str | None, detail: str, event: Callable[[str], bool], event_type: Callable[[str], bool]) -> dict[str, list[str]]:
    """Tags of each card of a listing that shows an exhibition, by its detail url with one closing slash.

    Cards are sections of class teaser, else elements whose class names a card
    or teaser. Tags are the texts of ?type= links and labels; those of 25
    characters or more or with digits don't count. A card drops out if a type
    link, its detail url or its heading tells of an event. Without cards,
    links themselves are taken, with the ?type= texts of the block around.
    """
    tree = _parse(page)
    resolve = lambda i: urljoin(base or "", tree.elements[i][1]["href"].strip())
    is_link = lambda i: tree.elements[i][0] == "a" and "href" in tree.elements[i][1]
    whole = lambda a: a.get("class", "")
    found = [i for i, (t, a) in enumerate(tree.elements) if t == "section" and "teaser" in _classes(a)]
    found = found or [i for i, (_, a) in enumerate(tree.elements) if any(x in whole(a) for x in CARD_PARTS)]
    out: dict[str, list[str]] = {}
    for card in found:
        inside = tree.inside(card)
        links = [i for i in inside if is_link(i)]
        typed = [i for i in links if "?type=" in resolve(i)]
        is_event = any(event_type(resolve(i)) for i in typed)
        tags = [tree.text_in(i) for i in typed]
        for i in inside:
            t, a = tree.elements[i]
            if t not in NO_LABELS and any(x in whole(a) for x in LABEL_PARTS):
                text = tree.text_in(i)
                if text and len(text) < 40:
                    tags += [x.strip() for x in re.split(r",\s*", text)]
        tags = [x for x in dict.fromkeys(tags) if x and len(x) < 25 and not any(c.isdigit() for c in x)]
        urls = (resolve(i) for i in links)
        url = next((u for u in urls if re.search(detail, u) and "?" not in u and "/archive/" not in u and not u.endswith("/whats-on/")), None)
        if url is None:
            continue
        url = url.rstrip("/") + "/"
        heading = next((tree.text_in(i) for i in inside if tree.elements[i][0] == "h3"), "")
        if not (is_event or event(url) or event(heading)):
            out[url] = tags or DEFAULT_TAGS
    if not found:
        for i in range(len(tree.elements)):
            if not is_link(i) or not re.search(detail, resolve(i)) or event(resolve(i)) or event(tree.text_in(i)):
                continue
            around = next((j for j in tree.around(i) if tree.elements[j][0] in ("div", "section", "article")), None)
            tags = [] if around is None else [tree.text_in(j) for j in tree.inside(around) if is_link(j) and "?type=" in tree.elements[j][1]["href"]]
            out[resolve(i).rstrip("/") + "/"] = [x for x in dict.fromkeys(tags) if x] or DEFAULT_TAGS
    return out


def card_tags(html: Column, base: Column, detail: str) -> Column:
    """map of detail url to tags of the cards that show exhibitions; ``detail`` is the pattern of their urls."""
    from sparkfolio.operators.extraction import EVENT_PATTERN, EVENT_TYPES

    words = re.compile(EVENT_PATTERN)

    @pandas_udf("map<string,array<string>>")
    def udf(pages: pd.Series, bases: pd.Series) -> pd.Series:
        event = lambda x: bool(words.search(x))
        event_type = lambda u: any(f"type={t}" in u for t in EVENT_TYPES)
        return pd.Series([cards(p, b, detail, event, event_type) for p, b in zip(pages, bases, strict=True)])

    return udf(html, base)


def page_links(html: Column, base: Column, listing: list[str], patterns: list[str]) -> Column:
    """Sorted distinct resolved links that match a pattern and aren't a listing page."""
    strip = [u.rstrip("/") for u in listing]
    hit = F.filter(
        anchors(html, base),
        lambda x: ~F.regexp_replace(x["url"], "/+$", "").isin(strip) & F.exists(F.array(*map(F.lit, patterns)), lambda p: F.rlike(x["url"], p) | F.rlike(x["raw"], p)),
    )
    return F.array_sort(F.array_distinct(F.transform(hit, lambda x: x["url"])))


def page_images(html: Column, base: Column, most: int = 8) -> Column:
    """The first distinct picture urls, without decoration."""
    ok = F.filter(F.transform(images(html, base), lambda x: x["url"]), lambda u: ~F.lower(u).rlike(IMAGE_NOISE) & F.lower(u).rlike(IMAGE_TYPES))
    return F.slice(F.array_distinct(ok), 1, most)


def link_diagnosis(html: Column, base: Column, patterns: list[str], most: int = 10) -> Column:
    """struct(total, matched, candidates): links of a page, distinct ones that match, and, without any, paths that look like exhibitions."""
    all_links = anchors(html, base)
    fits = lambda x: F.exists(F.array(*map(F.lit, patterns)), lambda p: F.rlike(x["url"], p) | F.rlike(x["raw"], p))
    matched = F.array_distinct(F.transform(F.filter(all_links, fits), lambda x: x["url"]))
    like = F.filter(F.transform(all_links, lambda x: x["raw"]), lambda r: F.lower(r).rlike("exhib|show|event|program"))
    like = F.slice(F.array_sort(F.array_distinct(like)), 1, most)
    return F.struct(F.size(all_links).alias("total"), F.size(matched).alias("matched"), F.when(F.size(matched) == 0, like).otherwise(F.array().cast("array<string>")).alias("candidates"))


def json_ld_event(html: Column) -> Column:
    """struct(name, description, start_date, end_date) of the first ExhibitionEvent in the page's JSON-LD blocks; null fields without one."""
    kind = "struct<`@type`:string,name:string,description:string,startDate:string,endDate:string>"
    blocks = F.regexp_extract_all(html, F.lit(r'(?is)<script[^>]*type="?application/ld\+json[^>]*>(.*?)</script>'), F.lit(1))
    found = F.flatten(F.transform(blocks, lambda b: F.coalesce(F.from_json(b, f"array<{kind}>"), F.array(F.from_json(b, kind)))))
    event = F.get(F.filter(found, lambda e: e["@type"] == "ExhibitionEvent"), F.lit(0))
    day = lambda c: F.substring(event[c], 1, 10)
    return F.struct(
        F.when(event.isNotNull(), strip(F.coalesce(event["name"], F.lit("")))).alias("name"), F.nullif(strip(event["description"]), F.lit("")).alias("description"),
        day("startDate").alias("start_date"), day("endDate").alias("end_date"),
    )


def _untagged(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def _heading(html: Column) -> Column:
    """The text of the first h1, or empty."""
    return strip(_untagged(F.regexp_extract(html, r"(?s)<h1[^>]*>(.*?)</h1>", 1)))


def _cut_at(c: Column, words: tuple[str, ...]) -> Column:
    """Text before the first of the words, in their order, that it holds."""
    out = None
    for w in words:
        part = strip(F.substring_index(c, w, 1))
        out = F.when(c.contains(w), part) if out is None else out.when(c.contains(w), part)
    return out.otherwise(c)


# Fixed values of the Chinese page: its house, words that end a place or a list of curators, text that is no introduction.
HOUSE, HOUSE_EN = "上海当代艺术博物馆", "Power Station of Art"
PLACE_ENDS = ("策展人", "主办", "承办", "协办", "支持", "特别")
CURATOR_ENDS = ("主办", "承办", "协办", "支持", "特别支持", "展期", "地点", "赞助", '计划"', "自")
CURATOR_SEPARATORS = ("、", "，", ",", "  ")
NO_CURATORS = ("策展", "计划", "自")
BOILERPLATE = ("中国大陆第一家公立当代艺术博物馆", "坐落于黄浦江畔", "前身为", "Power Station of Art", "上海当代艺术博物馆（")
NO_PREFACE = ("关于PSA", "参观购票", "沪ICP", "展览时间", "展览地点", "策展人")


def page_fields(html: Column, url: Column) -> Column:
    """struct(title, start_date, end_date, location, curators, preface, concept) of a Chinese exhibition page; null without a title.

    The title is the h1, or the page's where that is under 5 characters. A
    biennale's concept is what follows the colon of its title, or stands in
    quotes before its edition.
    """
    text = _untagged(html)
    h1 = _heading(html)
    meta = strip(F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1))
    title = F.when((F.length(h1) < 5) & html.rlike(r"(?s)<title>(.*?)</title>"), meta).otherwise(h1)
    span = date_span(text)
    place = _cut_at(strip(F.regexp_extract(text, r"(?U)地点\s+([^\n\r]{2,40})", 1)), PLACE_ENDS)
    raw = F.nullif(F.regexp_extract(text, r"(?U)策展人\s*:?\s*([^\n\r]{2,60})", 1), F.lit(""))
    named = _cut_at(strip(raw), CURATOR_ENDS)
    none = F.array().cast("array<string>")
    fits = lambda x: (x != "") & (F.length(x) <= 15) & ~_holds(x, NO_CURATORS)
    parts = None
    for sep in CURATOR_SEPARATORS:
        cut = F.filter(F.transform(F.split(named, sep), strip), fits)
        parts = F.when(named.contains(sep), cut) if parts is None else parts.when(named.contains(sep), cut)
    parts = F.coalesce(parts, none)
    curators = F.when(raw.isNull(), none).when((F.size(parts) == 0) & (F.length(named) <= 15), F.array(named)).otherwise(parts)
    paragraphs = F.transform(F.regexp_extract_all(html, F.lit(r"(?s)<p[^>]*>(.*?)</p>"), F.lit(1)), lambda p: strip(F.regexp_replace(_untagged(p), r"(?U)\s+", " ")))
    preface = F.get(F.filter(paragraphs, lambda p: (F.length(p) > 40) & ~_holds(p, BOILERPLATE + NO_PREFACE)), F.lit(0))
    theme = F.nullif(strip(F.regexp_extract(title, r'(?U)[:：]\s*"?(.*?)"?\s*$', 1)), F.lit(""))
    quoted = F.nullif(F.regexp_extract(text, r'(?U)"([^"]{2,30})"\s*[:：]?\s*第[\d一二三四五六七八九十]+届上海双年展', 1), F.lit(""))
    concept = F.when(url.contains("biennale"), F.coalesce(theme, quoted))
    ok = (F.length(title) >= 2) & (title != HOUSE_EN)
    return F.when(
        ok,
        F.struct(
            title.alias("title"), span["start"].alias("start_date"), span["end"].alias("end_date"),
            F.when(F.length(place) >= 2, place).otherwise(F.lit(HOUSE)).alias("location"), curators.alias("curators"), preface.alias("preface"), concept.alias("concept"),
        ),
    )


def _holds(c: Column, words: tuple[str, ...]) -> Column:
    return c.rlike("|".join(re.escape(w) for w in words))


# Fixed values of the English page: words of lines that are navigation.
NAVIGATION = (
    "Skip To", "Home Page", "Visitor Guidelines", "Accessibility", "Tours", "Restaurant", "Exhibitions", "Events", "Learn",
    "About", "Support", "Shop", "SEARCH", "TICKETS", "New Museum Home Page",
)


def english_page_fields(html: Column) -> Column:
    """struct(title, start_date, end_date, curators, preface) of an English exhibition page; null without an h1.

    Dates stay as written. Curators are what follows "curated by", split at
    commas up to two commas in a row, without parts that say Curator; the
    preface is the first line over 80 characters that isn't navigation.
    """
    text = _untagged(html)
    title = _heading(html)
    span = long_date_span(text)
    tail = F.element_at(F.split(F.regexp_extract(text, r"(?is)curated by\s+(.*)$", 1), ",,"), 1)
    curators = F.filter(F.transform(F.split(tail, ","), strip), lambda c: (c != "") & ~c.contains("Curator"))
    lines = F.transform(F.split(text, "\n"), strip)
    preface = F.get(F.filter(lines, lambda x: (F.length(x) > 80) & ~_holds(x, NAVIGATION)), F.lit(0))
    return F.when(title != "", F.struct(title.alias("title"), span["start"].alias("start_date"), span["end"].alias("end_date"), curators.alias("curators"), preface.alias("preface")))


def href_matches(html: Column, path: str, excluded: tuple[str, ...] = (), host: str = "") -> Column:
    """Sorted distinct hrefs that match a path pattern, without an exclusion list; those that start with / behind ``host``."""
    found = F.regexp_extract_all(html, F.lit(f'href="({path})"'), F.lit(1))
    found = F.array_except(found, F.array(*map(F.lit, excluded)).cast("array<string>"))
    return F.array_sort(F.array_distinct(F.transform(found, lambda h: F.when(F.startswith(h, F.lit("/")), F.concat(F.lit(host), h)).otherwise(h))))
