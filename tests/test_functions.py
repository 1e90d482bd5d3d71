"""Scalar functions, HTML, sources and writes on literal rows."""

import os

from pyspark.sql import functions as F

from sparkfolio.functions import html as H
from sparkfolio.functions import scalars as X
from sparkfolio.operators import extraction as V
from sparkfolio.operators import store as W
from sparkfolio.sources import files as S
from sparkfolio.sources.sites import sites


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} string" for c in cols))
    return df.select(expr.alias("v")).first().v


def test_dates(spark):
    n = lambda t: tuple(one(spark, X.normalize_date("d"), d=t))
    assert n("2024") == ("2024-01-01", True) and n("2024-3") == ("2024-03-01", True)
    assert n("1/5/2020") == ("2020-01-05", True) and n("2024-13-99") == ("2024-13-99", False) and n(None) == (None, False)
    assert one(spark, X.leading_int("d"), d="11/7") == 11 and one(spark, X.leading_int("d"), d="") == 0
    assert one(spark, X.extract_year("d"), d="in 2019, 1999") == 2019 and one(spark, X.extract_year("d"), d="12019") is None
    assert one(spark, X.slug("d"), d="M+ Museum") == "m+_museum"


def test_text(spark):
    assert one(spark, X.caption("a", "b", "c", "d"), a="N", b="", c="1900", d="") == "N, 1900"
    assert one(spark, X.shorten("a"), a="x" * 30) == "x" * 22 + "..."
    assert one(spark, X.json_list("a"), a="bad") == [] and one(spark, X.json_list("a", True), a="bad") == ["bad"]
    names = F.array(*(F.lit(f" n{i} ") for i in range(20)))
    told = lambda kind, t, names=None, p=None: one(spark, X.synthesize_concept(kind, "t", names, "p", "s"), t=t, p=p, s="House")
    assert told("moma", "Show", names) == "展览《Show》展出艺术家包括 " + ", ".join(f"n{i}" for i in range(15)) + " 等 的作品。"
    assert told("moma", "Show") == "展览《Show》" and told("aic", "Show") == "芝加哥艺术博物馆展览《Show》" and told("generic", "Show") == "House 展览《Show》"
    assert told("whitney", "Show", names) == "Whitney Museum of American Art exhibition: Show"
    assert told("aic", "Show", names, " " + "line\n" * 80) == ("line " * 60)[:300] and told("moma", "Show", None, "long " * 20) == "展览《Show》"
    assert all(told(k, t, names) == "" for k in X.NO_ARTISTS for t in ("", None))
    twice = F.array(F.lit("A"), F.lit(" A "), F.lit(""), F.lit("  "))
    assert told("generic", "T", twice) == "House 展览《T》展出艺术家包括 A 的作品。"
    assert one(spark, X.strip("a"), a="\u3000\t x \x85\n") == "x" and one(spark, X.blank("a"), a="\u00a0") is True
    assert one(spark, X.bilingual("a", "b", "> ", "none"), a=" ", b="y") == "> y" and one(spark, X.bilingual("a", "b", "> ", "none"), a=None, b="") == "none"
    assert one(spark, X.table_cell("a", 4), a="a|bcd") == "a\\|b"
    assert [X.parse_interval_seconds(x) for x in ("7d", "24h", "30m", "2024-01-01", "")] == [604800, 86400, 1800, None, None]
    assert one(spark, X.fence_stripped("a"), a='x ```{"b":1}```') == 'x ```{"b":1}```' and one(spark, X.fence_stripped("a"), a="```json\n{}\n```") == "{}"
    assert one(spark, X.long_date_span("a"), a="May 2, 2024—Ongoing") == ("May 2, 2024", None)


def test_html(spark):
    page = '<html><nav>menu</nav><h1>A title</h1><p>' + "body text " * 6 + '</p><img src="/relative/pic.png"><img src="/logo.png"><a href="/e/1">x</a><script>no()</script>'
    assert one(spark, H.page_images(F.col("h"), F.col("u")), h=page, u="http://test.com") == ["http://test.com/relative/pic.png"]
    assert one(spark, H.page_links(F.col("h"), F.col("u"), ["http://test.com/"], ["/e/"]), h=page, u="http://test.com") == ["http://test.com/e/1"]
    text = one(spark, H.clean_html("h"), h=page)
    assert "A title" in text and "menu" not in text and "no()" not in text
    assert one(spark, H.clean_html("h"), h=None) == ""
    ld = '<script type="application/ld+json">{"@type":"ExhibitionEvent","name":"N","startDate":"2024-01-02T10:00"}</script>'
    assert one(spark, H.json_ld_event(F.col("h")), h=ld)[:3] == ("N", None, "2024-01-02")


def test_clean_html_drops_what_is_no_content(spark):
    clean = lambda h: one(spark, H.clean_html("h"), h=h)
    body = "Real content here. " * 20
    kept = "".join(f"<div class='{c}'>keep {c}</div>" for c in ("navigation", "ads", "search", "Cookie", "subscribe")) + "<div id='sidebar'>keep id</div>"
    gone = "".join(f"<div class='x {c}'>gone</div>" for c in sorted(H.DROP_CLASSES)) + "".join(f"<div id='{c}'>gone</div>" for c in H.DROP_IDS) + "".join(f"<{t}>gone</{t}>" for t in sorted(H.DROP_TAGS - {"script", "style"}))
    text = clean(f"<html><body class='menu'>{gone}{kept}<p>{body}</p></body></html>")
    assert "gone" not in text and text.count("keep") == 6 and "Real content" in text
    long = "Main text in here. " * 20
    page = "<head><meta name='description' content=' Meta. '></head><body><nav>garbage</nav><div{}><p>" + long + "</p></div></body>"
    for mark in (" role='main'", " class='a content'", " class='exhibition-content'"):
        assert clean(page.format(mark)).split("\n")[0] == "Meta." and "garbage" not in clean(page.format(mark))
    assert clean("<head><meta name='description' content='Meta.'></head><p>Short</p>") == "Meta.\nShort"
    assert clean("Hello    World<br>\n\n\nTest") == "Hello\nWorld\nTest"
    assert one(spark, X.tidy_lines("h"), h="Hello    World\n\n\nTest  ") == "Hello\nWorld\nTest"


DETAIL = r"serpentinegalleries\.org/whats-on/[a-zA-Z0-9][a-zA-Z0-9_-]+/?$"


def test_cards(spark):
    base = "https://www.serpentinegalleries.org/whats-on/"
    tags = lambda h: one(spark, H.card_tags(F.col("h"), F.col("u"), DETAIL), h=h, u=base)
    card = '<div class="card-x"><a href="/whats-on/{0}"><h3>{1}</h3></a><a href="{2}">{3}</a></div>'
    page = card.format("one", "Paintings", "/whats-on/?type=exhibitions", "Shows") + card.format("two", "Gallery tour", "/x", "y")
    page += card.format("three", "Paintings", "/whats-on/?type=live", "Live") + card.format("four", "Paintings", "/x", "y")
    assert tags(page) == {base + "one/": ["Shows"], base + "four/": ["Exhibitions"]}
    loose = '<div><a href="/whats-on/one">Paintings</a> <a href="?type=exhibitions">Shows</a></div><a href="/whats-on/talks-two">x</a><p><a href="/whats-on/three/">Drawings</a></p>'
    assert tags(loose) == {base + "one/": ["Shows"], base + "three/": ["Exhibitions"]}
    assert tags(None) == {}


def test_page_fields(spark):
    cn = lambda h, u="u": one(spark, H.page_fields(F.col("h"), F.col("u")), h=h, u=u)
    assert cn("<p>x</p>") is None and cn("<h1>Power Station of Art</h1>") is None
    got = cn("<title>T</title><h1>第十届展览名称</h1>\n2023.1.2 - 2023/3/4\n地点 三楼 支持 某\n策展人: 王一，李二\n<p>策展人与很多很多" + "字" * 50 + "</p><p>" + "文" * 45 + "</p>")
    assert got == ("第十届展览名称", "2023-1-2", "2023-3-4", "三楼", ["王一", "李二"], "文" * 45, None)
    assert cn("<title>Whole page title</title><h1>abc</h1>").title == "Whole page title"
    assert cn("<h1>第十四届展：“宇宙”</h1>", "x/shanghai-biennale").concept == "“宇宙”"
    assert cn('<h1>Biennale edition</h1> "主题" 第九届上海双年展', "x/biennale").concept == "主题"
    en = lambda h: one(spark, H.english_page_fields(F.col("h")), h=h)
    assert en("<p>x</p>") is None
    got = en("<h1>A show</h1>\nMay 1, 2024 – June 2, 2025\ncurated by Ann, Bo")
    assert got == ("A show", "May 1, 2024", "June 2, 2025", ["Ann", "Bo"], None)


def test_response(spark):
    parse = lambda t: one(spark, V.parse_response(F.col("r")), r=t)
    ok = lambda t: parse(t).ok
    assert ok('{"title": "x"}') and ok('```json\n{"title": "x", "extra": 1}\n```') and ok('```\n{"title": "x"}\n```') and ok('[{"title": "x"}, 2]')
    assert not ok("nope") and not ok("[]") and not ok("[1]") and not ok('{"concept": "x"}') and not ok('{"title": 3}') and not ok("{broken}") and not ok(None)
    assert not ok('{"title": null}') and not ok('{"title": "x", "curators": null}') and not ok('{"title": "x", "curators": "y"}') and not ok('{"title": "x", "images": [1]}')
    assert not ok('{"title": "x", "artworks": [1]}') and not ok('{"title": "x", "artworks": [{"medium": 1}]}') and not ok('{"title": "x", "credits": []}')
    got = parse('{"title": "x", "credits": "c", "images": ["i"], "artworks": [{"artist_name": "a", "z": 1}]}').record
    assert got.credits == "c" and got.images == ["i"] and got.curators == [] and got.artworks[0].artist_name == "a" and got.artworks[0].medium is None


def test_valid_result(spark):
    def ok(title=None, start=None, preface=None, concept=None):
        return one(spark, V.valid_result(F.col("t"), F.col("s"), F.lit(None).cast("string"), F.col("p"), F.col("c")), t=title, s=start, p=preface, c=concept)

    assert ok("Show", "2024-01-01", "Some text", "A nice curatorial concept for it.") and ok("T", "2024", None, "")
    assert not ok("") and not ok("N/A", "2024") and not ok(None, "2024") and ok(" N/A ", "2024")
    assert not ok("T", None, "short", "Very short") and ok("T", None, "X" * 50, "A nice curatorial concept.")
    assert not ok("T", "2024", None, "short") and not ok("T", "2024", None, "  short" + " " * 30)


def test_paged_sources(spark, tmp_path):
    rows = [(1, '{"data":[{"id":1,"title":""},{"id":2,"title":"Real","artist_titles":[]}],"pagination":{"total_pages":3}}'), (2, None), (3, '{"data":[{"id":3,"title":"Late"}]}')]
    pages = spark.createDataFrame(rows, "page int, body string")
    assert [r.page for r in S.reached_pages(pages).collect()] == [1]
    assert [r.title for r in S.gallery_exhibitions(pages).orderBy("page").collect()] == ["Real", "Late"]
    assert [r.title for r in S.gallery_exhibitions(pages, limit=1).collect()] == ["Real"]
    assert S.reached_pages(pages.filter("page < 0")).count() == 0 and S.gallery_exhibitions(pages.filter("page = 2")).count() == 0
    query = S.sparql_query(2001, 5)
    assert "YEAR(?start) >= 2001" in query and query.endswith("LIMIT 5") and query.count("wd:Q") == 18 and "FILTER" not in S.sparql_query()
    assert S.sparql_bindings(spark.createDataFrame([("broken",)], "body string")).count() == 0
    path = tmp_path / "e.csv"
    path.write_bytes('id,name\n1,"Zo\xeb ""Z""\nB"\n2,\n'.encode("latin-1"))
    got = S.read_csv(spark, f"file://{path}").orderBy("pos").collect()
    assert [(r.id, r.name) for r in got] == [("1", 'Zoë "Z"\nB'), ("2", None)]


def test_rest_pages(spark, tmp_path):
    from sparkfolio.sources.rest import RestPages

    spark.dataSource.register(RestPages)
    for n, items in ((1, [1, 2]), (2, [3]), (3, [])):
        (tmp_path / f"{n}.json").write_text('{"data": %s, "pagination": {"total_pages": 2}}' % items)
    read = lambda **o: sorted((r.page, r.body) for r in spark.read.format("rest_pages").options(url=f"file://{tmp_path}/{{page}}.json", **o).load().collect())
    assert [p for p, _ in read(first="1", last="2")] == [1, 2]
    assert [p for p, _ in read()] == [1, 2, 3] and [p for p, _ in read(total="pagination.total_pages")] == [1, 2]
    assert read(first="4", last="5", lenient="true") == [(4, None), (5, None)]


def test_filters_reach_the_requests(spark, tmp_path):
    """Requests are files of a log, one each."""
    from sparkfolio.sources.rest import RestPages, SparqlExhibitions

    log = str(tmp_path / "log")
    os.mkdir(log)

    def answer(url):
        import os
        import tempfile

        handle, name = tempfile.mkstemp(dir=log)
        os.write(handle, url.encode())
        os.close(handle)
        if "query=" in url:
            return {"results": {"bindings": []}}
        number = int(url.rpartition("/")[2])
        return {"data": [number] * (number < 9), "pagination": {"total_pages": 8}}

    def asked():
        out = sorted(open(f"{log}/{x}").read() for x in os.listdir(log))
        for x in os.listdir(log):
            os.remove(f"{log}/{x}")
        return out

    class Pages(RestPages):
        fetch = staticmethod(answer)

    class Sparql(SparqlExhibitions):
        fetch = staticmethod(answer)

    spark.dataSource.register(Pages)
    spark.dataSource.register(Sparql)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        read = lambda **o: spark.read.format("rest_pages").options(url="x/{page}", pushdown="true", **o).load()
        df = read(first="1", last="8").filter("page >= 3 AND page < 6 AND body LIKE '%data%'")
        assert sorted(r.page for r in df.collect()) == [3, 4, 5] and asked() == ["x/3", "x/4", "x/5"]
        assert sorted(r.page for r in read(total="pagination.total_pages").filter("page IN (2, 7, 99)").collect()) == [2, 7]
        assert {*asked()} == {"x/1", "x/2", "x/7"}  # the first one to count
        whole = read(total="pagination.total_pages")
        assert whole.rdd.getNumPartitions() == 8 and sorted(r.page for r in whole.collect()) == list(range(1, 9))
        asked()
        assert sorted(r.page for r in read().filter("page > 6").collect()) == [7, 8, 9] and len(asked()) == 9  # nothing tells how many there are
        found = spark.read.format("sparql_exhibitions").options(url="x?query={query}", pushdown="true", limit="7").load().filter("start_year > 1999")
        assert [(r.start_year, "bindings" in r.body) for r in found.collect()] == [(2000, True)]
        assert all("YEAR%28%3Fstart%29%20%3E%3D%202000" in q and "LIMIT%207" in q for q in asked())
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_fold(spark):
    cols = "ExhibitionID ExhibitionTitle ExhibitionBeginDate ExhibitionEndDate ExhibitionURL DisplayName ExhibitionRole Nationality ConstituentBeginDate ConstituentEndDate".split()
    rows = [
        ("1", "A", "1/15/2010", "", "moma.org/a", "Ann", "Artist", "", "", ""), ("1", "A", "1/15/2010", "", "", "Cy", "Curator", "", "", ""),
        ("2", "B", "1/15/2025", "", "", " ", "Artist", "", "", ""), ("3", "C", "abcd/ef/gh", "", "", "Di", "", "", "", ""), ("", "D", "", "", "", "x", "", "", "", ""),
    ]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], ", ".join(f"{c} string" for c in cols) + ", pos long")
    got = {r.exhibition_id: r for r in S.fold_exhibitions(df, 2020).collect()}
    assert set(got) == {"2", "3"} and got["2"].artworks == [] and got["3"].artworks[0].artist_name == "Di"
    every = {r.exhibition_id: r for r in S.fold_exhibitions(df).collect()}
    assert every["1"].curators == ["Cy"] and every["1"].url == "https://www.moma.org/a" and every["1"].artworks[0].work_year == "1/15"


def test_insert_or_ignore(spark):
    old = spark.createDataFrame([(1, "s", "t", "u1")], "id long, source string, title string, url string")
    new = spark.createDataFrame([(2, "s", "t", "u1"), (3, "s", "t", "u2"), (4, "s", "t", "u2"), (5, None, "t", "u3")], old.schema)
    assert sorted(r.id for r in W.insert_or_ignore(old, new, "id").collect()) == [1, 3]
    assert sites(spark).count() == 61


def test_site_capabilities_tell_of_every_site(spark, tmp_path):
    from sparkfolio.plans import catalog

    columns = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate date, o_orderpriority string"
    spark.createDataFrame([(4, 1, "O", None, "1-URGENT"), (10, 1, "O", None, "1-URGENT")], columns).write.parquet(str(tmp_path / "orders.parquet"))
    got = {r.key: r for r in catalog.QUERIES["site_capabilities"](spark, str(tmp_path)).collect()}
    assert len(got) == 61 and {k: r.n_records for k, r in got.items() if r.n_records} == {"moma": 2}
    assert got["yokohama_triennale"][1:] == ("html_llm", False, " [三年展]", 0) and got["mplus"].has_history


def test_references_without_a_semicolon_are_read(spark):
    assert one(spark, H.clean_html("h"), h="<h1>a &amp;&amp</h1><p>b &lt</p><p>c &am</p>") == "a &&\nb <\nc &am"


def test_page_clean_text_reads_pages_of_any_length(spark, tmp_path):
    import duckdb

    from sparkfolio.plans import catalog

    html = "<html><nav>menu</nav><article><h1>A title</h1>" + ("<p>Words of an open <b>paragraph</b>." + "&amp; more" * 13) * 40_000 + "</article></html>"
    assert len(html) > V.MOST_HTML
    spark.createDataFrame([(1, html), (2, "<p>Short</p>")], "page_id bigint, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = {r.page_id: r.text for r in catalog.QUERIES["page_clean_text"](spark, str(tmp_path)).collect()}
    assert got == dict(con.execute(catalog.ORACLE_SQL["page_clean_text"]).fetchall()) and got[1].count("paragraph") == 40_000
    assert {r.page_id: r.gate for r in catalog.QUERIES["page_gates"](spark, str(tmp_path)).collect()} == {1: "too_large", 2: "too_short"}


def test_page_clean_text_has_no_text_of_no_page(spark, tmp_path):
    from sparkfolio.plans import catalog

    rows = [(1, None), (2, ""), (3, "<h1>a &amp;&amp</h1>")]
    spark.createDataFrame(rows, "page_id bigint, html string").write.parquet(str(tmp_path / "pages.parquet"))
    assert {r.page_id: r.text for r in catalog.QUERIES["page_clean_text"](spark, str(tmp_path)).collect()} == {1: None, 2: "", 3: "a &&"}
