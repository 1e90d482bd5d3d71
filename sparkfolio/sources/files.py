"""Scans of exhibition CSV files, artwork CSV sets, REST pages and SPARQL results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from sparkfolio.functions.html import html_to_text
from sparkfolio.functions.scalars import absolute_url, blank_to_null, caption, first_filled, present, strip
from sparkfolio.storage import materialise


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None, encoding: str = "ISO-8859-1") -> DataFrame:
    """All-text CSV with quoted newlines of a file or of many; adds ``pos``, the row's place in the files by name.

    Many files are written once as a table with each row's number in its
    task, where a file's rows stand together; the files' row counts by prefix
    sum then give the place, however files share tasks.
    """
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("encoding", encoding)
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = reader.csv(path)
    number = F.monotonically_increasing_id()
    if len(df.inputFiles()) < 2:
        return df.withColumn("pos", number)
    names = df.columns
    table = materialise(df.select("*", F.col("_metadata.file_path").alias("_file"), number.alias("_n")), "csv")
    files = table.groupBy("_file").agg(F.count("*").alias("_rows"), F.min("_n").alias("_first"))
    along = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.select(F.col("_file"), (F.coalesce(F.sum("_rows").over(along), F.lit(0)) - F.col("_first")).alias("_ahead"))
    return table.join(files, "_file").select(*names, (F.col("_n") + F.col("_ahead")).alias("pos"))


def first_present(df: DataFrame, *names: str) -> Column:
    """The first of the columns that exists, whatever it holds; null if none does."""
    return next((F.col(c) for c in names if c in df.columns), F.lit(None).cast("string"))


def kept_since(date: Column, since: int | None) -> Column:
    """Whether a raw date is of ``since`` or later; a blank or unparsable one stays."""
    if not since:
        return F.lit(True)
    raw = F.coalesce(date, F.lit(""))
    year = F.when(raw.contains("/"), F.element_at(F.split(raw, "/"), -1)).otherwise(F.substring(raw, 1, 4))
    return F.coalesce(year.try_cast("int") >= since, F.lit(True))


def fold_exhibitions(rows: DataFrame, since: int | None = None) -> DataFrame:
    """One exhibition per id from rows per participant, in file order.

    The parent takes the first kept row's fields; roles with Curator,
    Director or Organiz make curators, Artist or a blank role artworks, other
    roles nothing. Groups form by partial aggregation on the id.
    """
    begin = first_present(rows, "ExhibitionBeginDate", "BeginDate")
    end = first_present(rows, "ExhibitionEndDate", "EndDate")
    name, role = F.trim(first_present(rows, "DisplayName")), F.coalesce(first_present(rows, "ExhibitionRole", "Role"), F.lit(""))
    url = F.trim(F.coalesce(first_present(rows, "ExhibitionURL", "URL"), F.lit("")))
    r = rows.withColumns({"_id": F.trim("ExhibitionID"), "_title": F.trim("ExhibitionTitle"), "_begin": begin, "_end": end})
    r = r.withColumn("_url", F.when(url == "", F.concat(F.lit("https://www.moma.org/calendar/exhibitions/"), "_id")).when(url.startswith("http"), url).otherwise(F.concat(F.lit("https://www."), url)))
    r = r.filter(present("_id") & present("_title"))
    # Rows before the group's first kept one are dropped; later rows stay. The first places combine before the shuffle.
    if since:
        first = r.filter(kept_since(F.col("_begin"), since)).groupBy("_id").agg(F.min("pos").alias("_first"))
        r = r.join(first, "_id").filter(F.col("pos") >= F.col("_first"))
    curator = role.rlike("Curator|Director|Organiz")
    artwork = ~curator & (role.contains("Artist") | (F.trim(role) == ""))
    person = F.struct(
        "pos",
        name.alias("artist_name"),
        F.col("_title").alias("work_title"),
        F.substring("_begin", 1, 4).alias("work_year"),
        caption(name, first_present(rows, "Nationality"), first_present(rows, "ConstituentBeginDate"), first_present(rows, "ConstituentEndDate")).alias("caption"),
    )
    g = r.groupBy(F.col("_id").alias("exhibition_id")).agg(
        F.min_by(F.struct("_title", "_begin", "_end", "_url"), "pos").alias("p"),
        F.array_sort(F.collect_list(F.when(curator & (name != ""), F.struct("pos", name.alias("name"))))).alias("c"),
        F.array_sort(F.collect_list(F.when(artwork & (name != ""), person))).alias("a"),
        F.min("pos").alias("pos"),
    )
    return g.select(
        "exhibition_id",
        F.col("p._title").alias("title"),
        F.col("p._begin").alias("start_date"),
        F.col("p._end").alias("end_date"),
        F.col("p._url").alias("url"),
        F.array_distinct(F.col("c.name")).alias("curators"),
        F.transform("a", lambda x: F.struct(x["artist_name"], x["work_title"], x["work_year"], x["caption"])).alias("artworks"),
        "pos",
    )


def artworks_with_artists(objects: DataFrame, links: DataFrame, people: DataFrame, since: int | None = None, classification: str = "") -> DataFrame:
    """Objects left-joined with their first linked artist; unknown people drop out, none at all reads "Unknown"."""
    person = people.groupBy("constituentid").agg(F.max_by(F.struct("displayname", "nationality", "beginyear", "endyear"), "pos").alias("who"))
    artist = links.select("objectid", "constituentid", "pos").join(person, "constituentid")
    artist = artist.groupBy("objectid").agg(F.min_by("who", "pos").alias("who"))
    o = objects.filter(present("title") & kept_since(F.col("beginyear"), since))
    if classification:
        o = o.filter(F.contains(F.lower("classification"), F.lit(classification.lower())))
    o = o.join(artist, "objectid", "left")
    return o.select(
        "objectid",
        F.coalesce(blank_to_null("who.displayname"), F.lit("Unknown")).alias("artist_name"),
        F.col("title").alias("work_title"),
        F.coalesce(blank_to_null("displaydate"), F.col("beginyear")).alias("work_year"),
        "medium",
        "dimensions",
        caption(F.col("who.displayname"), F.col("who.nationality"), F.col("who.beginyear"), F.col("who.endyear")).alias("caption"),
    )


def page_records(pages: DataFrame, schema: str, since: int | None = None, date: str | None = None) -> DataFrame:
    """Records of landed REST pages (page, body): {"data": [...]} exploded; malformed pages give none."""
    body = F.from_json("body", f"struct<data:array<{schema}>>")
    out = pages.select("page", F.posexplode(body["data"]).alias("place", "record")).select("page", "place", "record.*")
    return out.filter(kept_since(F.col(date), since)) if date else out


def reached_pages(pages: DataFrame, use_total: bool = True) -> DataFrame:
    """The landed pages (page, body; body null where the request failed) that a reader who stops would have read.

    It stops before a failed page or one without items, and, with
    ``use_total``, after the page that pagination.total_pages names (1 where
    it names none). Only page numbers meet in one place.
    """
    parsed = F.from_json("body", "struct<data:array<string>,pagination:struct<total_pages:int>>")
    p = pages.select("page", "body", parsed.alias("_p"))
    gone = F.coalesce(F.size("_p.data"), F.lit(0)) <= 0
    last = F.col("page") >= F.coalesce(F.col("_p.pagination.total_pages"), F.lit(1)) if use_total else F.lit(False)
    end = p.agg(F.min(F.when(gone, F.col("page"))).alias("_gone"), F.min(F.when(~gone & last, F.col("page"))).alias("_last"))
    keep = (F.col("page") < F.coalesce("_gone", F.col("page") + 1)) & (F.col("page") <= F.coalesce("_last", F.col("page")))
    return p.join(F.broadcast(end)).filter(keep).select("page", "body")


# Fields of the two paged sources.
GALLERY_DEFAULT = "Art Institute of Chicago"
GALLERY_FIELDS = "struct<id:long,title:string,description:string,short_description:string,aic_start_at:string,aic_end_at:string,gallery_title:string,web_url:string,artist_titles:array<string>,artwork_titles:array<string>>"
NESTED_FIELDS = "struct<id:string,attributes:struct<title:string,start_time:string,end_time:string,primary_text:string,url:string>>"


def gallery_exhibitions(pages: DataFrame, since: int | None = None, limit: int | None = None) -> DataFrame:
    """Exhibitions of the source with flat fields: first filled description, gallery default, dates cut to the day, artists with works."""
    r = page_records(pages, GALLERY_FIELDS)
    r = r.filter(present(strip(F.coalesce("title", F.lit(""))))).filter(kept_since(F.col("aic_start_at"), since))
    day = lambda c: F.nullif(F.substring(c, 1, 10), F.lit(""))
    title, start = strip("title"), F.coalesce("aic_start_at", F.lit(""))
    works = F.transform(
        F.coalesce("artist_titles", F.array().cast("array<string>")),
        lambda a, i: F.struct(
            a.alias("artist_name"), F.when(i < F.coalesce(F.size("artwork_titles"), F.lit(0)), F.get("artwork_titles", i)).otherwise(title).alias("work_title"),
            F.nullif(F.substring(start, 1, 4), F.lit("")).alias("work_year"), a.alias("caption"),
        ),
    )
    out = r.select(
        "page", "place", title.alias("title"), first_filled("description", "short_description").alias("preface"), day("aic_start_at").alias("start_date"),
        day("aic_end_at").alias("end_date"), F.coalesce(first_filled("gallery_title"), F.lit(GALLERY_DEFAULT)).alias("location"),
        F.coalesce(first_filled("web_url"), F.concat(F.lit("https://www.artic.edu/exhibitions/"), F.col("id").cast("string"))).alias("url"), works.alias("artworks"),
    )
    return out.orderBy("page", "place").limit(limit) if limit else out


def nested_exhibitions(pages: DataFrame, since: int | None = None, limit: int | None = None) -> DataFrame:
    """Exhibitions of the source whose fields sit under attributes; the text comes as an HTML fragment."""
    r = page_records(pages, NESTED_FIELDS).select("page", "place", "id", "attributes.*")
    r = r.filter(present(strip(F.coalesce("title", F.lit(""))))).filter(kept_since(F.col("start_time"), since))
    day = lambda c: F.nullif(F.substring(c, 1, 10), F.lit(""))
    url = absolute_url("url", "https://whitney.org", F.concat(F.lit("https://whitney.org/exhibitions/"), F.coalesce("id", F.lit(""))))
    out = r.select("page", "place", strip("title").alias("title"), html_to_text("primary_text").alias("preface"), day("start_time").alias("start_date"), day("end_time").alias("end_date"), url.alias("url"))
    return out.orderBy("page", "place").limit(limit) if limit else out


def image_map(pages: DataFrame) -> DataFrame:
    """(number, image_url) of landed pages of an offset scan; blank urls drop, the last one of an id wins."""
    r = page_records(pages, "struct<id:long,image_url:string>").filter(present("image_url") & (F.col("id") != 0))
    return r.groupBy(F.col("id").alias("number")).agg(F.max_by("image_url", F.struct("page", "place")).alias("image_url"))


def offsets(spark: SparkSession, total: int, batch: int = 100, limit_pages: int | None = None) -> DataFrame:
    """The offsets that a scan of ``total`` records asks for, one at least."""
    n = max(1, -(-total // batch))
    return spark.range(min(n, limit_pages) if limit_pages else n).select((F.col("id") * batch).alias("offset"))


def offsets_by(totals: DataFrame, key: str, total: str, batch: int = 100, limit_pages: int | None = None) -> DataFrame:
    """(key, offset) of the requests that scans of many sources make, from each source's total; one at least."""
    n = F.greatest(F.lit(1), F.ceil(F.col(total) / batch)).cast("long")
    n = F.least(n, F.lit(limit_pages)) if limit_pages else n
    return totals.select(key, F.explode(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: i * batch)).alias("offset"))


def zip_artworks(df: DataFrame) -> DataFrame:
    """Artist i with work i; a missing work reads as the title, surplus works drop."""
    out = df.select("*", F.posexplode("artist_titles").alias("place", "artist_name"))
    has = F.col("place") < F.coalesce(F.size("artwork_titles"), F.lit(0))
    return out.withColumn("work_title", F.when(has, F.get("artwork_titles", F.col("place"))).otherwise(F.col("title")))


# Museums as entity, name, city; the query's terms.
MUSEUMS = (
    ("Q19675", "Louvre", "Paris"),
    ("Q178065", "Centre Pompidou", "Paris"),
    ("Q189826", "Tate Modern", "London"),
    ("Q190804", "Rijksmuseum", "Amsterdam"),
    ("Q2501625", "Stedelijk Museum Amsterdam", "Amsterdam"),
    ("Q224124", "Van Gogh Museum", "Amsterdam"),
    ("Q51252", "Uffizi", "Florence"),
    ("Q160112", "Museo del Prado", "Madrid"),
    ("Q180788", "National Gallery", "London"),
    ("Q23402", "Musée d'Orsay", "Paris"),
    ("Q28450", "Guggenheim Museum Bilbao", "Bilbao"),
    ("Q1474887", "Tate Britain", "London"),
    ("Q151849", "Serpentine Galleries", "London"),
    ("Q1052661", "Palais de Tokyo", "Paris"),
    ("Q1471477", "Mori Art Museum", "Tokyo"),
    ("Q89568", "M+ Museum", "Hong Kong"),
    ("Q214078", "SFMOMA", "San Francisco"),
)
SPARQL_VARIABLES = "exhibition exhibitionLabel museum museumLabel start end cityLabel".split()
SPARQL_PATTERNS = (
    "?exhibition wdt:P31 wd:Q464980 .",
    "?exhibition wdt:P276 ?museum .",
    "?exhibition wdt:P580 ?start .",
    "OPTIONAL { ?exhibition wdt:P582 ?end }",
    "OPTIONAL { ?museum wdt:P131 ?city }",
)
SPARQL_LANGUAGES = "en,fr,de,it,es,zh"


def sparql_query(since: int | None = None, limit: int | None = None, museums: list[str] | None = None) -> str:
    """The query for exhibitions of the museums (entities), latest first, from the year ``since`` on."""
    entities = museums or [q for q, _, _ in MUSEUMS]
    where = [
        "VALUES ?museum { " + " ".join(f"wd:{q}" for q in entities) + " }",
        *SPARQL_PATTERNS,
        *([f"FILTER(YEAR(?start) >= {since})"] if since else []),
        f'SERVICE wikibase:label {{ bd:serviceParam wikibase:language "{SPARQL_LANGUAGES}" . }}',
    ]
    head = "SELECT " + " ".join(f"?{v}" for v in SPARQL_VARIABLES)
    tail = ["ORDER BY DESC(?start)", *([f"LIMIT {limit}"] if limit else [])]
    return "\n".join([head, "WHERE {", *(f"  {w}" for w in where), "}", *tail])


def sparql_bindings(pages: DataFrame) -> DataFrame:
    """Exhibitions of a SPARQL JSON result (body).

    A missing label, or one that starts with Q, falls back to the URI's tail;
    missing museum and city names come from the museums' table.
    """
    cell = "struct<value:string>"
    body = F.from_json("body", f"struct<results:struct<bindings:array<struct<{','.join(f'`{c}`:{cell}' for c in SPARQL_VARIABLES)}>>>>")
    b = pages.select(F.explode(body["results"]["bindings"]).alias("b"))
    b = b.select(*(F.col(f"b.`{c}`.value").alias(c) for c in SPARQL_VARIABLES))
    rows = [("http://www.wikidata.org/entity/" + q, name, city) for q, name, city in MUSEUMS]
    known = pages.sparkSession.createDataFrame(rows, "museum string, _name string, _city string")
    b = b.join(F.broadcast(known), "museum", "left")
    number = F.coalesce(F.element_at(F.split("exhibition", "/"), -1), F.lit(""))
    label = F.when(present("exhibitionLabel") & ~F.startswith("exhibitionLabel", F.lit("Q")), F.col("exhibitionLabel"))
    museum = F.coalesce(first_filled("museumLabel"), F.col("_name"), F.lit("Wikidata"))
    day = lambda c: F.nullif(F.substring(c, 1, 10), F.lit(""))
    return b.select(
        museum.alias("source"), F.coalesce(label, F.nullif(number, F.lit("")), F.lit("Untitled Exhibition")).alias("title"), day("start").alias("start_date"), day("end").alias("end_date"),
        museum.alias("location"), F.coalesce(first_filled("cityLabel"), F.col("_city"), F.lit("")).alias("city"), F.concat(F.lit("https://www.wikidata.org/wiki/"), number).alias("url"),
    )


def listing_urls(spark: SparkSession, template: str, first: int, last: int) -> DataFrame:
    """URLs of a template with one number over a range (years, pages or editions)."""
    return spark.range(first, last + 1).select(F.col("id").alias("number"), F.replace(F.lit(template), F.lit("{}"), F.col("id").cast("string")).alias("url"))


def yearly_listings(spark: SparkSession, current: str, template: str, this_year: int, since: int | None = None) -> DataFrame:
    """The current listing, then one of each year from ``since`` (by default this year) on."""
    return _listings(spark, [current], template, since or this_year, this_year)


def archive_listings(spark: SparkSession, current: str, archive: str, template: str, this_year: int, since: int | None = None, per_year: int = 2, extra: int = 0, most: int = 20) -> DataFrame:
    """The current and the archive's first listing, then its pages from 2 on: ``per_year`` for each year back plus ``extra``, ``most`` at most."""
    pages = min(max(1, this_year - since) * per_year + extra, most) if since else most
    return _listings(spark, [current, archive], template, 2, pages)


def _listings(spark: SparkSession, lead: list[str], template: str, first: int, last: int) -> DataFrame:
    head = spark.createDataFrame([(i - len(lead), u) for i, u in enumerate(lead)], "number long, url string")
    rest = listing_urls(spark, template, first, last) if last >= first else head.limit(0)
    return head.union(rest)


def listings_by(sites: DataFrame, template: str, first: str, last: str) -> DataFrame:
    """(columns of ``sites``, number, url) of a listing for each number between two columns; the template's two {} are site_key and number."""
    head, middle, tail = template.split("{}")
    numbers = F.explode(F.sequence(F.col(first).cast("long"), F.greatest(F.col(first), F.col(last)).cast("long")))
    out = sites.withColumn("number", numbers)
    return out.withColumn("url", F.concat(F.lit(head), F.col("site_key"), F.lit(middle), F.col("number").cast("string"), F.lit(tail)))


def all_urls(*sets: DataFrame) -> DataFrame:
    """The union of discovered and listed urls, each once, in order."""
    out = sets[0].select("url")
    for s in sets[1:]:
        out = out.union(s.select("url"))
    return out.distinct().orderBy("url")


def synthetic_parent(children: DataFrame, source: str, city: str, parser_key: str, institution_type: str = "museum", base: str = "https://example.org/collection/") -> DataFrame:
    """A parent made up for works without an exhibition, with the number of its children.

    Its url is ``base`` and the key, the same every time; pass the base that stored records have.
    """
    return children.agg(F.count("*").alias("n_artworks")).select(
        F.lit(source).alias("source"), F.lit(f"{source} Permanent Collection").alias("title"), F.lit(f"Selected works from the {source} collection.").alias("preface"),
        F.lit(source).alias("location"), F.lit(city).alias("city"), F.lit(base + parser_key).alias("url"),
        F.lit(parser_key).alias("parser_key"), F.lit(institution_type).alias("institution_type"), "n_artworks",
    )


def stamp(records: DataFrame, sites: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """Records (site_key, url, city, images and others) with their site's source, key and type; its city where they have none.

    ``tags`` has url and tags, JSON lists; records without one get an empty list, as do images.
    """
    s = F.broadcast(sites.select(F.col("key").alias("site_key"), F.col("source").alias("_source"), F.col("city").alias("_city"), F.col("institution_type").alias("_type")))
    out = records.join(s, "site_key")
    if tags is not None:
        out = out.join(tags.select("url", F.col("tags").alias("_tags")).dropDuplicates(["url"]), "url", "left")
    return out.withColumns(
        {
            "source": F.col("_source"),
            "parser_key": F.col("site_key"),
            "institution_type": F.col("_type"),
            "city": F.coalesce(first_filled("city"), F.col("_city")),
            "tags": F.coalesce("_tags", F.lit("[]")) if tags is not None else F.lit("[]"),
            "images": F.coalesce(F.col("images"), F.lit("[]")) if "images" in records.columns else F.lit("[]"),
        }
    ).drop("_source", "_city", "_type", "_tags")
