"""Counts, timelines, co-occurrence networks and record search over parents and children.

Parents have id, source, city, title, start_date; children exhibition_id,
artist_name, work_title, medium. All functions are lazy and order totally.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkfolio.functions.scalars import ascii_lower, extract_year, json_list, like_any_case, present, year_prefix
from sparkfolio.storage import materialise

# Parts of names that stand for no artist, fields of a parent that a keyword is looked for in, columns of a gallery page.
SEARCHED = ("title", "preface", "concept", "curators", "location", "preface_en", "concept_en")
GALLERY = "id source title curators start_date end_date location city url tags".split()
PLACEHOLDERS = ("various", "unknown", "multiple")


def named_artist(c: str = "artist_name") -> Column:
    """Not blank and no placeholder such as "Various Artists"."""
    return present(c) & ~reduce(or_, (ascii_lower(c).like(f"%{p}%") for p in PLACEHOLDERS))


def totals(parents: DataFrame, children: DataFrame) -> DataFrame:
    one = parents.agg(F.count("*").alias("parents"))
    return one.crossJoin(F.broadcast(children.agg(F.count("*").alias("children"))))  # one row each


def count_by(df: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    out = df.groupBy(F.col(key).alias("name")).agg(F.count("*").alias("n"))
    out = out.orderBy(F.desc("n"), F.col("name").asc_nulls_first())
    return out.limit(limit) if limit else out


def top_artists(children: DataFrame, limit: int = 15) -> DataFrame:
    return count_by(children.filter(named_artist()), "artist_name", limit)


def top_mediums(children: DataFrame, limit: int = 12) -> DataFrame:
    return count_by(children.filter(present("medium")), "medium", limit)


def by_city(parents: DataFrame) -> DataFrame:
    return count_by(parents.filter(present("city")), "city")


def timeline(parents: DataFrame, first: int = 1920, last: int = 2026) -> DataFrame:
    """Dense (year, source, n): each year that occurs with each source that has a date; both sets are small aggregates."""
    dated = parents.filter(present("start_date")).withColumn("year", extract_year("start_date"))
    counts = dated.groupBy("source", "year").agg(F.count("*").alias("n"))
    seen = counts.filter(F.col("year").between(first, last))
    grid = seen.select("year").distinct().join(counts.select("source").distinct())
    out = grid.join(seen.withColumnRenamed("source", "s").withColumnRenamed("year", "y"), (F.col("year") == F.col("y")) & F.col("source").eqNullSafe(F.col("s")), "left")
    return out.select("year", "source", F.coalesce("n", F.lit(0)).alias("n")).orderBy("year", "source")


def timeline_wide(parents: DataFrame, sources: list[str], first: int = 1920, last: int = 2026) -> DataFrame:
    dated = parents.withColumn("year", extract_year("start_date")).filter(F.col("year").between(first, last))
    return dated.groupBy("year").agg(*(F.count_if(F.col("source") == s).alias(f"s{i}") for i, s in enumerate(sources))).orderBy("year")


def artist_shares(children: DataFrame) -> DataFrame:
    """(exhibition_id, artist_name, k): rows of each named artist in each parent, written once for names, links and totals."""
    return materialise(children.filter(named_artist()).groupBy("exhibition_id", "artist_name").agg(F.count("*").alias("k")), "artist-shares")


def _totals_of(shares: DataFrame) -> DataFrame:
    return shares.groupBy(F.col("artist_name").alias("name")).agg(F.sum("k").alias("n"))


def links_of_shares(shares: DataFrame, top: int = 40, least: int = 2, limit: int = 300) -> DataFrame:
    """Pairs of the ``top`` artists met in one parent, weighted by row pairs.

    Both sides are cut to the top names (a broadcast of ``top`` rows at most),
    so a parent with k of the names gives at most top^2 / 2 rows whatever its
    size.
    """
    names = _totals_of(shares).orderBy(F.desc("n"), "name").limit(top).select(F.col("name").alias("artist_name"))
    few = shares.join(F.broadcast(names), "artist_name", "left_semi")
    a = few.select("exhibition_id", F.col("artist_name").alias("source"), F.col("k").alias("ka"))
    b = few.select("exhibition_id", F.col("artist_name").alias("target"), F.col("k").alias("kb"))
    pairs = a.join(b, "exhibition_id").filter("source < target")
    out = pairs.groupBy("source", "target").agg(F.sum(F.col("ka") * F.col("kb")).alias("weight"))
    return out.filter(F.col("weight") >= least).orderBy(F.desc("weight"), "source", "target").limit(limit)


def cooccurrence_links(children: DataFrame, top: int = 40, least: int = 2, limit: int = 300) -> DataFrame:
    return links_of_shares(artist_shares(children), top, least, limit)


def cooccurrence_nodes(shares: DataFrame, links: DataFrame) -> DataFrame:
    """Endpoints of links with totals, a drawing size, and size scaled over all nodes."""
    ends = links.select(F.col("source").alias("name")).union(links.select("target")).distinct()
    out = ends.join(_totals_of(shares), "name")
    everything = Window.partitionBy()  # links are limited, so are their ends
    lo, hi = F.min("n").over(everything), F.max("n").over(everything)
    size = F.greatest(F.lit(6.0), F.least(F.lit(22.0), 6 + F.sqrt("n")))
    scaled = F.when(hi == lo, F.lit(0.5)).otherwise((F.col("n") - lo) / (hi - lo))
    bucket = F.when(F.col("n") >= 30, 3).when(F.col("n") >= 15, 2).when(F.col("n") >= 8, 1).otherwise(0)
    return out.select("name", "n", F.round(size, 4).alias("size"), F.round(8 + 36 * scaled, 4).alias("radius"), bucket.alias("bucket"))


def search(
    parents: DataFrame,
    children: DataFrame,
    keyword: str = "",
    source: str = "",
    year_from: int = 0,
    year_to: int = 0,
    parent_fields: tuple[str, ...] | None = None,
    child_fields: tuple[str, ...] = ("artist_name", "work_title"),
) -> DataFrame:
    """Parents that match all given conditions; a keyword may match the parent (those of its searched fields that it has) or any child."""
    out = parents
    parent_fields = parent_fields or tuple(c for c in SEARCHED if c in parents.columns)
    if source:
        out = out.filter(F.col("source") == source)
    if year_from:
        out = out.filter(year_prefix("start_date") >= year_from)
    if year_to:
        out = out.filter(year_prefix("start_date") <= year_to)
    if keyword:
        own = parents.filter(reduce(or_, (like_any_case(c, keyword) for c in parent_fields))).select("id")
        kids = children.filter(reduce(or_, (like_any_case(c, keyword) for c in child_fields))).select(F.col("exhibition_id").alias("id"))
        out = out.join(own.union(kids).distinct(), "id", "left_semi")
    return out


def page(df: DataFrame, limit: int, offset: int = 0, chronological: bool = False) -> DataFrame:
    """A page by start_date descending (as text, or by normalised date), then id."""
    key = F.col("start_date")
    if chronological:
        from sparkfolio.functions.scalars import normalize_date

        key = F.try_to_date(normalize_date("start_date")["value"], "yyyy-MM-dd")
    return df.orderBy(key.desc_nulls_last(), F.desc("id")).offset(offset).limit(limit)


def with_child_count(parents: DataFrame, children: DataFrame) -> DataFrame:
    """Parents with the number of their children, 0 without any. All children are counted once, before the join."""
    counts = children.groupBy(F.col("exhibition_id").alias("id")).agg(F.count("*").alias("artwork_count"))
    return parents.join(counts, "id", "left").withColumn("artwork_count", F.coalesce("artwork_count", F.lit(0)))


def page_with_child_count(shown: DataFrame, children: DataFrame) -> DataFrame:
    """A page's rows (a few, by their limit) with the number of their children; only those children are counted."""
    few = F.broadcast(shown.select(F.col("id").alias("exhibition_id")))
    return with_child_count(shown, children.join(few, "exhibition_id", "left_semi"))


def gallery(parents: DataFrame, children: DataFrame, limit: int = 20, offset: int = 0, **conditions) -> DataFrame:
    """A gallery page with the total of matches: the gallery's columns, lists decoded (curators that aren't JSON as one name), artwork_count, total."""
    hits = search(parents, children, **conditions)
    shown = page(hits.select(*GALLERY), limit, offset)
    shown = shown.withColumns({"curators": json_list("curators", keep_raw=True), "tags": json_list("tags")})
    total = hits.agg(F.count("*").alias("total"))
    return page_with_child_count(shown, children).join(F.broadcast(total))  # one row


def detail(parents: DataFrame, children: DataFrame, parent_id: int) -> DataFrame:
    """One parent's row beside its children by (artist_name, work_title); the filter reaches both scans."""
    kids = children.filter(F.col("exhibition_id") == parent_id)
    return parents.filter(F.col("id") == parent_id).join(kids.drop("id"), F.col("id") == F.col("exhibition_id"), "left").orderBy("artist_name", "work_title")


def detail_record(parents: DataFrame, children: DataFrame, parent_id: int, fields: tuple[str, ...] = ("id", "artist_name", "work_title", "medium")) -> DataFrame:
    """One parent's row with its lists decoded and its children as one array, by (artist_name, work_title)."""
    kids = children.filter(F.col("exhibition_id") == parent_id)
    art = kids.agg(F.array_sort(F.collect_list(F.struct("artist_name", "work_title", *(c for c in fields if c not in ("artist_name", "work_title"))))).alias("_a"))
    art = art.select(F.transform("_a", lambda x: F.struct(*(x[c].alias(c) for c in fields))).alias("artworks"))
    one = parents.filter(F.col("id") == parent_id).withColumns({"curators": json_list("curators", keep_raw=True), "tags": json_list("tags")})
    return one.join(F.broadcast(art))  # one row


def statistics(parents: DataFrame, children: DataFrame) -> DataFrame:
    """One row: total_exhibitions, total_artworks, and the ranked lists museum_stats, top_artists, medium_stats, city_stats.

    Each list is ranked as a relation and has one entry for each source, city
    or rank, so one row holds it.
    """

    def ranked(df: DataFrame, name: str, key: str) -> DataFrame:
        rows = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col("name"))))
        return df.agg(F.transform(rows, lambda x: F.struct(x["name"].alias(key), (-x["o"]).alias("count"))).alias(name))

    out = totals(parents, children).toDF("total_exhibitions", "total_artworks")
    for part in (
        ranked(count_by(parents, "source"), "museum_stats", "source"),
        ranked(top_artists(children), "top_artists", "artist_name"),
        ranked(top_mediums(children), "medium_stats", "medium"),
        ranked(by_city(parents), "city_stats", "city"),
    ):
        out = out.join(F.broadcast(part))  # one row each
    return out
