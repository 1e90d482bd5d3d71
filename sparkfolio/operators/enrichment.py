"""Plans that fill missing fields: candidates, tiers and changes, all as relations to look at before they are applied."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.html import title_key
from sparkfolio.functions.scalars import last_number_in_path, present, synthesize_concept

# When a field counts as missing; keys of older records and the site keys they stand for.
ENRICH_FIELDS = {
    "concept": "concept is null or concept = '' or length(concept) < 50",
    "preface": "preface is null or preface = ''",
    "curators": "curators is null or curators = '[]' or curators = ''",
    "dates": "start_date is null or start_date = ''",
    "images": "images is null or images = '[]' or images = ''",
}
ANY_MISSING = f"{ENRICH_FIELDS['concept']} or {ENRICH_FIELDS['preface']} or curators = '[]' or {ENRICH_FIELDS['dates']}"
LEGACY_KEYS = {
    "serpentine_galleries": "serpentine",
    "tate_modern": "tate",
    "mori_art_museum": "mori",
    "m+_museum": "mplus",
    "art_institute_of_chicago": "aic",
}
SOURCE_TO_KEY = {
    "Serpentine Galleries": "serpentine_galleries",
    "Mori Art Museum": "mori_art_museum",
    "M+ Museum": "m+_museum",
    "Tate Modern": "tate_modern",
}
# Sources without pages to fetch images from, and those that block it.
NO_IMAGE_SOURCES = ("Art Institute of Chicago", "MoMA", "National Gallery of Art", "The Met", "Wikidata", "Rijksmuseum")
BLOCKED_SOURCES = (
    "Guggenheim",
    "LACMA",
    "Dia Art Foundation",
    "Whitechapel Gallery",
    "Hayward Gallery",
    "MASS MoCA",
    "Fondation Louis Vuitton",
    "Hirshhorn Museum",
)


def missing_filter(fields: tuple[str, ...] = ()) -> Column:
    """Whether one of the fields is missing; without fields the usual ones, unknown fields alone select all rows."""
    if not fields:
        return F.expr(ANY_MISSING)
    tests = [ENRICH_FIELDS["dates" if f == "date" else f] for f in fields if f in (*ENRICH_FIELDS, "date")]
    return F.expr(" or ".join(f"({t})" for t in tests)) if tests else F.lit(True)


def site_keys(keys: DataFrame, sites: DataFrame) -> DataFrame:
    """(parser_key, site_key) of all keys that stand for one of the sites: their own, and those of older records.

    ``keys`` has parser_key, ``sites`` key; both maps are a few rows, so the
    join is broadcast.
    """
    spark = keys.sparkSession
    legacy = spark.createDataFrame(list(LEGACY_KEYS.items()), "parser_key string, site_key string")
    own = sites.select(F.col("key").alias("parser_key"), F.col("key").alias("site_key"))
    known = own.union(legacy.join(sites.select(F.col("key").alias("site_key")), "site_key", "left_semi").select("parser_key", "site_key"))
    return keys.select("parser_key").filter(present("parser_key")).distinct().join(F.broadcast(known.dropDuplicates(["parser_key"])), "parser_key")


def enrichment_candidates(df: DataFrame, sites: DataFrame, fields: tuple[str, ...] = (), site: str | None = None, limit: int | None = None) -> DataFrame:
    """Records of sites whose pages are parsed that lack one of the fields, newest ids first, with their site_key.

    The tests on fields are grouped before they meet the one on keys.
    """
    pages = sites.filter(F.col("strategy") == "HTML_LLM")
    pages = pages.filter(F.col("key") == site) if site else pages
    known = F.broadcast(site_keys(df, pages))
    out = df.join(known, "parser_key").filter(missing_filter(fields)).orderBy(F.desc("id"))
    return out.limit(limit) if limit else out


# Sources whose concepts are made without fetching, and the kind of sentence.
SYNTHESIZED = {"MoMA": "moma", "Art Institute of Chicago": "aic", "Whitney Museum of American Art": "whitney"}


def artist_names(children: DataFrame, most: int = 16) -> DataFrame:
    """(id, names): the first ``most`` distinct artists of each parent by name, enough for a sentence and its suffix.

    Names are made distinct and cut per parent before they are collected, so
    no parent's list grows with its children.
    """
    from pyspark.sql import Window

    names = children.select(F.col("exhibition_id").alias("id"), F.trim("artist_name").alias("name")).filter(present("name")).distinct()
    cut = names.withColumn("_n", F.row_number().over(Window.partitionBy("id").orderBy("name"))).filter(F.col("_n") <= most)
    return cut.groupBy("id").agg(F.array_sort(F.collect_list("name")).alias("names"))


def synthesized_concepts(parents: DataFrame, children: DataFrame, kinds: dict[str, str] = SYNTHESIZED) -> DataFrame:
    """Changes (id, source, concept) for records of the given sources that have no concept."""
    todo = parents.filter(F.col("source").isin(*kinds) & F.expr("concept is null or concept = ''")).select("id", "source", "title", "preface")
    todo = todo.join(artist_names(children), "id", "left")
    told = F.coalesce(*(F.when(F.col("source") == s, synthesize_concept(k, "title", F.col("names"), "preface", "source")) for s, k in kinds.items()))
    return todo.select("id", "source", told.alias("concept")).filter(F.col("concept") != "")


def dry_run_counts(changes: DataFrame, key: str = "source") -> DataFrame:
    """How many records of each source a plan would change."""
    return changes.groupBy(key).agg(F.count("*").alias("updated"))


def apply_changes(df: DataFrame, changes: DataFrame, columns: tuple[str, ...], key: str = "id") -> DataFrame:
    """``df`` with the columns replaced where ``changes`` has the key and a value that isn't null."""
    new = changes.select(F.col(key).alias("_k"), *(F.col(c).alias(f"_new_{c}") for c in columns)).dropDuplicates(["_k"])
    out = df.join(new, F.col(key) == F.col("_k"), "left")
    return out.withColumns({c: F.coalesce(f"_new_{c}", c) for c in columns}).select(*df.columns)


def parsed_changes(candidates: DataFrame, parsed: DataFrame) -> DataFrame:
    """Changes (id, and each field or null) that parsed pages (id, fields) bring to candidates, each under its own guard.

    concept: missing or under 50 characters, new one of 20; preface: missing,
    new one of 10; dates: missing; curators and images: missing, new ones not
    empty. Records without any new field drop out.
    """
    new = parsed.select(F.col("id").alias("_id"), *(F.col(c).alias(f"_{c}") for c in ("concept", "preface", "curators", "images", "start_date", "end_date")))
    j = candidates.join(new, F.col("id") == F.col("_id"))
    lacks = lambda c: F.coalesce(F.col(c).isin("", "[]"), F.lit(True))
    empty = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    guards = {
        "concept": (empty("concept") | (F.length("concept") < 50)) & (F.length(F.trim("_concept")) >= 20),
        "preface": empty("preface") & (F.length(F.trim("_preface")) >= 10),
        "curators": lacks("curators") & ~F.coalesce(F.col("_curators").isin("", "[]"), F.lit(True)),
        "images": lacks("images") & ~F.coalesce(F.col("_images").isin("", "[]"), F.lit(True)),
        "start_date": empty("start_date") & present("_start_date"),
        "end_date": empty("end_date") & present("_end_date"),
    }
    out = j.select("id", *(F.when(g, F.col(f"_{c}")).alias(c) for c, g in guards.items()))
    return out.filter(F.coalesce(*(F.col(c) for c in guards)).isNotNull())


def image_candidates(df: DataFrame, source: str | None = None, limit: int | None = None) -> DataFrame:
    """Records without images of one source, or of all but those that have no pages or block them; newest ids first."""
    out = df.filter(F.expr(ENRICH_FIELDS["images"]))
    out = out.filter(F.col("source") == source) if source else out.filter(~F.col("source").isin(*NO_IMAGE_SOURCES, *BLOCKED_SOURCES))
    out = out.orderBy(F.desc("id"))
    return out.limit(limit) if limit else out


def image_changes(df: DataFrame, images: DataFrame, marker: str = "/exhibitions/") -> DataFrame:
    """Changes (id, images) from a map of numbers in urls to image urls (number, image_url)."""
    m = images.filter(F.col("number").isNotNull() & present("image_url")).groupBy("number").agg(F.max("image_url").alias("image_url"))
    todo = df.filter(F.expr(ENRICH_FIELDS["images"])).withColumn("number", last_number_in_path("url", marker))
    return todo.join(m, "number").select("id", F.to_json(F.array("image_url")).alias("images"))


def curators_by_title(rows: DataFrame) -> DataFrame:
    """(title_key, curators): the distinct curators of exhibition rows (ExhibitionTitle, DisplayName, ExhibitionRole, pos), in file order.

    Each name's first place is taken before a title's names meet.
    """
    named = rows.select(title_key("ExhibitionTitle").alias("title_key"), F.trim("DisplayName").alias("name"), F.coalesce("ExhibitionRole", F.lit("")).alias("role"), "pos")
    named = named.filter(present("title_key") & present("name") & F.col("role").rlike("Curator|Director|Organiz"))
    named = named.groupBy("title_key", "name").agg(F.min("pos").alias("pos"))
    return named.groupBy("title_key").agg(F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("c")).select("title_key", F.col("c.name").alias("curators"))


def curator_changes(df: DataFrame, curators: DataFrame) -> DataFrame:
    """(id, curators, status) of records without curators: updated where the title is known, else no_match or no_title."""
    todo = df.filter(F.expr(ENRICH_FIELDS["curators"])).select("id", title_key("title").alias("title_key"))
    out = todo.join(curators, "title_key", "left")
    status = F.when(~present("title_key"), "no_title").when(F.col("curators").isNull(), "no_match").otherwise("updated")
    return out.select("id", F.when(status == "updated", F.to_json("curators")).alias("curators"), status.alias("status"))
