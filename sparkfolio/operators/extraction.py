"""Structured extraction: content gates, cached calls, response parsing, validity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.scalars import cache_key, fence_stripped, present, strip
from sparkfolio.storage import materialise

# A record's text fields, lists of texts, and the fields of its artworks; titles that say nothing.
TEXTS = "title preface concept preface_en concept_en biographies biographies_cn credits start_date end_date location city".split()
LISTS = ("curators", "images")
WORK = "artist_name work_title work_year medium dimensions caption".split()
NO_TITLE = ("N/A", "n/a", "NA", "null", "")

RECORD = "struct<{}>".format(
    ",".join([*(f"{c}:string" for c in TEXTS), *(f"{c}:array<string>" for c in LISTS), "artworks:array<struct<{}>>".format(",".join(f"{c}:string" for c in WORK))])
)
MOST_HTML = 5 * 1024 * 1024
LEAST_TEXT = 100


def page_gate(html: Column, text: Column) -> Column:
    """Why a fetched page isn't extracted: too_large (characters of the page), too_short (of its cleaned text), else null."""
    return F.when(F.length(html) > MOST_HTML, "too_large").when(F.coalesce(F.length(strip(text)), F.lit(0)) < LEAST_TEXT, "too_short")


def _kind(value: Column) -> Column:
    return F.regexp_extract(F.coalesce(F.schema_of_variant(value), F.lit("VOID")), "^([A-Z]+)", 1)


def parse_response(raw: Column) -> Column:
    """struct(record, ok): the object (or a list's first) of a plain or fenced JSON answer, typed strictly.

    Refused as a whole: text that isn't JSON, an absent or null title, a text
    that is of another type, a list that isn't one (null included) or holds
    other than texts, artworks that aren't objects of texts. Unknown keys
    drop, absent lists read as empty.
    """
    # Bound as lambda variables, so the text is parsed once.
    whole = F.transform(F.array(F.try_parse_json(fence_stripped(raw))), lambda v: F.when(_kind(v) == "ARRAY", F.try_variant_get(v, "$[0]", "variant")).otherwise(v))
    return F.transform(whole, _checked)[0]


def _checked(v: Column) -> Column:
    """struct(record, ok) of a parsed answer."""
    at = lambda c: F.try_variant_get(v, f"$.{c}", "variant")
    record = F.from_json(F.to_json(v), RECORD)
    empty_list = F.array().cast("array<string>")
    empty_works = F.expr("array()").cast("array<struct<{}>>".format(",".join(f"{c}:string" for c in WORK)))

    def listed(c: str, fits: Callable[[Column], Column]) -> Column:
        """Absent, or a list whose entries fit."""
        entries = F.try_variant_get(v, f"$.{c}", "array<variant>")
        return at(c).isNull() | (entries.isNotNull() & F.forall(entries, fits))

    text = lambda x: _kind(x) == "STRING"
    works = lambda x: F.coalesce(
        (_kind(x) == "OBJECT") & _all(_kind(F.try_variant_get(x, f"$.{c}", "variant")).isin("STRING", "VOID") for c in WORK), F.lit(False)
    )
    typed = _all([*(_kind(at(c)).isin("STRING", "VOID") for c in TEXTS), *(listed(c, text) for c in LISTS), listed("artworks", works)])
    ok = F.coalesce((_kind(v) == "OBJECT") & (_kind(at("title")) == "STRING") & typed, F.lit(False))
    fields = [*(record[c].alias(c) for c in TEXTS), *(F.coalesce(record[c], empty_list).alias(c) for c in LISTS), F.coalesce(record["artworks"], empty_works).alias("artworks")]
    return F.struct(F.when(ok, F.struct(*fields)).alias("record"), ok.alias("ok"))


def _all(tests) -> Column:
    out = F.lit(True)
    for t in tests:
        out = out & t
    return out


def valid_result(title: Column, start: Column, end: Column, preface: Column, concept: Column) -> Column:
    """A title that says something, and a date or 30 characters of text; a concept given needs 20, blanks at its ends apart."""
    text = F.array_join(F.filter(F.array(preface, concept), lambda x: x != ""), " ")
    c = F.coalesce(concept, F.lit(""))
    dated = present(start) | present(end)
    said = ~F.coalesce(title, F.lit("")).isin(*NO_TITLE)
    return said & (dated | (F.length(strip(text)) >= 30)) & ((c == "") | (F.length(strip(c)) >= 20))


def cached_extract(pages: DataFrame, cache: DataFrame, extract: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame]:
    """(answers of all pages, new cache rows) of pages (url, source, city, text).

    Keys are those of "source:city" and the text. ``extract`` gets the text
    of each key missing in the cache (cache_key, result_json) once, however
    many pages have it, and gives a raw answer; answers that don't parse or
    say too little become null and aren't cached. A corrupted cache entry
    counts as a miss. The new cache rows are written first, so that no answer
    is asked for again by those who read the result.
    """
    where = F.concat(F.coalesce("source", F.lit("")), F.lit(":"), F.coalesce("city", F.lit("")))
    keyed = pages.withColumn("cache_key", cache_key(where, "text"))
    good = cache.filter(F.try_parse_json("result_json").isNotNull()).select("cache_key", "result_json").dropDuplicates(["cache_key"])
    hits = keyed.join(good, "cache_key")
    misses = keyed.join(good.select("cache_key"), "cache_key", "left_anti")
    asked = misses.select("cache_key", "text").dropDuplicates(["cache_key"]).withColumn("_r", parse_response(extract(F.col("text"))))
    r = F.col("_r.record")
    fine = F.col("_r.ok") & valid_result(r["title"], r["start_date"], r["end_date"], r["preface"], r["concept"])
    asked = materialise(asked.select("cache_key", F.when(fine, F.to_json(r)).alias("result_json")), "extracted")
    answered = misses.join(asked, "cache_key")
    return hits.unionByName(answered.select(*hits.columns)), asked.filter("result_json IS NOT NULL")


# Words and parts of words that tell an event from an exhibition, types of event links.
EVENT_KEYWORDS = [
    "talk",
    "workshop",
    "symposium",
    "seminar",
    "conference",
    "lecture",
    "conversation",
    "screening",
    "film",
    "performance",
    "concert",
    "recital",
    "study-evening",
    "celebration",
    "launch",
    "reading",
    "discussion",
    "panel",
    "gala",
    "dinner",
    "salon",
    "tour",
    "school-visit",
    "podcast",
    "marathon",
    "park-nights",
    "saturday-talks",
    "book-club",
    "study-day",
]
EVENT_PARTS = "-talks|-nights|workshop|symposium|seminar|conference|lecture|conversation|screening|performance|concert|launch|reading|discussion|panel|tour|podcast|marathon"
EVENT_TYPES = ("events", "live", "publication", "digital", "education", "research")

EVENT_PATTERN = r"(?i)\b(" + "|".join(EVENT_KEYWORDS) + r")s?\b|(" + EVENT_PARTS + ")"


def names_event(c: Column) -> Column:
    """Whether a text holds an event word or a part of one."""
    return F.coalesce(c.rlike(EVENT_PATTERN), F.lit(False))


def is_event_type(url: Column) -> Column:
    """Whether a link's ``?type=`` is one of events."""
    u = F.coalesce(url, F.lit(""))
    return u.contains("?type=") & u.rlike("type=(" + "|".join(EVENT_TYPES) + ")")


def is_event(url: Column, title: Column) -> Column:
    """Whether a stored record is an event or an archive page rather than an exhibition."""
    return F.coalesce(url, F.lit("")).contains("/archive/") | names_event(url) | names_event(title)
