"""Queries of the operators over the star-schema tables, each with the SQL it must agree with; ``records`` has more of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkfolio.functions import scalars as X
from sparkfolio.operators import analytics as A
from sparkfolio.operators import enrichment as E
from sparkfolio.operators import quality as Q
from sparkfolio.operators import runlog as R
from sparkfolio.operators import store as W
from sparkfolio.plans.roles import CHILDREN, ORACLE_SQL, PARENTS, QUERIES, RUNS, children, parents, query, role, run_log
from sparkfolio.session import load_table
from sparkfolio.sources import files as S
from sparkfolio.sources.sites import series
from sparkfolio.streaming import runs as ST

_NAMED = "artist_name <> '' AND lower(artist_name) NOT LIKE '%various%' AND lower(artist_name) NOT LIKE '%unknown%' AND lower(artist_name) NOT LIKE '%multiple%'"
_YEAR = "CAST(nullif(regexp_extract(start_date, '\\b(19[0-9]{2}|20[0-9]{2})\\b', 1), '') AS INTEGER)"


# --- analytics -------------------------------------------------------------------------------------------------------
@query("SELECT (SELECT count(*) FROM parents) AS parents, (SELECT count(*) FROM children) AS children")
def stats_totals(s, d):
    return A.totals(load_table(s, d, "orders"), load_table(s, d, "lineitem"))


@query("SELECT source AS name, count(*) AS n FROM parents GROUP BY source")
def source_distribution(s, d):
    return A.count_by(parents(s, d), "source")


@query(f"SELECT artist_name AS name, count(*) AS n FROM children WHERE {_NAMED} GROUP BY 1 ORDER BY n DESC, name LIMIT 15")
def top_artists(s, d):
    return A.top_artists(children(s, d))


@query("SELECT medium AS name, count(*) AS n FROM children WHERE medium <> '' GROUP BY 1 ORDER BY n DESC, name LIMIT 12")
def medium_distribution(s, d):
    return A.top_mediums(children(s, d))


@query("SELECT city AS name, count(*) AS n FROM parents WHERE city <> '' GROUP BY 1")
def city_distribution(s, d):
    return A.by_city(parents(s, d))


@query(
    f"SELECT y.year, s.source, coalesce(c.n, 0)::BIGINT AS n FROM (SELECT DISTINCT {_YEAR} AS year FROM parents WHERE start_date <> '' AND {_YEAR} BETWEEN 1920 AND 2026) y "
    f"CROSS JOIN (SELECT DISTINCT source FROM parents WHERE start_date <> '') s LEFT JOIN (SELECT source, {_YEAR} AS year, count(*) AS n FROM parents GROUP BY 1, 2) c ON c.year = y.year AND c.source = s.source"
)
def timeline_long(s, d):
    return A.timeline(parents(s, d))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    f"SELECT {_YEAR} AS year, " + ", ".join(f"count(*) FILTER (source = '{p}') AS s{i}" for i, p in enumerate(_PRIORITIES)) + f" FROM parents WHERE {_YEAR} BETWEEN 1920 AND 2026 GROUP BY 1"
)
def timeline_pivot(s, d):
    return A.timeline_wide(parents(s, d), _PRIORITIES)


_LINKS = f"""SELECT a.artist_name AS source, b.artist_name AS target, count(*) AS weight FROM children a JOIN children b
 ON a.exhibition_id = b.exhibition_id AND a.artist_name < b.artist_name
 WHERE a.artist_name IN (SELECT artist_name FROM top40) AND b.artist_name IN (SELECT artist_name FROM top40)
 GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY weight DESC, source, target LIMIT 300"""
_TOP40 = f"SELECT artist_name FROM children WHERE {_NAMED} GROUP BY 1 ORDER BY count(*) DESC, artist_name LIMIT 40"


@query(_LINKS, {"children": CHILDREN, "top40": _TOP40})
def cooccurrence_links(s, d):
    return A.cooccurrence_links(children(s, d))


@query(
    "SELECT name, n, round(greatest(6.0, least(22.0, 6 + sqrt(n))), 4) AS size, round(8 + 36 * CASE WHEN hi = lo THEN 0.5 ELSE (n - lo)::DOUBLE / (hi - lo) END, 4) AS radius, "
    "CASE WHEN n >= 30 THEN 3 WHEN n >= 15 THEN 2 WHEN n >= 8 THEN 1 ELSE 0 END AS bucket FROM (SELECT *, min(n) OVER () AS lo, max(n) OVER () AS hi FROM "
    f"(SELECT artist_name AS name, count(*) AS n FROM children WHERE {_NAMED} AND artist_name IN (SELECT source FROM links UNION SELECT target FROM links) GROUP BY 1))",
    {"children": CHILDREN, "top40": _TOP40, "links": _LINKS},
)
def cooccurrence_nodes(s, d):
    shares = A.artist_shares(children(s, d))
    return A.cooccurrence_nodes(shares, A.links_of_shares(shares))


_SEARCH = "SELECT id FROM parents WHERE " + " OR ".join(f"lower({c}) LIKE '%customer 12%'" for c in "title preface concept curators location preface_en concept_en".split()) + " UNION SELECT exhibition_id FROM children WHERE lower(artist_name) LIKE '%customer 12%' OR lower(work_title) LIKE '%customer 12%'"


@query(_SEARCH)
def search_union(s, d):
    return A.search(parents(s, d), children(s, d), "CUSTOMER 12").select("id")


@query("SELECT id, source FROM parents WHERE source = '1-URGENT' AND CAST(substr(start_date, 1, 4) AS INTEGER) BETWEEN 1996 AND 1998")
def search_year_range(s, d):
    return A.search(parents(s, d), children(s, d), source="1-URGENT", year_from=1996, year_to=1998).select("id", "source")


@query(
    "SELECT p.id, p.title, p.start_date, coalesce(c.n, 0)::BIGINT AS artwork_count, t.total FROM (SELECT * FROM parents WHERE source = '2-HIGH' ORDER BY start_date DESC NULLS LAST, id DESC LIMIT 20 OFFSET 40) p "
    "LEFT JOIN (SELECT exhibition_id, count(*) AS n FROM children GROUP BY 1) c ON c.exhibition_id = p.id CROSS JOIN (SELECT count(*) AS total FROM parents WHERE source = '2-HIGH') t"
)
def exhibitions_page(s, d):
    hits = A.search(parents(s, d), children(s, d), source="2-HIGH")
    shown = A.page_with_child_count(A.page(hits, 20, 40), children(s, d))
    return shown.join(F.broadcast(hits.agg(F.count("*").alias("total")))).select("id", "title", "start_date", "artwork_count", "total")


@query("SELECT p.id, p.title, c.artist_name, c.work_title FROM parents p LEFT JOIN children c ON c.exhibition_id = p.id WHERE p.id = 5")
def exhibition_detail(s, d):
    return A.detail(parents(s, d), children(s, d), 5).select("id", "title", "artist_name", "work_title")


@query("SELECT p.id, coalesce(c.n, 0)::BIGINT AS artwork_count FROM parents p LEFT JOIN (SELECT exhibition_id, count(*) AS n FROM children GROUP BY 1) c ON c.exhibition_id = p.id")
def artwork_count(s, d):
    return A.with_child_count(parents(s, d), children(s, d)).select("id", "artwork_count")


# --- quality ---------------------------------------------------------------------------------------------------------
def _rules():
    every = Q.missing_rules()
    return {c: every[c] for c in ("title", "concept", "city", "start_date", "end_date", "curators")}


_MISS = {
    "title": "title IS NULL OR title = ''", "concept": "concept IS NULL OR concept = ''", "city": "city IS NULL OR city = ''",
    "start_date": "start_date IS NULL", "end_date": "end_date IS NULL", "curators": "curators IS NULL OR curators = '[]'",
}
_MISS_SUMS = ", ".join(f"count(*) FILTER ({w}) AS missing_{c}, round(count(*) FILTER ({w}) * 100.0::DOUBLE / count(*), 2) AS pct_{c}" for c, w in _MISS.items())


@query(f"SELECT parser_key, count(*) AS total, {_MISS_SUMS} FROM parents GROUP BY parser_key")
def missing_fields_by_key(s, d):
    return Q.missing_profile(parents(s, d), "parser_key", _rules())


@query(f"SELECT count(*) AS total, {_MISS_SUMS} FROM parents")
def missing_fields_overall(s, d):
    return Q.missing_profile(parents(s, d), None, _rules())


@query("SELECT parser_key, count(*) AS total, grouping(parser_key)::INTEGER AS is_total, " + ", ".join(f"count(*) FILTER ({w}) AS missing_{c}" for c, w in _MISS.items()) + " FROM parents GROUP BY ROLLUP (parser_key)")
def missing_fields_rollup(s, d):
    return Q.missing_cube(parents(s, d), "parser_key", _rules())


_DUP = "count(*) AS cnt, min(id) AS first_id, max(id) AS last_id FROM parents"


@query(f"SELECT parser_key, title, {_DUP} WHERE title IS NOT NULL AND title <> '' GROUP BY 1, 2 HAVING count(*) > 1")
def dup_exact(s, d):
    return Q.duplicate_groups(Q.titled(parents(s, d)), ["parser_key", "title"])


@query(f"SELECT parser_key, title, start_date, {_DUP} WHERE title IS NOT NULL AND title <> '' AND start_date IS NOT NULL GROUP BY 1, 2, 3 HAVING count(*) > 1")
def dup_near(s, d):
    return Q.duplicate_groups(Q.titled(parents(s, d)).filter("start_date is not null"), ["parser_key", "title", "start_date"])


@query(f"SELECT url, {_DUP} WHERE url IS NOT NULL AND url <> '' GROUP BY 1 HAVING count(*) > 1")
def dup_url(s, d):
    return Q.duplicate_groups(parents(s, d).filter("url <> ''"), ["url"])


@query("SELECT first_id, cnt, id FROM (SELECT id, min(id) OVER w AS first_id, count(*) OVER w AS cnt FROM parents WHERE title <> '' WINDOW w AS (PARTITION BY parser_key, title)) WHERE cnt > 1")
def dup_members(s, d):
    return Q.duplicate_members(Q.titled(parents(s, d)), ["parser_key", "title"])


@query("SELECT md5(text) AS text_md5, count(*) AS cnt, min(doc_id) AS first_id, max(doc_id) AS last_id FROM documents GROUP BY text HAVING count(*) > 1")
def dup_documents(s, d):
    keyed = load_table(s, d, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"))
    return Q.duplicate_groups(keyed, ["text_md5"], "doc_id")


_RAWDATE = "CASE id % 4 WHEN 0 THEN start_date WHEN 1 THEN substr(start_date, 1, 4) WHEN 2 THEN substr(start_date, 1, 7) ELSE concat(CAST(CAST(substr(start_date, 6, 2) AS INTEGER) AS string), '/', substr(start_date, 9, 2), '/', substr(start_date, 1, 4)) END"


@query("SELECT id, raw, CASE WHEN raw IS NULL THEN NULL WHEN id % 4 = 0 THEN start_date WHEN id % 4 = 1 THEN concat(substr(start_date, 1, 4), '-01-01') WHEN id % 4 = 2 THEN concat(substr(start_date, 1, 7), '-01') ELSE start_date END AS value, coalesce(id % 4 <> 0 AND start_date IS NOT NULL, false) AS changed "
       f"FROM (SELECT *, CASE WHEN start_date IS NULL THEN NULL ELSE {_RAWDATE} END AS raw FROM parents)")  # fmt: skip
def normalize_dates(s, d):
    p = parents(s, d).withColumn("raw", F.when(F.col("start_date").isNotNull(), F.expr(_RAWDATE)))
    return p.select("id", "raw", X.normalize_date("raw").alias("n")).select("id", "raw", "n.value", "n.changed")


# The record check as its rules read: a title is missing or short, else noise; dates compare only where both are strict.
_NOISE = "home menu exhibitions exhibition about contact visit support donate shop search events news education collections artists programs gallery museum foundation press privacy terms cookies subscribe newsletter login sign_up loading back next previous close open more less"
_NOISE_SQL = ", ".join("'" + w.replace("_", " ") + "'" for w in _NOISE.split())
_STRICT = "regexp_matches({}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"
_ISSUES = f"""SELECT id, source, i.field AS field, i.severity AS severity, i.detail AS detail FROM (SELECT id, source, unnest(list_filter([
 CASE WHEN coalesce(title, '') = '' OR length(trim(title)) < 3 THEN {{'field': 'title', 'severity': 'error', 'detail': 'Missing or too short'}}
   WHEN lower(trim(title)) IN ({_NOISE_SQL}) THEN {{'field': 'title', 'severity': 'error', 'detail': concat('Noise word: ''', trim(title), '''')}} END,
 CASE WHEN start_date <> '' AND NOT {_STRICT.format('start_date')} THEN {{'field': 'start_date', 'severity': 'warn', 'detail': concat('Non-standard format: ''', start_date, '''')}} END,
 CASE WHEN end_date <> '' AND NOT {_STRICT.format('end_date')} THEN {{'field': 'end_date', 'severity': 'warn', 'detail': concat('Non-standard format: ''', end_date, '''')}} END,
 CASE WHEN {_STRICT.format('start_date')} AND {_STRICT.format('end_date')} AND start_date > end_date THEN {{'field': 'dates', 'severity': 'error', 'detail': concat('start_date (', start_date, ') > end_date (', end_date, ')')}} END,
 CASE WHEN coalesce(concept, '') = '' THEN {{'field': 'concept', 'severity': 'warn', 'detail': 'Missing'}}
   WHEN length(trim(concept)) < 50 THEN {{'field': 'concept', 'severity': 'warn', 'detail': concat('Too short (', length(trim(concept)), ' chars)')}} END,
 CASE WHEN coalesce(preface, '') = '' THEN {{'field': 'preface', 'severity': 'info', 'detail': 'Missing'}} END,
 CASE WHEN coalesce(city, '') = '' THEN {{'field': 'city', 'severity': 'warn', 'detail': 'Missing'}} END,
 CASE WHEN coalesce(parser_key, '') = '' THEN {{'field': 'parser_key', 'severity': 'error', 'detail': 'Empty'}} END], lambda x: x IS NOT NULL)) AS i FROM parents)
 UNION ALL SELECT p.id, p.source, 'artwork', 'warn', concat('ID ', c.id, ': ', array_to_string(list_filter([CASE WHEN trim(artist_name) = '' THEN 'missing artist_name' END,
   CASE WHEN trim(work_title) = '' THEN 'missing work_title' END, CASE WHEN trim(artist_name) = trim(work_title) AND artist_name <> '' THEN 'artist_name == work_title (possible hallucination)' END], lambda x: x IS NOT NULL), ', '))
   FROM children c JOIN parents p ON p.id = c.exhibition_id WHERE trim(artist_name) = '' OR trim(work_title) = '' OR (trim(artist_name) = trim(work_title) AND artist_name <> '')"""
_WITH_ISSUES = {"parents": PARENTS, "children": CHILDREN, "issues": _ISSUES}


def _issues(s, d):
    return Q.record_issues(parents(s, d), children(s, d))


@query("SELECT * FROM issues", _WITH_ISSUES)
def validate_records(s, d):
    return _issues(s, d)


@query("SELECT field, severity, count(*) AS n FROM issues GROUP BY 1, 2", _WITH_ISSUES)
def issue_counts(s, d):
    return Q.issue_counts(_issues(s, d))


_RATES = (
    "SELECT p.source, count(*) AS total, count(c.id) AS with_issues, count(*) FILTER (c.errors > 0) AS with_errors, round(count(c.id) * 100.0::DOUBLE / count(*), 1) AS issue_rate "
    "FROM parents p LEFT JOIN (SELECT id, count(*) FILTER (severity = 'error') AS errors FROM issues GROUP BY id) c ON c.id = p.id GROUP BY 1"
)


@query(_RATES, _WITH_ISSUES)
def source_issue_rate(s, d):
    return Q.issue_rates(parents(s, d), _issues(s, d))


# The extraction check over documents (concept), with titles, dates and works made of their ids.
_NOISE_B = "home homepage menu untitled exhibition exhibitions current upcoming past archive about visit tickets shop support contact news press events program education research collection collections artists"
EXTRACTED = """SELECT id, source, CASE WHEN id % 7 = 0 THEN 'Archive' WHEN id % 11 = 0 THEN 'x ' ELSE title END AS title, start_date, end_date, CASE WHEN id % 13 = 0 THEN 'Too short a concept' ELSE concept END AS concept, preface, city,
 CASE WHEN id % 3 = 0 THEN '' ELSE 'An artist' END AS artist, CASE WHEN id % 4 = 0 THEN '' ELSE 'A work' END AS work, id % 5 AS n FROM parents"""
_EXTRACTION_ISSUES = f"""SELECT id, source, list_filter([
 CASE WHEN coalesce(title, '') = '' OR length(trim(title)) < 3 THEN 'title missing or too short' WHEN lower(title) IN ({", ".join(f"'{w}'" for w in _NOISE_B.split())}) THEN concat('title looks like noise: ''', title, '''') END,
 CASE WHEN start_date <> '' AND NOT {_STRICT.format('start_date')} THEN concat('start_date invalid format (expected YYYY-MM-DD): ''', start_date, '''') END,
 CASE WHEN end_date <> '' AND NOT {_STRICT.format('end_date')} THEN concat('end_date invalid format (expected YYYY-MM-DD): ''', end_date, '''') END,
 CASE WHEN concept <> '' AND length(trim(concept)) < 30 THEN 'concept too short (< 30 chars)' END, CASE WHEN coalesce(concept, '') = '' THEN 'concept is missing' END,
 CASE WHEN coalesce(preface, '') = '' THEN 'preface is missing' END, CASE WHEN n > 0 AND work = '' THEN 'artworks[0] missing work_title' END,
 CASE WHEN n > 1 THEN 'artworks[1] missing work_title' END, CASE WHEN n > 0 AND artist = '' AND n < 2 THEN 'all artworks missing artist_name' END,
 CASE WHEN coalesce(city, '') = '' THEN 'city is missing' END], lambda x: x IS NOT NULL) AS issues FROM extracted"""
_WITH_EXTRACTED = {"parents": PARENTS, "extracted": EXTRACTED, "checked": _EXTRACTION_ISSUES}


def _extraction(s, d):
    p = parents(s, d)
    title = F.when(F.col("id") % 7 == 0, "Archive").when(F.col("id") % 11 == 0, "x ").otherwise(F.col("title"))
    work = F.struct(F.when(F.col("id") % 3 == 0, "").otherwise("An artist").alias("artist_name"), F.when(F.col("id") % 4 == 0, "").otherwise("A work").alias("work_title"))
    second = F.struct(F.lit("Another").alias("artist_name"), F.lit(None).cast("string").alias("work_title"))
    n = F.col("id") % 5
    works = F.when(n == 0, F.array().cast("array<struct<artist_name:string,work_title:string>>")).when(n == 1, F.array(work)).otherwise(F.array(work, second))
    return Q.extraction_issues(p.withColumns({"title": title, "concept": F.when(F.col("id") % 13 == 0, "Too short a concept").otherwise(F.col("concept")), "artworks": works}))


@query("SELECT id, issue FROM (SELECT id, unnest(issues) AS issue FROM checked)", _WITH_EXTRACTED)
def validate_extraction(s, d):
    return _extraction(s, d).select("id", F.explode("issues").alias("issue"))


_VERDICT_KEYS = "SELECT DISTINCT source AS parser_key, CASE WHEN source = '5-LOW' THEN 'REST_API' ELSE 'HTML_LLM' END AS strategy, CASE WHEN source = '4-NOT SPECIFIED' THEN 0 ELSE 3 END AS urls_found FROM parents"


@query(
    "SELECT k.parser_key, coalesce(r.tested, 0) AS tested, coalesce(r.n, 0) AS n_issues, CASE WHEN strategy <> 'HTML_LLM' THEN 'SKIPPED' WHEN urls_found = 0 THEN 'NO_URLS' WHEN r.tested IS NULL THEN 'NO_RESULTS' "
    "WHEN r.n::DOUBLE / r.tested = 0 THEN 'PASS' WHEN r.n::DOUBLE / r.tested <= 2 THEN 'WARN' ELSE 'FAIL' END AS verdict FROM keys k "
    "LEFT JOIN (SELECT source, count(*) AS tested, sum(len(issues))::BIGINT AS n FROM checked WHERE source <> '3-MEDIUM' AND (source <> '2-HIGH' OR len(issues) < 2) GROUP BY 1) r ON r.source = k.parser_key",
    _WITH_EXTRACTED | {"keys": _VERDICT_KEYS},
)
def llm_verdict(s, d):
    keys = parents(s, d).select(F.col("source").alias("parser_key")).distinct().withColumns(
        {"strategy": F.when(F.col("parser_key") == "5-LOW", "REST_API").otherwise("HTML_LLM"), "urls_found": F.when(F.col("parser_key") == "4-NOT SPECIFIED", 0).otherwise(3)}
    )
    r = _extraction(s, d).filter((F.col("source") != "3-MEDIUM") & ((F.col("source") != "2-HIGH") | (F.size("issues") < 2)))
    return Q.verdicts(r.select(F.col("source").alias("parser_key"), "issues"), keys)


@query("SELECT issue, count(*) AS n FROM (SELECT unnest(issues) AS issue FROM checked) GROUP BY 1 ORDER BY n DESC, issue LIMIT 30", _WITH_EXTRACTED)
def issue_breakdown(s, d):
    return Q.issue_breakdown(_extraction(s, d))


@query(
    "SELECT id, CASE WHEN id % 4 = 1 THEN 'curators is not a list: str' WHEN id % 4 = 2 THEN 'artworks is not a list: dict' WHEN id % 4 = 3 THEN 'artworks[1] is not a dict: int' END AS issue FROM parents WHERE id % 4 <> 0"
)
def typed_issues(s, d):
    j = F.when(F.col("id") % 4 == 1, F.lit('{"curators":"x","artworks":[]}')).when(F.col("id") % 4 == 2, F.lit('{"artworks":{"a":1}}')).when(F.col("id") % 4 == 3, F.lit('{"artworks":[{},7]}')).otherwise(F.lit("{}"))
    return parents(s, d).select("id", F.explode(Q.typed_issues(j)).alias("issue"))


@query("SELECT id, exhibition_id FROM children WHERE exhibition_id NOT IN (SELECT id FROM parents WHERE id % 3 <> 0) ORDER BY 1 LIMIT 100")
def artworks_orphaned(s, d):
    return Q.orphans(children(s, d), parents(s, d).filter("id % 3 <> 0")).select("id", "exhibition_id")


_KINDS = """SELECT c.id, c.exhibition_id, p.source, unnest(list_filter([
 CASE WHEN trim(artist_name) = '' OR trim(work_title) = '' THEN {'t': 'missing_field', 'd': concat('Missing: ', CASE WHEN trim(artist_name) = '' AND trim(work_title) = '' THEN 'artist_name, work_title' WHEN trim(artist_name) = '' THEN 'artist_name' ELSE 'work_title' END)} END,
 CASE WHEN f AND lower(trim(artist_name)) = lower(trim(work_title)) THEN {'t': 'suspicious', 'd': concat('artist_name == work_title: ''', substr(trim(artist_name), 1, 50), '''')} END,
 CASE WHEN f AND (regexp_matches(artist_name, 'https?://') OR regexp_matches(work_title, 'https?://')) THEN {'t': 'suspicious', 'd': concat('URL detected in name: artist=''', substr(trim(artist_name), 1, 30), ''', title=''', substr(trim(work_title), 1, 30), '''')} END,
 CASE WHEN f AND (length(trim(artist_name)) > 200 OR length(trim(work_title)) > 200) THEN {'t': 'suspicious', 'd': concat('Abnormally long: artist=', length(trim(artist_name)), ' chars, title=', length(trim(work_title)), ' chars')} END], lambda x: x IS NOT NULL)) AS k
 FROM (SELECT *, trim(artist_name) <> '' AND trim(work_title) <> '' AS f FROM children) c JOIN parents p ON p.id = c.exhibition_id"""
_WITH_KINDS = {"parents": PARENTS, "children": CHILDREN, "kinds": _KINDS}


@query("SELECT id, exhibition_id, source, 'warn' AS severity, k.d AS detail FROM kinds WHERE k.t = 'missing_field' AND source = '1-URGENT'", _WITH_KINDS)
def artworks_missing(s, d):
    found = Q.child_issues(children(s, d), parents(s, d), "1-URGENT").filter("type = 'missing_field'")
    return found.select("id", "exhibition_id", "source", "severity", "detail")


@query("SELECT id, k.d AS detail FROM kinds WHERE k.t = 'suspicious'", _WITH_KINDS)
def artworks_suspicious(s, d):
    return Q.child_issues(children(s, d), parents(s, d)).filter("type = 'suspicious'").select("id", "detail")


@query("SELECT k.t AS type, 'warn' AS severity, count(*) AS n FROM kinds GROUP BY 1", _WITH_KINDS)
def artwork_issue_counts(s, d):
    return Q.child_issues(children(s, d), parents(s, d)).groupBy("type", "severity").agg(F.count("*").alias("n"))


@query("SELECT p.id, p.title FROM parents p WHERE site_key NOT IN ('aic', 'wikidata', 'rijksmuseum', 'met', 'whitney', 'tate') AND NOT EXISTS (SELECT 1 FROM children c WHERE c.exhibition_id = p.id AND line > 1) ORDER BY 1 LIMIT 50")
def artworks_zero(s, d):
    p = parents(s, d).withColumn("parser_key", F.when(F.col("site_key") == "tate", "met").otherwise(F.col("site_key")))
    return Q.zero_children(p, children(s, d).filter("line > 1")).select("id", "title")


@query("SELECT * FROM (SELECT exhibition_id AS id, count(*) AS artwork_count FROM children GROUP BY 1) WHERE artwork_count > 5 ORDER BY artwork_count DESC, id LIMIT 20")
def artworks_excessive(s, d):
    return Q.excessive_children(parents(s, d), children(s, d), 5).select("id", "artwork_count")


@query("SELECT exhibition_id, line, min(artist_name) AS artist_name FROM children GROUP BY 1, 2")
def artworks_keep_first(s, d):
    return Q.keep_first(children(s, d).select("exhibition_id", "line", "artist_name"), ["exhibition_id", "line"], "artist_name")


@query(
    "SELECT light, CASE light WHEN 'PASS' THEN 'green' WHEN 'WARN' THEN 'yellow' ELSE 'red' END AS colour, count(*) AS n FROM (SELECT CASE WHEN id % 10 = 1 THEN CASE id % 3 WHEN 0 THEN 'TIMEOUT' WHEN 1 THEN 'BLOCKED_SSL' ELSE 'FAIL' END "
    "WHEN u >= 5 OR (run_type <> 'full' AND u > 0) THEN 'PASS' WHEN u > 0 THEN 'WARN' WHEN id % 4 = 0 THEN 'BLOCKED_403' ELSE 'ZERO_URLS' END AS light FROM (SELECT *, urls_discovered % 9 AS u FROM runs)) GROUP BY 1, 2"
)
def traffic_lights(s, d):
    raised = F.when(F.col("id") % 10 == 1, F.when(F.col("id") % 3 == 0, "read Timeout").when(F.col("id") % 3 == 1, "bad certificate").otherwise("boom"))
    light = Q.traffic_light(F.col("urls_discovered") % 9, F.col("run_type") == "full", F.when(F.col("id") % 4 == 0, "403"), raised)
    r = run_log(s, d).select(light.alias("light"))
    return r.groupBy("light", Q.light_colour(F.col("light")).alias("colour")).agg(F.count("*").alias("n"))


# A failed run's output by kind, and what the rules make of it.
_OUTPUTS = {
    0: ("403 by Cloudflare", "BLOCKED_403", "cloudflare", False), 1: ("HTTP 403", "BLOCKED_403", "http_403", False), 2: ("bad certificate", "BLOCKED_SSL", "ssl_error", True),
    3: ("Playwright is required", "NEEDS_PLAYWRIGHT", "playwright_missing", True), 4: ("read Timeout", "TIMEOUT", "slow_response", False),
    5: ("No exhibition URLs discovered", "ZERO_URLS", "no_urls_found", True), 6: ("Error fetching page", "ZERO_URLS", "fetch_error", True),
    7: ("json cannot decode", "ZERO_URLS", "json_decode", True), 8: ("nothing", "ZERO_URLS", "unknown", False), 9: ("'discovered': 7, done", "PASS", None, False),
    10: ("发现 URL数  : 12", "PASS", None, False),
}
_LOG = "concat('start', chr(10), CASE id % 11 " + " ".join(f"WHEN {k} THEN '{v[0].replace(chr(39), chr(39) * 2)}'" for k, v in _OUTPUTS.items()) + " END, chr(10), '  Failed step ', CAST(id % 7 AS string), '  ')"
_sql = lambda x: "NULL" if x is None else str(x).lower() if isinstance(x, bool) else f"'{x}'"
_DIAGNOSED = (
    "SELECT id, CASE id % 11 WHEN 9 THEN 7 WHEN 10 THEN 12 ELSE 0 END AS urls_found, "
    + ", ".join(f"CASE WHEN id % 23 = 5 AND id % 11 > 4 THEN {slow} ELSE CASE id % 11 " + " ".join(f"WHEN {k} THEN {_sql(v[i])}" for k, v in _OUTPUTS.items()) + f" END END AS {c}" for i, c, slow in ((1, "status", "'TIMEOUT'"), (2, "error_type", "'slow_response'"), (3, "fixable", "false")))
    + ", concat(CASE WHEN id % 11 = 6 THEN 'Error fetching page | ' ELSE '' END, 'Failed step ', id % 7) AS error_detail FROM runs"
)


def _diagnosed(s, d):
    r = run_log(s, d).withColumn("log", F.expr(_LOG))
    return r.select("id", Q.diagnose_log(F.col("log"), F.when(F.col("id") % 23 == 5, 89.5).otherwise(3.0)).alias("g")).select("id", "g.*")


@query(_DIAGNOSED)
def log_diagnosis(s, d):
    return _diagnosed(s, d).drop("suggestion")


@query("SELECT count(*) FILTER (urls_found > 0) AS recovered, count(*) FILTER (fixable) AS fixable, count(*) FILTER (NOT fixable AND urls_found = 0) AS unfixable FROM diagnosed", {"runs": RUNS, "diagnosed": _DIAGNOSED})
def diagnosis_summary(s, d):
    return Q.diagnosis_summary(_diagnosed(s, d))


_STATS_LOG = "concat('{''discovered'': ', CAST(urls_discovered AS string), ', ''saved'': 1}', chr(10), '{\"saved\": ', CAST(saved AS string), '}', chr(10), 'HTTP Request: GET https://x \"HTTP/1.1 ', CASE WHEN id % 3 = 0 THEN '403 Forbidden' ELSE '200 OK' END, '\"', chr(10), 'ValueError: code ', CAST(id % 5 AS string), ' ', chr(10), 'end')"


@query(
    "SELECT id, urls_discovered AS discovered, saved, 0::BIGINT AS failed, CASE WHEN id % 3 = 0 THEN 403 ELSE 200 END AS http_status, CASE WHEN id % 2 = 1 THEN concat('ValueError: code ', id % 5) END AS error FROM runs"
)
def log_counters(s, d):
    r = run_log(s, d).withColumn("log", F.expr(_STATS_LOG))
    out = r.select("id", Q.run_statistics(F.col("log")).alias("c"), Q.last_http_status(F.col("log")).alias("http_status"), Q.last_error(F.col("log"), F.col("id") % 2).alias("error"))
    return out.select("id", "c.discovered", "c.saved", "c.failed", "http_status", "error")


@query(
    "SELECT id, CASE WHEN id % 10 = 0 THEN 'SKIPPED' WHEN id % 10 = 1 THEN 'FAIL' WHEN id % 10 = 2 THEN 'PASS' WHEN id % 10 = 3 THEN 'BLOCKED_403' WHEN id % 10 = 4 THEN 'BLOCKED_SSL' WHEN id % 10 = 5 THEN 'TIMEOUT' WHEN id % 10 = 6 THEN 'NEEDS_PLAYWRIGHT' ELSE 'ZERO_URLS' END AS status FROM runs"
)
def health_status(s, d):
    k = F.col("id") % 10
    log = F.when(k == 3, "HTTP 403").when(k == 4, "bad certificate").when(k == 5, "timed out").when(k == 6, "Playwright is required").otherwise("nothing")
    status = Q.health_status(F.when(k == 0, "BLOCKED_SPA"), (k == 1).cast("int"), (k == 2).cast("int"), log)
    return run_log(s, d).select("id", status.alias("status"))


# --- run log ---------------------------------------------------------------------------------------------------------
@query("SELECT id, parser_key FROM runs WHERE error_message <> '' ORDER BY started_at DESC, id DESC LIMIT 20")
def run_failures(s, d):
    return R.failures(run_log(s, d)).select("id", "parser_key")


_REAL = "SELECT * FROM runs WHERE run_type <> 'dry_run'"


@query("SELECT r.id, r.parser_key FROM alive r JOIN (SELECT parser_key, max(started_at) AS t FROM alive GROUP BY 1) m ON m.parser_key = r.parser_key AND m.t = r.started_at WHERE urls_discovered > 0 AND saved = 0", {"runs": RUNS, "alive": _REAL})
def run_zero_saves(s, d):
    return R.zero_saves(run_log(s, d)).select("id", "parser_key")


@query(
    "SELECT parser_key, current, previous, round((previous - current) * 100.0::DOUBLE / previous, 2) AS drop_pct FROM (SELECT parser_key, urls_discovered AS current, lead(urls_discovered) OVER w AS previous, row_number() OVER w AS rn FROM alive WINDOW w AS (PARTITION BY parser_key ORDER BY started_at DESC, id DESC)) WHERE rn = 1 AND previous > 0 AND current < 0.8 * previous",
    {"runs": RUNS, "alive": _REAL},
)
def run_regression(s, d):
    return R.regressions(run_log(s, d))


@query("SELECT parser_key, max(started_at) AS last_run FROM runs GROUP BY 1 HAVING max(started_at) < TIMESTAMP '2024-01-29 00:00:00'")
def run_stale(s, d):
    return R.stale(run_log(s, d), "2024-01-29 00:00:00")


@query(
    "SELECT id, parser_key, CASE WHEN urls_discovered % 3 = 0 THEN 'running...' WHEN urls_discovered < 60 THEN concat(urls_discovered::VARCHAR, 's') ELSE concat(printf('%.1f', urls_discovered / 60.0), 'm') END AS duration FROM runs WHERE started_at >= TIMESTAMP '2024-01-20 00:00:00' ORDER BY started_at DESC, id DESC LIMIT 50"
)
def run_history(s, d):
    end = F.when(F.col("urls_discovered") % 3 != 0, F.timestamp_add("SECOND", F.col("urls_discovered"), F.col("started_at")))
    return R.history(run_log(s, d).withColumn("finished_at", end), since="2024-01-20 00:00:00").select("id", "parser_key", "duration")


@query("SELECT parser_key, max(id) AS id, arg_max(urls_discovered, id) AS urls_discovered FROM runs GROUP BY 1")
def last_run_per_key(s, d):
    return R.last_run(run_log(s, d)).select("parser_key", "id", "urls_discovered")


@query("SELECT count(*) FILTER (saved > 0) AS saved, count(*) FILTER (saved = 0 AND error_message = '') AS skipped, count(*) FILTER (saved = 0 AND error_message <> '') AS failed, count(*) AS discovered FROM runs")
def run_counters(s, d):
    status = F.when(F.col("saved") > 0, "saved").when(F.col("error_message") != "", "failed").otherwise("skipped")
    return R.counters(run_log(s, d), status)


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def window_counts(s, d):
    return ST.windowed_counts(load_table(s, d, "events"))


@query(
    "SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, count(*) AS n FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY user_id, s"
)
def session_counts(s, d):
    return ST.sessions(load_table(s, d, "events"))


# --- writes ----------------------------------------------------------------------------------------------------------
_STORED = "SELECT id, url, title, source FROM parents WHERE id % 10 = 0"
_FIRSTS = "SELECT id, url, title, source FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY id) AS rn FROM parents WHERE title IS NOT NULL) WHERE rn = 1 AND url NOT IN (SELECT url FROM stored)"


def _stored(s, d):
    return Q.keep_first(parents(s, d).filter("id % 10 = 0"), ["url"], "id").select("id", "url", "title", "source")


_STORED1 = "SELECT id, url, title, source FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY id) AS rn FROM parents WHERE id % 10 = 0) WHERE rn = 1"


@query("SELECT * FROM stored UNION ALL SELECT * FROM firsts", {"parents": PARENTS, "stored": _STORED1, "firsts": _FIRSTS})
def insert_or_ignore(s, d):
    return W.insert_or_ignore(_stored(s, d), parents(s, d).select("id", "url", "title", "source"), "id")


@query("SELECT c.exhibition_id, c.artist_name, c.work_title FROM children c WHERE c.exhibition_id IN (SELECT id FROM firsts) GROUP BY 1, 2, 3", {"parents": PARENTS, "children": CHILDREN, "stored": _STORED1, "firsts": _FIRSTS})
def insert_children(s, d):
    added = W.new_parents(_stored(s, d), parents(s, d).select("id", "url", "title", "source"), "id")
    return W.new_children(children(s, d), added).select("exhibition_id", "artist_name", "work_title")


@query("SELECT exhibition_id, count(*) AS n FROM children WHERE exhibition_id NOT IN (SELECT id FROM parents WHERE url IN (SELECT url FROM parents WHERE source = '5-LOW')) GROUP BY 1")
def cascade_delete(s, d):
    _, kids = W.delete_cascade(parents(s, d), children(s, d), parents(s, d).filter("source = '5-LOW'").select("url").distinct())
    return kids.groupBy("exhibition_id").agg(F.count("*").alias("n"))


@query("SELECT id, title FROM parents WHERE url NOT IN (SELECT url FROM parents WHERE regexp_matches(title, ' 1[0-9]$'))")
def delete_by_pattern(s, d):
    left, _ = W.delete_where(parents(s, d), children(s, d), F.rlike("title", F.lit(" 1[0-9]$")))
    return left.select("id", "title")


@query("SELECT id, source, CASE WHEN id % 10 = 0 THEN 'new' ELSE title END AS title FROM parents")
def force_upsert(s, d):
    p = parents(s, d).select("id", "source", "title")
    return W.upsert(p, p.filter("id % 10 = 0").withColumn("title", F.lit("new")), "id")


_SERIES = "(VALUES (1, 'venice_biennale'), (7, 'liverpool_biennale')) s(sid, k)"


@query(f"SELECT id, s.sid::BIGINT AS series_id FROM parents JOIN {_SERIES} ON s.k = site_key WHERE series_id IS NULL OR series_id = 0")
def backfill_series(s, d):
    return W.backfill_series(parents(s, d).withColumn("parser_key", F.col("site_key")), series(s))


@query("SELECT id, 'museum' AS institution_type FROM parents WHERE coalesce(institution_type, '') = ''")
def backfill_institution_type(s, d):
    _, changed = W.backfill_institution_type(parents(s, d))
    return changed.select("id", "institution_type")


@query("SELECT source, CASE source WHEN '1-URGENT' THEN 'urgent_key' WHEN '2-HIGH' THEN 'high_key' END AS parser_key, count(*) AS n FROM parents WHERE parser_key IS NULL AND source IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2")
def backfill_mapped_keys(s, d):
    _, changed = W.mapped_keys(parents(s, d), {"1-URGENT": "urgent_key", "2-HIGH": "high_key"})
    return changed.groupBy("source", "parser_key").agg(F.count("*").alias("n"))


@query("SELECT coalesce(parser_key, 'none') AS name, count(*) AS n FROM (SELECT coalesce(parser_key, replace(replace(replace(lower(source), ' ', '_'), '''', ''), '.', '')) AS parser_key FROM parents) GROUP BY 1")
def key_distribution(s, d):
    filled, _ = W.backfill(parents(s, d), "parser_key", W.parser_key_from_source())
    return A.count_by(filled.withColumn("parser_key", F.coalesce("parser_key", F.lit("none"))), "parser_key")


@query("SELECT count(*) AS removed FROM (SELECT DISTINCT url FROM parents)")
def cache_clear(s, d):
    _, removed = W.cleared(parents(s, d).select("url").distinct())
    return removed


@query("SELECT id, replace(replace(replace(lower(source), ' ', '_'), '''', ''), '.', '') AS parser_key FROM parents WHERE parser_key IS NULL")
def backfill_parser_key(s, d):
    _, changed = W.backfill(parents(s, d), "parser_key", W.parser_key_from_source())
    return changed.select("id", "parser_key")


@query("SELECT count(*) FILTER (url NOT IN (SELECT url FROM stored)) AS fresh, count(*) FILTER (url IN (SELECT url FROM stored)) AS skipped FROM parents", {"parents": PARENTS, "stored": _STORED})
def skip_existing(s, d):
    fresh, skipped = W.skip_existing(parents(s, d), _stored(s, d))
    return fresh.agg(F.count("*").alias("fresh")).join(F.broadcast(skipped.agg(F.count("*").alias("skipped"))))


@query("SELECT id, sha256(concat(url, ':', length(concept)::VARCHAR, ':', substr(sha256(concept), 1, 16))) AS cache_key FROM parents WHERE concept <> ''")
def cache_key(s, d):
    return parents(s, d).filter("concept <> ''").select("id", X.cache_key("url", "concept").alias("cache_key"))


@query("SELECT url, arg_max({'t': title}, id).t AS title, max(id) AS id FROM parents GROUP BY 1")
def cache_upsert(s, d):
    return W.last_writer_wins(parents(s, d).select("url", "title", "id"), "url", "id").select("url", "title", "id")


@query("SELECT id, city, CASE WHEN id % 5 = 0 THEN 'A concept that is long enough' WHEN length(concept) < 50 THEN 'A concept that is long enough' ELSE concept END AS concept FROM parents")
def enrich_guarded(s, d):
    return W.fill_guarded(parents(s, d), {"concept": F.lit("A concept that is long enough")}).select("id", "city", "concept")


# --- ingestion -------------------------------------------------------------------------------------------------------
@query(
    "SELECT o_custkey::VARCHAR AS exhibition_id, arg_min(concat('Show ', o_orderstatus), o_orderkey) AS title, min(o_orderkey) AS first_pos, "
    "concat(CASE WHEN o_custkey % 2 = 0 THEN 'https://www.moma.org/calendar/exhibitions/' ELSE 'https://www.x.org/' END, o_custkey) AS url, "
    "coalesce(string_agg(concat(o_orderpriority, ' ', o_orderkey), '|' ORDER BY o_orderkey) FILTER (o_orderkey % 4 > 1), '') AS artworks, "
    "coalesce(string_agg(concat(o_orderpriority, ' ', o_orderkey, ', Dutch, 1950'), '|' ORDER BY o_orderkey) FILTER (o_orderkey % 4 > 1), '') AS captions, "
    "coalesce(array_to_string(list_distinct_in_order, ','), '') AS curators FROM (SELECT *, (SELECT list(c ORDER BY k) FROM (SELECT concat('Curator ', o_orderstatus) AS c, min(o_orderkey) AS k FROM orders i WHERE i.o_custkey = o.o_custkey AND i.o_orderkey % 4 = 0 GROUP BY 1)) AS list_distinct_in_order FROM orders o) GROUP BY o_custkey, list_distinct_in_order"
)
def csv_fold(s, d):
    o, k = load_table(s, d, "orders"), F.col("o_orderkey") % 4
    name = F.when(k == 0, F.concat(F.lit("Curator "), "o_orderstatus")).otherwise(F.concat_ws(" ", "o_orderpriority", F.col("o_orderkey").cast("string")))
    rows = o.select(
        F.col("o_custkey").cast("string").alias("ExhibitionID"),
        F.concat(F.lit("Show "), "o_orderstatus").alias("ExhibitionTitle"),
        F.date_format("o_orderdate", "M/d/yyyy").alias("ExhibitionBeginDate"),
        F.lit("").alias("ExhibitionEndDate"),
        F.when(F.col("o_custkey") % 2 == 0, "").otherwise(F.concat(F.lit("x.org/"), F.col("o_custkey").cast("string"))).alias("ExhibitionURL"),
        F.concat(F.lit(" "), name).alias("DisplayName"),
        F.when(k == 0, "Organizer").when(k == 1, "Designer").when(k == 2, "").otherwise("Artist").alias("ExhibitionRole"),
        F.lit("Dutch").alias("Nationality"),
        F.lit("1950").alias("ConstituentBeginDate"),
        F.lit("").alias("ConstituentEndDate"),
        F.col("o_orderkey").alias("pos"),
    )
    out = S.fold_exhibitions(rows)
    joined = lambda c, f: F.array_join(F.transform("artworks", lambda x: x[f]), "|").alias(c)
    return out.select("exhibition_id", "title", F.col("pos").alias("first_pos"), "url", joined("artworks", "artist_name"), joined("captions", "caption"), F.array_join("curators", ",").alias("curators"))


@query(
    "SELECT o_custkey::VARCHAR AS exhibition_id, count(*) AS n FROM orders o JOIN (SELECT o_custkey AS c, min(o_orderkey) AS first FROM orders WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1) f ON f.c = o.o_custkey AND o.o_orderkey >= f.first GROUP BY 1"
)
def csv_fold_since(s, d):
    rows = load_table(s, d, "orders").select(
        F.col("o_custkey").cast("string").alias("ExhibitionID"), F.lit("Show").alias("ExhibitionTitle"), F.date_format("o_orderdate", "M/d/yyyy").alias("BeginDate"),
        F.col("o_orderkey").cast("string").alias("DisplayName"), F.lit("Artist").alias("Role"), F.col("o_orderkey").alias("pos"),
    )
    return S.fold_exhibitions(rows, 1996).select("exhibition_id", F.size("artworks").cast("long").alias("n"))


@query("SELECT o_orderkey::VARCHAR AS objectid FROM orders WHERE lower(o_orderpriority) LIKE '%urgent%' AND year(o_orderdate) >= 1996")
def classified_artworks(s, d):
    """Artworks of a classification, since a year."""
    objects = load_table(s, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("objectid"), F.lit("t").alias("title"), F.year("o_orderdate").cast("string").alias("beginyear"),
        F.lit("").alias("displaydate"), F.lit("").alias("medium"), F.lit("").alias("dimensions"), F.col("o_orderpriority").alias("classification"),
    )
    people = load_table(s, d, "supplier").select(
        F.col("s_suppkey").alias("constituentid"), F.col("s_name").alias("displayname"), F.lit("").alias("nationality"), F.lit("").alias("beginyear"), F.lit("").alias("endyear"), F.col("s_suppkey").alias("pos")
    )
    links = load_table(s, d, "lineitem").select(F.col("l_orderkey").cast("string").alias("objectid"), F.col("l_suppkey").alias("constituentid"), F.col("l_linenumber").alias("pos"))
    return S.artworks_with_artists(objects, links, people, since=1996, classification="Urgent").select("objectid")


@query("SELECT o.o_orderkey::VARCHAR AS objectid, coalesce(f.s_name, 'Unknown') AS artist_name FROM orders o LEFT JOIN (SELECT l_orderkey, arg_min(s_name, l_linenumber * 1000000 + l_suppkey) AS s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1) f ON f.l_orderkey = o.o_orderkey")
def primary_artist_join(s, d):
    objects = load_table(s, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("objectid"), F.lit("t").alias("title"), F.lit("1999").alias("beginyear"),
        F.lit("").alias("displaydate"), F.lit("").alias("medium"), F.lit("").alias("dimensions"), F.lit("").alias("classification"),
    )
    links = load_table(s, d, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("objectid"), F.col("l_suppkey").alias("constituentid"), (F.col("l_linenumber") * 1000000 + F.col("l_suppkey")).alias("pos")
    )
    people = load_table(s, d, "supplier").select(
        F.col("s_suppkey").alias("constituentid"), F.col("s_name").alias("displayname"), F.lit("").alias("nationality"), F.lit("").alias("beginyear"), F.lit("").alias("endyear"), F.col("s_suppkey").alias("pos")
    )
    return S.artworks_with_artists(objects, links, people).select("objectid", "artist_name")


@query("SELECT id, a.artist AS artist_name, CASE WHEN a.place = 0 THEN 'w' ELSE title END AS work_title FROM parents, (VALUES (0, 'x'), (1, 'y')) a(place, artist)")
def positional_zip(s, d):
    p = parents(s, d).withColumns({"artist_titles": F.array(F.lit("x"), F.lit("y")), "artwork_titles": F.array(F.lit("w"))})
    return S.zip_artworks(p).select("id", "artist_name", "work_title")


_ARTISTS = "SELECT exhibition_id, list_sort(list_distinct(list(trim(artist_name)) FILTER (trim(artist_name) <> ''))) AS l FROM children GROUP BY 1"
_BY = "concat(array_to_string(list_slice(l, 1, 3), ', '), CASE WHEN len(l) > 3 THEN ' 等' ELSE '' END)"
_ARTIST_SENTENCE = "concat('展出艺术家包括 ', array_to_string(list_slice(l, 1, 15), ', '), CASE WHEN len(l) > 15 THEN ' 等' ELSE '' END, ' 的作品。')"
_PREFACED = "CASE WHEN length(trim(preface)) >= 50 THEN substr(replace(trim(preface), chr(10), ' '), 1, 300) ELSE {} END"


def _with_artists(plain: str) -> str:
    return f"concat({plain}, CASE WHEN len(l) > 0 THEN {_ARTIST_SENTENCE} ELSE '' END)"


@query(
    f"SELECT p.id, CASE WHEN coalesce(title, '') = '' THEN '' WHEN p.id % 4 = 0 THEN {_with_artists(chr(39) + '展览《' + chr(39) + ', title, ' + chr(39) + '》' + chr(39))} "
    f"WHEN p.id % 4 = 1 THEN {_PREFACED.format(_with_artists(chr(39) + '芝加哥艺术博物馆展览《' + chr(39) + ', title, ' + chr(39) + '》' + chr(39)))} "
    f"WHEN p.id % 4 = 2 THEN {_PREFACED.format('concat(' + chr(39) + 'Whitney Museum of American Art exhibition: ' + chr(39) + ', title)')} "
    f"ELSE {_with_artists('source, ' + chr(39) + ' 展览《' + chr(39) + ', title, ' + chr(39) + '》' + chr(39))} END AS concept FROM parents p LEFT JOIN artists a ON a.exhibition_id = p.id",
    {"parents": PARENTS, "children": CHILDREN, "artists": _ARTISTS},
)
def concept_synthesis(s, d):
    p = parents(s, d).join(E.artist_names(children(s, d)), "id", "left")
    kind = F.col("id") % 4
    told = [X.synthesize_concept(k, "title", F.col("names"), "preface", "source") for k in ("moma", "aic", "whitney", "generic")]
    return p.select("id", F.coalesce(*(F.when(kind == i, c) for i, c in enumerate(told))).alias("concept"))


@query(
    f"SELECT exhibition_id AS id, {_BY} AS names FROM artists",
    {"children": CHILDREN.replace("l_orderkey AS exhibition_id", "l_suppkey AS exhibition_id"), "artists": "SELECT exhibition_id, list_sort(list_distinct(list(line::VARCHAR))) AS l FROM children GROUP BY 1"},
)
def artist_list(s, d):
    kids = role(s, d, CHILDREN.replace("l_orderkey AS exhibition_id", "l_suppkey AS exhibition_id")).withColumn("artist_name", F.concat(F.lit(" "), F.col("line").cast("string")))
    return E.artist_names(kids).select("id", X.artist_sentence(F.col("names"), 3).alias("names"))


from sparkfolio.plans import records, stored  # noqa: E402, F401 - register their queries
