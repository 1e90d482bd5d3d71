"""Queries over records that are written and read back, rows of null and equal order, and rows that fail."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from sparkfolio.functions.scalars import normalize_date
from sparkfolio.operators import quality as Q
from sparkfolio.operators import store as W
from sparkfolio.operators.dashboard import Dashboard
from sparkfolio.operators.isolation import isolate
from sparkfolio.operators.pages import PageDirectory
from sparkfolio.operators.searchindex import SearchIndex
from sparkfolio.plans.roles import CHILDREN, PARENTS, children, parents, query, run_log
from sparkfolio.session import load_table
from sparkfolio.sources.recordstore import RecordStore
from sparkfolio.sources.reportfile import batch_json, read_json_lines, write_lines
from sparkfolio.storage import new_folder
from sparkfolio.streaming import monitors as M


# --- null and equal orders -------------------------------------------------------------------------------------------
def _first_sql(keys: str, rows: str, order: str, columns: str) -> str:
    ties = ", ".join(f"{c} NULLS FIRST" for c in columns.split(", "))
    return f"SELECT * EXCLUDE (rn) FROM (SELECT {keys}, {columns}, row_number() OVER (PARTITION BY {keys} ORDER BY {order} IS NULL, {order}, {ties}) AS rn FROM {rows}) WHERE rn = 1"


@query(
    "SELECT url, id, title, source, start_date FROM stored UNION ALL SELECT url, id, title, source, start_date FROM firsts WHERE url NOT IN (SELECT url FROM stored)",
    {
        "parents": PARENTS,
        "stored": _first_sql("url", "(SELECT * FROM parents WHERE id % 10 = 0)", "start_date", "id, title, source, start_date"),
        "firsts": _first_sql("url", "(SELECT * FROM parents WHERE title IS NOT NULL)", "start_date", "id, title, source, start_date"),
    },
)
def insert_or_ignore_undated(s, d):
    p = parents(s, d).select("url", "id", "title", "source", "start_date")
    return W.insert_or_ignore(W.first_of(p.filter("id % 10 = 0"), ["url"], "start_date"), p, "start_date")


@query(_first_sql("exhibition_id", "(SELECT *, CASE WHEN line % 3 = 0 THEN line END AS place FROM children)", "place", "place, artist_name, work_title, line"), {"children": CHILDREN})
def artworks_keep_first_unordered(s, d):
    kids = children(s, d).withColumn("place", F.when(F.col("line") % 3 == 0, F.col("line")))
    return Q.keep_first(kids.select("exhibition_id", "place", "artist_name", "work_title", "line"), ["exhibition_id"], "place")


@query(
    "SELECT url, title, id, start_date FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY start_date DESC NULLS LAST, title DESC NULLS LAST, id DESC) AS rn FROM parents) WHERE rn = 1"
)
def cache_upsert_undated(s, d):
    return W.last_writer_wins(parents(s, d).select("url", "title", "id", "start_date"), "url", "start_date")


# --- the store -------------------------------------------------------------------------------------------------------
_FIELDS = "id url title source city start_date".split()
_ARTWORK = "exhibition_id artist_name work_title".split()


def _store(s, d):
    p, kids = parents(s, d).select(*_FIELDS), children(s, d).select(*_ARTWORK)
    return RecordStore.create(s, new_folder(s, "records"), p.schema, kids.schema, 16), p, kids


def _shown(store: RecordStore):
    """Stored parents with the number of stored children."""
    n = store.read("children").groupBy(F.col("exhibition_id").alias("id")).agg(F.count("*").alias("n_children"))
    return store.read("parents").join(n, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))


_WITH = {
    "parents": PARENTS,
    "children": CHILDREN,
    "one": _first_sql("url", "(SELECT * FROM parents WHERE id % 3 = 0 AND title IS NOT NULL)", "id", "id, title, source, city, start_date"),
    "two": _first_sql("url", "(SELECT * FROM parents WHERE title IS NOT NULL)", "id", "id, title, source, city, start_date"),
    "kept": "SELECT * FROM one UNION ALL SELECT * FROM two WHERE url NOT IN (SELECT url FROM one)",
    "kids": "SELECT exhibition_id AS id, count(DISTINCT (artist_name, work_title)) AS n FROM children WHERE artist_name IS NOT NULL AND work_title IS NOT NULL GROUP BY 1",
}


@query("SELECT id, url, title, source, city, start_date, coalesce(n, 0)::BIGINT AS n_children FROM kept LEFT JOIN kids USING (id)", _WITH)
def store_insert(s, d):
    """Two batches with urls in common, the second run twice."""
    store, p, kids = _store(s, d)
    store.insert("first", p.filter("id % 3 = 0"), kids, "id")
    store.insert("second", p, kids, "id")
    store.insert("second", p, kids, "id")
    return _shown(store)


@query(
    "SELECT id, url, title, source, coalesce(city, '') AS city, start_date, coalesce(n, 0)::BIGINT AS n_children FROM "
    "(SELECT * FROM kept WHERE url NOT IN (SELECT url FROM again) UNION ALL SELECT * FROM again) LEFT JOIN kids USING (id) WHERE url NOT LIKE '%7' AND source <> '5-LOW'",
    _WITH | {"again": "SELECT * REPLACE (concat('New ', title) AS title) FROM (" + _first_sql("url", "(SELECT * FROM parents WHERE id % 10 = 0 AND title IS NOT NULL)", "id", "id, title, source, city, start_date") + ")"},
)
def store_changes(s, d):
    """Records overwritten by url, deleted by url and by a predicate, and cities filled in place."""
    store, p, kids = _store(s, d)
    store.insert("first", p.filter("id % 3 = 0"), kids, "id")
    store.insert("second", p, kids, "id")
    store.overwrite("third", p.filter("id % 10 = 0").withColumn("title", F.concat(F.lit("New "), "title")), kids, "id")
    store.delete("fourth", p.filter("url LIKE '%7'"))
    store.delete_where("fifth", F.col("source") == "5-LOW")
    store.update("sixth", {"city": F.lit("")}, F.col("city").isNull())
    return _shown(store)


@query(
    "SELECT url, start_date AS old_start_date, CASE WHEN length(start_date) = 10 THEN substr(start_date, 1, 4) END AS new_start_date FROM kept WHERE id % 4 = 1 AND start_date IS NOT NULL",
    _WITH,
)
def store_update_dry_run(s, d):
    """What an update of dates would change; nothing is written."""
    store, p, kids = _store(s, d)
    store.insert("all", p.filter("id % 3 = 0"), kids, "id")
    store.insert("rest", p, kids, "id")
    year = F.substring(normalize_date("start_date")["value"], 1, 4)
    report, done = store.update("dates", {"start_date": year}, F.col("id") % 4 == 1, dry_run=True)
    assert done.buckets == 0 and not store.applied("dates")
    return report


@query(
    "SELECT url AS cache_key, concat('v', arg_max(id, id)) AS result_json, max(id) AS version FROM parents WHERE id % 3 < 2 GROUP BY url"
)
def store_cache(s, d):
    """Answers put in two batches, the older versions later; the greatest version of each key stays."""
    store, _, _ = _store(s, d)
    rows = parents(s, d).select(F.col("url").alias("cache_key"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("result_json"), F.col("id").alias("version"))
    store.put_cache("one", rows.filter("version % 3 = 1"))
    store.put_cache("two", rows.filter("version % 3 = 0"))
    store.put_cache("two", rows.filter("version % 3 = 0"))
    return store.read("cache")


# --- rows that fail --------------------------------------------------------------------------------------------------
def _word_counts(frame):
    """An extractor that can't take some documents."""
    for doc_id, text in zip(frame["doc_id"], frame["text"], strict=True):
        if doc_id % 100 == 7:
            raise ValueError(f"document {doc_id} can't be read")
        if text is None:
            raise TypeError("no text")
    return frame.assign(n_words=[len(t.split(" ")) for t in frame["text"]])[["doc_id", "n_words"]]


@query(
    "SELECT doc_id, CASE WHEN doc_id % 100 <> 7 THEN len(string_split(text, ' ')) END AS n_words, CASE WHEN doc_id % 100 = 7 THEN concat('ValueError: document ', doc_id, ' can''t be read') "
    "WHEN text IS NULL THEN 'TypeError: no text' END AS error FROM documents"
)
def isolated_extraction(s, d):
    """A batch function that one document in a hundred makes fail: the others' results, and those documents' errors."""
    docs = load_table(s, d, "documents").select("doc_id", "text")
    results, errors = isolate(docs, _word_counts, "doc_id long, n_words long", ["doc_id"])
    none = F.lit(None)
    return results.withColumn("error", none.cast("string")).unionByName(errors.select("doc_id", none.cast("long").alias("n_words"), "error"))


# --- search and pages ------------------------------------------------------------------------------------------------
_SEARCHED_SQL = (
    "SELECT id FROM parents WHERE {} UNION SELECT exhibition_id FROM children WHERE exhibition_id IN (SELECT id FROM parents) AND (lower(artist_name) LIKE '{{0}}' OR lower(work_title) LIKE '{{0}}')"
).format(" OR ".join(f"lower({c}) LIKE '{{0}}'" for c in "title preface concept curators location preface_en concept_en".split()))


def _index(s, d):
    return SearchIndex.build(s, new_folder(s, "index"), parents(s, d), children(s, d))


@query(_SEARCHED_SQL.format("%customer 12%"), {"parents": PARENTS, "children": CHILDREN})
def search_index(s, d):
    """The keyword search of search_union by the index."""
    return _index(s, d).search("CUSTOMER 12")


@query(
    " UNION ALL ".join(f"SELECT '{k.replace('%', '*')}' AS keyword, count(*) AS n FROM ({_SEARCHED_SQL.format('%' + k.lower() + '%')})" for k in ("Supplier#00000000%", "er_12", "zz", "no such words")),
    {"parents": PARENTS, "children": CHILDREN},
)
def search_index_keywords(s, d):
    """Matches of keywords with wildcards, too short for the index, and that nothing has."""
    index = _index(s, d)
    counts = [index.search(k).agg(F.count("*").alias("n")).select(F.lit(k.replace("%", "*")).alias("keyword"), "n") for k in ("Supplier#00000000%", "er_12", "zz", "no such words")]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _scraped(s, d):
    day = F.when(F.col("id") % 31 != 0, F.coalesce("start_date", F.lit("1999-09-09")))
    return parents(s, d).select("id", "source", "title", "start_date").withColumn("scraped_at", F.concat(day, F.lit(" "), F.expr("lpad(string(id % 24), 2, '0')"), F.lit(":"), F.expr("lpad(string(id % 60), 2, '0')"), F.lit(":00")))


_DAY = "CASE WHEN id % 31 <> 0 THEN coalesce(start_date, '1999-09-09') END"
_ROWS = f"SELECT id, source, title, start_date, {_DAY} || ' ' || lpad((id % 24)::VARCHAR, 2, '0') || ':' || lpad((id % 60)::VARCHAR, 2, '0') || ':00' AS scraped_at FROM parents"


@query(
    f"SELECT id, scraped_at, total FROM (SELECT *, row_number() OVER (ORDER BY scraped_at DESC NULLS LAST, id DESC) AS rn, count(*) OVER () AS total FROM rows_) WHERE rn > total * 9 // 10 AND rn <= total * 9 // 10 + 30",
    {"parents": PARENTS, "rows_": _ROWS},
)
def page_by_scraped_at(s, d):
    """A page at nine tenths of the records by scraped_at, and the total, from the directory."""
    pages = PageDirectory.build(s, new_folder(s, "pages"), _scraped(s, d), [("scraped_at", True), ("id", True)], part_rows=2000)
    total = pages.total().first()[0]
    return pages.page(30, total * 9 // 10).select("id", "scraped_at", F.lit(total).alias("total"))


@query(
    "SELECT id, start_date, total FROM (SELECT *, row_number() OVER (ORDER BY start_date DESC NULLS LAST, id DESC) AS rn, count(*) OVER () AS total FROM parents WHERE source = '2-HIGH') WHERE rn > total // 2 AND rn <= total // 2 + 20"
)
def page_of_source(s, d):
    """A page in the middle of one source's records by start_date, and the source's total."""
    rows = parents(s, d).select("id", "source", "start_date")
    pages = PageDirectory.build(s, new_folder(s, "pages"), rows, [("start_date", True), ("id", True)], group="source", part_rows=2000)
    total = pages.total("2-HIGH").first()[0]
    return pages.page(20, total // 2, "2-HIGH").select("id", "start_date", F.lit(total).alias("total"))


# --- the run log as a stream -----------------------------------------------------------------------------------------
def _log_stream(s, d, files, in_time=False):
    """The run log in files of mixed times, or of one time after the other; two of them a micro-batch."""
    folder = new_folder(s, "runs")
    log = run_log(s, d)
    if in_time:  # files are read in the order of their writing
        second = F.unix_seconds(F.col("started_at").cast("timestamp"))
        low, high = log.agg(F.min(second), F.max(second)).first()
        part = F.floor((second - low) * files / (high - low + 1))
        for i in range(files):
            log.filter(part == i).coalesce(1).write.mode("append").parquet(folder)
    else:
        log.repartition(files, F.xxhash64("id")).write.parquet(folder)
    return s.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(folder)


def _followed(s, verdicts):
    path = new_folder(s, "verdicts")
    query = M.keep_verdicts(verdicts, path)
    query.awaitTermination()
    return M.latest_verdicts(s, path)


@query(
    "SELECT parser_key, current, previous, round((previous - current) * 100.0::DOUBLE / previous, 2) AS drop_pct FROM (SELECT parser_key, max(urls_discovered) FILTER (rn = 1) AS current, "
    "max(urls_discovered) FILTER (rn = 2) AS previous FROM (SELECT *, row_number() OVER (PARTITION BY parser_key ORDER BY started_at DESC, id DESC) AS rn FROM runs WHERE run_type <> 'dry_run') "
    "GROUP BY 1) WHERE previous > 0 AND current < 0.8 * previous"
)
def stream_regression(s, d):
    """run_regression as a stream over micro-batches in mixed order."""
    return _followed(s, M.watch_regressions(_log_stream(s, d, 6))).filter("regressed").select("parser_key", "current", "previous", "drop_pct")


@query(
    "SELECT parser_key, last_run FROM (SELECT parser_key, max(started_at) AS last_run FROM runs GROUP BY 1) WHERE last_run + INTERVAL 12 HOUR <= (SELECT max(started_at) - INTERVAL 1 HOUR FROM runs)"
)
def stream_stale(s, d):
    """Parsers whose last run the log's time has passed by half a day, by timers of a stream."""
    return _followed(s, M.watch_staleness(_log_stream(s, d, 6, in_time=True), 0.5)).filter("stale").select("parser_key", F.col("at").alias("last_run"))


# --- the dashboard by changes ----------------------------------------------------------------------------------------
_LEFT = "SELECT * FROM parents WHERE id % 10 <> 0"
_LEFT_KIDS = "SELECT * FROM children WHERE exhibition_id % 10 <> 0"
_NAMED_SQL = "artist_name <> '' AND lower(artist_name) NOT LIKE '%various%' AND lower(artist_name) NOT LIKE '%unknown%' AND lower(artist_name) NOT LIKE '%multiple%'"


def _changed_dashboard(s, d):
    """A dashboard of some records, to which others are added in two batches and from which some are taken between them."""
    p, kids = parents(s, d), children(s, d)

    def part(digits):
        return [df.filter((F.col(key) % 10).isin(digits)) for df, key in ((p, "id"), (kids, "exhibition_id"))]

    digits = [0, 1, 2, 3, 4, 5]
    board = Dashboard.build(*part(digits))
    for changed, sign in (([6, 7, 8], 1), ([0], -1), ([9], 1)):
        digits = sorted({*digits, *changed}) if sign > 0 else [x for x in digits if x not in changed]
        board = board.apply(*(df.withColumn("sign", F.lit(sign)) for df in part(changed)), part(digits)[1])
    return board


@query(
    "SELECT 'parents' AS metric, NULL AS name, count(*) AS n FROM left_ UNION ALL SELECT 'children', NULL, count(*) FROM left_kids UNION ALL SELECT 'source', source, count(*) FROM left_ GROUP BY source "
    "UNION ALL SELECT 'city', city, count(*) FROM left_ WHERE city <> '' GROUP BY city UNION ALL SELECT 'medium', medium, count(*) FROM left_kids WHERE trim(medium) <> '' GROUP BY medium "
    f"UNION ALL SELECT * FROM (SELECT 'artist', artist_name, count(*) AS n FROM left_kids WHERE {_NAMED_SQL} GROUP BY 2 ORDER BY n DESC, 2 LIMIT 15)",
    {"parents": PARENTS, "children": CHILDREN, "left_": _LEFT, "left_kids": _LEFT_KIDS},
)
def dashboard_counts(s, d):
    """Figures after batches of inserts and deletes."""
    board = _changed_dashboard(s, d)
    out = board.totals().select(F.inline(F.array(*(F.struct(F.lit(m).alias("metric"), F.lit(None).cast("string").alias("name"), F.col(m).alias("n")) for m in ("parents", "children")))))
    for metric, limit in (("source", None), ("city", None), ("medium", None), ("artist", 15)):
        out = out.unionByName(board.ranking(metric, limit).select(F.lit(metric).alias("metric"), "name", "n"))
    return out


@query(
    "SELECT a.artist_name AS source, b.artist_name AS target, count(*) AS weight FROM left_kids a JOIN left_kids b ON a.exhibition_id = b.exhibition_id AND a.artist_name < b.artist_name "
    "WHERE a.artist_name IN (SELECT artist_name FROM top40) AND b.artist_name IN (SELECT artist_name FROM top40) GROUP BY 1, 2 HAVING count(*) >= 2 ORDER BY weight DESC, source, target LIMIT 300",
    {"children": CHILDREN, "left_kids": _LEFT_KIDS, "top40": f"SELECT artist_name FROM left_kids WHERE {_NAMED_SQL} GROUP BY 1 ORDER BY count(*) DESC, artist_name LIMIT 40"},
)
def dashboard_links(s, d):
    """Co-occurrence after batches of inserts and deletes, whose head of the ranking changes."""
    return _changed_dashboard(s, d).cooccurrence()


# --- report files ----------------------------------------------------------------------------------------------------
@query(
    "SELECT count(*) AS total_parsers, count(*) FILTER (id % 7 <> 0) AS ok, count(*) FILTER (id % 7 = 0) AS failed, sum(saved)::BIGINT AS exhibitions_saved, sum(id)::BIGINT AS ids, "
    "count(*) FILTER (id % 7 = 0) AS errors FROM runs"
)
def report_file_json(s, d):
    """A batch's JSON report, written as one file and read back."""
    results = run_log(s, d).select(F.col("id").alias("key"), (F.col("id") % 7 != 0).alias("success"), "saved", F.when(F.col("id") % 7 == 0, 'Exit "code" 1').alias("error"))
    path = new_folder(s, "batch") + ".json"
    write_lines(batch_json(results, "2024-01-31T00:00:00"), path)
    head = "total_parsers long, ok long, failed long, exhibitions_saved long"
    told, rows = read_json_lines(s, path, head, "key long, success boolean, saved long, error string")
    sums = rows.agg(F.sum("key").alias("ids"), F.count_if(F.col("error") == 'Exit "code" 1').alias("errors"))
    return told.join(F.broadcast(sums))  # one row each


@query("SELECT (row_number() OVER (ORDER BY id) - 1)::INTEGER AS place, concat('- ', id, ' ', coalesce(title, 'None')) AS line FROM parents")
def report_file_lines(s, d):
    """A report of many lines, written as one file by many tasks; read back, each line with its number in the file."""
    rows = parents(s, d).select("id", F.concat_ws(" ", F.lit("-"), F.col("id").cast("string"), F.coalesce("title", F.lit("None"))).alias("line"))
    path = new_folder(s, "lines") + ".md"
    write_lines(rows.select(F.col("id").alias("place"), "line"), path)
    whole = s.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("place", "line"))
