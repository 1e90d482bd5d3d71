"""Data-quality profiles, duplicates and validators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.scalars import percent, strict_date, strip
from sparkfolio.operators.store import first_of


def missing_rules() -> dict[str, Column]:
    empty = lambda c: F.col(c).isNull() | (F.col(c) == "")
    return {
        **{c: empty(c) for c in ("title", "concept", "preface", "city", "location")},
        **{c: F.col(c).isNull() for c in ("start_date", "end_date")},
        "curators": F.col("curators").isNull() | (F.col("curators") == "[]"),
    }


def missing_profile(df: DataFrame, key: str | None, rules: Mapping[str, Column]) -> DataFrame:
    """Missing counts and percentages of each field, by key (null is a group) or overall."""
    counts = [F.coalesce(F.sum(F.when(r, 1).otherwise(0)), F.lit(0)).alias(f"missing_{c}") for c, r in rules.items()]
    out = (df.groupBy(key) if key else df).agg(F.count("*").alias("total"), *counts)
    return out.select("*", *(percent(F.col(f"missing_{c}"), F.col("total")).alias(f"pct_{c}") for c in rules))


def missing_cube(df: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """Counts by key with the grand total in one pass (grouping sets)."""
    counts = [F.sum(F.when(r, 1).otherwise(0)).alias(f"missing_{c}") for c, r in rules.items()]
    return df.rollup(key).agg(F.count("*").alias("total"), F.grouping(key).cast("int").alias("is_total"), *counts)


def duplicate_groups(df: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """Groups of rows equal in ``keys`` (nulls group together) with count, least and greatest id.

    Counts combine before the shuffle and hold no list, so a key that many rows
    share is one short row; ``duplicate_members`` has its rows.
    """
    out = df.groupBy(*keys).agg(F.count("*").alias("cnt"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id"))
    return out.filter("cnt > 1")


def duplicate_members(df: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """The rows of duplicate groups: first_id, which names the group, cnt, and the row's id."""
    g = duplicate_groups(df, keys, id_col).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), "first_id", "cnt")
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(g, same).select("first_id", "cnt", F.col(id_col).alias("id"))


def titled(df: DataFrame) -> DataFrame:
    """Rows with a title: what duplicates by title are looked for in."""
    return df.filter(F.col("title") != "")


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row of least ``order`` for each key; nulls last, ties by the other columns."""
    return first_of(df, keys, order)


def issue(when: Column, field: str, severity: str, detail: Column | str = "") -> Column:
    d = F.lit(detail) if isinstance(detail, str) else detail
    return F.when(when, F.struct(F.lit(field).alias("field"), F.lit(severity).alias("severity"), d.alias("detail")))


def validate(df: DataFrame, checks: list[Column]) -> DataFrame:
    """Rows with an array of the issues that hold; each check is one ``issue``."""
    return df.withColumn("issues", F.filter(F.array(*checks), lambda x: x.isNotNull()))


# Titles that are navigation, of the record check and of the extraction check.
NOISE_WORDS = (
    "home", "menu", "exhibitions", "exhibition", "about", "contact",
    "visit", "support", "donate", "shop", "search", "events", "news",
    "education", "collections", "artists", "programs", "gallery",
    "museum", "foundation", "press", "privacy", "terms", "cookies",
    "subscribe", "newsletter", "login", "sign up", "loading",
    "back", "next", "previous", "close", "open", "more", "less",
)
NOISE_TITLES = (
    "home", "homepage", "menu", "untitled", "exhibition", "exhibitions",
    "current", "upcoming", "past", "archive", "about", "visit", "tickets",
    "shop", "support", "contact", "news", "press", "events", "program",
    "education", "research", "collection", "collections", "artists",
)


def record_checks() -> list[Column]:
    """Checks of a stored record; each gives one issue at most."""
    empty = lambda c: F.coalesce(F.col(c) == "", F.lit(True))
    t, concept = strip(F.coalesce("title", F.lit(""))), strip(F.coalesce("concept", F.lit("")))
    quoted = lambda text, c: F.concat(F.lit(text + "'"), c, F.lit("'"))
    start, end = F.col("start_date"), F.col("end_date")
    dated = ~empty("start_date") & ~empty("end_date") & strict_date("start_date") & strict_date("end_date")
    return [
        F.coalesce(
            issue(F.length(t) < 3, "title", "error", "Missing or too short"),
            issue(F.lower(t).isin(*NOISE_WORDS), "title", "error", quoted("Noise word: ", t)),
        ),
        issue(~strict_date("start_date"), "start_date", "warn", quoted("Non-standard format: ", start)),
        issue(~strict_date("end_date"), "end_date", "warn", quoted("Non-standard format: ", end)),
        issue(F.coalesce(dated & (start > end), F.lit(False)), "dates", "error", F.concat(F.lit("start_date ("), start, F.lit(") > end_date ("), end, F.lit(")"))),
        F.coalesce(
            issue(empty("concept"), "concept", "warn", "Missing"),
            issue(F.length(concept) < 50, "concept", "warn", F.concat(F.lit("Too short ("), F.length(concept).cast("string"), F.lit(" chars)"))),
        ),
        issue(empty("preface"), "preface", "info", "Missing"),
        issue(empty("city"), "city", "warn", "Missing"),
        issue(empty("parser_key"), "parser_key", "error", "Empty"),
    ]


def child_record_issues(children: DataFrame, parent_key: str = "exhibition_id") -> DataFrame:
    """Issues of children (parent key, field, severity, detail), one row per child at most."""
    a, w = strip(F.coalesce("artist_name", F.lit(""))), strip(F.coalesce("work_title", F.lit("")))
    told = F.array(
        F.when(a == "", F.lit("missing artist_name")),
        F.when(w == "", F.lit("missing work_title")),
        F.when((a == w) & (F.coalesce("artist_name", F.lit("")) != ""), F.lit("artist_name == work_title (possible hallucination)")),
    )
    told = F.filter(told, lambda x: x.isNotNull())
    detail = F.concat(F.lit("ID "), F.coalesce(F.col("id").cast("string"), F.lit("?")), F.lit(": "), F.array_join(told, ", "))
    return children.filter(F.size(told) > 0).select(F.col(parent_key).alias("id"), F.lit("artwork").alias("field"), F.lit("warn").alias("severity"), detail.alias("detail"))


def record_issues(parents: DataFrame, children: DataFrame | None = None) -> DataFrame:
    """All issues of parents and their children as rows: id, source, field, severity, detail.

    Children's issues join their parents' source; nothing is collected per parent.
    """
    own = validate(parents, record_checks()).select("id", "source", F.explode("issues").alias("i")).select("id", "source", "i.*")
    if children is None:
        return own
    kids = child_record_issues(children).join(parents.select("id", "source"), "id")
    return own.unionByName(kids)


def extraction_checks() -> list[Column]:
    """Checks of an extracted record's typed fields: arrays of texts, each an issue's words; null entries hold nothing.

    ``curators`` is an array of texts and ``artworks`` an array of
    struct(artist_name, work_title); wrong JSON types are found before that by
    ``typed_issues``.
    """
    empty = lambda c: F.coalesce(c == "", F.lit(True))
    say = lambda when, text: F.when(when, F.array(F.lit(text) if isinstance(text, str) else text))
    title = F.coalesce("title", F.lit(""))
    works = F.coalesce("artworks", F.expr("array()").cast("array<struct<artist_name:string,work_title:string>>"))
    untitled = F.transform(works, lambda x, i: F.when(empty(x["work_title"]), F.concat(F.lit("artworks["), i.cast("string"), F.lit("] missing work_title"))))
    return [
        say(F.length(strip(title)) < 3, "title missing or too short"),
        say((F.length(strip(title)) >= 3) & F.lower(title).isin(*NOISE_TITLES), F.concat(F.lit("title looks like noise: '"), title, F.lit("'"))),
        *(say(~strict_date(c), F.concat(F.lit(f"{c} invalid format (expected YYYY-MM-DD): '"), F.col(c), F.lit("'"))) for c in ("start_date", "end_date")),
        say(~empty(F.col("concept")) & (F.length(strip("concept")) < 30), "concept too short (< 30 chars)"),
        say(empty(F.col("concept")), "concept is missing"),
        say(empty(F.col("preface")), "preface is missing"),
        F.filter(untitled, lambda x: x.isNotNull()),
        say((F.size(works) > 0) & F.forall(works, lambda x: empty(x["artist_name"])), "all artworks missing artist_name"),
        say(empty(F.col("city")), "city is missing"),
    ]


def extraction_issues(df: DataFrame) -> DataFrame:
    """Rows with ``issues``, the texts of all extraction checks that fail, in order."""
    none = F.array().cast("array<string>")
    return df.withColumn("issues", F.flatten(F.array(*(F.coalesce(c, none) for c in extraction_checks()))))


def typed_issues(record: Column) -> Column:
    """Issues of a JSON record whose curators or artworks aren't lists or whose artworks aren't objects."""
    v = F.try_parse_json(record)
    # Names of JSON types as the issues tell them.
    names = {"STRING": "str", "BOOLEAN": "bool", "BIGINT": "int", "DOUBLE": "float", "DECIMAL": "float", "OBJECT": "dict"}
    kind = lambda x: F.regexp_extract(F.coalesce(F.schema_of_variant(x), F.lit("VOID")), "^([A-Z]+)", 1)
    name = lambda k: F.coalesce(*(F.when(k == a, F.lit(b)) for a, b in names.items()), F.lit("list"))
    out = []
    for c in ("curators", "artworks"):
        k = kind(F.try_variant_get(v, f"$.{c}", "variant"))
        out.append(F.when(~k.isin("VOID", "ARRAY"), F.array(F.concat(F.lit(f"{c} is not a list: "), name(k)))))
    works = F.try_variant_get(v, "$.artworks", "array<variant>")
    bad = F.transform(works, lambda x, i: F.when(kind(x) != "OBJECT", F.concat(F.lit("artworks["), i.cast("string"), F.lit("] is not a dict: "), F.when(kind(x) == "VOID", F.lit("NoneType")).otherwise(name(kind(x))))))
    out.append(F.filter(bad, lambda x: x.isNotNull()))
    return F.flatten(F.array(*(F.coalesce(c, F.array().cast("array<string>")) for c in out)))


def issue_counts(issues: DataFrame) -> DataFrame:
    """Number of issues by field and severity."""
    return issues.groupBy("field", "severity").agg(F.count("*").alias("n"))


def issue_rates(parents: DataFrame, issues: DataFrame) -> DataFrame:
    """Per source: records, records with issues, records with errors, and the rate of the former in percent."""
    per = issues.groupBy("id").agg(F.max((F.col("severity") == "error").cast("int")).alias("error"))
    out = parents.select("id", "source").join(per, "id", "left").groupBy("source").agg(
        F.count("*").alias("total"), F.count("error").alias("with_issues"), F.coalesce(F.sum("error"), F.lit(0)).alias("with_errors")
    )
    return out.withColumn("issue_rate", percent(F.col("with_issues"), F.col("total"), 1))


def verdicts(results: DataFrame, keys: DataFrame, issues: str = "issues") -> DataFrame:
    """The verdict on each parser of ``keys`` (parser_key, strategy, urls_found) from its results (parser_key, issues).

    SKIPPED for other strategies than HTML_LLM, NO_URLS, NO_RESULTS, PASS
    without issues, WARN up to two for a result on average, else FAIL.
    """
    r = results.groupBy("parser_key").agg(F.count("*").alias("tested"), F.sum(F.size(issues)).alias("n_issues"))
    out = keys.join(r, "parser_key", "left").withColumns({"tested": F.coalesce("tested", F.lit(0)), "n_issues": F.coalesce("n_issues", F.lit(0))})
    verdict = (
        F.when(F.col("strategy") != "HTML_LLM", "SKIPPED")
        .when(F.col("urls_found") == 0, "NO_URLS")
        .when(F.col("tested") == 0, "NO_RESULTS")
        .when(F.col("n_issues") == 0, "PASS")
        .when(F.col("n_issues") <= 2 * F.col("tested"), "WARN")
        .otherwise("FAIL")
    )
    return out.select("parser_key", "tested", "n_issues", verdict.alias("verdict"))


def issue_breakdown(results: DataFrame, limit: int = 30) -> DataFrame:
    """The most frequent issue texts."""
    rows = results.select(F.explode("issues").alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))
    return rows.orderBy(F.desc("n"), "issue").limit(limit)


def orphans(children: DataFrame, parents: DataFrame, limit: int = 100) -> DataFrame:
    """Children without their parent, least ids first."""
    return children.join(parents.select(F.col("id").alias("exhibition_id")), "exhibition_id", "left_anti").orderBy("id").limit(limit)


def child_issues(children: DataFrame, parents: DataFrame, source: str | None = None) -> DataFrame:
    """Rows of children that have their parent (with its source) and an issue: type, severity, detail.

    missing_field: a name is missing (of the given source only); suspicious:
    equal names but for case, a link in a name, a name over 200 characters.
    """
    kids = children.join(parents.select(F.col("id").alias("exhibition_id"), "source"), "exhibition_id")
    a, w = strip(F.coalesce("artist_name", F.lit(""))), strip(F.coalesce("work_title", F.lit("")))
    both = (a != "") & (w != "")
    gone = F.array_join(F.filter(F.array(F.when(a == "", F.lit("artist_name")), F.when(w == "", F.lit("work_title"))), lambda x: x.isNotNull()), ", ")
    asked = F.lit(True) if source is None else F.col("source") == source
    cut = lambda c, n: F.substring(c, 1, n)
    found = F.array(
        issue(~both & asked, "missing_field", "warn", F.concat(F.lit("Missing: "), gone)),
        issue(both & (F.lower(a) == F.lower(w)), "suspicious", "warn", F.concat(F.lit("artist_name == work_title: '"), cut(a, 50), F.lit("'"))),
        issue(both & (a.rlike("https?://") | w.rlike("https?://")), "suspicious", "warn", F.concat(F.lit("URL detected in name: artist='"), cut(a, 30), F.lit("', title='"), cut(w, 30), F.lit("'"))),
        issue(both & ((F.length(a) > 200) | (F.length(w) > 200)), "suspicious", "warn", F.concat(F.lit("Abnormally long: artist="), F.length(a).cast("string"), F.lit(" chars, title="), F.length(w).cast("string"), F.lit(" chars"))),
    )
    rows = kids.withColumn("_i", F.explode(F.filter(found, lambda x: x.isNotNull())))
    return rows.select("id", "exhibition_id", "source", F.col("_i.field").alias("type"), "_i.severity", "_i.detail")


# Parsers whose records need no children.
CHILDLESS = ("aic", "wikidata", "rijksmuseum", "met", "whitney")


def zero_children(parents: DataFrame, children: DataFrame, limit: int = 50) -> DataFrame:
    """Parents without a child, but for parsers that give none (a null key is none of those that are checked)."""
    checked = parents.filter(~F.col("parser_key").isin(*CHILDLESS))
    return checked.join(children.select(F.col("exhibition_id").alias("id")), "id", "left_anti").orderBy("id").limit(limit)


def excessive_children(parents: DataFrame, children: DataFrame, most: int = 500, limit: int = 20) -> DataFrame:
    """Parents with more than ``most`` children, those with most first."""
    counts = children.groupBy(F.col("exhibition_id").alias("id")).agg(F.count("*").alias("artwork_count")).filter(F.col("artwork_count") > most)
    return parents.join(counts, "id").orderBy(F.desc("artwork_count"), "id").limit(limit)


def traffic_light(urls: Column, html: Column, context: Column, raised: Column | None = None) -> Column:
    """PASS with five urls (any for other strategies), WARN with some, else the blocker that the context names.

    Where the run raised an error (text in ``raised``), its kind is told instead.
    """
    c = F.coalesce(context, F.lit(""))
    out = (
        F.when((urls >= 5) | (~html & (urls > 0)), "PASS")
        .when(urls > 0, "WARN")
        .when(c.contains("403"), "BLOCKED_403")
        .when(c.contains("SSL") | F.upper(c).contains("CERTIFICATE"), "BLOCKED_SSL")
        .otherwise("ZERO_URLS")
    )
    if raised is None:
        return out
    told = (
        F.when(raised.contains("403"), "BLOCKED_403")
        .when(raised.contains("SSL") | F.upper(raised).contains("CERTIFICATE"), "BLOCKED_SSL")
        .when(F.lower(raised).contains("timeout"), "TIMEOUT")
        .otherwise("FAIL")
    )
    return F.when(raised.isNotNull(), told).otherwise(out)


def light_colour(status: Column) -> Column:
    return F.when(status == "PASS", "green").when(status == "WARN", "yellow").otherwise("red")


# Outcomes of a failed run as (status, error type, fixable, suggestion), first rule that holds.
DIAGNOSES = {
    "cloudflare": ("BLOCKED_403", "cloudflare", False, "标记为 BLOCKED_CLOUDFLARE，寻找替代数据源"),
    "http_403": ("BLOCKED_403", "http_403", False, "服务器拒绝访问，可能需要更强的反爬策略"),
    "ssl": ("BLOCKED_SSL", "ssl_error", True, "尝试 verify=False"),
    "playwright": ("NEEDS_PLAYWRIGHT", "playwright_missing", True, "安装 Playwright: uv pip install playwright && python -m playwright install"),
    "slow": ("TIMEOUT", "slow_response", False, "网站响应极慢，可能需要更长的超时或替代数据源"),
    "no_urls": ("ZERO_URLS", "no_urls_found", True, "检查 link_patterns 是否匹配当前网站结构"),
    "fetch": ("ZERO_URLS", "fetch_error", True, "检查 URL 是否可达、网站是否重构"),
    "json": ("ZERO_URLS", "json_decode", True, "API 返回格式变化，需要更新解析逻辑"),
    "unknown": ("ZERO_URLS", "unknown", False, "需要手动查看输出"),
    "pass": ("PASS", None, False, "重试成功"),
}
ERROR_MARKS = ("ERROR", "Error", "exception", "Exception", "Failed", "failed")


def _last(log: Column, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(log, F.lit(pattern), F.lit(1)), F.lit(-1))


def found_urls(log: Column) -> Column:
    """The number of urls that a run's log tells last, 0 without any."""
    lines = F.split(log, "\n")
    told = lambda x: F.when(x.contains("发现 URL") | x.contains("发现URL"), F.trim(F.element_at(F.split(x, ":"), -1)).try_cast("int")).otherwise(
        F.nullif(F.regexp_extract(x, r"'discovered':\s*(\d+)\s*(?:,|$)", 1), F.lit("")).try_cast("int")
    )
    numbers = F.filter(F.transform(lines, told), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(numbers, F.lit(-1)), F.lit(0))


def diagnose_log(log: Column, elapsed: Column, timeout: float = 90.0) -> Column:
    """struct(urls_found, status, error_type, fixable, suggestion, error_detail) of a run from its output."""
    low, up = F.lower(log), F.upper(log)
    urls = found_urls(log)
    key = (
        F.when(log.contains("403") & (low.contains("cloudflare") | low.contains("blocked")), "cloudflare")
        .when(log.contains("403"), "http_403")
        .when(up.contains("SSL") | up.contains("CERTIFICATE"), "ssl")
        .when(log.contains("Playwright") & log.contains("required"), "playwright")
        .when(low.contains("timeout") | (elapsed >= timeout - 1), "slow")
        .when(urls > 0, "pass")
        .when(log.contains("No exhibition URLs discovered"), "no_urls")
        .when(log.contains("Error fetching"), "fetch")
        .when(up.contains("JSON") & low.contains("decode"), "json")
        .otherwise("unknown")
    )
    rule = lambda i, kind: F.coalesce(*(F.when(key == k, F.lit(v[i]).cast(kind)) for k, v in DIAGNOSES.items()))
    lines = F.filter(F.split(log, "\n"), lambda x: x.rlike("|".join(ERROR_MARKS)))
    shown = F.transform(F.slice(lines, 1, 3), lambda x: F.substring(strip(x), 1, 200))
    return F.struct(
        urls.alias("urls_found"), rule(0, "string").alias("status"), rule(1, "string").alias("error_type"),
        rule(2, "boolean").alias("fixable"), rule(3, "string").alias("suggestion"),
        F.when(F.size(lines) > 0, F.array_join(shown, " | ")).alias("error_detail"),
    )


def diagnosis_summary(diagnosed: DataFrame) -> DataFrame:
    """How many runs recovered (have urls), can be fixed, or neither; from urls_found and fixable."""
    return diagnosed.agg(
        F.count_if(F.col("urls_found") > 0).alias("recovered"),
        F.count_if("fixable").alias("fixable"),
        F.count_if(~F.col("fixable") & (F.col("urls_found") == 0)).alias("unfixable"),
    )


def run_statistics(log: Column) -> Column:
    """struct of the counters that a run's output tells last, in either kind of quotes; 0 where it tells none."""
    names = ("discovered", "parsed", "saved", "skipped", "failed")
    return F.struct(*(F.coalesce(_last(log, rf"""['"]{c}['"]:\s*(\d+)""").try_cast("long"), F.lit(0).cast("long")).alias(c) for c in names))


def last_http_status(log: Column) -> Column:
    """The status of the last logged request, from its quoted protocol line; null without one."""
    return _last(log, r'(?m)^.*HTTP Request:.*"HTTP/[^ "]*\s+(\d+)[^"]*"').try_cast("int")


def last_error(errors: Column, exit_code: Column) -> Column:
    """The last line that names an error, stripped and cut to 200 characters, else the exit code; null on success."""
    lines = F.filter(F.split(errors, "\n"), lambda x: x.contains("Error") | x.contains("ERROR"))
    line = F.substring(strip(F.try_element_at(lines, F.lit(-1))), 1, 200)
    return F.when(exit_code != 0, F.coalesce(F.nullif(line, F.lit("")), F.concat(F.lit("Exit code "), exit_code.cast("string"))))


def health_status(marker: Column, exit_code: Column, urls: Column, log: Column) -> Column:
    """SKIPPED for a marked site, FAIL, PASS with urls, else what the output tells of none being found."""
    low, up = F.lower(log), F.upper(log)
    return (
        F.when(F.coalesce(marker, F.lit("")) != "", "SKIPPED")
        .when(exit_code != 0, "FAIL")
        .when(urls > 0, "PASS")
        .when(log.contains("403"), "BLOCKED_403")
        .when(log.contains("SSL") | up.contains("CERTIFICATE"), "BLOCKED_SSL")
        .when(low.contains("timeout") | low.contains("timed out"), "TIMEOUT")
        .when(log.contains("Playwright is required"), "NEEDS_PLAYWRIGHT")
        .otherwise("ZERO_URLS")
    )
