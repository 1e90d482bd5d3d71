"""Scalar column functions. Each is a Catalyst expression; none runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ascii_lower(c: Column | str) -> Column:
    """Lower-case A-Z only, as a case-insensitive match over ASCII does."""
    return F.translate(col(c), _UPPER, _LOWER)


def present(c: Column | str) -> Column:
    """Neither null nor empty; never null itself."""
    return F.coalesce(col(c) != "", F.lit(False))


_BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"


def strip(c: Column | str) -> Column:
    """Without white space, Unicode's included, at either end."""
    return F.regexp_replace(col(c), f"^{_BLANKS}|{_BLANKS}$", "")


def blank(c: Column | str) -> Column:
    """Null, empty or white space only; never null itself."""
    return F.coalesce(strip(c) == "", F.lit(True))


def blank_to_null(c: Column | str) -> Column:
    return F.when(strip(c) != "", col(c))


def first_filled(*columns: Column | str) -> Column:
    """The first of the columns that is neither null nor empty."""
    return F.coalesce(*(F.nullif(col(c), F.lit("")) for c in columns))


def bilingual(primary: Column | str, other: Column | str, hint: str, missing: str) -> Column:
    """The primary text unless blank; else the other one behind ``hint``; else ``missing``."""
    return F.when(~blank(primary), col(primary)).when(~blank(other), F.concat(F.lit(hint), col(other))).otherwise(F.lit(missing))


def absolute_url(url: Column | str, host: str, fallback: Column) -> Column:
    """A url as it is where it starts with http, behind ``host`` otherwise; ``fallback`` where it is empty."""
    u = F.coalesce(col(url), F.lit(""))
    return F.when(u == "", fallback).when(F.startswith(u, F.lit("http")), u).otherwise(F.concat(F.lit(host), u))


def table_cell(c: Column | str, most: int) -> Column:
    """Text for a cell of a Markdown table: pipes escaped, then cut to ``most`` characters."""
    return F.substring(F.replace(F.coalesce(col(c), F.lit("")), F.lit("|"), F.lit("\\|")), 1, most)


def like_any_case(c: Column | str, needle: str) -> Column:
    """Substring pattern over folded ASCII; % and _ in the needle are wildcards, a backslash is not special."""
    pattern = "%" + needle.translate(str.maketrans(_UPPER, _LOWER)).replace("\\", "\\\\") + "%"
    return ascii_lower(c).like(pattern)


def extract_year(c: Column | str) -> Column:
    """First stand-alone year 1900 to 2099 in the text, else null."""
    return F.regexp_extract(col(c), r"\b(19\d{2}|20\d{2})\b", 1).try_cast("int")


def leading_int(c: Column | str) -> Column:
    """The integer that a text starts with (0 without one, null for null)."""
    digits = F.regexp_extract(col(c), r"^\s*([+-]?[0-9]+)", 1)
    return F.when(col(c).isNotNull(), F.coalesce(digits.try_cast("int"), F.lit(0)))


def year_prefix(c: Column | str) -> Column:
    return leading_int(F.substring(col(c), 1, 4))


def normalize_date(c: Column | str) -> Column:
    """struct(value, changed): Y, Y-M and M/D/Y become ISO dates, all else stays as it is."""
    raw, t = col(c), F.trim(col(c))
    part = lambda p, i: F.regexp_extract(t, p, i)
    ym, mdy = r"^(\d{4})-(\d{1,2})$", r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    iso = (
        F.when(t.rlike(r"^\d{4}$"), F.concat(t, F.lit("-01-01")))
        .when(t.rlike(ym), F.concat_ws("-", part(ym, 1), F.lpad(part(ym, 2), 2, "0"), F.lit("01")))
        .when(t.rlike(mdy), F.concat_ws("-", part(mdy, 3), F.lpad(part(mdy, 1), 2, "0"), F.lpad(part(mdy, 2), 2, "0")))
    )
    return F.struct(F.coalesce(iso, raw).alias("value"), F.coalesce(iso != t, F.lit(False)).alias("changed"))


def strict_date(c: Column | str) -> Column:
    """Null, empty or YYYY-MM-DD in form; a newline may follow."""
    return F.coalesce(col(c) == "", F.lit(True)) | F.coalesce(col(c).rlike(r"^\d{4}-\d{2}-\d{2}\n?\z"), F.lit(False))


def date_span(c: Column | str) -> Column:
    """struct(start, end) of a "Y.M.D - Y.M.D" span with any of . / - between parts; nulls without one."""
    p = r"(\d{4}[./-]\d{1,2}[./-]\d{1,2})\s*[-–—]\s*(\d{4}[./-]\d{1,2}[./-]\d{1,2})"
    side = lambda i: F.regexp_replace(F.nullif(F.regexp_extract(col(c), p, i), F.lit("")), "[./]", "-")
    return F.struct(side(1).alias("start"), side(2).alias("end"))


def long_date_span(c: Column | str) -> Column:
    """struct(start, end) of "Month D, YYYY - Month D, YYYY" as written; "- Ongoing" has a null end."""
    one = r"[A-Za-z]+\s+\d{1,2},\s+\d{4}"
    p = f"({one})\\s*[-–—]\\s*(Ongoing|{one})"
    side = lambda i: F.nullif(F.regexp_extract(col(c), p, i), F.lit(""))
    return F.struct(side(1).alias("start"), F.when(F.lower(side(2)) != "ongoing", side(2)).alias("end"))


def format_duration(start: Column | str, end: Column | str) -> Column:
    """Ns under a minute, N.Nm under an hour, else N.Nh; "running..." without an end, "?" without a start."""
    s = F.unix_timestamp(col(end)) - F.unix_timestamp(col(start))
    return (
        F.when(col(end).isNull(), F.lit("running..."))
        .when(col(start).isNull(), F.lit("?"))
        .when(s < 60, F.concat(s.cast("string"), F.lit("s")))
        .when(s < 3600, F.concat(F.format_string("%.1f", s / 60), F.lit("m")))
        .otherwise(F.concat(F.format_string("%.1f", s / 3600), F.lit("h")))
    )


def slug(c: Column | str) -> Column:
    """Lower case with spaces as underscores, without apostrophes and full stops."""
    return F.lower(F.replace(F.replace(F.replace(col(c), F.lit(" "), F.lit("_")), F.lit("'"), F.lit("")), F.lit("."), F.lit("")))


def cache_key(url: Column | str, text: Column | str | None = None) -> Column:
    """sha256 of the url; with a text also of its length and the head of its own digest."""
    u = col(url)
    if text is not None:
        t = col(text)
        with_text = F.concat_ws(":", u, F.length(t).cast("string"), F.substring(F.sha2(t, 256), 1, 16))
        u = F.when(present(t), with_text).otherwise(u)
    return F.sha2(u, 256)


def json_list(c: Column | str, keep_raw: bool = False) -> Column:
    """Array of a JSON list of texts; malformed text reads as no elements, or as itself with ``keep_raw``."""
    empty = F.array().cast("array<string>")
    raw = F.when(present(c), F.array(col(c))).otherwise(empty) if keep_raw else empty
    return F.coalesce(F.from_json(col(c), "array<string>"), raw)


def tidy_lines(c: Column | str) -> Column:
    """Lines and double-space phrases, each trimmed, blanks dropped, joined by newlines."""
    lines = F.split(col(c), r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]")
    phrases = F.flatten(F.transform(lines, lambda x: F.split(F.regexp_replace(x, r"^\s+|\s+$", ""), "  ")))
    phrases = F.transform(phrases, lambda x: F.regexp_replace(x, r"^\s+|\s+$", ""))
    return F.array_join(F.filter(phrases, lambda x: x != ""), "\n")


def last_number_in_path(url: Column | str, marker: str) -> Column:
    """The integer after the last ``marker`` of a url, up to "/", "?" or "#"; null if it isn't one."""
    tail = F.element_at(F.split(col(url), marker), -1)
    has = F.contains(col(url), F.lit(marker))
    return F.when(has, F.regexp_extract(tail, r"^([^/?#]*)", 1).try_cast("long"))


def caption(name: Column | str, nationality: Column | str, birth: Column | str, death: Column | str) -> Column:
    """name, nationality, birth-death, leaving out blank parts and a dash without both years."""
    years = F.regexp_replace(F.concat(F.coalesce(F.trim(col(birth)), F.lit("")), F.lit("–"), F.coalesce(F.trim(col(death)), F.lit(""))), "^–+|–+$", "")
    return F.concat_ws(", ", blank_to_null(name), blank_to_null(nationality), F.nullif(years, F.lit("")))


def shorten(c: Column | str, most: int = 25) -> Column:
    """Texts over ``most`` characters end in three dots in place of the rest."""
    return F.when(F.length(col(c)) > most, F.concat(F.substring(col(c), 1, most - 3), F.lit("..."))).otherwise(col(c))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), digits)


def artist_list(names: Column) -> Column:
    """Names that aren't blank, stripped, each once in order."""
    return F.array_distinct(F.filter(F.transform(names, strip), lambda x: x != ""))


# The sentences that concepts are made of, {t} the title, {s} the source, {a} the artists.
NO_ARTISTS = {"moma": "展览《{t}》", "aic": "芝加哥艺术博物馆展览《{t}》", "generic": "{s} 展览《{t}》", "whitney": "Whitney Museum of American Art exhibition: {t}"}
WITH_ARTISTS = " 的作品。"
ARTISTS_ARE = "展出艺术家包括 "
MORE_ARTISTS = " 等"
MOST_ARTISTS = 15


def artist_sentence(names: Column, most: int = MOST_ARTISTS) -> Column:
    """The first ``most`` of the artists, joined by commas; a suffix tells of more."""
    clean = artist_list(names)
    return F.concat(F.array_join(F.slice(clean, 1, most), ", "), F.when(F.size(clean) > most, F.lit(MORE_ARTISTS)).otherwise(F.lit("")))


def synthesize_concept(kind: str, title: Column | str, names: Column | None = None, preface: Column | str | None = None, source: Column | str | None = None) -> Column:
    """A concept from what is known of a record; ``kind`` is one of ``NO_ARTISTS``. Empty without a title.

    A preface of 50 characters or more, in one line and cut to 300, comes
    first (kinds aic and whitney), else a sentence on the title and artists
    (whitney: title only).
    """
    t = F.coalesce(col(title), F.lit(""))
    pieces = []
    for part in NO_ARTISTS[kind].replace("{t}", "|{t}|").replace("{s}", "|{s}|").split("|"):
        if part:
            pieces.append({"{t}": t, "{s}": col(source) if source is not None else F.lit("")}.get(part, F.lit(part)))
    plain = F.concat(*pieces)
    told = plain
    if kind != "whitney":
        none = F.array().cast("array<string>")
        sentence = artist_sentence(none if names is None else F.coalesce(names, none))
        told = F.when(sentence != "", F.concat(plain, F.lit(ARTISTS_ARE), sentence, F.lit(WITH_ARTISTS))).otherwise(plain)
    if kind in ("aic", "whitney"):
        body = strip(F.lit(None).cast("string") if preface is None else preface)
        told = F.when(F.length(body) >= 50, F.substring(F.replace(body, F.lit("\n"), F.lit(" ")), 1, 300)).otherwise(told)
    return F.when(t == "", F.lit("")).otherwise(told)


def fence_stripped(c: Column | str) -> Column:
    """The body of a fence that the text starts with, without a json tag, backticks, blanks and newlines; other text as it is."""
    body = F.element_at(F.split(col(c), "```"), 2)
    body = F.when(F.startswith(body, F.lit("json")), F.substring(body, 5, 1 << 30)).otherwise(body)
    return F.when(F.startswith(col(c), F.lit("```")), F.regexp_replace(body, r"^[` \n]+|[` \n]+$", "")).otherwise(col(c))


def parse_interval_seconds(text: str) -> int | None:
    """Nd, Nh or Nm as seconds; None for anything else."""
    unit = {"d": 86400, "h": 3600, "m": 60}.get(text[-1:])
    return int(text[:-1]) * unit if unit and text[:-1].isdigit() else None
