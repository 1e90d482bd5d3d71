"""A Python data source over numbered REST pages; each page is a partition, and a projection is asked of the server."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from sparkfolio.sources.files import sparql_query

class Page(InputPartition):
    def __init__(self, number: int, follow: bool = False):
        self.number, self.follow = number, follow


def fetch_json(url: str) -> dict:
    from urllib.request import urlopen

    with urlopen(url, timeout=30) as reply:  # noqa: S310 - the url is the user's option
        return json.load(reply)


class RestPages(DataSource):
    """``spark.read.format("rest_pages").options(url="...{page}...", first=1, last=9).load()``.

    Rows (page, body): the raw JSON of each page; pages are read side by side.
    ``step`` multiplies the number in the url (offsets). A page that can't be
    read after Spark's task retries fails the job; with ``lenient`` its body
    is null, where ``reached_pages`` stops. Without ``last``, a first request
    reads how many pages there are from its ``total`` (a path such as
    pagination.total_pages); where nothing tells, pages are read one after
    another, in one task, until one has no items (under ``items``, "data").

    With ``pushdown`` (and spark.sql.python.filterPushdown.enabled), filters
    on ``page`` reach the requests: other pages aren't asked for.
    """

    fetch: Callable[[str], dict] = staticmethod(fetch_json)

    @classmethod
    def name(cls) -> str:
        return "rest_pages"

    def schema(self) -> str:
        return "page int, body string"

    def reader(self, schema) -> DataSourceReader:
        kind = _PushingReader if self.options.get("pushdown", "false") == "true" else _Reader
        return kind(self.options, self.fetch)


class _Reader(DataSourceReader):
    def __init__(self, options, fetch):
        self.options, self.fetch = dict(options), fetch
        self.wanted: list[Callable[[int], bool]] = []

    def _asked(self, number: int) -> bool:
        return all(f(number) for f in self.wanted)

    def partitions(self) -> list[Page]:
        first, last = int(self.options.get("first", 1)), self.options.get("last")
        if last is None and "total" in self.options:
            last = self._total(self._body(first))
        if last is None:
            return [Page(first, follow=True)]
        return [Page(n) for n in range(first, max(first, int(last)) + 1) if self._asked(n)]

    def _total(self, body: dict | None) -> int:
        """Pages there are, by a page's own words; 1 where it has none."""
        for part in self.options["total"].split("."):
            body = body.get(part) if isinstance(body, dict) else None
        return body if isinstance(body, int) else 1

    def _body(self, number: int) -> dict | None:
        try:
            return self.fetch(self.options["url"].replace("{page}", str(number * int(self.options.get("step", 1)))))
        except OSError:
            if self.options.get("lenient", "false") != "true":
                raise
            return None

    def read(self, partition: Page) -> Iterator[tuple[int, str | None]]:
        number = partition.number
        while True:
            body = self._body(number)
            if self._asked(number):
                yield number, None if body is None else json.dumps(body, ensure_ascii=False)
            if not partition.follow or not body or not body.get(self.options.get("items", "data")):
                return
            number += 1


_COMPARED = {
    EqualTo: lambda v: lambda n: n == v, In: lambda v: lambda n: n in v, GreaterThan: lambda v: lambda n: n > v, GreaterThanOrEqual: lambda v: lambda n: n >= v,
    LessThan: lambda v: lambda n: n < v, LessThanOrEqual: lambda v: lambda n: n <= v,
}


class _PushingReader(_Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take comparisons of the page's number; others stay with Spark."""
        for f in filters:
            if type(f) in _COMPARED and f.attribute == ("page",) and f.value is not None:
                self.wanted.append(_COMPARED[type(f)](f.value))
            else:
                yield f


class SparqlExhibitions(DataSource):
    """``spark.read.format("sparql_exhibitions").option("url", "...{query}...").load()``: body, the JSON answer, and start_year, the year asked from.

    A filter ``start_year >= y`` (or >) and the option ``limit`` become
    part of the query that is sent; other filters stay with Spark. Without a
    filter start_year is null. Parse bodies with ``sparql_bindings``.
    """

    fetch: Callable[[str], dict] = staticmethod(fetch_json)

    @classmethod
    def name(cls) -> str:
        return "sparql_exhibitions"

    def schema(self) -> str:
        return "start_year int, body string"

    def reader(self, schema) -> DataSourceReader:
        kind = _PushingSparql if self.options.get("pushdown", "false") == "true" else _Sparql
        return kind(self.options, self.fetch)


class _Sparql(DataSourceReader):
    since: int | None = None

    def __init__(self, options, fetch):
        self.options, self.fetch = dict(options), fetch

    def read(self, partition) -> Iterator[tuple[int | None, str]]:
        from urllib.parse import quote

        limit = self.options.get("limit")
        query = sparql_query(self.since, int(limit) if limit else None)
        yield self.since, json.dumps(self.fetch(self.options["url"].replace("{query}", quote(query))), ensure_ascii=False)


class _PushingSparql(_Sparql):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("start_year",) and f.value is not None:
                year = int(f.value) + isinstance(f, GreaterThan)
                self.since = max(year, self.since or year)
            else:
                yield f


class Slice(InputPartition):
    """Items ``start`` to ``stop`` of a page, to its end without ``stop``."""

    def __init__(self, number: int, start: int, stop: int | None):
        self.number, self.start, self.stop = number, start, stop


class RestFeed(DataSource):
    """``spark.readStream.format("rest_feed").options(url="...{page}...", total="pagination.total_pages").load()``.

    A stream of rows (page, place, record): the items of numbered pages that
    grow at their end, each once. An offset is a page and how many of its
    items are behind, so a batch can be read again as it was, and a last page
    that has grown goes on where it was left. The stream starts at ``page``
    and ``place`` (1 and 0 by default). Pages are read side by side; planning
    a batch asks for two of them. Items may come behind the last one only.
    """

    fetch: Callable[[str], dict] = staticmethod(fetch_json)

    @classmethod
    def name(cls) -> str:
        return "rest_feed"

    def schema(self) -> str:
        return "page int, place int, record string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Feed(self.options, self.fetch)


class _Feed(DataSourceStreamReader):
    def __init__(self, options, fetch):
        self.options, self.fetch = dict(options), fetch

    def _page(self, number: int) -> dict:
        return self.fetch(self.options["url"].replace("{page}", str(number)))

    def _items(self, body: dict) -> list:
        return body.get(self.options.get("items", "data")) or []

    def initialOffset(self) -> dict:
        return {"page": int(self.options.get("page", 1)), "place": int(self.options.get("place", 0))}

    def latestOffset(self) -> dict:
        first = self.initialOffset()["page"]
        body = told = self._page(first)
        for part in self.options["total"].split("."):
            told = told.get(part) if isinstance(told, dict) else None
        last = max(first, told if isinstance(told, int) else first)
        return {"page": last, "place": len(self._items(body if last == first else self._page(last)))}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        pages = range(start["page"], end["page"] + 1)
        return [Slice(n, start["place"] if n == start["page"] else 0, end["place"] if n == end["page"] else None) for n in pages]

    def read(self, partition: Slice) -> Iterator[tuple[int, int, str]]:
        if partition.stop is not None and partition.stop <= partition.start:
            return
        items = self._items(self._page(partition.number))
        for place in range(partition.start, len(items) if partition.stop is None else partition.stop):
            yield partition.number, place, json.dumps(items[place], ensure_ascii=False)

    def commit(self, end: dict) -> None:
        pass
