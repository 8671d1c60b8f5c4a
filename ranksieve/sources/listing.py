"""A paged REST listing as Spark data sources: in one go, a partition a category; or as a stream, a partition a range of pages."""

from __future__ import annotations

import json
import os
import time
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

Fetch = Callable[[dict], tuple[int, dict]]


def http_fetch(params: dict) -> tuple[int, dict]:
    """GET with a limit of 30 s; whatever goes wrong in transport counts as 503."""
    query = "&".join(f"{k}={v}" for k, v in params.items() if k != "url")
    try:
        with urllib.request.urlopen(f"{params['url']}?{query}", timeout=30) as r:
            return r.status, json.loads(r.read())
    except urllib.error.HTTPError as e:
        return e.code, {}
    except Exception:
        return 503, {}


def fetch_with_retry(fetch: Fetch, params: dict, attempts: int, base: float, sleep: Callable[[float], None]) -> dict | None:
    """200 gives the body; 429 and 5xx wait base*2^k and try again; anything else gives up."""
    for k in range(attempts):
        status, body = fetch(params)
        if status == 200:
            return body
        if status != 429 and status < 500:
            return None
        sleep(base * 2**k)
    return None


FAILED = "no answer within the allowed attempts"
#: Pages that are tried to learn how many a category has.
PROBES = 3


def pages(category: int, params: dict, fetch: Fetch, attempts: int, base: float, pause: float, sleep: Callable[[float], None]) -> Iterator[tuple]:
    """(category, page, ord, item, error) rows; a failed page is a row with an error, later pages go on.

    Any page tells how many there are, so a first page that fails does not end its category: the next ones are tried. If none
    of PROBES answers, the last error says that the category's pages are unknown.
    """
    page, total = 1, None
    while page <= (PROBES if total is None else total):
        if page > 1:
            sleep(pause)
        body = fetch_with_retry(fetch, params | {"codigoModalidadeContratacao": category, "pagina": page}, attempts, base, sleep)
        if body is None:
            yield category, page, None, None, FAILED if total is not None or page < PROBES else f"{FAILED}; the category's pages are unknown"
        else:
            total = body.get("totalPaginas") or 0
            yield from _items(category, page, body)
        page += 1


def _items(category: int, page: int, body: dict) -> Iterator[tuple]:
    for i, item in enumerate(body.get("data") or []):
        yield category, page, i, json.dumps(item, ensure_ascii=False), None


class _Category(InputPartition):
    def __init__(self, code: int):
        super().__init__(code)
        self.code = code


class _Reader(DataSourceReader):
    def __init__(self, source: Listing):
        self.fetch, self.options = source.fetch, dict(source.options)

    def partitions(self) -> list[InputPartition]:
        return [_Category(int(x)) for x in self.options["categories"].split(",")]

    def read(self, partition: _Category) -> Iterator[tuple]:
        o = self.options
        params = {"url": o.get("url", ""), "dataInicial": o.get("from", ""), "dataFinal": o.get("to", ""), "tamanhoPagina": o.get("pagesize", "50")}
        yield from pages(partition.code, params, self.fetch, int(o.get("attempts", 5)), float(o.get("wait", 2.0)), float(o.get("pause", 1.0)), time.sleep)


class Listing(DataSource):
    """``spark.dataSource.register(listing(fetch))``; options: categories, url, from, to, attempts, wait, pause."""

    fetch: Fetch = staticmethod(http_fetch)

    @classmethod
    def name(cls) -> str:
        return "paged_listing"

    def schema(self) -> str:
        return "category int, page int, ord int, item string, error string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self)


def listing(transport: Fetch) -> type[Listing]:
    """The data source with another transport."""

    class Own(Listing):
        fetch = staticmethod(transport)

    return Own


class _Pages(InputPartition):
    """Pages first to last of a day and category; none where its first page did not answer."""

    def __init__(self, day: str, category: int, first: int, last: int):
        super().__init__((day, category, first, last))
        self.day, self.category, self.first, self.last = day, category, first, last


class _StreamReader(DataSourceStreamReader):
    """Offsets: for each day and category the pages that are done, and how often its first page has failed.

    The first page of a day and category tells how many it has; pages beyond those done are new. One that does not answer counts as a
    failure: the next batch has an error row for it, and the one after tries again. What was planned last is kept in the file
    ``progress``, as an offset is not handed back after a restart and a failing page must not make a category begin anew.
    """

    def __init__(self, source: ListingStream):
        self.fetch, self.options = source.fetch, dict(source.options)
        self.known: dict | None = None

    def _number(self, name: str, default: float) -> float:
        return float(self.options.get(name, default))

    def _params(self, day: str, category: int, page: int) -> dict:
        o = self.options
        return {"url": o.get("url", ""), "dataInicial": day, "dataFinal": day, "tamanhoPagina": o.get("pagesize", "50"), "codigoModalidadeContratacao": category, "pagina": page}

    def _ask(self, day: str, category: int, page: int) -> dict | None:
        return fetch_with_retry(self.fetch, self._params(day, category, page), int(self._number("attempts", 5)), self._number("wait", 2.0), time.sleep)

    def _planned(self) -> dict:
        if self.known is None:
            path = self.options["progress"]
            self.known = {"pages": {}, "failed": {}}
            if os.path.exists(path):
                with open(path) as f:
                    self.known = json.load(f)
        return self.known

    def initialOffset(self) -> dict:
        return {"pages": {}, "failed": {}}

    def latestOffset(self) -> dict:
        known = self._planned()
        done, failed = dict(known["pages"]), dict(known["failed"])
        for day in self.options["days"].split(","):
            for category in self.options["categories"].split(","):
                key = f"{day}/{category}"
                body = self._ask(day, int(category), 1)
                if body is None:
                    failed[key] = failed.get(key, 0) + 1
                else:
                    done[key] = max(done.get(key, 0), body.get("totalPaginas") or 0)
        return {"pages": done, "failed": failed}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        out: list[InputPartition] = []
        step = int(self._number("pagesperpartition", 20))
        for key in sorted({*end["pages"], *end["failed"]}):
            day, category = key.rsplit("/", 1)
            first, last = start["pages"].get(key, 0) + 1, end["pages"].get(key, 0)
            out += [_Pages(day, int(category), at, min(last, at + step - 1)) for at in range(first, last + 1, step)]
            if end["failed"].get(key, 0) > start["failed"].get(key, 0):
                out.append(_Pages(day, int(category), 1, 0))
        self.known = end
        path = self.options["progress"]
        with open(f"{path}.new", "w") as f:
            json.dump(end, f)
        os.replace(f"{path}.new", path)
        return out

    def read(self, partition: _Pages) -> Iterator[tuple]:
        p = partition
        if p.last < p.first:
            yield p.day, p.category, 1, None, None, f"{FAILED}; it is tried again"
        for page in range(p.first, p.last + 1):
            if page > p.first:
                time.sleep(self._number("pause", 1.0))
            body = self._ask(p.day, p.category, page)
            if body is None:
                yield p.day, p.category, page, None, None, FAILED
            else:
                yield from ((p.day, *row) for row in _items(p.category, page, body))

    def commit(self, end: dict) -> None:
        pass


class ListingStream(Listing):
    """``spark.readStream.format("paged_listing_stream")``; options: days and categories (comma-joined), progress (a file of the driver), url, pagesize, attempts, wait, pause, pagesperpartition.

    A run takes the pages that are not done, by page ranges, over all tasks. A page that fails is a row with an error.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_listing_stream"

    def schema(self) -> str:
        return "day string, category int, page int, ord int, item string, error string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return _StreamReader(self)


def listing_stream(transport: Fetch) -> type[ListingStream]:
    """The streaming source with another transport."""

    class Own(ListingStream):
        fetch = staticmethod(transport)

    return Own
