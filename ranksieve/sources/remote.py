"""Remote files of notices: listings and downloads, patient, over connections that a worker keeps.

A transport is made once a task by a factory, so tests and other services put in their own. Requests of a task follow
one another; the number of partitions is the number of requests in flight.
"""

from __future__ import annotations

import http.client
import json
import random
import re
import threading
import time
from collections.abc import Callable, Iterator
from functools import lru_cache
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranksieve.functions.names import quoted
from ranksieve.functions.text import safe_name

#: Attempts, and seconds of the first wait.
ATTEMPTS, WAIT = 5, 2.0
#: Most redirections that are followed.
HOPS = 5

#: (status, items or None) of a notice's address; (status, content or None, file name or None) of a URL.
List = Callable[..., tuple[int, list[dict] | None]]
Fetch = Callable[[str], tuple[int, bytes | None, str | None]]


def patient(call: Callable[[], tuple], attempts: int = ATTEMPTS, wait: float = WAIT, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> tuple | None:
    """The first answer that is final: its first field is neither 429 nor 5xx. None once all attempts are spent.

    Waits double, and a random part of the first is added, so that tasks that failed together do not return together.
    """
    for k in range(attempts):
        answer = call()
        if answer[0] != 429 and answer[0] < 500:
            return answer
        sleep(wait * 2**k + jitter() * wait)
    return None


class Pool:
    """Open connections by host, at most ``size`` idle ones a host; safe to be shared by threads."""

    def __init__(self, size: int):
        self.size, self.idle, self.lock = size, {}, threading.Lock()

    def get(self, url: str, timeout: float) -> tuple[int, bytes, dict[str, str]]:
        """Status, body and headers (names in lower case); what fails in transport is 503."""
        for _ in range(HOPS + 1):
            status, body, headers = self._once(url, timeout)
            if status not in (301, 302, 303, 307, 308) or "location" not in headers:
                return status, body, headers
            url = urljoin(url, headers["location"])
        return 508, b"", {}

    def _once(self, url: str, timeout: float) -> tuple[int, bytes, dict[str, str]]:
        at = urlsplit(url)
        with self.lock:
            held = self.idle.setdefault((at.scheme, at.netloc), [])
            connection = held.pop() if held else None
        for fresh in (connection is None, True):  # an idle connection may have been closed by the other side
            try:
                if fresh:
                    kind = http.client.HTTPSConnection if at.scheme == "https" else http.client.HTTPConnection
                    connection = kind(at.netloc, timeout=timeout)
                connection.request("GET", (at.path or "/") + (f"?{at.query}" if at.query else ""))
                answer = connection.getresponse()
                body = answer.read()
            except (OSError, http.client.HTTPException):
                connection.close()
                if fresh:
                    return 503, b"", {}
                continue
            with self.lock:
                if not answer.will_close and len(held) < self.size:
                    held.append(connection)
                else:
                    connection.close()
            return answer.status, body, {k.lower(): v for k, v in answer.getheaders()}
        return 503, b"", {}


@lru_cache(maxsize=1)
def pool(size: int = 8) -> Pool:
    """The pool of this worker process."""
    return Pool(size)


def http_list(base: str, timeout: float = 30) -> Callable[[], List]:
    """A factory of listings at ``base``/{company}/compras/{year}/{number}/arquivos."""

    def make() -> List:
        def ask(company, year, number):
            status, body, _ = pool().get(f"{base}/{company}/compras/{year}/{number}/arquivos", timeout)
            return status, json.loads(body) if status == 200 else None

        return ask

    return make


def http_fetch(timeout: float = 120) -> Callable[[], Fetch]:
    """A factory of downloads; names come from the header that may give one."""

    def make() -> Fetch:
        def ask(url):
            status, body, headers = pool().get(url, timeout)
            name = re.search(r'filename="?([^"]+)"?', headers.get("content-disposition", ""))
            return status, body if status == 200 else None, name[1] if name else None

        return ask

    return make


_FILE = "file_ord int, seq int, title string, kind string, url string, published string, erro string"


def listings(notices: DataFrame, key: str, address: tuple[str, str, str], transport: Callable[[], List], attempts: int = ATTEMPTS, wait: float = WAIT, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> DataFrame:
    """key, file_ord, seq, title, kind, url, published, erro: a row for each active file of each notice.

    A file is active unless its status is given and not true. A notice without files has no row; one whose listing
    fails, for whatever reason, has one row with an error, and does not stop the others.
    """
    kinds = notices.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = transport()
        for frame in frames:
            out = []
            for name, *at in frame.itertuples(index=False, name=None):
                failed = (name, None, None, None, None, None, None, f"no listing of the files of {name}")
                answer = patient(lambda at=at: ask(*at), attempts, wait, sleep, jitter)
                if answer is None or answer[0] not in (200, 204):
                    out.append(failed)
                    continue
                items = (answer[1] or []) if answer[0] == 200 else []
                active = (x for x in items if x.get("statusAtivo", True))
                out += [(name, i, x["sequencialDocumento"], x["titulo"], x["tipoDocumentoNome"], x["url"], x["dataPublicacaoPncp"], None) for i, x in enumerate(active)]
            frame = pd.DataFrame(out, columns=["key", "file_ord", "seq", "title", "kind", "url", "published", "erro"])
            yield frame.astype({"file_ord": "Int32", "seq": "Int32"})

    own = notices.select(F.col(quoted(key)).alias("key"), *[F.col(quoted(x)).alias(f"a{i}") for i, x in enumerate(address)])
    return own.mapInPandas(run, f"key {kinds}, {_FILE}").withColumnRenamed("key", key)


def cached_listings(notices: DataFrame, cache: DataFrame, key: str, address: tuple[str, str, str], transport: Callable[[], List], **how) -> tuple[DataFrame, DataFrame]:
    """Listings of all notices, from ``cache`` where it has the key; and the new ones without errors, to be appended to it."""
    have = cache.select(key).distinct()
    new = listings(notices.join(have, key, "left_anti"), key, address, transport, **how)
    return cache.join(notices.select(key).distinct(), key, "left_semi").unionByName(new), new.where("erro IS NULL")


def downloads(files: DataFrame, transport: Callable[[], Fetch], url: str = "url", attempts: int = ATTEMPTS, wait: float = WAIT, sleep: Callable[[float], None] = time.sleep, jitter: Callable[[], float] = random.random) -> DataFrame:
    """All columns, and status, content, file_name, erro: what each URL gives; a failure fails its row alone.

    A file at a time is held by a task. Rows with a null URL get an error.
    """
    fields = [*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in files.schema), "status int, content binary, file_name string, erro string"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = transport()
        for frame in frames:
            for i in range(len(frame)):
                row = frame.iloc[i : i + 1].copy()
                at = row[url].iloc[0]
                answer = patient(lambda at=at: ask(at), attempts, wait, sleep, jitter) if at is not None else (0, None, None)
                status, content, name = answer if answer is not None else (503, None, None)
                ok = status == 200 and content is not None
                row["status"], row["content"], row["file_name"] = status, content if ok else None, name if ok else None
                row["erro"] = None if ok else f"no download of {at}"
                yield row.astype({"status": "int32"})

    return files.mapInPandas(run, ", ".join(fields))


def archive(downloaded: DataFrame, path: str, key: str, seq: str = "seq", title: str = "title") -> None:
    """Appends what was downloaded, main document or not, to the table of raw documents: key, seq, name, content."""
    name = F.concat(F.col(quoted(seq)).cast("string"), F.lit("_"), safe_name(F.coalesce("file_name", F.col(quoted(title)))))
    downloaded.where("content IS NOT NULL").select(key, seq, name.alias("name"), "content").write.mode("append").parquet(path)
