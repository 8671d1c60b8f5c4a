"""Rows posted to a service by the executors, in batches that carry a key."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, datetime
from decimal import Decimal

from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

Send = Callable[[str, list[dict]], None]
#: Rows of a post at most.
MOST = 200


@dataclass
class Posted(WriterCommitMessage):
    """What a task has sent: rows, and the keys of its batches."""

    rows: int
    keys: list[str]


def _plain(value):
    if isinstance(value, (date, datetime)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return str(value)
    if isinstance(value, (bytes, bytearray)):
        return value.hex()
    raise TypeError(f"no JSON for {type(value).__name__}")


def key_of(rows: list[dict], partition: int, number: int) -> str:
    """The same for the same batch of the same task, however often it runs: by it the service knows a repetition."""
    return hashlib.sha256(json.dumps([partition, number, rows], sort_keys=True, default=_plain).encode()).hexdigest()


class _Writer(DataSourceWriter):
    def __init__(self, source: Posts):
        self.send, self.options = source.send, dict(source.options)

    def write(self, iterator: Iterator[Row]) -> Posted:
        most = min(MOST, int(self.options.get("most", MOST)))
        really, partition = self.options.get("send", "false") == "true", TaskContext.get().partitionId()
        batch, keys, rows = [], [], 0

        def close() -> None:
            nonlocal rows
            key = key_of(batch, partition, len(keys))
            if really:
                self.send(key, list(batch))
            keys.append(key)
            rows += len(batch)
            batch.clear()

        for row in iterator:
            batch.append(row.asDict(recursive=True))
            if len(batch) == most:
                close()
        if batch:
            close()
        return Posted(rows, keys)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        self._tell("committed", messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._tell("aborted", messages)

    def _tell(self, what: str, messages) -> None:
        """The keys of what was sent go to the file ``report``, if that option is given: after an abort they say what the service has."""
        if path := self.options.get("report"):
            done = [m for m in messages if m is not None]
            with open(path, "w") as f:
                json.dump({"state": what, "rows": sum(m.rows for m in done), "keys": [k for m in done for k in m.keys]}, f)


class Posts(DataSource):
    """``df.write.format("posts").mode("append").options(send="true")``: each task posts its rows, at most MOST at a time.

    Nothing is sent unless ``send`` is true, so a run is a dry one by default. A task that runs again posts the same batches under
    the same keys, if its rows come in the same order, and the service takes each key once. A post that fails fails its task, which Spark
    tries again; if that does not help the write is aborted. Options: send, most, report (a file of the driver).
    """

    @staticmethod
    def send(key: str, rows: list[dict]) -> None:
        raise ValueError("register posts(send) with a transport")

    @classmethod
    def name(cls) -> str:
        return "posts"

    def schema(self) -> str:
        return "row string"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self)


def posts(transport: Send) -> type[Posts]:
    """The sink with a transport of (key, rows); it must be idempotent by the key."""

    class Own(Posts):
        send = staticmethod(transport)

    return Own
