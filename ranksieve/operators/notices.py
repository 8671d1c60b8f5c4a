"""From notices to chunks: what was chunked under the same date is reused, the rest is listed, downloaded, extracted and cut."""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ranksieve.sources import remote

from . import cache, chunking, documents
from .ranking import last_wins


def main_texts(files: DataFrame, key: str) -> DataFrame:
    """key, text: the texts of a notice's main documents, in order of files and of texts within one, joined by line breaks.

    ``files``: key, file_ord, kind, title, content, file_name. Only main documents are opened.
    """
    main = documents.main_documents(files.where("content IS NOT NULL"), key, "kind")
    named = main.select(key, "file_ord", F.coalesce("file_name", "title").alias("name"), "content")
    texts = documents.extract(named).select(key, F.struct("file_ord", "text_ord", "text").alias("t"))
    listed = texts.groupBy(key).agg(F.array_sort(F.collect_list("t")).alias("l"))
    return listed.select(key, F.array_join("l.text", "\n").alias("text"))


def split(notices: DataFrame, cached: DataFrame, key: str, date: str) -> tuple[DataFrame, DataFrame]:
    """Entries of the cache (key, date, chunks) that hold for the notices, and the notices that have none."""
    newest = last_wins(cached, key, "ord").drop("ord")
    old = cache.stale(notices, newest, key, date)
    return newest.join(notices.join(old.select(key), key, "left_anti").select(key).distinct(), key, "left_semi"), old


def fetched(notices: DataFrame, key: str, date: str, address: tuple[str, str, str], list_files: Callable, fetch: Callable, archive: str | None = None, staging: str | None = None, **how) -> tuple[DataFrame, DataFrame]:
    """key, date, chunks of notices whose files could be listed, and key, erro of what failed.

    A notice whose listing fails gets no chunks at all, so nothing false is cached; a file that fails is left out and
    reported. Downloads pass through a table at ``staging``, if given, so that nothing is fetched twice.
    """
    spark = notices.sparkSession
    listed = remote.listings(notices, key, address, list_files, **how)
    found = remote.downloads(listed.where("erro IS NULL").drop("erro"), fetch, **how)
    failed = listed.where("erro IS NOT NULL").select(key, "erro")
    if staging is not None:
        listed.write.mode("overwrite").parquet(f"{staging}/listed")
        listed = spark.read.parquet(f"{staging}/listed")
        remote.downloads(listed.where("erro IS NULL").drop("erro"), fetch, **how).write.mode("overwrite").parquet(f"{staging}/files")
        found, failed = spark.read.parquet(f"{staging}/files"), listed.where("erro IS NOT NULL").select(key, "erro")
    if archive is not None:
        remote.archive(found, archive, key)
    whole = notices.join(failed.select(key), key, "left_anti").select(key, date).join(main_texts(found, key), key, "left")
    cut = chunking.chunks(whole, key, "text").groupBy(key).agg(F.array_sort(F.collect_list(F.struct("chunk_ord", "chunk")))["chunk"].alias("chunks"))
    chunks = F.coalesce("chunks", F.array().cast("array<string>")).alias("chunks")
    return whole.select(key, date).join(cut, key, "left").select(key, date, chunks), failed.unionByName(found.where("erro IS NOT NULL").select(key, "erro"))


def save(entries: DataFrame, path: str) -> None:
    """Adds entries to the chunk table; the last one of a key counts. A write that fails leaves the table as it was."""
    entries.withColumn("ord", F.unix_micros(F.current_timestamp())).write.mode("append").parquet(path)


def watched(rows: DataFrame, name: str = "progress") -> tuple[DataFrame, Observation]:
    """The same rows, and how many there were, and with how many chunks, once an action has run over them."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("done"), F.coalesce(F.sum(F.size("chunks")), F.lit(0)).alias("chunks")), seen


def counted(rows: DataFrame) -> tuple[DataFrame, Accumulator]:
    """The same rows, and a count of them that grows as tasks end; what runs again counts again."""
    seen = rows.sparkSession.sparkContext.accumulator(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(run, rows.schema), seen


@contextmanager
def telling(seen: Accumulator, tell: Callable[[int], None], seconds: float = 5.0) -> Iterator[None]:
    """While an action runs within, ``tell`` gets the running count every ``seconds`` if it has changed, and the last one at the end."""
    over, told = threading.Event(), [None]

    def now() -> None:
        if seen.value != told[0]:
            told[0] = seen.value
            tell(told[0])

    def watch() -> None:
        while not over.wait(seconds):
            now()

    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()
        now()


def skipped(failures: DataFrame) -> int:
    """How many rows have an error."""
    return failures.agg(F.count_if(F.col("erro").isNotNull())).first()[0]
