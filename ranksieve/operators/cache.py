"""Caches as tables: what is missing, what is there, what has changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranksieve.functions.names import free_names, quoted

from .ranking import last_wins


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def misses(texts: DataFrame, cache: DataFrame, text: str = "text") -> DataFrame:
    """Distinct hashes and texts that the cache lacks."""
    own = texts.select(text_hash(F.col(text)).alias("hash"), F.col(text).alias("text")).where("hash is not null").dropDuplicates(["hash"])
    return own.join(cache.select("hash"), "hash", "left_anti")


def lookup(texts: DataFrame, cache: DataFrame, text: str = "text", ord: str = "ord") -> DataFrame:
    """Texts with the cached vector, the last entry of a hash; input order is kept in their own columns."""
    return texts.withColumn("hash", text_hash(F.col(text))).join(last_wins(cache, "hash", ord).select("hash", "vector"), "hash")


def stale(now: DataFrame, before: DataFrame, key: str, date: str) -> DataFrame:
    """Rows whose date differs from the processed one in any way, a missing one being ''."""
    k, d = free_names(now, "k", "d")
    old = before.select(F.col(quoted(key)).alias(k), F.col(quoted(date)).alias(d))
    joined = now.join(old, F.col(quoted(key)) == F.col(k), "left")
    changed = F.col(k).isNull() | ~F.coalesce(F.col(quoted(date)), F.lit("")).eqNullSafe(F.coalesce(F.col(d), F.lit("")))
    return joined.where(changed).drop(k, d)


def append(rows: DataFrame, path: str, model: str) -> None:
    """New vectors of a model, one a hash, added to the cache table; ``ord`` is the time, for ``lookup``."""
    rows = rows.dropDuplicates(["hash"]).withColumn("ord", F.unix_micros(F.current_timestamp()))
    rows.withColumn("modelo", F.lit(model)).write.mode("append").partitionBy("modelo").parquet(path)
