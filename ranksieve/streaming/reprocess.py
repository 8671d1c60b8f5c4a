"""Incremental runs: day files as a stream, reprocessing of what has changed, a ranking kept up to date."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ranksieve.functions.names import quoted
from ranksieve.operators.ranking import last_wins
from ranksieve.sources import shared


class _Changes(StatefulProcessor):
    """Passes a key's last row on if its date is not the one that was passed on last."""

    def __init__(self, forget: float | None):
        self.forget = forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.date = handle.getValueState("date", "d string", None if self.forget is None else int(1000 * self.forget))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:
        last = None
        for frame in rows:
            for d, o, row in zip(frame["d"], frame["o"], frame["row"], strict=True):
                at = (not pd.isna(o), None if pd.isna(o) else o)
                if last is None or at[0] > last[0][0] or (at[0] and at[0] == last[0][0] and at[1] >= last[0][1]):
                    last = (at, d, row)
        new = not self.date.exists() or self.date.get()[0] != last[1]
        if new or self.forget is not None:  # what is seen lives on
            self.date.update((last[1],))
        if new:
            yield pd.DataFrame({"row": [last[2]]})

    def close(self) -> None:
        pass


def changed(rows: DataFrame, key: str, date: str, ord: str, forget: float | None = None) -> DataFrame:
    """A stream's rows that are new or whose date differs, in any way, from the last one of their key; a missing date is ''.

    The state store keeps a date a key, so a batch costs what it holds, however many keys there were before; a key unseen
    for ``forget`` seconds expires there and is new again (such a query goes on until it is stopped, as Spark adds batches for what expires). Of a batch's rows of a key the last by ``ord`` counts.
    Rows pass as JSON, as the day files have them. The session's state store must be the RocksDB one: ``use_state_store``.
    """
    named = rows.select(F.col(quoted(key)).alias("k"), F.coalesce(F.col(quoted(date)).cast("string"), F.lit("")).alias("d"), F.col(quoted(ord)).alias("o"), F.to_json(F.struct(*map(quoted, rows.columns))).alias("row"))
    mode = "None" if forget is None else "ProcessingTime"
    found = named.groupBy("k").transformWithStateInPandas(_Changes(forget), "row string", "append", mode)
    return found.select(F.from_json("row", rows.schema).alias("r")).select("r.*")


def use_state_store(spark: SparkSession) -> None:
    """State of streams lives in RocksDB, on disk and in the checkpoint, not in the executors' heaps."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def run_once(spark: SparkSession, folder: str, schema: StructType, state: str, checkpoint: str, key: str, date: str, ord: str, process: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Takes all new files of ``folder``; ``process`` gets the rows that are new or ``changed`` since they were processed.

    What a batch has changed is recorded with the batch, so if ``process`` fails, or the run stops before the batch is
    committed, the next run gets the same rows under the same number. ``state`` is a table of key, date and batch for those
    who want to see what was processed; it is written, never read.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows.persist()
        process(rows, number)
        done = rows.select(F.col(quoted(key)), F.col(quoted(date)), F.lit(number).cast("long").alias("batch"))
        done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(state)
        rows.unpersist()

    use_state_store(spark)
    stream = changed(spark.readStream.schema(schema).json(folder), key, date, ord)
    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Ranking:
    """The best n of a table of scores, kept from batch to batch.

    Beside the table, whose rows are added by batch, there is a set of candidates: the best ``room`` of all keys when it was
    last filled, and a floor that no other key is above. A batch takes its keys out of the set and puts back those above the floor, so it reads
    its own rows and the set. Only where keys that fell leave fewer than n candidates is the set filled from the table again.
    The files of batch b come from those of b - 1, so a batch that is replayed finds what it found before.
    """

    def __init__(self, table: str, ranking: str, key: str, score: str, ord: str, n: int):
        self.table, self.ranking, self.key, self.score, self.ord, self.n = table, ranking, key, score, ord, n
        self.room, self.filled = 2 * n + 50, 0
        self.order = [F.desc_nulls_last(score), F.asc(ord), F.asc(key)]

    def __call__(self, rows: DataFrame, number: int) -> None:
        spark, own = rows.sparkSession, f"{self.table}/batch={number}"
        rows.write.mode("overwrite").parquet(own)
        held, floor = self._held(spark, number)
        if held is not None:
            latest = last_wins(spark.read.schema(rows.schema).parquet(own), self.key, self.ord)
            above = latest if floor is None else latest.where(self._above(floor))
            kept = self._best(held.join(latest.select(self.key), self.key, "left_anti").select(*rows.columns).unionByName(above))
            found = self._write(kept, number, floor)
        if held is None or (found < self.n and floor is not None):
            self.filled += 1
            whole = spark.read.parquet(self.table).withColumn("at", F.struct("batch", self.ord))
            self._write(self._best(last_wins(whole, self.key, "at").select(*rows.columns)), number, None)
        best = spark.read.parquet(f"{self.ranking}.candidates/batch={number}").where(F.col("position") <= self.n)
        best.write.mode("overwrite").parquet(self.ranking)
        self._forget(spark, number)

    def _best(self, rows: DataFrame) -> DataFrame:
        """The best ``room``, and one more that shows whether there are others."""
        top = rows.orderBy(*self.order).limit(self.room + 1)
        return top.withColumn("position", F.row_number().over(Window.orderBy(*self.order)))  # as many rows

    def _write(self, rows: DataFrame, number: int, floor: dict | None) -> int:
        """Writes a candidate set and the floor below it; how many there are."""
        spark, path = rows.sparkSession, f"{self.ranking}.candidates"
        rows.write.mode("overwrite").parquet(f"{path}/batch={number}")
        there = spark.read.parquet(f"{path}/batch={number}")
        over = there.where(F.col("position") > self.room).select(self.score, self.ord, self.key)
        below = over if over.limit(1).count() else over.limit(0) if floor is None else spark.createDataFrame([tuple(floor.values())], over.schema)
        below.write.mode("overwrite").parquet(f"{path}/floor={number}")
        return min(self.room, there.count())

    def _batches(self, spark: SparkSession) -> list[int]:
        path = f"{self.ranking}.candidates"
        if not shared.exists(spark, path):
            return []
        names = [x.getPath().getName() for x in shared.file_system(spark, path).listStatus(shared.path_of(spark, path))]
        whole = {x.removeprefix("floor=") for x in names if x.startswith("floor=") and shared.exists(spark, f"{path}/{x}/_SUCCESS")}
        return sorted(int(x) for x in whole)

    def _held(self, spark: SparkSession, number: int) -> tuple[DataFrame | None, dict | None]:
        before = [b for b in self._batches(spark) if b < number]
        if not before:
            return None, None
        path = f"{self.ranking}.candidates"
        floor = spark.read.parquet(f"{path}/floor={before[-1]}").collect()  # one row at most
        return spark.read.parquet(f"{path}/batch={before[-1]}").where(F.col("position") <= self.room), floor[0].asDict() if floor else None

    def _above(self, floor: dict) -> Column:
        """Whether a row comes before the floor in the order."""
        s, o, k = (F.lit(floor[x]) for x in (self.score, self.ord, self.key))
        score, ord, key = F.col(self.score), F.col(self.ord), F.col(self.key)
        higher = score.isNotNull() & (s.isNull() | (score > s))
        return F.coalesce(higher | (score.eqNullSafe(s) & ((ord < o) | (ord.eqNullSafe(o) & (key < k)))), F.lit(False))

    def _forget(self, spark: SparkSession, number: int) -> None:
        """Sets from before the last batch are never read again."""
        for b in [b for b in self._batches(spark) if b < number][:-1]:
            for name in ("floor", "batch"):
                path = f"{self.ranking}.candidates/{name}={b}"
                shared.file_system(spark, path).delete(shared.path_of(spark, path), True)


def keep_ranking(scores: DataFrame, table: str, ranking: str, checkpoint: str, key: str = "item", score: str = "score", ord: str = "ord", n: int = 100) -> StreamingQuery:
    """A stream of scores (key, score, ord) and the ranking of the best n so far, written anew after each batch; see ``Ranking``.

    A batch that is replayed replaces its own rows of the score table, so nothing counts twice; the last score of a key counts.
    """
    kept = Ranking(table, ranking, key, score, ord, n)
    return scores.writeStream.foreachBatch(kept).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def append_vectors(vectors: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """A stream of (modelo, hash, vector) into the cache table: the first vector of a model and hash, once; the state store knows them."""
    once = vectors.dropDuplicates(["modelo", "hash"]).withColumn("ord", F.unix_micros(F.current_timestamp()))
    return once.writeStream.format("parquet").partitionBy("modelo").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
