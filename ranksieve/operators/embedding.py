"""Remote embedders: polite clients, and the job that embeds what a cache lacks."""

from __future__ import annotations

import json
import math
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ranksieve.functions.names import quoted
from ranksieve.sources import shared

from .cache import append, misses

Post = Callable[[list[str]], list[list[float]]]


class Transient(Exception):
    """Worth another attempt: no connection, 429, 5xx."""


class Overfull(Exception):
    """The request holds more tokens than the service takes."""


def batches(texts: list[str], most: int, budget: int, estimate: Callable[[str], int]) -> Iterator[list[str]]:
    """Greedy batches as ``batching.greedy`` makes them; a larger text stands alone."""
    batch: list[str] = []
    held = 0
    for text in texts:
        size = estimate(text)
        if batch and (len(batch) >= most or held + size > budget):
            yield batch
            batch, held = [], 0
        batch.append(text)
        held += size
    if batch:
        yield batch


@dataclass
class Pace:
    """One spacing for the requests of all tasks: task k of n may start one at epoch + (m n + k) spacing, for each m once.

    ``epoch`` is the same for all, and so must their clocks be, but for a small part of the spacing.
    """

    task: int
    tasks: int
    epoch: float
    spacing: float
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.time
    turn: int = 0

    @classmethod
    def of_stage(cls, spacing: float, **how) -> Pace:
        """Of a task of a barrier stage, whose tasks agree on the epoch before any goes on."""
        context = BarrierTaskContext.get()
        clock = how.get("clock", time.time)
        epoch = max(map(float, context.allGather(repr(clock()))))
        return cls(context.partitionId(), len(context.getTaskInfos()), epoch, spacing, **how)

    def wait(self) -> None:
        """Sleeps until the next start of this task that is not over."""
        now = self.clock()
        if self.spacing > 0:
            self.turn = max(self.turn, math.ceil(((now - self.epoch) / self.spacing - self.task) / self.tasks))
            start = self.epoch + (self.turn * self.tasks + self.task) * self.spacing
            self.turn += 1
            if start > now:
                self.sleep(start - now)


@dataclass
class Client:
    """Vectors of texts in their order, over ``post``, one batch at a time.

    Batches start ``spacing`` seconds apart. Transient failures are tried again after waits that double up to
    ``cap``, with jitter; a batch with too many tokens is halved until it fits. What remains is a RuntimeError.
    Each task has its own client, so the number of partitions is the number of requests in flight. With a ``pace`` the requests of
    all tasks, those tried again too, start ``spacing`` apart.
    """

    post: Post
    most: int = 1000
    budget: int = 90_000
    spacing: float = 5.0
    attempts: int = 5
    base: float = 1.0
    cap: float = 60.0
    estimate: Callable[[str], int] = lambda text: max(1, len(text) // 4)
    sleep: Callable[[float], None] = time.sleep
    clock: Callable[[], float] = time.monotonic
    jitter: Callable[[], float] = random.random
    last: float | None = None
    pace: Pace | None = None

    def __call__(self, texts: list[str]) -> list[list[float]]:
        out: list[list[float]] = []
        for batch in batches(texts, self.most, self.budget, self.estimate):
            if self.pace is None and self.last is not None and (wait := self.spacing - (self.clock() - self.last)) > 0:
                self.sleep(wait)
            self.last = self.clock()
            out += self._fitting(batch)
        return out

    def _fitting(self, batch: list[str]) -> list[list[float]]:
        todo, out = [batch], []
        while todo:
            part = todo.pop()
            try:
                out += self._patient(part)
            except Overfull as e:
                if len(part) == 1:
                    raise RuntimeError(f"one text has too many tokens: {e}") from e
                half = len(part) // 2
                todo += [part[half:], part[:half]]
        return out

    def _patient(self, batch: list[str]) -> list[list[float]]:
        failure: Exception | None = None
        for attempt in range(self.attempts):
            if self.pace is not None:
                self.pace.wait()
            try:
                return self.post(batch)
            except Transient as e:
                failure = e
                self.sleep(min(self.cap, self.base * 2**attempt + self.jitter() * self.base))
        raise RuntimeError(f"no answer after {self.attempts} attempts: {failure}")


def http_post(url: str, headers: dict[str, str], body: Callable[[list[str]], dict], read: Callable[[dict], list[list[float]]], overfull: Callable[[int, str], bool] | None = None, timeout: float = 60) -> Post:
    """A ``post`` over HTTP with JSON; ``overfull`` tells from status and answer that tokens were too many."""

    def post(texts: list[str]) -> list[list[float]]:
        request = urllib.request.Request(url, json.dumps(body(texts)).encode(), {"Content-Type": "application/json", **headers})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as answer:
                return read(json.load(answer))
        except urllib.error.HTTPError as e:
            said = e.read().decode("utf-8", "replace")
            if e.code == 429 or e.code >= 500:
                raise Transient(f"HTTP {e.code}") from e
            if overfull is not None and overfull(e.code, said):
                raise Overfull(said[:500]) from e
            raise RuntimeError(f"HTTP {e.code} for {len(texts)} texts: {said[:500]}") from e
        except (urllib.error.URLError, ConnectionError, TimeoutError) as e:
            raise Transient(str(e)) from e

    return post


def indexed(answer: dict) -> list[list[float]]:
    """Vectors of ``{"data": [{"index", "embedding"}]}``, by index."""
    return [x["embedding"] for x in sorted(answer["data"], key=lambda x: x["index"])]


def in_order(answer: dict) -> list[list[float]]:
    """Vectors of ``{"embeddings": [{"values"}]}``, which keep the order of the request."""
    return [x["values"] for x in answer["embeddings"]]


def embed(rows: DataFrame, client: Callable[[], Callable[[list[str]], list[list[float]]]], text: str = "text", vector: str = "embedding") -> DataFrame:
    """All columns and the vector of each text, null for a null one; the embedder gets a batch of rows at a time.

    An embedder that gives another number of vectors than texts is an error, as rows would get others' vectors.
    """
    columns = rows.columns

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for frame in frames:
            there = frame[text].notna().to_numpy()
            texts = frame[text][there].tolist()
            found = ask(texts) if texts else []
            if len(found) != len(texts):
                raise RuntimeError(f"{len(found)} vectors for {len(texts)} texts")
            vectors = iter(found)
            frame[vector] = [next(vectors) if x else None for x in there]
            yield frame[[*columns, vector]]

    fields = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema]
    return rows.mapInPandas(run, ", ".join([*fields, f"{quoted(vector)} array<double>"]))


def fill(texts: DataFrame, cache: DataFrame, path: str, model: str, client: Callable[..., Callable[[list[str]], list[list[float]]]], staging: str, text: str = "text", group: int = 1000, seconds: float = 240.0, spacing: float | None = None, flight: int = 8) -> DataFrame:
    """Embeds distinct texts that ``cache`` (hash) lacks, appends them to the table at ``path``; returns hash, erro of the rest.

    ``client`` makes an embedder in each task. Texts go in groups of ``group``; before each group but a task's first, the
    task's time is compared with ``seconds``, and beyond it the remaining rows get an error. A failing group fails alone:
    what succeeded is kept, and the next run finds only the rest missing. Results pass through a table at ``staging``, so no
    text is sent twice within a run unless its task is lost. Null texts are never sent. With ``spacing`` the texts go to ``flight`` tasks of a
    barrier stage (the cluster must run so many at once), and ``client`` gets their common ``Pace``.
    """
    lacking = misses(texts, cache, text)
    number = lacking.count()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        embed, began, first = client() if spacing is None else client(Pace.of_stage(spacing)), time.monotonic(), True
        for frame in frames:
            for at in range(0, len(frame), group):
                part = frame.iloc[at : at + group]
                vectors: list = [None] * len(part)
                failure = None
                if not first and time.monotonic() - began > seconds:
                    failure = f"time budget of {seconds:.0f} s spent"
                else:
                    try:
                        vectors = embed(part["text"].tolist())
                    except RuntimeError as e:
                        failure = str(e)
                first = False
                yield pd.DataFrame({"hash": part["hash"].to_numpy(), "vector": vectors, "erro": failure})

    tasks = max(1, math.ceil(number / group))
    tasks = tasks if spacing is None else min(tasks, flight)
    sent = lacking.repartition(tasks, "hash").mapInPandas(run, "hash string, vector array<double>, erro string", barrier=spacing is not None)
    sent.write.mode("overwrite").parquet(staging)
    done = texts.sparkSession.read.parquet(staging)
    append(done.where("erro is null").select("hash", "vector"), path, model)
    return done.where("erro is not null").select("hash", "erro")


def slow_client(post: Post, **how) -> Client:
    """The client of the service with small batches: 250 texts, 14,000 tokens, one in 35 s; too many tokens are not halved."""
    return Client(post, **({"most": 250, "budget": 14_000, "spacing": 35.0} | how))


def too_many_tokens(status: int, said: str) -> bool:
    """Whether an answer says that a batch held too many tokens; texts that are no JSON objects do not."""
    try:
        body = json.loads(said)
    except ValueError:
        return False
    return status == 400 and isinstance(body, dict) and body.get("error_code") == "TOO_MANY_TOKENS_IN_BATCH"


def profile_vectors(units: DataFrame, cached: DataFrame, model: str, client: Callable[[], Callable[[list[str]], list[list[float]]]]) -> tuple[DataFrame, DataFrame]:
    """name, hash, modelo, unit, text, vector of all profile units; and those embedded now, to replace cache entries.

    A profile whose hash and model the cache has is taken from there; each of the others is embedded with one call. ``units``:
    name, hash, unit, text; a profile is a file that a person wrote, so its units fit one task.
    """
    same = ["name", "hash", "modelo"]
    own = units.withColumn("modelo", F.lit(model))
    have = cached.select(*same).distinct()
    lacking = own.join(have, same, "left_anti")

    def embed(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("unit")
        frame["vector"] = client()(frame["text"].tolist())
        return frame

    schema = "name string, hash string, unit int, text string, modelo string, vector array<double>"
    columns = [*same, "unit", "text", "vector"]
    new = lacking.select("name", "hash", F.col("unit").cast("int").alias("unit"), "text", "modelo").groupBy("name").applyInPandas(embed, schema).select(*columns)
    return cached.join(own.select(*same).distinct(), same, "left_semi").select(*columns).unionByName(new), new


def migrate(old: DataFrame, path: str, value: str = "value", delete: tuple[str, ...] = ()) -> None:
    """Legacy caches, each one JSON object {modelo, vetores: {hash: vector}} a row, added to the cache table once.

    Entries that the table has already are left out, so a repeated run adds nothing; two runs at once would both add them. Paths
    in ``delete``, the legacy files, go once the table has everything.
    """
    spark = old.sparkSession
    read = old.select(F.from_json(value, "modelo string, vetores map<string,array<double>>").alias("j"))
    rows = read.select(F.coalesce("j.modelo", F.lit("")).alias("modelo"), F.explode("j.vetores").alias("hash", "vector")).dropDuplicates(["modelo", "hash"])
    if shared.exists(spark, path):
        there = spark.read.option("basePath", path).schema("hash string, vector array<double>, modelo string").parquet(path).select("modelo", "hash")
        rows = rows.join(there, ["modelo", "hash"], "left_anti")
    # before whatever is appended later
    rows.withColumn("ord", F.lit(0).cast("long")).write.mode("append").partitionBy("modelo").parquet(path)
    for gone in delete:
        shared.file_system(spark, gone).delete(shared.path_of(spark, gone), True)


def judge(rows: DataFrame, key: str, prompt: str, call: Callable[[], Callable[[str], str]], estimate: Callable[[str], int], most: int = 100_000) -> DataFrame:
    """key, veredito (JSON), erro: the answer to each prompt; a row that fails, or whose prompt exceeds ``most`` tokens, fails alone."""
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = call()
        for frame in frames:
            said, failed = [], []
            for text in frame["prompt"]:
                try:
                    if text is None:
                        raise ValueError("no prompt")
                    if (size := estimate(text)) > most:
                        raise ValueError(f"prompt of {size} tokens, more than {most}")
                    answer = ask(text)
                    json.loads(answer)
                    said.append(answer)
                    failed.append(None)
                except Exception as e:  # one row's failure must not end the run; it is returned
                    said.append(None)
                    failed.append(f"{type(e).__name__}: {e}")
            yield pd.DataFrame({"key": frame["key"], "veredito": said, "erro": failed})

    named = rows.select(F.col(key).alias("key"), F.col(prompt).alias("prompt"))
    return named.mapInPandas(run, f"key {kind}, veredito string, erro string").withColumnRenamed("key", key)
