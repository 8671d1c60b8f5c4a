"""Scores of items and chunks against a profile of several vectors; full doubles, never rounded.

A profile is a stated query set, small by nature: up to PROFILE_ROWS vectors, which are counted first, go to every task, and
each row is scored where it lies, with no shuffle and no pairs. ``dense`` takes larger ones too, in a grid of tiles.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Accumulator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ranksieve.functions import vectors as v
from ranksieve.functions.names import free_names, quoted
from ranksieve.sources.shared import written

#: Largest profile that is broadcast, in rows.
PROFILE_ROWS = 10_000


def small(profile: DataFrame) -> DataFrame:
    if profile.limit(PROFILE_ROWS + 1).count() > PROFILE_ROWS:
        raise ValueError(f"a profile has at most {PROFILE_ROWS} vectors")
    return F.broadcast(profile)


@dataclass
class Profile:
    """Names and vectors in order of their units; of equal vectors only the first, which wins their ties."""

    names: list[str]
    vectors: list[np.ndarray]

    @classmethod
    def of(cls, profile: DataFrame, each: tuple[str, ...] = ()) -> Profile:
        """A profile of at most PROFILE_ROWS rows; ``each``: columns within which equal vectors count as such."""
        columns = [F.col("name"), F.col("unit"), F.col("vector").cast("array<double>").alias("vector"), *[F.col(x).alias(f"by_{x}") for x in each]]
        rows = profile.select(*columns).orderBy("unit").limit(PROFILE_ROWS + 1).collect()
        if len(rows) > PROFILE_ROWS:
            raise ValueError(f"a profile has at most {PROFILE_ROWS} vectors")
        out, seen = cls([], []), set()
        for r in rows:
            vector = np.array([np.nan if x is None else x for x in r["vector"] or []], np.float64)
            key = (hashlib.blake2b(vector.tobytes(), digest_size=16).digest(), *(r[f"by_{x}"] for x in each))
            if key not in seen:
                seen.add(key)
                out.names.append(r["name"])
                out.vectors.append(vector)
        return out

    def scores(self, vectors: list[np.ndarray]) -> np.ndarray:
        """Cosines of vectors with all of the profile's; products over the shorter length, 0 where a norm is 0."""
        out = np.zeros((len(vectors), len(self.vectors)))
        own, other = _by_length(vectors), _by_length(self.vectors)
        for n, rows in own.items():
            a = np.array([vectors[i] for i in rows]).reshape(len(rows), n)
            for m, columns in other.items():
                b = np.array([self.vectors[i] for i in columns]).reshape(len(columns), m)
                k = min(n, m)
                norms = np.outer(np.sqrt((a * a).sum(1)), np.sqrt((b * b).sum(1)))
                out[np.ix_(rows, columns)] = np.where(norms == 0, 0.0, a[:, :k] @ b[:, :k].T / np.where(norms == 0, 1.0, norms))
        return out


def _by_length(vectors: list[np.ndarray]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, x in enumerate(vectors):
        out.setdefault(len(x), []).append(i)
    return out


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """Null ones have no entries, so their scores are 0."""
    return [np.zeros(0) if x is None else np.array([np.nan if e is None else e for e in x], np.float64) for x in column.to_pylist()]


def _scored(rows: DataFrame, vector: str, keep: list[str], fields: list[StructField], of) -> DataFrame:
    """The kept columns and ``fields``, which ``of`` makes from the vectors of a batch; every row stays a row."""
    (own,) = free_names(rows, "own")
    schema = StructType([*(rows.schema[x] for x in keep), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                made = of(_vectors(part.column(len(keep))))
                yield pa.RecordBatch.from_arrays([*part.columns[: len(keep)], *made], names=[f.name for f in schema])

    return rows.select(*[F.col(quoted(x)) for x in keep], F.col(quoted(vector)).cast("array<double>").alias(own)).mapInArrow(run, schema)


def _pairs(rows: DataFrame, profile: DataFrame, vector: str, keep: list[str]) -> tuple[DataFrame, str, str, str]:
    """The kept columns of every row with every profile vector, and the names of three more: score, name and unit."""
    own, norm, name, unit, other, length, score = free_names(rows, "own", "norm", "name", "unit", "other", "length", "score")
    of = F.col(quoted(vector))
    left = rows.select(*[F.col(quoted(x)) for x in keep], of.alias(own), v.norm(of).alias(norm))
    right = small(profile.select(F.col("name").alias(name), F.col("unit").alias(unit), F.col("vector").alias(other), v.norm(F.col("vector")).alias(length)))
    pairs = left.crossJoin(right).withColumn(score, v.cosine(F.col(own), F.col(other), F.col(norm), F.col(length)))
    return pairs.drop(own, norm, other, length), score, name, unit


def triage(items: DataFrame, profile: DataFrame, ord: str = "ord", vector: str = "vector") -> DataFrame:
    """ord, score, product: the best profile vector of each row; the first of equals. Fails on an empty profile."""
    known = Profile.of(profile)
    if not known.names:
        raise ValueError("the profile is empty")

    def best(vectors: list[np.ndarray]) -> list[pa.Array]:
        scores = known.scores(vectors)
        first = scores.argmax(1)
        return [pa.array(scores[np.arange(len(first)), first]), pa.array([known.names[i] for i in first], pa.string())]

    return _scored(items, vector, [ord], [StructField("score", DoubleType()), StructField("product", StringType())], best)


def classify(chunks: DataFrame, priority: DataFrame, vector: str = "vector") -> DataFrame:
    """Adds low, keep and ``class``, which is baixa only if its best similarity is strictly above that of incluir.

    Each row is judged by itself, so rows with equal keys stay rows of their own; a group without vectors scores -1.
    """
    known = Profile.of(priority, each=("name",))

    def both(vectors: list[np.ndarray]) -> list[pa.Array]:
        scores, names = known.scores(vectors), np.array(known.names, object)
        low, keep = (scores[:, names == g].max(1) if (names == g).any() else np.full(len(vectors), -1.0) for g in ("baixa", "incluir"))
        return [pa.array(low), pa.array(keep), pa.array(np.where(low > keep, "baixa", "incluir").tolist(), pa.string())]

    fields = [StructField("low", DoubleType()), StructField("keep", DoubleType()), StructField("class", StringType())]
    return _scored(chunks, vector, [x for x in chunks.columns if x != vector], fields, both)


def adherence(keys: DataFrame, chunks: DataFrame, profile: DataFrame, key: str = "item", ord: str = "chunk", vector: str = "vector") -> DataFrame:
    """key, score, product of every key: best chunk and vector above 0, else 0 and ''; the first chunk, then vector, of equals."""
    if not profile.limit(1).count():
        return keys.select(key, F.lit(0.0).alias("score"), F.lit("").alias("product"))
    pairs = dense(chunks, profile, ord, vector, (key,)).where("score > 0")
    best = pairs.groupBy(key).agg(F.max_by(F.struct("score", "product"), F.struct("score", -F.col(ord))).alias("b"))
    return keys.join(best, key, "left").select(key, F.coalesce("b.score", F.lit(0.0)).alias("score"), F.coalesce("b.product", F.lit("")).alias("product"))


def without_failed(keys: DataFrame, failed: DataFrame, key: str = "item") -> DataFrame:
    """Keys but those with an error: what could not be embedded is left out, not scored 0."""
    return keys.join(failed.where("erro IS NOT NULL").select(key).distinct(), key, "left_anti")


def explain(chunks: DataFrame, profile: DataFrame, vector: str = "vector") -> DataFrame:
    """All columns but the vector, and name, unit and score of every profile vector."""
    pairs, score, name, unit = _pairs(chunks, profile, vector, [x for x in chunks.columns if x != vector])
    return pairs.withColumnsRenamed({name: "name", unit: "unit", score: "score"})


#: Items of a tile that a task holds, and profile vectors of its block, which stream by.
TILE_ITEMS, BLOCK = 1 << 15, 1 << 16


def dense(items: DataFrame, profile: DataFrame, ord: str = "ord", vector: str = "vector", keep: tuple[str, ...] = ()) -> DataFrame:
    """ord, the columns in ``keep``, score, product as ``triage`` gives them, for a profile of any size whose vectors have one length.

    Up to PROFILE_ROWS vectors are broadcast and items are scored where they lie. More meet the items in a grid: items are
    cut into blocks of TILE_ITEMS by their place, profile vectors into blocks of BLOCK by a hash, and each pair of blocks is a
    tile, whose task holds the items and lets the vectors stream by. The best of an item's tiles is the highest score, then
    the first unit. The plan has that size whatever the tables have, and nothing of them passes the driver.
    Vectors of another length than the first unit's, null ones and those of norm 0 score 0 against all, as ``cosine`` has it for norm 0.
    Fails on an empty profile.
    """
    known = profile.select("name", "unit", F.col("vector").cast("array<double>").alias("vector"))
    first = known.orderBy("unit").limit(1).collect()
    if not first:
        raise ValueError("the profile is empty")
    width = len(first[0]["vector"] or [])
    # products of equal vectors may differ in a last digit from tile to tile, so only the first of them is used
    distinct = known.groupBy("vector").agg(F.min(F.struct("unit", "name")).alias("f")).select("vector", F.col("f.unit").alias("unit"), F.col("f.name").alias("name"))
    names = [ord, *keep]
    if known.limit(PROFILE_ROWS + 1).count() <= PROFILE_ROWS:
        units = Profile.of(profile)
        against = _normalised(units.vectors, width)

        def best(vectors: list[np.ndarray]) -> list[pa.Array]:
            scores = _normalised(vectors, width) @ against.T
            at = scores.argmax(1)
            return [pa.array(scores[np.arange(len(at)), at]), pa.array([units.names[i] for i in at], pa.string())]

        return _scored(items, vector, names, [StructField("score", DoubleType()), StructField("product", StringType())], best)
    return _grid(items, written(distinct, "profile"), width, names, vector)


class Clusters:
    """Unit vectors in clusters, each with a center and the distance of its furthest member.

    The vectors nearest to a query are found exactly: by the triangle inequality none of a cluster is nearer than the
    center's distance less that radius, so clusters for which this exceeds the best found are skipped.
    """

    #: What rounding may add to a distance.
    SLACK = 1e-7

    def __init__(self, vectors: np.ndarray):
        n = len(vectors)
        # centers are vectors far from each other; sqrt(n) of them cost about as much as the members of one
        chosen, far = [0], np.linalg.norm(vectors - vectors[0], axis=1)
        while len(chosen) < math.isqrt(n) and far.max() > 0:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(vectors - vectors[chosen[-1]], axis=1))
        self.centers = vectors[chosen]
        of = (vectors @ self.centers.T).argmax(1)
        self.members = [np.flatnonzero(of == k) for k in range(len(chosen))]
        self.vectors = [vectors[m] for m in self.members]
        self.radius = np.array([np.linalg.norm(v - c, axis=1).max(initial=0.0) for v, c in zip(self.vectors, self.centers, strict=True)])

    def best(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each unit query the highest product and the first vector that has it; and how many products were made."""
        score, at, made = np.full(len(queries), -np.inf), np.full(len(queries), np.iinfo(np.int64).max), queries.shape[0] * len(self.centers)
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * queries @ self.centers.T))
        near = apart - self.radius  # no member is nearer

        def look(rows: np.ndarray, k: int) -> None:
            nonlocal made
            if not len(rows) or not len(self.members[k]):
                return
            products = queries[rows] @ self.vectors[k].T
            made += products.size
            first = products.argmax(1)
            found, which = products[np.arange(len(rows)), first], self.members[k][first]
            better = (found > score[rows]) | ((found == score[rows]) & (which < at[rows]))
            score[rows[better]], at[rows[better]] = found[better], which[better]

        nearest = apart.argmin(1)
        for k in range(len(self.centers)):
            look(np.flatnonzero(nearest == k), k)
        for k in range(len(self.centers)):
            reach = np.sqrt(np.maximum(0.0, 2 - 2 * score))
            look(np.flatnonzero((nearest != k) & (near[:, k] <= reach + self.SLACK)), k)
        return score, at, made


def pruned(items: DataFrame, profile: DataFrame, ord: str = "ord", vector: str = "vector", keep: tuple[str, ...] = (), products: Accumulator | None = None) -> DataFrame:
    """The rows of ``dense``, for a profile that is broadcast, by exact search: most products are never made where the profile's vectors lie in clusters.

    ``products``, if given, counts those that are made. Vectors of norm 0 or another length than the first unit's score 0 against all.
    """
    known = Profile.of(profile)
    if not known.names:
        raise ValueError("the profile is empty")
    width = len(known.vectors[0])
    units = _normalised(known.vectors, width)
    some = np.flatnonzero(units.any(1))  # the others score 0
    zero = np.flatnonzero(~units.any(1))
    index = Clusters(units[some]) if len(some) else None

    def best(vectors: list[np.ndarray]) -> list[pa.Array]:
        own = _normalised(vectors, width)
        score, at = np.zeros(len(own)), np.zeros(len(own), np.int64)  # the first of all, for items of norm 0
        rows = np.flatnonzero(own.any(1)) if index is not None else np.zeros(0, np.int64)
        if len(rows):
            found, which, made = index.best(own[rows])
            which = some[which]
            if len(zero):
                other = (found < 0) | ((found == 0) & (zero[0] < which))
                found, which = np.where(other, 0.0, found), np.where(other, zero[0], which)
            score[rows], at[rows] = found, which
            if products is not None:
                products.add(made)
        return [pa.array(score), pa.array([known.names[i] for i in at], pa.string())]

    return _scored(items, vector, [ord, *keep], [StructField("score", DoubleType()), StructField("product", StringType())], best)


def _normalised(vectors: list, width: int) -> np.ndarray:
    fits = [x if x is not None and len(x) == width else np.zeros(width) for x in vectors]
    out = np.array(fits, np.float64).reshape(len(vectors), width)
    norms = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(norms == 0, 1.0, norms)


def _grid(items: DataFrame, profile: DataFrame, width: int, names: list[str], vector: str) -> DataFrame:
    kept = [f"k{i}" for i in range(len(names))]
    parts = -(-profile.count() // BLOCK)
    item = F.monotonically_increasing_id()
    block = F.floor(item / TILE_ITEMS)
    own = items.select(item.alias("item"), block.alias("block"), *[F.col(quoted(x)).alias(k) for x, k in zip(names, kept, strict=True)], F.col(quoted(vector)).cast("array<double>").alias("vector"))
    own = written(own, "items")  # numbers are given once
    tiles = own.select("block").distinct()
    rows = own.select("block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), F.col("item").alias("at"), F.lit(None).cast("string").alias("name"), "vector")
    units = profile.select(F.pmod(F.xxhash64("unit"), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("kind"), F.col("unit").cast("long").alias("at"), "name", "vector")
    units = units.crossJoin(tiles).select("block", "part", "kind", "at", "name", "vector")  # each unit once a block of items
    met = rows.union(units).repartition("block", "part").sortWithinPartitions("block", "part", "kind", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, vectors, held, score, unit, name = None, [], [], None, None, None, None

        def given() -> pa.RecordBatch:
            some = held is not None
            columns = [pa.array(ids if some else [], pa.int64()), pa.array(score if some else [], pa.float64()), pa.array(unit if some else [], pa.int64()), pa.array(name.tolist() if some else [], pa.string())]
            return pa.RecordBatch.from_arrays(columns, ["item", "score", "unit", "product"])

        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                b, p, kind, place = (part.column(k).to_numpy(zero_copy_only=False) for k in range(4))
                edge = np.flatnonzero((b[1:] != b[:-1]) | (p[1:] != p[:-1]) | (kind[1:] != kind[:-1])) + 1
                for lo, hi in zip([0, *edge], [*edge, len(b)], strict=True):
                    now = (b[lo], p[lo])
                    if now != key:
                        yield given()
                        key, ids, vectors, held = now, [], [], None
                    own = _vectors(part.column(5).slice(lo, hi - lo))
                    if kind[lo] == 0:
                        ids += place[lo:hi].tolist()
                        vectors.append(_normalised(own, width))
                        continue
                    if not ids:
                        continue
                    if held is None:
                        held, vectors = np.concatenate(vectors), []
                        score, unit, name = np.full(len(ids), -np.inf), np.zeros(len(ids), np.int64), np.full(len(ids), None, object)
                    # units come in order, so a later one must be better
                    said = np.array(part.column(4).slice(lo, hi - lo).to_pylist(), object)
                    scores = held @ _normalised(own, width).T
                    first = scores.argmax(1)
                    found = scores[np.arange(len(ids)), first]
                    better = found > score
                    score[better], unit[better], name[better] = found[better], place[lo:hi][first[better]], said[first[better]]
        yield given()

    best = met.mapInArrow(run, "item long, score double, unit long, product string")
    best = best.groupBy("item").agg(F.max_by(F.struct("score", "product"), F.struct("score", -F.col("unit"))).alias("b"))
    out = own.drop("vector", "block").join(best, "item")
    return out.select(*[F.col(k).alias(x) for k, x in zip(kept, names, strict=True)], "b.score", "b.product")
