"""Whitening of embeddings from an exact scatter by residue numbers.

An entry c becomes the whole number x = floor(1024 c) + 100000, so sums over all rows can be exact. Reading the rows

1. gives their number n, and sums S and bounds of each dimension,
2. gives the scatter of y = n x - S, that is n times what is left after centring: for several primes below 2^20 each task
   multiplies matrices of residues of y. No sum of BLOCK products reaches 2^53, so products of doubles are exact; they are
   reduced after each block, and a task hands on one residue matrix a prime. As many primes are taken as the
   bounds of step 1 ask for, so any number of rows and any size of entries fit. Tasks that each own some matrix rows add
   the residues up and reconstruct every sum by Chinese remaindering; divided by n^3 it is the covariance, rounded once.
   Its eigenvectors are found in doubles: the driver holds that one matrix, the square of the dimension, whatever n is,
3. measures the whitened rows' covariance, from means and centred products of each task, and
4. returns the rows.

Cases: rows whose vector is null or holds null or non-finite entries are left out; of vectors of different lengths those of the
most frequent length (the longer one of equals) are the table, others are left out, and so are empty ones; entries beyond 2^52 / 1024 in
size count as that; directions without variance (eigenvalue 0 but for rounding: one row, equal rows, constant dimensions, fewer rows than dimensions) have
whitened null and are no part of identity_error, which is null if there is no other; explained is null if nothing varies; deviation is
null where it exceeds a long; repeated rows and null ids are rows like others; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

SCALE, SHIFT = 1024.0, 100_000
#: Largest size of a scaled entry.
LARGEST = 2.0**52
#: Rows whose products are added up before they are reduced: BLOCK * 2^40 is below 2^53.
BLOCK = 4096
COMPONENTS = 8


@lru_cache(maxsize=64)
def primes(k: int) -> tuple[int, ...]:
    """The k largest primes below 2^20."""
    out, x = [], (1 << 20) - 1
    while len(out) < k:
        if all(x % d for d in range(3, 1025, 2)):
            out.append(x)
        x -= 2
    return tuple(out)


def enough(bound: int) -> tuple[int, ...]:
    """Primes whose product exceeds twice the bound, so that numbers of that size and either sign are told apart."""
    k, product = 1, primes(1)[0]
    while product <= 2 * bound + 1:
        k += 1
        product *= primes(k)[-1]
    return primes(k)


def entries(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the rows whose entries are all finite (of ``width`` entries), their lengths, and their x, one after another."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    there = column.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0 if width is None else lengths == width)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    ends = np.cumsum(lengths)
    good = there & (bad[ends] == bad[ends - lengths])
    flat = flat[np.repeat(good, lengths)]
    with np.errstate(over="ignore"):
        x = np.clip(np.floor(flat * SCALE), -LARGEST, LARGEST).astype(np.int64) + SHIFT
    return np.flatnonzero(good), lengths[good], x


def _sums(rows: DataFrame) -> DataFrame:
    """For each length and dimension: rows, sum, least and largest x."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            _, lengths, x = entries(batch.column(0))
            owner = np.repeat(lengths, lengths)
            for width in np.unique(lengths).tolist():
                own = x[owner == width].reshape(-1, width)
                for at in range(0, len(own), 512):  # 512 * 2^53 is below 2^63
                    part = own[at : at + 512]
                    new = [len(part), part.sum(0).astype(object), part.min(0), part.max(0)]
                    old = held.get(width)
                    held[width] = new if old is None else [old[0] + new[0], old[1] + new[1], np.minimum(old[2], new[2]), np.maximum(old[3], new[3])]
        for width, (n, s, low, high) in held.items():
            columns = [pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64())]
            columns += [pa.array([Decimal(int(v)) for v in s], pa.decimal128(38, 0)), pa.array(low), pa.array(high)]
            yield pa.RecordBatch.from_arrays(columns, ["width", "dim", "n", "s", "low", "high"])
        c.give_back()

    parts = rows.select("vector").mapInArrow(run, "width int, dim int, n long, s decimal(38,0), low long, high long")
    return parts.groupBy("width", "dim").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"), F.min("low").alias("low"), F.max("high").alias("high"))


@dataclass
class Table:
    """What step 1 knows of the rows: their length and number, and each dimension's sum; the largest size of y."""

    width: int
    n: int
    sums: list[int]
    largest: int

    def residues(self, x: np.ndarray, p: int) -> np.ndarray:
        """y modulo p, as doubles."""
        s = np.array([v % p for v in self.sums], np.int64)
        return ((self.n % p * (x % p) - s) % p).astype(np.float64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, rounded once."""
        whole = np.array([v // self.n for v in self.sums], np.int64)
        return (x - whole) - np.array([v % self.n / self.n for v in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of y^2 of each row."""
        if self.width * self.largest**2 < 1 << 63:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [v if v < 1 << 63 else None for v in (y * y).sum(1)]


def _table(rows: DataFrame) -> Table | None:
    sums = c.Stage(_sums(rows), "whiten-sums")
    top = sums.df.orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not top:
        return None
    own = sums.df.where(F.col("width") == top[0]["width"]).orderBy("dim").collect()  # a row a dimension
    sums.drop()
    n, s = own[0]["n"], [int(r["s"]) for r in own]
    return Table(len(own), n, s, max(max(n * r["high"] - v, v - n * r["low"]) for r, v in zip(own, s, strict=True)))


def scatter(rows: DataFrame, table: Table) -> DataFrame:
    """row and values: the rows of the covariance, from residues of the scatter of y."""
    width, n = table.width, table.n
    moduli = enough(n * table.largest**2)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((len(moduli), width, width), np.int64)
        for batch in batches:
            x = entries(batch.column(0), width)[2].reshape(-1, width)
            for at in range(0, len(x), BLOCK):
                for k, p in enumerate(moduli):
                    y = table.residues(x[at : at + BLOCK], p)
                    held[k] = (held[k] + (y.T @ y).astype(np.int64)) % p
        for i in range(width):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([held[:, i].ravel().tolist()], pa.list_(pa.int64()))], ["row", "residues"])
        c.give_back()

    def remainder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        p = np.array(moduli, np.int64)[:, None]
        for batch in batches:
            for i, own in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                residues = own.values.to_numpy().reshape(-1, width)
                held[i] = (held.get(i, 0) + residues) % p
        product = 1
        for m in moduli:
            product *= m
        weights = [product // m * pow(product // m, -1, m) for m in moduli]
        for i, residues in held.items():
            values = []
            for column in residues.T.tolist():
                v = sum(w * r for w, r in zip(weights, column, strict=True)) % product
                values.append((v - product if 2 * v > product else v) / n**3)
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([values], pa.list_(pa.float64()))], ["row", "values"])

    parts = rows.select("vector").mapInArrow(multiply, "row int, residues array<long>")
    return parts.repartition("row").mapInArrow(remainder, "row int, values array<double>")


@dataclass
class Whitening:
    """Unit components by falling eigenvalue, what scales each (0 for directions without variance), and its part of all variance."""

    table: Table
    components: np.ndarray
    scales: np.ndarray
    explained: list[float | None]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.table.centred(x) @ self.components * self.scales


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all rows of a column ``vector``; none for a table without vectors."""
    table = _table(rows)
    if table is None:
        return None
    covariance = np.array([r["values"] for r in scatter(rows, table).orderBy("row").collect()])  # width rows
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    values, vectors = values[order], vectors[:, order]
    rounding = table.width * np.finfo(np.float64).eps * max(0.0, float(values[0]))
    varies = values > rounding
    scales = np.where(varies, 1 / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    trace = float(np.trace(covariance))
    return Whitening(table, vectors, scales, [float(v) / trace if trace > 0 else None for v in np.maximum(values, 0.0)])


def identity_error(rows: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened rows' covariance less the identity, over components that vary."""
    k, width = len(model.scales), model.table.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, products = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            x = entries(batch.column(0), width)[2].reshape(-1, width)
            if len(x):
                w = model(x)
                own, m = w.mean(0), len(w)
                w -= own
                gap = own - mean
                products += w.T @ w + np.outer(gap, gap) * (n * m / (n + m))
                mean += gap * (m / (n + m))
                n += m
        if n:
            a, b = np.indices((k, k)).reshape(2, -1)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (a, b, np.full(k * k, n), mean[a], mean[b], products.ravel())], ["a", "b", "n", "ma", "mb", "p"])
        c.give_back()

    parts = rows.select("vector").mapInArrow(run, "a long, b long, n long, ma double, mb double, p double")
    n = F.sum("n")
    between = F.sum(F.col("n") * F.col("ma") * F.col("mb")) - F.sum(F.col("n") * F.col("ma")) * F.sum(F.col("n") * F.col("mb")) / n
    found = parts.groupBy("a", "b").agg(((F.sum("p") + between) / n).alias("v")).collect()  # the square of ``components``
    errors = [abs(r["v"] - (r["a"] == r["b"])) for r in found if model.scales[r["a"]] and model.scales[r["b"]]]
    return max(errors, default=None)


def whiten(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    rows = df.select(F.col(c.quoted(id_col)).alias("vec_id"), F.col(c.quoted(vector)).alias("vector"))
    schema = f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    model = fit(rows, components)
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    error, k, table = identity_error(rows, model), len(model.scales), model.table
    varies = model.scales > 0

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, _, x = entries(batch.column(1), table.width)
        x = x.reshape(-1, table.width)
        m = len(at)
        ids = batch.column(0).take(pa.array(np.repeat(at, k)))
        deviation = np.repeat(np.array(table.deviations(x), object), k).tolist()
        off = np.tile(~varies, m)
        columns = [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, table.n, np.int64)), pa.array(deviation, pa.int64())]
        columns += [pa.array(model(x).ravel(), mask=off), pa.array(model.explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())]
        return pa.RecordBatch.from_arrays(columns, schema_names)

    schema_names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return c.map_batches(rows, run, schema)
