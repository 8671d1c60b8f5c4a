"""Stable ranking: ties keep their input order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ranksieve.functions.names import free_names, quoted
from ranksieve.sources.shared import written


def _sum(terms: list[Column]) -> Column:
    """In a tree of little depth."""
    half = len(terms) // 2
    return terms[0] if len(terms) == 1 else _sum(terms[:half]) + _sum(terms[half:])


#: Rows whose keys the driver sees to split the order, and rows a range, about, at most RANGES of them.
SAMPLE, RANGE_ROWS, RANGES = 4096, 100_000, 512


def mark(scores: DataFrame, n: int, score: str = "score", ord: str = "ord", flag: str = "selected") -> DataFrame:
    """All rows, with their position and whether it is among the first n; null scores come last.

    Scores are computed once and written; what follows reads that table. A sample of its keys (score, ord) splits the order
    into ranges; a range's rows are numbered by one task, beginning with the number of rows in the ranges before it.
    Where just the first rows are wanted, ``page`` is a top-k without that.
    """
    a, b = F.col(score), F.col(ord)
    scores = written(scores, "scores")
    (bucket,) = free_names(scores, "bucket")
    parts = min(RANGES, -(-scores.count() // RANGE_ROWS))
    cuts: list[tuple] = []
    if parts > 1:
        sample = scores.select(a, b).orderBy(F.xxhash64(b, a), a, b).limit(SAMPLE).collect()
        keys = sorted(((r[0] is None, -(r[0] or 0.0), r[1]) for r in sample if r[1] is not None))
        cuts = sorted({keys[len(keys) * i // parts] for i in range(1, parts)}) if keys else []

    def behind(none: bool, value: float, at) -> Column:
        late = a.isNull() & (b > F.lit(at)) if none else a.isNull() | (a < -value) | ((a == -value) & (b > F.lit(at)))
        return F.coalesce(late, F.lit(False)).cast("int")

    ranged, before = scores.withColumn(bucket, F.lit(0)), [0]
    if cuts:
        ranged = scores.withColumn(bucket, _sum([behind(*cut) for cut in cuts]))
        counts = {r[0]: r[1] for r in ranged.groupBy(bucket).count().collect()}
        before = [sum(counts.get(k, 0) for k in range(i)) for i in range(len(cuts) + 1)]
    order = Window.partitionBy(bucket).orderBy(F.desc_nulls_last(score), F.asc(ord))
    start = F.element_at(F.array(*map(F.lit, before)).cast("array<bigint>"), F.col(bucket) + 1)
    out = ranged.withColumn("position", start + F.row_number().over(order))
    return out.drop(bucket).withColumn(flag, F.col("position") <= n)


def totals(marked: DataFrame, flag: str = "selected", product: str = "product") -> DataFrame:
    """total, selected, products: rows, those among the first, and the different products that these name, '' being none."""
    named = F.when(F.col(flag) & (F.col(product) != ""), F.col(product))
    return marked.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(flag)).alias("selected"), F.count_distinct(named).alias("products"))


def page(scores: DataFrame, skip: int, n: int, score: str = "score", ord: str = "ord") -> DataFrame:
    return scores.orderBy(F.desc(score), F.asc(ord)).offset(skip).limit(n)


def quota(rows: DataFrame, key: str, order: list[str], each: int, total: int, cuts: list) -> DataFrame:
    """The first ``each`` rows of every key by ``order``, and of those the first ``total`` by key and order.

    ``cuts``, ascending, split the keys into ranges. One range is computed, then two, four, ... until there are enough rows;
    those beyond are not read. Null keys come last. What is kept of each step is written, at most ``total`` rows.
    """
    of = F.col(quoted(key))
    (place,) = free_names(rows, "place")
    bounds = [None, *sorted(set(cuts)), None]
    ranges: list[tuple] = [*zip(bounds, bounds[1:], strict=False), "null"]
    kept, left, size = [rows.limit(0)], total, 1
    while ranges and left > 0:
        now, ranges, size = ranges[:size], ranges[size:], 2 * size
        inside = of.isNull() if now[0] == "null" else of.isNotNull()
        if now[0] != "null":
            if now[-1] == "null":
                now, ranges = now[:-1], ["null"]
            low, high = now[0][0], now[-1][1]
            inside = inside if low is None else inside & (of >= F.lit(low))
            inside = inside if high is None else inside & (of < F.lit(high))
        first = Window.partitionBy(of).orderBy(*map(quoted, order))
        part = rows.where(inside).withColumn(place, F.row_number().over(first)).where(F.col(place) <= each)
        part = written(part.orderBy(of, place).limit(left), "quota").drop(place)
        left -= part.count()
        kept.append(part)
    out = kept[0]
    for part in kept[1:]:
        out = out.union(part)
    return out


def last_wins(rows: DataFrame, key: str, ord: str) -> DataFrame:
    """One row a key, the last by ord; rows without one come first of all, so a key that has no others keeps one of them."""
    row = F.struct(*map(quoted, rows.columns))
    at = F.struct(F.col(quoted(ord)).isNotNull(), F.col(quoted(ord)))
    return rows.groupBy(F.col(quoted(key))).agg(F.max_by(row, at).alias("r")).select("r.*")


def stable_sample(rows: DataFrame, key: str, n: int, seed: int = 17) -> DataFrame:
    return rows.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)
