"""Sharding by sampled splitters, with DataFrame functions only; law ``bytes``: shards of nearly the same size.

Documents are ordered by a hash of their text, then of their id, then by a number of the row, so equal texts are
neighbours and no two rows have the same key. A sample weighted by size gives splitters at its quantiles, which cut the
order into many narrow ranges; ranges found overfull, by bytes or by rows, are cut again at splitters of a sample of their
own, until none is. Within a range running sums give every row its exact place in bytes, and shards are cut at
exact places: a group of equal texts, however large, and repeated rows are cut there as all else, at most once a boundary.

Documents of more than a RANGES-th of a shard would make such cuts coarse. There are fewer than shards times RANGES of them; they
are dealt first, largest first, each to the shard that has least, and the cuts of the others then fill all shards to
one level. So no shard is further from the level than by one of the smaller documents, a RANGES-th of a shard; only a document
larger than a whole shard makes its own one larger. Slots count the large documents of a shard first, then its part of the order.

What the driver holds: the sizes of the large documents, SAMPLE keys at most a round, and a count and a size a range.

Cases: a null text is empty and of size 1; a null id is a key like others; repeated rows are rows of their own and may lie in
different shards; with fewer rows than shards some shards stay empty; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

#: Ranges a shard, and keys in a sample.
RANGES, SAMPLE = 64, 32_768

Key = tuple[int, int, int]


def _array(values, kind: str = "bigint") -> Column:
    """An array literal: the string folds into one constant."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def _count(n: int, below) -> Column:
    """How many of n ordered things are below, by binary search; ``below`` tells it of the k-th, from 1."""
    if not n:
        return F.lit(0)
    steps = _array([1 << k for k in reversed(range(n.bit_length()))], "int")

    def step(lo: Column, add: Column) -> Column:
        return F.when((lo + add <= n) & below(F.least(lo + add, F.lit(n))), lo + add).otherwise(lo)

    return F.aggregate(steps, F.lit(0), step)


def _range_of(splitters: list[Key]) -> Column:
    """How many splitters are below a row's key (h, v, w): its range."""
    held = [_array([s[k] for s in splitters]) for k in range(3)] if splitters else []

    def below(at: Column) -> Column:
        h, v, w = (F.element_at(x, at) for x in held)
        return (h < F.col("h")) | ((h == F.col("h")) & ((v < F.col("v")) | ((v == F.col("v")) & (w < F.col("w")))))

    return _count(len(splitters), below)


def _quantiles(keys: list[Key], n: int) -> list[Key]:
    keys = sorted(keys)
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if keys else []


def _dealt(sizes: list[tuple[int, int]], n_shards: int) -> tuple[list[tuple[int, int, int]], list[int], list[int]]:
    """Row, shard and slot of the large documents (row, size), and what bytes and rows each shard then has."""
    load, rows, out = [0] * n_shards, [0] * n_shards, []
    for row, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        shard = min(range(n_shards), key=lambda s: (load[s], s))
        out.append((row, shard, rows[shard]))
        load[shard] += size
        rows[shard] += 1
    return out, load, rows


def _cuts(load: list[int], rest: int) -> list[int]:
    """Where, in bytes of the ordered rows, each shard but the last ends, if all are filled to one level."""
    level, full = 0, sorted(load)
    for k in range(1, len(full) + 1):
        level = (sum(full[:k]) + rest) / k
        if k == len(full) or level <= full[k]:
            break
    cuts, end = [], 0.0
    for x in load[:-1]:
        end += max(0.0, level - x)
        cuts.append(int(end))
    return cuts


def shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of each document."""
    whole = F.coalesce(F.col(c.quoted(text)), F.lit(""))
    rows = docs.select(
        F.col(c.quoted(id_col)).alias("doc_id"), (F.octet_length(whole).cast("long") + 1).alias("size"), F.crc32(whole.cast("binary")).alias("text_crc32"), F.xxhash64(whole).alias("h"))
    # the number of a row is written once, so every later reading sees the same
    rows = c.Stage(rows.withColumn("v", F.xxhash64("doc_id", "h", F.lit(17))).withColumn("w", F.monotonically_increasing_id()), "shard-rows").df
    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    large = F.col("size") * (n_shards * RANGES) > F.lit(total)
    found = [(r["w"], r["size"]) for r in rows.where(large).select("w", "size").collect()]  # fewer than n_shards * RANGES
    dealt, load, taken = _dealt(found, n_shards)
    keyed = rows.where(~large)
    n, total = n - len(found), total - sum(load)
    target_rows, target = max(1.0, n / (n_shards * RANGES)), max(1.0, total / (n_shards * RANGES))

    weight = F.col("size") / F.lit(float(max(1, total))) + F.lit(1.0 / max(1, n))  # 2 in all
    chance = F.pmod(F.xxhash64("v", "w", F.lit(5)), F.lit(1 << 40)) / F.lit(float(1 << 40))

    def sample(df: DataFrame, share: float) -> list[Key]:
        """Keys, each as often as its weight asks for; SAMPLE of them for the whole table."""
        count = F.floor(weight * F.lit(SAMPLE / 2 / share) + chance).cast("int")
        picked = df.withColumn("count", count).where("count > 0").select("h", "v", "w", "count")
        return [k for r in picked.collect() for k in [(r["h"], r["v"], r["w"])] * min(r["count"], SAMPLE)]

    splitters = _quantiles(sample(keyed, 1.0), n_shards * RANGES) if n else []
    while True:
        sizes = _sizes(keyed, splitters)
        over = [r for r, (size, count) in sizes.items() if count > 1 and (size > 2 * target or count > 4 * target_rows)]
        if not over:
            break
        share = sum(sizes[r][0] / max(1, total) + sizes[r][1] / max(1, n) for r in over) / 2
        inside = keyed.where(_range_of(splitters).isin(over))
        by_range: dict[int, list[Key]] = {}
        for k in sample(inside, share):
            by_range.setdefault(bisect_left(splitters, k), []).append(k)
        more = {k for r, keys in by_range.items() for k in _quantiles(keys, 1 + int(max(sizes[r][0] / target, sizes[r][1] / target_rows)))}
        if more <= set(splitters):
            break
        splitters = sorted({*splitters, *more})

    # a row's place: what the ranges before its own hold, and what its range holds before it
    before, done, passed = [], 0, 0
    for r in range(len(splitters) + 1):
        before.append((done, passed))
        size, count = sizes.get(r, (0, 0))
        done, passed = done + size, passed + count
    ranged = keyed.withColumn("r", _range_of(splitters))
    order = Window.partitionBy("r").orderBy("h", "v", "w")
    start, first = (F.element_at(_array([x[k] for x in before]), F.col("r") + 1) for k in (0, 1))
    middle = 2 * (start + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))) - F.col("size")
    cuts = _cuts(load, total)
    shard = _count(len(cuts), lambda at: 2 * F.element_at(_array(cuts), at) <= F.col("middle"))
    placed = ranged.withColumn("middle", middle).withColumn("rank", first + F.row_number().over(order) - 1)
    placed = c.Stage(placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), "rank"), "shard-places").df
    begins = {r["shard"]: r["rank"] for r in placed.groupBy("shard").agg(F.min("rank").alias("rank")).collect()}  # a row a shard
    offset = F.element_at(_array([taken[s] - begins.get(s, 0) for s in range(n_shards)]), F.col("shard") + 1)
    out = placed.select("doc_id", "size", "text_crc32", "shard", (F.col("rank") + offset).alias("slot"))
    if dealt:
        places = F.arrays_zip(*(_array([x[k] for x in dealt], kind).alias(name) for k, (name, kind) in enumerate((("w", "bigint"), ("shard", "int"), ("slot", "bigint")))))
        named = F.broadcast(docs.sparkSession.range(1).select(F.inline(places)))  # fewer than n_shards * RANGES
        out = out.unionByName(rows.where(large).join(named, "w").select("doc_id", "size", "text_crc32", "shard", "slot"))
    return out


def _sizes(keyed: DataFrame, splitters: list[Key]) -> dict[int, tuple[int, int]]:
    """Bytes and rows of each range."""
    found = keyed.groupBy(_range_of(splitters).alias("r")).agg(F.sum("size").alias("s"), F.count(F.lit(1)).alias("n"))
    return {x["r"]: (x["s"], x["n"]) for x in found.collect()}
