"""Greedy batches by count and tokens, in parallel, and the waits of a polite client.

Where a batch ends depends on where it began, and so on all rows before it. Yet the end of the batch that would begin at a row
depends on the rows behind it alone, so a group's rows are cut into blocks that are worked on at once:

1. Rows are range-partitioned by group and order, written, and numbered within their group: a task numbers its own part,
   and what earlier parts hold is added. Only a row a part goes through the driver.
2. A block is a stretch of row numbers; beside its rows it gets the first ``most`` of the next block. Prefix sums and binary
   search give the next batch start of every row, and from the block's end backwards, for each row where a
   batch from before may leave off, where batches go on in the next block, and how many begin in this one.
3. These tables are composed by doubling: after k rounds a block knows what 2^k blocks make of every entry. So where the first batch
   start of each block lies, and how many batches began before it, takes as many rounds as the logarithm of the blocks' number.
4. Each block numbers its rows from its own first batch start on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranksieve.functions.names import quoted
from ranksieve.sources.shared import written

#: Rows of a block, at least.
BLOCK_ROWS = 1 << 16


def _numbered(own: DataFrame) -> DataFrame:
    """g, o, t, and of each row the number of its group and its place in the group's order."""
    ranged = own.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange("g", "o", "t", "tie").sortWithinPartitions("g", "o", "t", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, place, last = -1, 0, object()
        for batch in batches:
            keys = batch.column(0)
            if not len(keys):
                continue
            said = keys.to_pylist()
            new = [group < 0 or said[0] != last, *(a != b for a, b in zip(said[1:], said, strict=False))]
            begins = np.flatnonzero(new)
            groups = np.zeros(len(keys), np.int64)
            groups[begins] = 1
            groups = group + np.cumsum(groups)
            since = np.zeros(len(keys), np.int64)
            since[begins] = begins
            since = np.maximum.accumulate(since)
            places = np.arange(len(keys)) - since
            places[groups == group] += place
            group, place, last = int(groups[-1]), int(places[-1]) + 1, said[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(groups), pa.array(places)], ["g", "o", "t", "group", "place"])

    kinds = [own.schema[k].dataType.simpleString() for k in ("g", "o")]
    part = written(ranged.mapInArrow(run, f"g {kinds[0]}, o {kinds[1]}, t long, group long, place long").withColumn("part", F.spark_partition_id()), "batch-rows")
    at = F.struct("group", "place")
    ends = [F.min_by(F.struct("g"), at)["g"].alias("first"), F.max_by(F.struct("g"), at)["g"].alias("last"), F.max(at).alias("end")]
    found = part.groupBy("part").agg(*ends).orderBy("part").collect()  # a row a part
    of, base, before, rows = {}, 0, None, 0
    for r in found:
        on = before is not None and before[0] == r["first"]  # the group of the part before goes on
        of[r["part"]] = (base - on, rows if on else 0)
        rows = r["end"]["place"] + 1 + (rows if on and r["end"]["group"] == 0 else 0)
        base, before = base - on + r["end"]["group"] + 1, (r["last"],)
    if not of:
        return part.drop("part")
    group, place = (F.element_at(F.split(F.lit(",".join(str(of.get(k, (0, 0))[i]) for k in range(max(of) + 1))), ",").cast("array<bigint>"), F.col("part") + 1) for i in (0, 1))
    return part.select("g", "o", "t", (F.col("group") + group).alias("group"), (F.col("place") + F.when(F.col("group") == 0, place).otherwise(0)).alias("place"))


def _next(tokens: np.ndarray, most: int, budget: int) -> np.ndarray:
    """For each row the first of the next batch, if one begins at it."""
    ends = np.cumsum(tokens)
    at = np.arange(len(tokens))
    full = np.searchsorted(ends, ends - tokens + budget, side="right")
    return np.maximum(at + 1, np.minimum(full, at + most))


def _blocks(rows: DataFrame, size: int, most: int, fn, schema: str) -> DataFrame:
    """``fn`` of each block's group, number and rows, with those behind it; its rows come in order."""
    own = rows.withColumn("block", F.floor(F.col("place") / size)).withColumn("behind", F.lit(False))
    ahead = own.where((F.col("block") > 0) & (F.col("place") % size < most)).withColumn("block", F.col("block") - 1).withColumn("behind", F.lit(True))
    order = own.union(ahead).repartition("group", "block").sortWithinPartitions("group", "block", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            group, block = (batch.column(k).to_numpy(zero_copy_only=False) for k in (batch.schema.get_field_index("group"), batch.schema.get_field_index("block")))
            edge = np.flatnonzero((group[1:] != group[:-1]) | (block[1:] != block[:-1])) + 1
            for lo, hi in zip([0, *edge], [*edge, len(group)], strict=True):
                if lo == hi:
                    continue
                now = (int(group[lo]), int(block[lo]))
                if now != key:
                    if held:
                        yield fn(*key, pa.Table.from_batches(held).combine_chunks())
                    key, held = now, []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield fn(*key, pa.Table.from_batches(held).combine_chunks())

    return order.mapInArrow(run, schema)


def _entries(tables: DataFrame) -> DataFrame:
    """group, block, entry, begun: each block's first batch start, and the batches that began before the block; by doubling."""
    now, reach = written(tables, "batch-tables"), 1
    longest = now.agg(F.max("block")).first()[0] or 0
    while reach <= longest:
        before = now.select("group", (F.col("block") + reach).alias("block"), F.col("exits").alias("e"), F.col("counts").alias("c"))

        def through(values: str) -> Column:
            return F.transform("e", lambda at: F.element_at(values, F.least(at + 1, F.size(values)).cast("int")))

        # of a block of the group's first ones all is known once the group's beginning is reached
        joined = now.join(before, ["group", "block"], "left")
        counts = F.zip_with("c", through("counts"), lambda a, b: a + b)
        now = written(joined.select("group", "block", F.when(F.col("e").isNull(), F.col("exits")).otherwise(through("exits")).alias("exits"), F.when(F.col("c").isNull(), F.col("counts")).otherwise(counts).alias("counts")), "batch-tables")
        reach *= 2
    ends = now.select("group", (F.col("block") + 1).alias("block"), F.element_at("exits", 1).alias("entry"), F.element_at("counts", 1).alias("begun"))
    return now.select("group", "block").join(ends, ["group", "block"], "left").select("group", "block", F.coalesce("entry", F.lit(0)).alias("entry"), F.coalesce("begun", F.lit(0)).cast("long").alias("begun"))


def greedy(rows: DataFrame, group: str, ord: str, tokens: str, most: int, budget: int) -> DataFrame:
    """group, ord, batch: a batch closes before the row that would exceed its count or its tokens; a larger row stands alone.

    No group passes one task: a task holds a block of BLOCK_ROWS rows, or ``most`` if that is more, and ``most`` behind it. Null
    tokens count as 0, and so do negative ones; rows of equal group, ord and tokens are interchangeable. A null group is one like others.
    """
    own = rows.select(F.col(quoted(group)).alias("g"), F.col(quoted(ord)).alias("o"), F.greatest(F.lit(0), F.coalesce(F.col(quoted(tokens)), F.lit(0))).cast("long").alias("t"))
    size, entries = max(BLOCK_ROWS, most), most
    numbered = _numbered(own)

    def table(number: int, block: int, held: pa.Table) -> pa.RecordBatch:
        behind = held.column("behind").to_numpy()
        n = int((~behind).sum())
        after = _next(held.column("t").to_numpy(), most, budget)
        # where the batches that begin at a row leave the block, and how many there are: from the end backwards
        exits, counts = after.tolist(), [1] * n
        for i in range(n - 1, -1, -1):
            if exits[i] < n:
                counts[i] += counts[exits[i]]
                exits[i] = exits[exits[i]]
        first = min(n, entries if block else 1)
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([block]), pa.array([[x - n for x in exits[:first]]], pa.list_(pa.int64())), pa.array([counts[:first]], pa.list_(pa.int64()))], ["group", "block", "exits", "counts"])

    found = _entries(_blocks(numbered.select("t", "group", "place"), size, most, table, "group long, block long, exits array<long>, counts array<long>"))

    def assign(number: int, block: int, held: pa.Table) -> pa.RecordBatch:
        own = held.filter(pc.invert(held.column("behind")))
        n, at = own.num_rows, int(own.column("entry")[0].as_py())
        after = _next(held.column("t").to_numpy(), most, budget)
        starts = np.zeros(n, np.int32)
        while at < n:
            starts[at] = 1
            at = int(after[at])
        batch = int(own.column("begun")[0].as_py()) - 1 + np.cumsum(starts, dtype=np.int64)
        return pa.RecordBatch.from_arrays([own.column("g").combine_chunks(), own.column("o").combine_chunks(), pa.array(batch.astype(np.int32))], ["g", "o", "batch"])

    kinds = [own.schema[k].dataType.simpleString() for k in ("g", "o")]
    told = numbered.withColumn("block", F.floor(F.col("place") / size)).join(found, ["group", "block"]).drop("block")
    out = _blocks(told, size, most, assign, f"g {kinds[0]}, o {kinds[1]}, batch int")
    return out.select(F.col("g").alias(group), F.col("o").alias(ord), "batch")


def backoff(attempt: Column, base: float, cap: float | None = None, jitter: Column | None = None) -> Column:
    wait = F.lit(base) * F.pow(F.lit(2.0), attempt)
    wait = wait if jitter is None else wait + jitter * base
    return wait if cap is None else F.least(wait, F.lit(cap))
