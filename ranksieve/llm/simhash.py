"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has 64 bits; bit k is 1 if it is set in over half of the XXH64 hashes of the text's WIDTH-word
shingles, repeats included. Fingerprints that differ in at most ``threshold`` (2) bits are linked.

Anchors are the words of a covering code: bits 0-22 and 23-45 are each covered by the perfect Golay code (4096 words, every
value within 3 bits of exactly one), so the pair of codes has 2^24 anchors. A fingerprint is at home at the anchor within the
covering radius of each block, and is posted to every anchor within the radius plus the threshold, the excess over the
radius being counted over both blocks. Of a pair within the threshold, the one meets the other at the other's home, as a
distance grows by no more than the bits that differ. At each anchor those at home are compared with all that are posted there, on all 64 bits.

1. Equal fingerprints become one, so copies are never compared.
2. A fingerprint has some 61 posts. Anchors of more than CROWD posts get a third block, bits 46-63, covered by the Hamming code
   of 15 bits and 3 bits as they are: their posts go on to its 2^14 anchors, within what is left of the threshold.
   Cells where more than CROWD are at home after that are dealt over several tasks: those at home by a hash, visitors to each.
3. A task holds those at home at one cell; visitors stream by. It emits a forest over what it finds linked, not pairs: one link
   a visitor at most, and one for each that is at home.
4. Components come from label propagation over the links. Nothing but counts goes to the driver.

Cases: null, empty and blank texts have the fingerprint 0 and are linked like any other; texts of fewer than WIDTH words are
one shingle; very long texts are read in slices; repeated rows share a fingerprint; a null id takes part and gets its group's
component (null if no id of the group is known); an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c
from .minhash import components

WIDTH, SEED = 3, 42
#: Differing bits of linked fingerprints; what the codes below are laid out for.
THRESHOLD = 2
#: Posts of an anchor, or fingerprints at home at a cell, that are not split.
CROWD = 4096
#: Comparisons that are made in one go.
BLOCK = 1 << 21
#: Rows that are broadcast at most, of two longs.
BROADCAST_ROWS = 200_000
#: Part of all rows that copies of a fingerprint may be before its rows are joined apart; fewer than 1/HOT are.
HOT = 0.001


# ---------------------------------------------------------------- fingerprints
def _ones(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit."""
    return np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(raw: bytes) -> int:
    """Of a text's UTF-8 bytes, A-Z taken as a-z."""
    count, total, held = np.zeros(64, np.int64), 0, []
    for words in c.sliced_words(raw.lower()):
        held += words
        for at in range(0, len(held) - WIDTH + 1, 1 << 16):
            part = held[at : at + (1 << 16) + WIDTH - 1]
            line = b" ".join(part)
            ends = np.cumsum([len(w) + 1 for w in part]) - 1
            starts = np.concatenate([[0], ends[:-1] + 1])
            hashes = [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[: len(part) - WIDTH + 1].tolist(), ends[WIDTH - 1 :].tolist(), strict=True)]
            count += _ones(hashes)
            total += len(hashes)
        if len(held) >= WIDTH:
            held = held[-(WIDTH - 1) :]
    if not total and held:
        count, total = _ones([xxhash.xxh64_intdigest(b" ".join(held), SEED)]), 1
    return int.from_bytes(np.packbits(2 * count > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp, the fingerprint's 64 bits as a long."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offs = c.text_bytes(batch.column(1))
        found = np.array([fingerprint(data[offs[d] : offs[d + 1]].tobytes()) for d in range(batch.num_rows)], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    ids = docs.schema[id_col].dataType.simpleString()
    return c.map_batches(docs.select(F.col(c.quoted(id_col)).alias("doc_id"), F.col(c.quoted(text)).alias("text")), run, f"doc_id {ids}, fp long")


# ---------------------------------------------------------------- anchors
class Code:
    """A cyclic code of ``n`` bits beside ``free`` bits that stand for themselves; ``radius``: its covering radius.

    A value has the anchors value ^ e for all errors e of its syndrome; they are in order of their excess, the
    bits of e beyond the radius, ``upto[s, x]`` being how many of syndrome s have an excess of at most x.
    """

    def __init__(self, n: int, generator: int, radius: int, free: int = 0):
        self.n, self.check = n, generator.bit_length() - 1
        single = []
        for k in range(n):
            rest = 1 << k
            while rest.bit_length() > self.check:
                rest ^= generator << (rest.bit_length() - generator.bit_length())
            single.append(rest)
        size = 1 << self.check
        errors: list[list[tuple[int, int]]] = [[] for _ in range(size)]
        for weight in range(radius + THRESHOLD + 1):
            for bits in combinations(range(n), weight):
                syndrome = 0
                for k in bits:
                    syndrome ^= single[k]
                excess = max(0, weight - radius)
                own = sum(1 << k for k in bits)
                for more in range(min(free, THRESHOLD - excess) + 1):
                    errors[syndrome] += [(excess + more, own | sum(1 << (n + k) for k in rest)) for rest in combinations(range(free), more)]
        self.upto = np.array([[sum(x <= limit for x, _ in e) for limit in range(THRESHOLD + 1)] for e in errors], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.upto[:, -1])])[:-1]
        ordered = [p for e in errors for p in sorted(e)]
        self.errors, self.excess = np.array([e for _, e in ordered], np.int64), np.array([x for x, _ in ordered], np.int64)
        self.low = np.zeros(1 << 12, np.int64)
        self.high = np.zeros(1 << max(0, n - 12), np.int64)
        for k, s in enumerate(single):
            table, bit = (self.low, k) if k < 12 else (self.high, k - 12)
            table ^= np.where(np.arange(len(table)) >> bit & 1, s, 0)

    def anchors(self, value: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, anchor (its information bits) and excess of all anchors of the values, of an excess of at most ``left``."""
        syndrome = self.low[value & 0xFFF] ^ self.high[value >> 12 & ((1 << self.n - 12) - 1)]
        many = self.upto[syndrome, left]
        row = np.repeat(np.arange(len(value)), many)
        at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + self.first[syndrome][row]
        return row, (value[row] ^ self.errors[at]) >> self.check, self.excess[at]


@lru_cache(maxsize=1)
def _codes() -> tuple[Code, Code]:
    """The Golay code of 23 bits, and the Hamming code of 15 bits beside three bits."""
    return Code(23, 0b101011100011, 3), Code(15, 0b10011, 1, 3)


def _posts(fps: DataFrame) -> DataFrame:
    """anchor, fp, left (what is left of the threshold) and home of all fingerprints."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        golay, _ = _codes()
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        out = []
        for at in range(0, len(fp), 1 << 13):
            part = fp[at : at + (1 << 13)]
            row, one, used = golay.anchors(part & 0x7FFFFF, np.full(len(part), THRESHOLD))
            again, two, more = golay.anchors(part[row] >> 23 & 0x7FFFFF, THRESHOLD - used)
            left = THRESHOLD - used[again] - more
            own = part[row][again]
            # at home are those within the radius of both blocks: perfect codes have one such anchor
            out.append((one[again] << 12 | two, own, left))
        anchor, own, left = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(anchor.astype(np.int32)), pa.array(own), pa.array(left.astype(np.int8))], ["anchor", "fp", "left"])

    return c.map_batches(fps.select("fp"), run, "anchor int, fp long, left byte").withColumn("home", F.col("left") == THRESHOLD)


def _finer(posts: DataFrame) -> DataFrame:
    """Posts of crowded anchors, at the anchors of the third block."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, hamming = _codes()
        anchor, fp, left = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        row, cell, used = hamming.anchors(fp >> 46 & 0x3FFFF, left.astype(np.int64))
        rest = left[row] - used
        return pa.RecordBatch.from_arrays([pa.array(anchor[row]), pa.array(cell.astype(np.int32)), pa.array(fp[row]), pa.array(rest == THRESHOLD)], ["anchor", "cell", "fp", "home"])

    return c.map_batches(posts.select("anchor", "fp", "left"), run, "anchor int, cell int, fp long, home boolean")


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if c.sizes_within(df, BROADCAST_ROWS) else df


def _cells(fps: DataFrame) -> DataFrame:
    """anchor, cell, part, fp, home: what each task compares."""
    posts = _posts(fps)
    crowded = c.Stage(posts.groupBy("anchor").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > CROWD).select("anchor"), "simhash-crowded").df
    if not crowded.limit(1).count():
        return posts.select("anchor", F.lit(-1).alias("cell"), F.lit(0).alias("part"), "fp", "home")
    small = _small(crowded)
    plain = posts.join(small, "anchor", "left_anti").select("anchor", F.lit(-1).alias("cell"), F.lit(0).alias("part"), "fp", "home")
    finer = _finer(posts.join(small, "anchor", "left_semi"))
    at_home = finer.where("home").groupBy("anchor", "cell").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > CROWD)
    dealt = c.Stage(at_home.select("anchor", "cell", F.ceil(F.col("k") / CROWD).cast("int").alias("parts")), "simhash-cells").df
    finer = finer.join(_small(dealt), ["anchor", "cell"], "left")
    parts = F.coalesce("parts", F.lit(1))
    everywhere = F.sequence(F.lit(0), parts - 1)
    mine = F.pmod(F.xxhash64("fp"), parts).cast("int")
    # one at home is a visitor to the other parts
    finer = finer.withColumn("part", F.explode(everywhere)).select("anchor", "cell", "part", "fp", (F.col("home") & (F.col("part") == mine)).alias("home"))
    return plain.unionByName(finer)


# ---------------------------------------------------------------- comparing
class _Cell:
    """Fingerprints at home at one cell, and how visitors link them."""

    def __init__(self, homes: np.ndarray):
        self.homes, self.label = homes, np.arange(len(homes))

    def visit(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Links (visitor, at home), one for each visitor that is linked; what else it is linked with is joined here."""
        out = []
        step = max(1, BLOCK // max(1, len(self.homes)))
        for at in range(0, len(fps), step):
            part = fps[at : at + step]
            near = np.bitwise_count((part[:, None] ^ self.homes[None, :]).view(np.uint64)) <= THRESHOLD
            v, h = np.nonzero(near)
            if not len(v):
                continue
            first = np.concatenate([[True], v[1:] != v[:-1]])
            out.append((part[v[first]], self.homes[h[first]]))
            self._join(v, h)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 2

    def _join(self, v: np.ndarray, h: np.ndarray) -> None:
        """Gives homes that share a visitor the same label, the least."""
        begins = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
        sizes = np.diff(np.concatenate([begins, [len(v)]]))
        while True:
            least = np.repeat(np.minimum.reduceat(self.label[h], begins), sizes)
            if (least == self.label[h]).all():
                return
            np.minimum.at(self.label, self.label[h], least)
            while not np.array_equal(down := self.label[self.label], self.label):
                self.label = down

    def forest(self) -> tuple[np.ndarray, np.ndarray]:
        other = np.flatnonzero(self.label != np.arange(len(self.label)))
        return self.homes[other], self.homes[self.label[other]]


def _compare(cells: DataFrame) -> DataFrame:
    """Links (a, b) of fingerprints; within a cell those at home come first."""
    dealt = cells.repartition("anchor", "cell", "part").sortWithinPartitions("anchor", "cell", "part", F.desc("home"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, homes, cell, found = None, [], None, []

        def settle() -> _Cell:
            own = _Cell(np.concatenate(homes))
            own.visit(own.homes)
            return own

        def close() -> None:
            nonlocal homes, cell
            if cell is None and sum(map(len, homes)) > 1:  # nobody visited
                cell = settle()
            if cell is not None:
                found.append(cell.forest())
            homes, cell = [], None

        def given() -> pa.RecordBatch:
            a, b = (pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in (zip(*found, strict=True) if found else ((), ())))
            found.clear()
            return pa.RecordBatch.from_arrays([a, b], ["a", "b"])

        for batch in batches:
            anchor, sub, part, fp, home = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(5))
            if not len(fp):
                continue
            new = (anchor[1:] != anchor[:-1]) | (sub[1:] != sub[:-1]) | (part[1:] != part[:-1])
            begins = np.flatnonzero(np.concatenate([[True], new]))
            ends = np.concatenate([begins[1:], [len(fp)]])
            some = home[begins] & (ends - begins > 1)  # cells with one at home, and another one
            some[0] = some[-1] = True  # they may go on from the batch before, or in the next
            for g in np.flatnonzero(some).tolist():
                lo, hi = int(begins[g]), int(ends[g])
                now = (int(anchor[lo]), int(sub[lo]), int(part[lo]))
                if now != key:
                    close()
                    key = now
                middle = lo + int(home[lo:hi].sum())
                if middle > lo:
                    homes.append(fp[lo:middle])
                if middle < hi and homes:
                    cell = cell or settle()
                    found.append(cell.visit(fp[middle:hi]))
            yield given()
        close()
        yield given()
        c.give_back()

    return dealt.mapInArrow(run, "a long, b long").distinct()


def links(fps: DataFrame) -> DataFrame:
    """Links (a, b) of the distinct fingerprints fp: a forest whose components are those of all pairs within the threshold."""
    return c.Stage(_compare(_cells(fps)), "simhash-links").df


def hex_digits(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest id reachable): a row for each document."""
    rows = c.Stage(fingerprints(docs, id_col, text), "simhash-rows").df
    nodes = c.Stage(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")), "simhash-nodes").df
    label = components(links(nodes))
    named = nodes.join(label.select(F.col("node").alias("fp"), "label"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = named.groupBy("label").agg(F.min("rep").alias("component_id"))
    of = c.Stage(named.join(least, "label").select("fp", "copies", "component_id"), "simhash-groups").df
    total = of.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    many = F.col("copies") > HOT * total
    hot = F.broadcast(of.where(many))  # fewer than 1/HOT
    out = rows.join(hot, "fp", "left_anti").join(of.where(~many), "fp").unionByName(rows.join(hot, "fp"))
    return out.select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id")
