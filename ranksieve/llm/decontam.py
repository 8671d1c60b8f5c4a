"""Benchmark decontamination by winnowing.

Texts become words (``common.ALNUM`` after A-Z became a-z). Of every ``SPAN - GRAM + 1``
consecutive GRAM-word grams the one with the least hash is a fingerprint, so any shared run of
SPAN words has a fingerprint in common, at the same place in the run, whatever surrounds it.
Documents' fingerprints are joined with the benchmark's; each hit is extended to the SPAN-word
windows around it, and windows found in the benchmark (same hash, then the same bytes) mark their
words as hit. Items shorter than SPAN words are one window each; as winnowing cannot promise
those, all document grams of just those lengths are looked up.

Scale: a benchmark of at most BLOCK_BYTES of text and ids is indexed whole, in arrays of some four bytes
a byte, and broadcast; documents are not shuffled then. Beyond it, fingerprints and windows of the benchmark
are tables (``tables``). The documents are read once, beside a bit filter of the benchmark's hashes of
at most FILTER_BITS, which only lessens work; what passes it is joined with the windows by a digest of
their bytes. Only documents with such a window are shuffled. Keys that many documents share are dealt
over DEALT tasks; windows of the same items form a class, so a document meets the items of a class once.
The driver sees the filter and nothing else of a large benchmark.

Cases: null text or a text without words has no hits; an item without words matches nothing; the
words of an item with a null item_id are hit, but it cannot be named and is not counted among the
items; repeated items of one id count once; ties and repeated documents are judged each for itself;
an empty benchmark leaves all documents clean; columns of any name pass untouched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

SPAN = 10
GRAM = 5
#: Bytes of a benchmark whose index is broadcast; of a larger one, bytes of a part of an item.
BLOCK_BYTES = 8 << 20
#: Bits of the filter at most, 64 MB; a power of two.
FILTER_BITS = 1 << 29
#: A key of more than 1 / HOT of all rows is hot; its rows are dealt over DEALT tasks.
HOT, DEALT = 1024, 64
#: Windows of a benchmark that a task passes on at once.
SOME = 1 << 16

_WORDS = c.Words(c.ALNUM, fold=True)


def least(grams: np.ndarray, window: int = SPAN - GRAM + 1) -> np.ndarray:
    """For each run of ``window`` grams the place of its least hash, the last of equals."""
    n = len(grams) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, at = grams[:n].copy(), np.arange(n)
    for j in range(1, window):
        other = grams[j : j + n]
        better = other <= best
        best = np.where(better, other, best)
        at = np.where(better, np.arange(j, j + n), at)
    return at


def winnow(grams: np.ndarray) -> np.ndarray:
    """Places of fingerprints."""
    return np.unique(least(grams))


class Index:
    """Fingerprints and windows of a block of items (name or None, text), in arrays.

    ``text`` holds the block's words, each followed by a blank, ``word`` where each begins. ``windows`` has for every
    length in words the sorted hashes of the different windows, and beside each its first word and the class of its
    items; ``owners`` has the items of a class. So a window of many items is compared once.
    """

    def __init__(self, items: list[tuple[str | None, str]]):
        self.names = [name for name, _ in items]
        texts = [text.encode() for _, text in items]
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts, ends, hashes, bounds = _WORDS.table_of(data, np.concatenate([[0], np.cumsum([len(x) for x in texts], dtype=np.int64)]))
        end = np.cumsum(ends - starts + 1)
        self.word = np.append(0, end).astype(np.int32)
        text = np.full(self.word[-1], 32, np.uint8)
        inside = np.ones(len(text), bool)
        inside[end - 1] = False
        text[inside] = data[_WORDS.is_word[data]]
        self.text = text.tobytes().lower()
        count = np.diff(bounds)
        item = np.repeat(np.arange(len(items), dtype=np.int32), count)
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        self.prints = np.zeros(0, c.U64)
        self.owners: list[tuple[int, ...]] = [(i,) for i in range(len(items))]
        several: dict[tuple[int, ...], int] = {}
        for k in np.unique(np.minimum(count[count > 0], SPAN)).tolist():
            if k == SPAN:
                first = np.flatnonzero(item[: 1 - SPAN] == item[SPAN - 1 :])
                grams = c.windows(hashes, GRAM)
                self.prints = np.unique(grams[np.unique(least(grams)[first])])
            else:
                first = bounds[:-1][count == k]
            values, owner = _at(hashes, first, k), item[first]
            order = np.lexsort((owner, values))
            values, owner, first = values[order], owner[order], first[order]
            new = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1]))
            self.windows[k] = self._classes(values[new], first[new].astype(np.int32), owner[new], k, several)

    def _bytes(self, first: int, k: int) -> bytes:
        return self.text[self.word[first] : self.word[first + k] - 1]

    def _classes(self, values: np.ndarray, first: np.ndarray, owner: np.ndarray, k: int, several: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row a window: hash, first word, class of its items; ``several`` has the classes of more than one."""
        start = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        stop = np.append(start[1:], len(values))
        kind = owner[start].copy()
        more: list[tuple[int, int]] = []
        for g in np.flatnonzero(stop - start > 1).tolist():
            same: dict[bytes, list[int]] = {}
            for e in range(start[g], stop[g]):
                same.setdefault(self._bytes(first[e], k), []).append(e)
            for n, own in enumerate(same.values()):
                who = tuple(owner[own].tolist())
                if len(who) == 1:
                    at = who[0]
                else:
                    at = several.setdefault(who, len(self.owners))
                    if at == len(self.owners):
                        self.owners.append(who)
                if n == 0:
                    kind[g] = at
                else:  # one hash, other bytes
                    more.append((own[0], at))
        out = values[start], first[start], kind
        if more:
            own, at = (list(x) for x in zip(*more, strict=True))
            out = np.append(out[0], values[own]), np.append(out[1], first[own]), np.append(out[2], np.array(at, kind.dtype))
            order = np.argsort(out[0], kind="stable")
            out = tuple(x[order] for x in out)
        return out

    def search(self, raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, set[str]]:
        """Starts and lengths (in words) of windows of a document that items have, and those items' names."""
        n = len(hashes)
        at_all, len_all, kinds = [], [], set()
        for k, (known, first, kind) in self.windows.items():
            if n < k:
                continue
            if k == SPAN:
                tries = _extended(hashes, lambda x: _among(x, self.prints))
                if not len(tries):
                    continue
                values = _at(hashes, tries, k)
            else:
                values = c.windows(hashes, k)
                tries = np.arange(len(values))
            lo, hi = np.searchsorted(known, values, "left"), np.searchsorted(known, values, "right")
            for i, a, b in zip(*(x[lo < hi].tolist() for x in (tries, lo, hi)), strict=True):
                own = b" ".join(raw[s:e] for s, e in zip(starts[i : i + k].tolist(), ends[i : i + k].tolist(), strict=True))
                for e in range(a, b):  # one, but for windows of the same hash
                    if self._bytes(first[e], k) == own:
                        at_all.append(i)
                        len_all.append(k)
                        kinds.add(int(kind[e]))
        names = {self.names[o] for x in kinds for o in self.owners[x]}
        return np.array(at_all, np.int64), np.array(len_all, np.int64), names - {None}


def _at(hashes: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """``common.windows`` at some places only."""
    with np.errstate(over="ignore"):
        out = np.full(len(places), k, c.U64)
        for j in range(k):
            out = out * c.U64(c._BASE) + hashes[places + j]
        return c.mix(out)


def _extended(hashes: np.ndarray, known: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """First words of the windows around fingerprints that are known."""
    grams = c.windows(hashes, GRAM)
    places = winnow(grams)
    places = places[known(grams[places])]
    tries = np.unique((places[:, None] - np.arange(SPAN - GRAM + 1)).ravel())
    return tries[(tries >= 0) & (tries <= len(hashes) - SPAN)]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    return known[np.minimum(at, len(known) - 1)] == values


def _parts(text: str, limit: int) -> Iterator[str]:
    """A text, or parts of it of about ``limit`` bytes that have every window of SPAN words in one of them."""
    data = text.encode()
    if len(data) <= limit:
        yield text
        return
    starts, ends = _WORDS.spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    i = 0
    while i < len(starts):
        j = max(i + SPAN, int(np.searchsorted(ends, starts[i] + limit, side="right")))
        j = len(starts) if len(starts) - j < SPAN else j
        yield data[starts[i] : ends[j - 1]].decode()
        i = j - SPAN + 1 if j < len(starts) else j


def _items(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """Items with a text, as i and t."""
    return benchmark.select(F.col(c.quoted(item_id)).cast("string").alias("i"), F.col(c.quoted(text)).alias("t")).where("t <> ''")


def _whole_index(items: DataFrame) -> Index:
    """The index of a benchmark whose size was checked."""
    return Index([(row["i"], row["t"]) for row in items.toLocalIterator()])


def scan(batch_text: pa.Array, index: Index) -> list[tuple[int, np.ndarray, set[str]]]:
    """For each row: its number of words, merged hit spans as rows (start, end) in words, item ids."""
    data, offs = c.text_bytes(batch_text)
    out = []
    for i, j in c.groups(offs):
        part = data[offs[i] : offs[j]]
        starts, ends, hashes, bounds = _WORDS.table_of(part, offs[i : j + 1] - offs[i])
        raw = None
        for d in range(j - i):
            a, b = bounds[d], bounds[d + 1]
            raw = part.tobytes().lower() if raw is None else raw
            at, length, items = index.search(raw, starts[a:b], ends[a:b], hashes[a:b])
            out.append((int(b - a), merge(at, at + length), items))
    return out


def merge(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Disjoint spans that cover the same words."""
    if not len(lo):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    first = np.concatenate([[True], lo[1:] > hi[:-1]])
    last = np.concatenate([first[1:], [True]])
    return np.stack([lo[first], hi[last]], 1)


_STATE = "struct<n_words:long,spans:array<struct<start:long,end:long>>,items:array<string>>"


_KIND = pa.struct([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])


def _schema(docs: DataFrame) -> str:
    return ", ".join(f"{c.quoted(f.name)} {f.dataType.simpleString()}" for f in docs.schema)


def _mark(docs: DataFrame, text: str, index: Index, hits: str) -> DataFrame:
    """All columns of docs and ``hits``."""
    shared = docs.sparkSession.sparkContext.broadcast(index)
    at, names = docs.columns.index(text), docs.columns

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            {"n_words": n, "spans": [{"start": int(a), "end": int(b)} for a, b in spans], "items": sorted(items)}
            for n, spans, items in scan(batch.column(at), shared.value)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _KIND)], [*names, hits])

    return c.map_batches(docs, run, f"{_schema(docs)}, {c.quoted(hits)} {_STATE}")


# ---------------------------------------------------------------- a benchmark of any size, as tables
def _digest(raw: bytes, starts: list[int], ends: list[int]) -> bytes:
    return hashlib.blake2b(b" ".join(raw[s:e] for s, e in zip(starts, ends, strict=True)), digest_size=16).digest()


def tables(items: DataFrame, part_bytes: int) -> DataFrame:
    """Rows of a benchmark: hashes of fingerprints (no key), and windows with hash, length k, digest of their bytes and item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                for part in _parts(text.as_py(), part_bytes):
                    raw = part.encode()
                    data = np.frombuffer(raw, np.uint8)
                    starts, ends, hashes, _ = _WORDS.table_of(data, np.array([0, len(data)]))
                    raw, n = raw.lower(), len(hashes)
                    if not n:
                        continue
                    k = min(n, SPAN)
                    if k == SPAN:
                        grams = c.windows(hashes, GRAM)
                        prints = np.unique(grams[winnow(grams)]).view(np.int64)
                        none = [pa.nulls(len(prints), t) for t in (pa.int32(), pa.binary(), pa.string())]
                        yield pa.RecordBatch.from_arrays([pa.array(prints), *none], ["hash", "k", "key", "item"])
                    values = c.windows(hashes, k).view(np.int64)
                    for at in range(0, len(values), SOME):
                        end = min(len(values), at + SOME)
                        lo, hi = starts[at : end + k - 1].tolist(), ends[at : end + k - 1].tolist()
                        keys = [_digest(raw, lo[j : j + k], hi[j : j + k]) for j in range(end - at)]
                        cols = [pa.array(values[at:end]), pa.array([k] * len(keys), pa.int32()), pa.array(keys, pa.binary()), pa.array([name.as_py()] * len(keys), pa.string())]
                        yield pa.RecordBatch.from_arrays(cols, ["hash", "k", "key", "item"])
        c.give_back()

    return items.mapInArrow(run, "hash long, k int, key binary, item string")


def _places(values: np.ndarray, bits: int) -> list[np.ndarray]:
    return [((values >> c.U64(s)) & c.U64(bits - 1)).astype(np.int64) for s in (0, 17, 35)]


def _filter(rows: DataFrame) -> np.ndarray:
    """Bits of all hashes, some 24 a hash and FILTER_BITS at most, in 64-bit words."""
    n = rows.select(F.approx_count_distinct("hash")).first()[0]
    bits = min(FILTER_BITS, 1 << max(16, (24 * n - 1).bit_length()))
    three = F.array(*(F.shiftrightunsigned("hash", s).bitwiseAND(F.lit(bits - 1)) for s in (0, 17, 35)))
    place = rows.select(F.explode(three).alias("p"))
    one = F.expr("shiftleft(1L, cast(p & 63 as int))")
    found = place.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("b")).toArrow()
    out = np.zeros(bits // 64, c.U64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().view(c.U64)
    return out


def _passes(values: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether all bits of a hash are set."""
    ok = np.ones(len(values), bool)
    for p in _places(values, len(words) * 64):
        ok &= (words[p >> 6] >> (p & 63).astype(c.U64)) & c.U64(1) == 1
    return ok


def _tries(docs: DataFrame, text: str, words: np.ndarray, lengths: list[int], name: str, kept: list[str]) -> DataFrame:
    """Columns ``kept`` of docs and ``name``: n_words, and the windows that pass the filter, each once, with its first words."""
    shared = docs.sparkSession.sparkContext.broadcast(words)
    at = docs.columns.index(text)
    kind = pa.struct([("n_words", pa.int64()), ("tries", pa.list_(pa.struct([("key", pa.binary()), ("k", pa.int32()), ("at", pa.list_(pa.int64()))])))])

    def tried(raw: bytes, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> list[dict]:
        found: dict[tuple[bytes, int], list[int]] = {}
        for k in lengths:
            if len(hashes) < k:
                continue
            if k == SPAN:
                places = _extended(hashes, lambda x: _passes(x, shared.value))
                values = _at(hashes, places, k)
            else:
                values = c.windows(hashes, k)
                places = np.arange(len(values))
            for i in places[_passes(values, shared.value)].tolist():
                found.setdefault((_digest(raw, starts[i : i + k].tolist(), ends[i : i + k].tolist()), k), []).append(i)
        return [{"key": key, "k": k, "at": i} for (key, k), i in found.items()]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offs = c.text_bytes(batch.column(at))
        rows = []
        for i, j in c.groups(offs):
            part = data[offs[i] : offs[j]]
            starts, ends, hashes, bounds = _WORDS.table_of(part, offs[i : j + 1] - offs[i])
            raw = part.tobytes().lower()
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                rows.append({"n_words": b - a, "tries": tried(raw, starts[a:b], ends[a:b], hashes[a:b])})
        return pa.RecordBatch.from_arrays([*(batch.column(x) for x in kept), pa.array(rows, kind)], [*kept, name])

    state = "struct<n_words:long,tries:array<struct<key:binary,k:int,at:array<long>>>>"
    own = docs.select(*map(c.quoted, kept))
    return c.map_batches(docs, run, ", ".join(filter(None, [_schema(own), f"{c.quoted(name)} {state}"])))


def _meet(left: DataFrame, right: DataFrame, key: str, by: str) -> DataFrame:
    """Inner join in which rows of hot keys of the left side are dealt over tasks by ``by``, with the right side's rows for each.

    Fewer than HOT keys can be hot, so their list is broadcast.
    """
    total = left.count()
    hot = F.broadcast(left.groupBy(key).count().where(F.col("count") * HOT > total).select(key, F.lit(True).alias("hot")))
    deal = F.when(F.col("hot"), F.pmod(F.xxhash64(by), F.lit(DEALT))).otherwise(F.lit(0)).cast("int")
    every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(DEALT - 1))).otherwise(F.array(F.lit(0)))
    dealt = left.join(hot, key, "left").withColumn("deal", deal).drop("hot")
    copies = right.join(hot, key, "left").withColumn("deal", F.explode(every)).drop("hot")
    return dealt.join(copies, [key, "deal"]).drop("deal")


def _joined(docs: DataFrame, items: DataFrame, text: str, hits: str, total: int, part_bytes: int, with_text: bool) -> DataFrame:
    """All columns of docs (text too, if ``with_text``) and ``hits``, by joins."""
    rows = c.Stage(tables(items.repartition(-(-total // part_bytes)), part_bytes), "benchmark").df
    lengths = sorted(r["k"] for r in rows.where("k is not null").select("k").distinct().collect())
    kept = [x for x in docs.columns if with_text or x != text]
    uid, state = c.free_names(docs, "row", "tries")
    marked = c.Stage(_tries(docs, text, _filter(rows), lengths, state, kept).withColumn(uid, F.monotonically_increasing_id()), "decontam").df
    none = F.size(f"{state}.tries") == 0
    tries = marked.where(~none).select(F.col(uid).alias("uid"), F.explode(f"{state}.tries").alias("t")).select("uid", "t.*")

    owned = rows.where("k is not null").select("key", "item").join(tries.select("key").distinct(), "key", "left_semi").distinct()
    kind = F.concat_ws(":", F.count("item"), F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64("item"))), F.bit_xor(F.when(F.col("item").isNotNull(), F.xxhash64(F.lit(1), "item"))))
    owned = c.Stage(owned, "owned").df
    known = c.Stage(owned.groupBy("key").agg(kind.alias("kind")), "windows").df
    found = c.Stage(_meet(tries, known, "key", "uid"), "found").df
    spans = found.groupBy("uid").agg(F.collect_list(F.struct("k", "at")).alias("found"))
    one = known.groupBy("kind").agg(F.min("key").alias("key"))
    names = c.Stage(owned.where("item is not null").join(one, "key").select("kind", "item"), "names").df
    named = _meet(found.select("uid", "kind").distinct(), names, "kind", "uid").select("uid", "item").distinct()
    named = named.groupBy("uid").agg(F.sort_array(F.collect_set("item")).alias("items"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for had in batch.column("found").to_pylist():
            lo = np.array([i for x in had for i in x["at"]], np.int64)
            k = np.array([x["k"] for x in had for _ in x["at"]], np.int64)
            out.append([{"start": int(a), "end": int(b)} for a, b in merge(lo, lo + k)])
        return pa.RecordBatch.from_arrays([batch.column("uid"), pa.array(out, _KIND.field("spans").type)], ["uid", "spans"])

    spans = c.map_batches(spans, run, "uid long, spans array<struct<start:long,end:long>>")
    told = spans.join(named, "uid", "left").select(F.col("uid").alias(uid), F.struct("spans", "items").alias(hits))
    columns = [F.col(c.quoted(x)) for x in kept]
    kinds = {"spans": "array<struct<start:long,end:long>>", "items": "array<string>"}

    def hit(value) -> list:
        had = {x: F.coalesce(value[x], F.array().cast(kind)) if value is not None else F.array().cast(kind) for x, kind in kinds.items()}
        return [*columns, F.struct(F.col(f"{state}.n_words").alias("n_words"), *(v.alias(x) for x, v in had.items())).alias(hits)]

    met = marked.where(~none).join(told, uid, "left")
    return marked.where(none).select(*hit(None)).unionByName(met.select(*hit(F.col(hits))))


def find(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES, with_text: bool = True) -> tuple[DataFrame, str]:
    """All columns of docs (the text only if asked for) and one more, whose name is returned: n_words, spans of hit words, item ids sorted as strings."""
    (hits,) = c.free_names(docs, "hits")
    items = _items(benchmark, item_id, item_text)
    total = items.agg(F.sum(F.octet_length("t") + F.coalesce(F.octet_length("i"), F.lit(0)))).first()[0] or 0
    if total > block_bytes:
        return _joined(docs, items, text, hits, total, block_bytes, with_text), hits
    out = _mark(docs, text, _whole_index(items), hits)
    return (out if with_text else out.drop(text)), hits


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items, spans, contaminated for each document."""
    found, hits = find(docs.select(F.col(c.quoted(id_col)).alias("doc_id"), F.col(c.quoted(text)).alias("text")), benchmark, block_bytes=block_bytes, with_text=False)
    n_hit = F.aggregate(f"{hits}.spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return found.select(
        "doc_id", F.col(f"{hits}.n_words").alias("n_words"), n_hit.alias("n_hit"), F.size(f"{hits}.items").cast("long").alias("n_items"),
        F.col(f"{hits}.items").alias("items"), F.col(f"{hits}.spans").alias("spans"), (n_hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents without a hit, with all their columns."""
    found, hits = find(docs, benchmark, text, block_bytes=block_bytes)
    return found.where(F.size(f"{hits}.spans") == 0).drop(hits)


def brute(doc: str | None, items: list[tuple[object, str | None]]) -> dict:
    """The same result for one document by comparing all windows as words; for tests."""
    import re

    def words(t):
        low = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    own, hit, ids = words(doc), set(), set()
    for item_id, t in items:
        w = words(t)
        k = min(SPAN, len(w))
        grams = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if k else set()
        for i in range(len(own) - k + 1) if k else ():
            if tuple(own[i : i + k]) in grams:
                hit.update(range(i, i + k))
                ids |= set() if item_id is None else {str(item_id)}
    return {"n_words": len(own), "n_hit": len(hit), "n_items": len(ids), "items_sha256": hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), "contaminated": bool(hit)}
