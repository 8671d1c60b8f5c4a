"""Periodic runs of words, by Lyndon arrays over ordered alphabets that reuse matched extensions.

A run is a maximal stretch of words of smallest period q and at least two periods. By the runs theorem it holds, for
one of the two orders of an alphabet, a longest Lyndon word of length q that begins at each of its roots, so the
candidates of a text are its positions i with their next smaller suffix nss(i): period nss(i) - i. The method has no
suffix array or tree and no hashes: words are numbered as they first occur, and only such numbers are compared.

``edges`` makes nss from right to left. It walks i+1, nss(i+1), ... and carries the common extension of i with each,
which most often follows from the two that are known: it is the smaller one of unequal ones, and only equal ones are
extended by comparing words. Such a comparison stops where it comes to a pair that was matched before, a position with
its next or previous smaller suffix, and takes over that pair's extension. A run is extended to the left from its first
root only, by less than a period.

Two or three comparisons a word do for random, natural and periodic texts of any length. Words that are built by recursion
(Fibonacci, Thue-Morse, nested squares) take some 0.4 more for each doubling of the length, 9 at 100,000 words: this form
of reuse is simpler than one that never looks at a word twice, and that is what it costs. Tests hold it to 3 + log2(n) / 2.

Before that, ``stretches`` narrows a text exactly: in a run of q >= 3, or of 12 words, every three consecutive words but at most
two in a row occur again in the run, so runs lie in stretches where triples of words repeat, which are looked for
again within the stretch. Where none is long enough, a text needs no Lyndon array.

Cases: null, empty and blank texts have no words and no runs (counts 0, digests of empty strings, the longest run
null); texts of any length are split in slices and hold some 30 bytes a word; repeated rows are reported each; a null
id is passed on; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import hashlib
from array import array
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Shortest run that is reported, in words.
LEAST = 12

Run = tuple[int, int, int]


def edges(v: array) -> tuple[array, array, int]:
    """Next smaller suffix of each position (the length, if none), the common extension with it, and how many words were compared."""
    n, compared = len(v), 0
    nss, reach = array("i", [n]) * (n + 1), array("i", [0]) * (n + 1)
    pss, back = array("i", [-1]) * (n + 1), array("i", [0]) * (n + 1)

    def extend(i: int, j: int, k: int) -> int:
        nonlocal compared
        while j + k < n:
            if k:
                if nss[i + k] == j + k:
                    return k + reach[i + k]
                if pss[j + k] == i + k:
                    return k + back[j + k]
            compared += 1
            if v[i + k] != v[j + k]:
                break
            k += 1
        return k

    for i in range(n - 2, -1, -1):
        j = i + 1
        same = extend(i, j, 0)
        while True:
            at = j + same
            if at >= n or v[at] < v[i + same]:
                nss[i], reach[i] = j, same
                break
            pss[j], back[j] = i, same
            known, j = reach[j], nss[j]
            if j == n:
                break
            if same == known:
                same = extend(i, j, same)
            elif same > known:
                same = known
    return nss, reach, compared


def _of_order(v: array, least: int, out: set[Run]) -> None:
    """Adds the runs whose roots are Lyndon words of this order."""
    n = len(v)
    nss, reach, _ = edges(v)
    for i in range(n):
        right = reach[i]
        if not right:
            continue
        j = nss[i]
        p = j - i
        need = max(p - right, least - p - right, 0)
        if need >= p or need > i or (i >= p and nss[i - p] == i and reach[i - p] >= p):
            continue  # too short, or not the run's first root
        if v[i - need : i] != v[j - need : j]:
            continue
        left = need
        while left < p and i > left and v[i - 1 - left] == v[j - 1 - left]:
            left += 1
        if left < p:
            out.add((i - left, left + p + right, p))


def runs(ids, least: int = LEAST) -> list[Run]:
    """start, length and period of all runs of at least ``least`` words, by start, then period."""
    out: set[Run] = set()
    v = array("i", ids)
    _of_order(v, least, out)
    _of_order(array("i", [-x for x in v]), least, out)
    return sorted(out)


def _ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (a, b), the same for equal ones; a and b are below 2**31."""
    return np.unique((a << 31) | b, return_inverse=True)[1].astype(np.int64)


def stretches(ids: np.ndarray, texts: np.ndarray, least: int = LEAST) -> list[tuple[int, int]]:
    """Bounds of the stretches of words that can hold a run; ``texts``: the text of each word, in order."""
    if least < LEAST:  # each text whole
        cut = [0, *(np.flatnonzero(np.diff(texts)) + 1).tolist(), len(ids)]
        return [(a, b) for a, b in zip(cut, cut[1:], strict=False) if a < b]
    if len(ids) < least:
        return []
    triples = _ranks(_ranks(ids[:-2], ids[1:-1]), ids[2:])
    at = np.flatnonzero(texts[2:] == texts[:-2])
    part, triples = texts[at].astype(np.int64), triples[at]
    while len(at):
        _, which, often = np.unique((part << 31) | triples, return_inverse=True, return_counts=True)
        good = np.flatnonzero(often[which] > 1)
        if not len(good):
            return []
        # what is at most two apart, in the same part, belongs together
        begins = np.flatnonzero(np.concatenate([[True], (np.diff(at[good]) > 3) | (np.diff(part[good]) != 0)]))
        first, last = good[begins], good[np.concatenate([begins[1:], [len(good)]]) - 1]
        long = at[last] - at[first] >= least - 3
        first, last = first[long], last[long]
        sizes = last - first + 1
        total = int(sizes.sum())
        if not total or 10 * total > 9 * len(at):
            return [(int(at[a]), int(at[b]) + 3) for a, b in zip(first, last, strict=True)]
        inside = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(total)
        at, triples, part = at[inside], triples[inside], np.repeat(np.arange(len(first)), sizes)
    return []


def _numbered(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Numbers of the words of all rows, n+1 bounds of each row's words, and the texts' bytes."""
    known: dict[bytes, int] = {}
    parts, bounds, raws = [], [0], []
    for d in range(len(offs) - 1):
        raw = data[offs[d] : offs[d + 1]].tobytes()
        size = 0
        for words in c.sliced_words(raw):
            parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words)))
            size += len(words)
        bounds.append(bounds[-1] + size)
        raws.append(raw)
    return np.concatenate(parts) if parts else np.zeros(0, np.int64), np.array(bounds), raws


def collapsed(raw: bytes, n: int, found: list[Run]):
    """The text's words, one space between, without what runs repeat: their words after the first period. In pieces."""
    keep = None
    if found:
        edge = np.zeros(n + 1, np.int32)
        for start, length, period in found:
            edge[start + period] += 1
            edge[start + length] -= 1
        keep = np.cumsum(edge[:-1]) == 0
    at, some = 0, False
    for words in c.sliced_words(raw):
        kept = words if keep is None else list(compress(words, keep[at : at + len(words)]))
        at += len(words)
        if kept:
            yield (b" " if some else b"") + b" ".join(kept)
            some = True


def report(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = LEAST, with_runs: bool = False) -> DataFrame:
    """doc_id, n_runs; start, length, period and exponent_milli of the longest run; runs_sha256, collapsed_sha256.

    ``with_runs`` adds runs, an array of (start, length, period), and collapsed, the text without repeated periods.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offs = c.text_bytes(batch.column(1))
        found: list[list[Run]] = []
        best: list[Run | None] = []
        digests, texts, shown = [], [], []
        for i, j in c.groups(offs):
            ids, bounds, raws = _numbered(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
            own: list[list[Run]] = [[] for _ in raws]
            of = np.repeat(np.arange(len(raws)), np.diff(bounds))
            for a, b in stretches(ids, of, least):
                row = int(of[a])
                own[row] += [(s + a - int(bounds[row]), length, p) for s, length, p in runs(ids[a:b], least)]
            for d, raw in enumerate(raws):
                mine = sorted(own[d])
                found.append(mine)
                best.append(max(mine, key=lambda r: (r[1], -r[0], -r[2]), default=None))
                digests.append(hashlib.sha256("".join(f"{s},{length},{p}\n" for s, length, p in mine).encode()).hexdigest())
                digest, whole = hashlib.sha256(), []
                for piece in collapsed(raw, int(bounds[d + 1] - bounds[d]), mine):
                    digest.update(piece)
                    if with_runs:
                        whole.append(piece)
                texts.append(digest.hexdigest())
                shown.append(b"".join(whole).decode())
        long = pa.int64()
        columns = [batch.column(0), pa.array([len(x) for x in found], long)]
        columns += [pa.array([r and r[k] for r in best], long) for k in range(3)]
        columns += [pa.array([r and 1000 * r[1] // r[2] for r in best], long), pa.array(digests), pa.array(texts)]
        names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
        if with_runs:
            kind = pa.list_(pa.struct([("start", long), ("length", long), ("period", long)]))
            columns += [pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in found], kind), pa.array(shown)]
            names += ["runs", "collapsed"]
        return pa.RecordBatch.from_arrays(columns, names)

    ids = docs.schema[id_col].dataType.simpleString()
    more = ", runs array<struct<start:long,length:long,period:long>>, collapsed string" if with_runs else ""
    schema = f"doc_id {ids}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string{more}"
    return c.map_batches(docs.select(F.col(c.quoted(id_col)).alias("doc_id"), F.col(c.quoted(text)).alias("text")), run, schema)


def with_periods(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, one in ten made periodic from a word on that its id decides (fixed by the query's contract); a null id changes nothing."""
    h, g, words, n, a, p = c.free_names(docs, "h", "g", "words", "n", "a", "p")
    body = F.col(c.quoted(text))
    out = docs.withColumn(h, F.crc32(F.col(c.quoted(id_col)).cast("string").cast("binary"))).withColumn(g, F.floor(F.col(h) / 10))
    out = out.withColumn(words, F.when(F.col(h) % 10 == 0, F.regexp_extract_all(body, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    out = out.withColumn(n, F.coalesce(F.size(words), F.lit(0)).cast("long"))
    out = out.withColumn(a, F.when(F.col(n) > 0, F.col(g) % F.col(n))).withColumn(p, 1 + F.floor((F.col(n) - F.col(a)) / (3 + F.col(g) % 8)))

    def word(i):
        return F.get(words, F.when(i < F.col(a), i).otherwise(F.col(a) + (i - F.col(a)) % F.col(p)).cast("int"))

    changed = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), F.col(n) - 1), word), " ")
    return out.withColumn(text, F.when(F.col(n) > 0, changed).otherwise(body)).drop(h, g, words, n, a, p)
