"""What several operators share: tables in the shared folder, Arrow plumbing, word hashing.

Word hashing works on the UTF-8 bytes of a whole Arrow batch at once. A word's hash is a
polynomial over a random table modulo 2**64, so prefix sums give it for any span; hashes
of word windows are built from word hashes. Two different words share a hash with a
probability of about 2**-64.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Text bytes that are hashed in one go.
SLICE_BYTES = 1 << 20
#: Bytes of a batch that a Python function works on at once, on average; what it returns is as bounded.
BATCH_BYTES = 4 << 20


# ---------------------------------------------------------------- shared folder
def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used in local mode, as in tests; elsewhere that is an error, as
    executors would not see the driver's folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    found = getattr(spark.sparkContext, "_ranksieve_shared", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="ranksieve-")
        spark.sparkContext._ranksieve_shared = found
        _delete_at_exit(spark, found)
    return found


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _delete_at_exit(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it goes when the application ends."""
    path = f"{shared_dir(spark)}/ranksieve/{name}-{uuid.uuid4().hex}"
    fs, p = _fs(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)
    return path


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


class Stage:
    """A table written to the shared folder, which cuts the lineage."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch(self.spark, name)
        df.write.mode("overwrite").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)


def spread(df: DataFrame) -> DataFrame:
    """The rows over all cores, if the scan has fewer partitions than there are cores, as a table of one row group has."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# ---------------------------------------------------------------- Arrow plumbing
def give_back() -> None:
    """Freed memory goes back to the system: a worker lives on after its task, beside those of other steps."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not this C library
        pass


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from batch to batch; it gets batches of about BATCH_BYTES, in as many calls as that takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = out = None
        for batch in batches:
            rows = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
            for at in range(0, batch.num_rows, rows):
                out = fn(batch.slice(at, rows))
                if out is not None and out.num_rows:
                    yield out
        del batch, out
        give_back()

    return df.mapInArrow(run, schema)


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one after another, and n+1 offsets. Null: no bytes."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(col)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], kind)[col.offset : col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    return data[offs[0] : offs[-1]], offs - offs[0]


def groups(offs: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes each; a longer row stands alone."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield i, j
        i = j


_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def sliced_words(raw: bytes) -> Iterator[list[bytes]]:
    """Words `[^\\x20\\x09-\\x0D]+` of a text, in lists that each hold a slice of it, so few words are held at a time."""
    at = 0
    while at < len(raw):
        found = _SPACE.search(raw, at + SLICE_BYTES)
        end = found.start() if found else len(raw)
        if words := raw[at:end].split():
            yield words
        at = end


# ---------------------------------------------------------------- word hashing
_rng = np.random.Generator(np.random.PCG64(20240229))
_RANDOM = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_pow: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_pow[0]) < n:
        with np.errstate(over="ignore"):
            for k, base in enumerate((_BASE, _INVERSE)):
                a = np.full(n, base, U64)
                a[0] = 1
                _pow[k] = np.multiply.accumulate(a)
    return _pow[0][:n], _pow[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


class Words:
    """Byte classes of words; ``fold``: A-Z count as a-z."""

    def __init__(self, word_bytes, fold: bool):
        self.is_word = np.zeros(256, bool)
        self.is_word[list(word_bytes)] = True
        self.table = _RANDOM.copy()
        if fold:
            self.table[65:91] = self.table[97:123]

    def spans(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each word; a row's end ends a word."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = self.is_word[data]
        edge = offs[:-1][offs[1:] > offs[:-1]]  # first bytes of rows that have any
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        before[edge] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        after[edge[1:] - 1] = False
        return starts, np.flatnonzero(inside & ~after) + 1

    def span_hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans, in order and disjoint; the same for equal bytes anywhere."""
        out = np.zeros(len(starts), U64)
        with np.errstate(over="ignore"):
            i = 0
            while i < len(starts):
                lo = int(starts[i])
                j = max(i + 1, int(np.searchsorted(ends, lo + SLICE_BYTES, side="right")))
                if int(ends[j - 1]) - lo <= SLICE_BYTES:
                    up, down = _powers(int(ends[j - 1]) - lo + 1)
                    sums = np.zeros(len(up), U64)
                    np.cumsum(self.table[data[lo : int(ends[j - 1])]] * up[:-1], out=sums[1:])
                    out[i:j] = (sums[ends[i:j] - lo] - sums[starts[i:j] - lo]) * down[starts[i:j] - lo]
                else:  # one span longer than a slice
                    total, hi = 0, int(ends[i])
                    for at in range(lo, hi, SLICE_BYTES):
                        part = data[at : min(hi, at + SLICE_BYTES)]
                        s = int(np.sum(self.table[part] * _powers(SLICE_BYTES)[0][: len(part)]))
                        total = (total + s * pow(_BASE, at - lo, 1 << 64)) % (1 << 64)
                    out[i] = total
                i = j
            return mix(out + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))

    def table_of(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words, and n+1 bounds of each row's words."""
        starts, ends = self.spans(data, offs)
        return starts, ends, self.span_hashes(data, starts, ends), np.searchsorted(starts, offs)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (rows must be told apart by the caller)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    with np.errstate(over="ignore"):
        out = np.full(n, k, U64)
        for j in range(k):
            out = out * U64(_BASE) + hashes[j : j + n]
        return mix(out)


def whole(hashes: np.ndarray) -> int:
    """Hash of a whole short sequence, as ``windows`` gives for its length."""
    return int(windows(hashes, len(hashes))[0])


#: Words `[^\x20\x09-\x0D]+` and `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` (after A-Z became a-z) as byte classes.
SPACED = [b for b in range(256) if b != 0x20 and not 9 <= b <= 13]
ALNUM = [b for b in range(256) if b >= 0x80 or 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A]


def lower_ascii(c):
    """A-Z become a-z; all else stays (a Spark column)."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sizes_within(df: DataFrame, rows: int) -> bool:
    """Whether a table has at most so many rows, without counting further than that."""
    return df.limit(rows + 1).count() <= rows


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Column names like the wanted ones that no column of the table has, whatever its case."""
    taken, out = {x.lower() for x in df.columns}, []
    for name in wanted:
        name = f"__{name}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column's name as an expression."""
    return "`" + name.replace("`", "``") + "`"
