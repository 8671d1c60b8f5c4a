"""Token ids in Arrow files with fixed-size-list batches.

A shard is one Arrow IPC file: each row holds a sequence of LENGTH ids (uint16 or uint32) and a
mask of the same length (true: an id, false: filling at the shard's end), ROWS rows a batch. Lists
have a fixed size and are not compressed, so sequence k lies at a computed place and a memory map
gives it, or any run of ids, without copying. Shards hold ranges of ids in ascending order; an
index table (Parquet) names for each document its shard, its place there and its length.

Cases: a null text is empty and has the end id alone; documents of equal ids lie in order of their
texts; null ids come first; an empty table gives no shard and an empty result. Strings of the file's
added tokens within a text get their ids, as the library does by default.
"""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as c

LENGTH, ROWS = 2048, 64
#: Bytes of text that a shard is made of, about.
SHARD_BYTES = 64 << 20
#: Shards whose starts one task adds up, and most rows that are broadcast, of a shard and a number.
BLOCK, BROADCAST_ROWS = 1024, 200_000
#: Words and blank-separated runs that a worker remembers, and the longest of them.
WORDS, RUNS, LONGEST = 800_000, 200_000, 256
#: Characters that are encoded at a time.
PART = 2 << 20


class _Memo(dict):
    """Computes what it lacks. Half of ``most`` entries are at hand; when these are full they become the other half, from
    which those still asked for come back. Long keys are not kept."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST:
            if 2 * len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class WordEncoder:
    """The tokenizers library, asked once for each distinct word.

    Characters up to U+024F are in normal form already, so a text of them is put into lower case and cut
    by the file's own pattern, and its distinct words are given to the library's model. Blank-separated
    runs that hold others, or one of the file's added tokens, go through the whole library: ids depend on
    nothing beyond a word's ends, and words end at white space at the latest.
    """

    #: The pattern of the tokenizer file, and its white space up to U+024F.
    PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+"
    SPACES = "\\t-\\r \x85\xa0"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        near = sorted({*map(chr, range(0x250)), *"".join(map(chr, range(0x250))).lower()})
        kinds = {kind: "".join(ch for ch in near if unicodedata.category(ch)[0] == kind) for kind in "LN"}
        self.cut = re.compile(self.PATTERN.format(letters=kinds["L"], numbers=kinds["N"], spaces=self.SPACES)).findall
        added = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.added, self.far = re.compile(added).search if added else lambda text: None, re.compile("[^\\x00-\\u024f]").search
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters: dict[int, str] = {}  # the library's letter for each byte of those characters
        for ch in near:
            self.letters.update(zip(ch.encode(), level.pre_tokenize_str(ch)[0][0], strict=True))
        self.words, self.runs = _Memo(self._word, WORDS), _Memo(self._run, RUNS)

    def _word(self, word: str) -> bytes:
        if not (word.isascii() and word.isprintable()):  # others are their own letters
            word = "".join([self.letters[b] for b in word.encode()])
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def _run(self, run: str) -> bytes:
        return array("I", self.tokenizer.encode(run, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text."""
        return np.concatenate([ids for _, ids, _ in self.encode_all([text])])

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray, bool]]:
        """(number of the text, ids, whether they are its last ones), in order: texts in parts of bounded size."""
        held, size = [], 0
        for number, text in enumerate(texts):
            at = 0
            while True:
                end = len(text)
                if end - at > PART:
                    end = text.find(" ", at + PART) + 1 or end
                held.append((number, text[at:end], end == len(text)))
                size, at = size + end - at, end
                if size >= PART:
                    yield from self._parts(held)
                    held, size = [], 0
                if at == len(text):
                    break
        if held:
            yield from self._parts(held)

    def _parts(self, held: list[tuple[int, str, bool]]) -> Iterator[tuple[int, np.ndarray, bool]]:
        """Each word that the parts have is looked up once; the ids are put together by the words' numbers."""
        words, ends, others = [], [], {}
        for k, (_, part, _) in enumerate(held):
            if self.added(part) or not part.isascii() and self.far(part):
                others[k] = np.frombuffer(b"".join([self.runs[run] for run in part.split(" ")]), np.uint32)
            else:
                words += self.cut(part.lower())
            ends.append(len(words))
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        del words
        known = [self.words[word] for word in coded.dictionary.to_numpy(zero_copy_only=False)]
        count = np.fromiter(map(len, known), np.int64, len(known)) >> 2
        start = np.cumsum(count) - count
        word = coded.indices.to_numpy()
        n = count[word]
        bounds = np.concatenate([[0], np.cumsum(n)])
        ids = np.frombuffer(b"".join(known), np.uint32)[np.repeat(start[word] - bounds[:-1], n) + np.arange(bounds[-1])]
        lo = 0
        for k, (number, _, last) in enumerate(held):
            hi = bounds[ends[k]]
            yield number, others[k] if k in others else ids[lo:hi], last
            lo = hi


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def schema(vocabulary: int) -> pa.Schema:
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([("ids", pa.list_(kind, LENGTH)), ("mask", pa.list_(pa.bool_(), LENGTH))])


class Writer:
    """Packs ids into sequences and writes full batches as they come."""

    def __init__(self, sink, kind: pa.Schema):
        self.kind, self.out = kind, pa.ipc.new_file(sink, kind)
        self.dtype = np.dtype(kind.field("ids").type.value_type.to_pandas_dtype())
        self.held: list[np.ndarray] = []
        self.size = self.total = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids.astype(self.dtype))
        self.size += len(ids)
        self.total += len(ids)
        if self.size >= LENGTH * ROWS:
            flat = np.concatenate(self.held)
            full = self.size // (LENGTH * ROWS) * (LENGTH * ROWS)
            for at in range(0, full, LENGTH * ROWS):
                self._write(flat[at : at + LENGTH * ROWS], LENGTH * ROWS)
            self.held, self.size = [flat[full:].copy()], self.size - full

    def _write(self, flat: np.ndarray, n: int) -> None:
        mask = np.arange(len(flat)) < n
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(flat), LENGTH), pa.FixedSizeListArray.from_arrays(pa.array(mask), LENGTH)]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.kind))

    def close(self) -> None:
        if self.size:
            flat = np.concatenate(self.held)
            self._write(np.pad(flat, (0, -len(flat) % LENGTH)), len(flat))
        self.out.close()


class Reader:
    """Random access to a shard; over a memory map nothing is copied but what spans batches."""

    def __init__(self, source):
        self.file = pa.ipc.open_file(source)
        self._at, self._flat = -1, None

    def sequence(self, k: int) -> tuple[np.ndarray, pa.Array]:
        """Ids (a view) and mask of sequence k."""
        batch = self.file.get_batch(k // ROWS)
        row = k % ROWS
        return batch.column(0).values.to_numpy(zero_copy_only=True)[row * LENGTH : (row + 1) * LENGTH], batch.column(1).values.slice(row * LENGTH, LENGTH)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The n ids from ``start`` on, as views of one batch after another."""
        size = LENGTH * ROWS
        while n > 0:
            k, at = divmod(start, size)
            if k != self._at:
                self._at, self._flat = k, self.file.get_batch(k).column(0).values.to_numpy(zero_copy_only=True)
            part = self._flat[at : at + n]
            yield part
            start, n = start + len(part), n - len(part)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder of the shared store, and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES, vocabulary: int = 1 << 16) -> DataFrame:
    """Writes shards into ``folder``; returns the index: doc_id, shard, file, place, n_tokens.

    A task writes its shard under a name of its own attempt, so a repeated task never meets the
    remains of a lost one; the index names the file that counts.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // shard_bytes), int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = own.repartitionByRange(parts, "doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    kind, end = schema(vocabulary), np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        shard, name, writer, sink = task.partitionId(), f"shard-{task.partitionId():06d}-{task.taskAttemptId()}.arrow", None, None
        fs, at = filesystem(folder)
        for batch in batches:
            if not batch.num_rows:
                continue
            if writer is None:
                fs.create_dir(at, recursive=True)
                sink = fs.open_output_stream(f"{at}/{name}", compression=None)
                writer = Writer(sink, kind)
            place, n, k = [], [], batch.num_rows
            for number, ids, last in encoder(tokenizer).encode_all(value.as_py() for value in batch.column(1)):
                if number == len(place):
                    place.append(writer.total)
                writer.add(ids)
                if last:
                    writer.add(end)
                    n.append(writer.total - place[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shard] * k, pa.int32()), pa.array([name] * k), pa.array(place, pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "shard", "file", "place", "n_tokens"],
            )
        if writer is not None:
            writer.close()
            sink.close()

    ids = docs.schema[id_col].dataType.simpleString()
    return ordered.mapInArrow(run, f"doc_id {ids}, shard int, file string, place long, n_tokens long")


def read(index: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the shards."""
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("block", F.floor(F.col("shard") / BLOCK).cast("int"))
    sums = {r["block"]: r["n"] for r in totals.groupBy("block").agg(F.sum("n").alias("n")).collect()}  # a row for BLOCK shards
    first = list(accumulate((sums.get(k, 0) for k in range(max(sums, default=0))), initial=0))
    start = F.element_at(F.split(F.lit(",".join(map(str, first))), ",").cast("array<bigint>"), F.col("block") + 1)
    before = totals.select(F.col("shard").alias("of"), (start + F.sum("n").over(Window.partitionBy("block").orderBy("shard")) - F.col("n")).alias("before"))
    before = F.broadcast(before) if c.sizes_within(before, BROADCAST_ROWS) else before  # a row a shard
    rows = index.join(before, F.col("shard") == F.col("of"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = filesystem(folder)
        name = source = reader = None
        for batch in batches:
            crc = []
            for file, place, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                if file != name:
                    name, source = file, fs.open_input_file(f"{at}/{file}")
                    reader = Reader(source)
                value = 0
                for part in reader.ids(place, n):
                    value = zlib.crc32(part.astype("<u4").tobytes(), value)
                crc.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(4), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    ids = index.schema["doc_id"].dataType.simpleString()
    rows = rows.select("doc_id", (F.col("before") + F.col("place")).alias("start"), "file", "place", "n_tokens")
    return rows.mapInArrow(run, f"doc_id {ids}, start long, n_tokens long, ids_crc32 long")
