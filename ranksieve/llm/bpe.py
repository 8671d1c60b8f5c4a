"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece exactly one token can be the last of its encoding: the token t that
ends there and fits the last token p of what lies before it, i.e. the pair (p, t) encodes as
itself. So a table with one token a byte holds the encodings of all prefixes; a piece's encoding
is read from its end, an append only adds entries, and an edit redoes entries from its place on.

A text is cut into chunks (an optional blank and a run of non-space, or white space, as the
pattern cuts it), chunks into pieces by the pattern, and both are remembered in one table
within a bound (REMEMBERED), so a frequent one is encoded about once a worker. Texts are
read in parts of PART characters, cut where a chunk must begin.

Cases: a null text is empty: no tokens, and the digests of nothing; repeated rows are encoded each;
a piece without blanks may be of any length (its table takes 4 bytes a byte).
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import struct
from array import array
from bisect import bisect_right

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import common as c

#: Chunks and pieces that a worker remembers (some 200 bytes each), and the longest remembered.
REMEMBERED, LONGEST = 500_000, 256
#: Pairs of tokens whose fit a worker remembers (some 100 bytes each).
PAIRS = 300_000
#: Characters of a text that are encoded at a time.
PART = 1 << 20

#: Unicode White_Space, as the pattern's \s takes it.
_SPACE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_CUT = re.compile(f"[^{_SPACE}](?=[{_SPACE}])")


class Vocabulary:
    """Ranks of byte strings, and for each token the pair it is merged from."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.split: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for t, i in sorted(ranks.items(), key=lambda x: x[1]):
            parts = [ranks[t[k : k + 1]] for k in range(len(t))] if len(t) > 1 else []
            while len(parts) > 2:
                best = min(((self.pairs.get((a, b), 1 << 62), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
                if best[0] == 1 << 62:
                    break
                parts[best[1] : best[1] + 2] = [best[0]]
            if len(parts) == 2:
                self.split[i] = (parts[0], parts[1])
                self.pairs[parts[0], parts[1]] = i
            if len(t) == 1 or len(parts) == 2:  # others are never reached by merges
                self.automaton.add_word(t.decode("latin-1"), (len(t), i))
        self.automaton.make_automaton()
        self.longest = max(map(len, ranks), default=0)
        self.known: dict[int, bool] = {}

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def fits(self, p: int, t: int) -> bool:
        """Whether the bytes of p and t encode as p, t: no merge across their border comes before those inside them."""
        if len(self.known) > PAIRS:
            self.known.clear()
        ok = self.known[p << 20 | t] = self._walk(p, t)
        return ok

    def _walk(self, p: int, t: int) -> bool:
        """Undo the merges of both sides, latest first. The two tokens that then stand at the border exist together until
        the undone merge; if their own merge comes before that, p and t are never reached. Of equal ranks the left one is
        merged first, hence the 1 on the right side."""
        pairs, split = self.pairs, self.split
        until = 1 << 62
        while True:
            if pairs.get((p, t), 1 << 62) < until:
                return False
            left, right = split.get(p), split.get(t)
            if left is None and right is None:
                return True
            if right is None or (left is not None and p > t):
                until, p = p, left[1]
            else:
                until, t = t + 1, right[0]


class Table:
    """One last token for every prefix of a piece."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.v, self.data, self.last = vocabulary, b"", array("i")
        self.append(data)

    def append(self, more: bytes) -> None:
        """Earlier entries stay as they are."""
        last, begin = self.last, len(self.last)
        self.data += more
        back = max(0, begin - self.v.longest)  # a token that ends in ``more`` may start before it
        known, walk, filled = self.v.known, self.v.fits, begin
        for end, (length, t) in self.v.automaton.iter((self.data[back:] if back else self.data).decode("latin-1")):
            end += back
            if end < filled:  # before ``more``, or its token is known
                continue
            at = end - length
            if at < 0:
                if at < -1:
                    continue
            else:
                p = last[at]
                ok = known.get(p << 20 | t)
                if not (walk(p, t) if ok is None else ok):
                    continue
            if end != filled:
                break
            last.append(t)
            filled += 1
        if filled != len(self.data):
            raise ValueError(f"no token ends at byte {filled} of {self.data[:40]!r}")

    def cut(self, n: int) -> None:
        """Only the first n bytes stay."""
        self.data = self.data[:n]
        del self.last[n:]

    def ids(self, n: int | None = None) -> list[int]:
        """The encoding of the first n bytes."""
        out, i, last, tokens = [], (len(self.last) if n is None else n) - 1, self.last, self.v.tokens
        while i >= 0:
            out.append(last[i])
            i -= len(tokens[last[i]])
        out.reverse()
        return out


class _Memo(dict):
    def __init__(self, make, most):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= LONGEST:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


class Encoder:
    """Encodes as the pattern and the ranks say, without special tokens."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.v, self.pattern = vocabulary, regex.compile(pattern)
        self._chunks = _Memo(self._make, REMEMBERED)

    def _make(self, chunk: str) -> bytes:
        """A piece is a chunk that the pattern leaves whole."""
        pieces = self.pattern.findall(chunk)
        if len(pieces) == 1:
            return pack(Table(self.v, chunk.encode()).ids())
        return b"".join([self._chunks[p] for p in pieces])

    @classmethod
    @functools.lru_cache(maxsize=4)
    def load(cls, path: str, pattern: str) -> Encoder:
        """One encoder a worker process."""
        return cls(Vocabulary.read(path), pattern)

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        out, at, chunks = [], 0, self._chunks
        while at < len(text):
            cut = _CUT.search(text, at + PART) if len(text) - at > PART else None
            end = cut.end() if cut else len(text)
            out.append(b"".join([chunks[x] for x in _CHUNK.findall(text, at, end)]))
            at = end
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        tokens = self.v.tokens
        return b"".join([tokens[i] for i in memoryview(ids).cast("I")])


class Document:
    """An encoded text that takes appends and edits and redoes only the pieces they touch."""

    def __init__(self, encoder: Encoder, text: str = ""):
        self.encoder, self.text = encoder, ""
        self.starts: list[int] = []
        self.tables: list[Table] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> int:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> int:
        """Put ``new`` in place of text[start:end]; returns how many bytes of tables were computed."""
        old, shift = self.text, len(new) - (end - start)
        self.text = old[:start] + new + old[end:]
        first = max(0, bisect_right(self.starts, start) - 1)
        while first and not old[self.starts[first] - 1 : self.starts[first]].strip():
            first -= 1  # what comes before may look at the white space that follows it
        first = max(0, first - 1)
        at = self.starts[first] if self.starts else 0
        after = {s + shift: k for k, s in enumerate(self.starts) if s >= end}
        starts, tables, done, k = self.starts[:first], self.tables[:first], 0, first
        for m in self.encoder.pattern.finditer(self.text, at):
            same = after.get(m.start())
            if same is not None and m.start() > start + len(new) and self.tables[same].data == m[0].encode():
                starts += [s + shift for s in self.starts[same:]]
                tables += self.tables[same:]
                break
            data = m[0].encode()
            table = self.tables[k] if k < len(self.tables) and self.starts[k] == m.start() and self.starts[k] <= start else None
            if table is None:
                table = Table(self.encoder.v)
            common = 0
            while common < min(len(table.data), len(data)) and table.data[common] == data[common]:
                common += 1
            table.cut(common)
            table.append(data[common:])
            done += len(data) - common
            starts.append(m.start())
            tables.append(table)
            k += 1
        self.starts, self.tables = starts, tables
        return done

    def ids(self) -> list[int]:
        return [i for t in self.tables for i in t.ids()]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array<int>) of each document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = Encoder.load(path, pattern)
        n, digest, decoded, ids = [], [], [], []
        for value in batch.column(1):
            own = encoder.encode(value.as_py() or "")
            n.append(len(own) // 4)
            digest.append(hashlib.sha256(own).hexdigest())
            decoded.append(hashlib.sha256(encoder.decode(own)).hexdigest())
            if with_ids:
                ids.append(np.frombuffer(own, "<i4"))
        columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(digest), pa.array(decoded)]
        if with_ids:
            columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), pa.array(np.concatenate(ids))))
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: len(columns)])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return c.map_batches(docs.select(id_col, text), run, schema)


def plain(vocabulary: Vocabulary, data: bytes) -> list[int]:
    """Merging the lowest rank first, for tests."""
    parts = [data[i : i + 1] for i in range(len(data))]
    while len(parts) > 1:
        rank, k = min((vocabulary.ranks.get(a + b, 1 << 62), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 62:
            break
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return [vocabulary.ranks[p] for p in parts]


def pack(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)
