"""Quality rules as a short-circuit cascade.

Every rule gives a verdict for each document of a batch. On a bounded random sample
(``SAMPLE_ROWS`` documents) the cost of each rule in nanoseconds a document and
the share that it rejects are measured; rules then run in order of rejections per cost, each
only on what those before it let pass. The verdict is the conjunction of all rules, so the
order never changes a result.

``keep`` is where the order pays: a rule runs on what is left. ``measure`` reports the base measures of
every row, so it makes those first, and the cascade saves the other rules' work only.

Cases: a null text has no words and fails ``few_words``; an empty table gives an empty result;
repeated rows are judged each for itself; other columns, whatever their names, pass untouched.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as c

#: Documents that the order of the rules is estimated on.
SAMPLE_ROWS = 512
#: Words in a window that counts as repeated.
WINDOW = 5

_WORDS = c.Words(c.SPACED, fold=False)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(x) for x in "#*$%&|<>"]] = True
_LEAD = np.array([(b & 0xC0) != 0x80 for b in range(256)])


class Batch:
    """Texts of a run of rows; what rules ask for is computed once, at the first use."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs, self.n = data, offs, len(offs) - 1
        self._kept: dict[str, np.ndarray] = {}

    def __getattr__(self, name: str) -> np.ndarray:
        kept = self.__dict__["_kept"]
        if name not in kept:
            kept[name] = _MEASURES[name](self)
        return kept[name]

    def take(self, rows: np.ndarray) -> Batch:
        """Only these rows, in ascending order; measures already made are carried over."""
        lengths = np.diff(self.offs)[rows]
        offs = np.concatenate([[0], np.cumsum(lengths)])
        parts = [self.data[self.offs[i] : self.offs[i + 1]] for i in rows]
        out = Batch(np.concatenate(parts) if parts else self.data[:0], offs)
        out._kept = {k: v[rows] for k, v in self._kept.items() if k in _PER_ROW}
        if "words" in self._kept:
            starts, ends, hashes, bounds = self._kept["words"]
            count = np.diff(bounds)
            there = np.zeros(self.n, bool)
            there[rows] = True
            own = np.repeat(there, count)
            shift = np.repeat(offs[:-1] - self.offs[rows], count[rows])
            out._kept["words"] = starts[own] + shift, ends[own] + shift, hashes[own], np.concatenate([[0], np.cumsum(count[rows])])
        return out


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[offs[1:]] - sums[offs[:-1]]


def _repeat_words(b: Batch) -> np.ndarray:
    """Words inside a window of WINDOW words that stands twice or more in the text."""
    hashes, bounds = b.words[2], b.words[3]
    grams = c.windows(hashes, WINDOW)
    out = np.zeros(b.n, np.int64)
    for i in range(b.n):
        own = grams[bounds[i] : max(bounds[i], bounds[i + 1] - WINDOW + 1)]
        if len(own) < 2:
            continue
        s = np.sort(own)
        twice = s[1:][s[1:] == s[:-1]]
        if len(twice):
            at = np.flatnonzero(np.isin(own, twice))
            step = np.zeros(len(own) + WINDOW + 1, np.int64)
            step[at] += 1
            np.add.at(step, at + WINDOW, -1)
            out[i] = int((np.cumsum(step) > 0).sum())
    return out


def _lines(b: Batch) -> tuple[np.ndarray, np.ndarray]:
    """For each row: lines that have a word, and those of them equal to an earlier line."""
    breaks = np.flatnonzero(b.data == 10)
    starts = np.unique(np.concatenate([b.offs[:-1][b.offs[1:] > b.offs[:-1]], breaks + 1]))
    starts = starts[starts < len(b.data)]
    if not len(starts):
        return np.zeros(b.n, np.int64), np.zeros(b.n, np.int64)
    ends = np.minimum(np.append(starts[1:], len(b.data)), len(b.data))
    cut = np.append(starts[1:], len(b.data))
    ends = np.where((cut > starts) & (b.data[cut - 1] == 10), cut - 1, ends)
    words = np.concatenate([[0], np.cumsum(_WORDS.is_word[b.data], dtype=np.int64)])
    full = words[ends] > words[starts]
    starts, ends = starts[full], ends[full]
    hashes = _WORDS.span_hashes(b.data, starts, ends)
    bounds = np.searchsorted(starts, b.offs)
    count = np.diff(bounds)
    same = np.zeros(b.n, np.int64)
    for i in np.flatnonzero(count > 1):
        same[i] = count[i] - len(np.unique(hashes[bounds[i] : bounds[i + 1]]))
    return count, same


def _doubled(b: Batch) -> np.ndarray:
    """Words equal to the word just before them."""
    hashes, bounds = b.words[2], b.words[3]
    if len(hashes) < 2:
        return np.zeros(b.n, np.int64)
    same = np.concatenate([[0, 0], np.cumsum(hashes[1:] == hashes[:-1], dtype=np.int64)])
    last = np.maximum(bounds[1:], bounds[:-1] + 1)
    return np.where(bounds[1:] > bounds[:-1], same[last] - same[np.minimum(bounds[:-1] + 1, len(same) - 1)], 0)


_MEASURES: dict[str, Callable[[Batch], object]] = {
    "words": lambda b: _WORDS.table_of(b.data, b.offs),
    "n_words": lambda b: np.diff(b.words[3]),
    "word_chars": lambda b: _per_row(_WORDS.is_word[b.data] & _LEAD[b.data], b.offs),
    "n_symbols": lambda b: _per_row(_SYMBOL[b.data], b.offs),
    "n_shouts": lambda b: _per_row(b.data == 33, b.offs),
    "lines": _lines,
    "n_lines": lambda b: b.lines[0],
    "n_dup_lines": lambda b: b.lines[1],
    "n_repeat_words": _repeat_words,
    "n_doubled": _doubled,
}
_PER_ROW = {"n_words", "word_chars", "n_symbols", "n_shouts", "n_lines", "n_dup_lines", "n_repeat_words", "n_doubled"}


@dataclass(frozen=True)
class Rule:
    """``rejects`` gives a boolean for each row of a batch."""

    name: str
    rejects: Callable[[Batch], np.ndarray]


BASE = (
    Rule("few_words", lambda b: b.n_words < 10),
    Rule("repeated_windows", lambda b: 100 * b.n_repeat_words > 20 * b.n_words),
)
RULES = (
    *BASE,
    Rule("symbols", lambda b: 10 * b.n_symbols > b.n_words),
    Rule("shouting", lambda b: 2 * b.n_shouts > b.n_words),
    Rule("word_length", lambda b: (b.word_chars < 2 * b.n_words) | (b.word_chars > 20 * b.n_words)),
    Rule("repeated_lines", lambda b: 10 * b.n_dup_lines > 3 * b.n_lines),
    Rule("doubled_words", lambda b: 10 * b.n_doubled > 3 * b.n_words),
)


def _batches(column: pa.Array):
    data, offs = c.text_bytes(column)
    for i, j in c.groups(offs):
        yield i, j, Batch(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])


def estimate(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Cost (ns a document) and rejections of each rule, each run alone, on a sample of ``rows``.

    Returns rule, n_rows, n_rejected, cost_ns; no row for a rule if the table is empty.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for _, _, b in _batches(batch.column(0)):
            shared = b.words  # what several rules share is no rule's own cost
            for r in rules:
                fresh = Batch(b.data, b.offs)
                fresh._kept["words"] = shared
                began = time.perf_counter_ns()
                n = int(np.count_nonzero(r.rejects(fresh)))
                out.append((r.name, b.n, n, time.perf_counter_ns() - began))
        return pa.RecordBatch.from_pydict(
            {k: pa.array([x[i] for x in out], t) for i, (k, t) in enumerate((("rule", pa.string()), ("n_rows", pa.int64()), ("n_rejected", pa.int64()), ("cost_ns", pa.int64())))}
        )

    share = min(1.0, 2 * rows / max(1, docs.count()))  # so about twice ``rows`` rows meet in the limit, at any size
    few = docs.select(F.col(c.quoted(text)).alias("text")).sample(fraction=share, seed=7).limit(rows)
    found = c.map_batches(few, run, "rule string, n_rows long, n_rejected long, cost_ns long")
    return found.groupBy("rule").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_rejected").alias("n_rejected"), F.sum("cost_ns").alias("cost_ns"))


def plan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules, those first that reject most for their cost."""
    rate = {r["rule"]: (r["n_rejected"] + 0.5) / max(1, r["cost_ns"]) for r in estimate(docs, text, rules, rows).collect()}
    return tuple(sorted(rules, key=lambda r: (-rate.get(r.name, 0.0), r.name)))


def cascade(b: Batch, order: tuple[Rule, ...]) -> np.ndarray:
    """Which rows pass all rules; a rule sees only rows that passed those before it."""
    alive, left = np.arange(b.n), b
    for r in order:
        if not len(alive):
            break
        ok = ~r.rejects(left)
        if not ok.all():
            keep = np.flatnonzero(ok)
            alive, left = alive[keep], left.take(keep)
    out = np.zeros(b.n, bool)
    out[alive] = True
    return out


def measure(docs: DataFrame, order: tuple[Rule, ...], id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the base measures, base_failed and the cascade's verdict ``kept``, a row per document."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cols: dict[str, list] = {k: [] for k in (*names, "base_failed", "kept")}
        for _, _, b in _batches(batch.column(1)):
            for k in names:  # asked for of every row; the cascade finds them made and adds the other rules' measures
                cols[k].append(getattr(b, k))
            kept = cascade(b, order)
            failed = np.logical_or.reduce([r.rejects(b) for r in BASE])
            cols["base_failed"].append(failed)
            cols["kept"].append(kept & ~failed)
        return pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **{k: pa.array(np.concatenate(v)) for k, v in cols.items()}})

    ids = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {ids}, " + ", ".join(f"{k} long" for k in names) + ", base_failed boolean, kept boolean"
    return c.map_batches(docs.select(F.col(c.quoted(id_col)), F.col(c.quoted(text))), run, schema)


def keep(docs: DataFrame, order: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """The documents that pass all rules, with all their columns."""
    at = docs.columns.index(text)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        verdict = [cascade(b, order) for _, _, b in _batches(batch.column(at))]
        return batch.filter(pa.array(np.concatenate(verdict)))

    return c.map_batches(docs, run, docs.schema)

