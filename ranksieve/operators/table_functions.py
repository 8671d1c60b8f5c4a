"""Chunks and profile units as table functions of SQL.

``register(spark)`` adds three. ``text_chunks(TABLE(t), 'text')`` and ``profile_units(TABLE(t), 'markdown')`` keep all
other columns of any table and need no shuffle; a table argument may name its own (``PARTITION BY``).
``chunks_of(text)`` takes one text, for LATERAL. They give the rows of ``chunking.chunks`` and ``text.profile_units``,
which stay the way of DataFrames, as those run without Python.

A null text has no chunk and no unit. Columns to be added whose names a table has, in any case, are an error, as is a
text column that it lacks.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ranksieve.operators.chunking import MANY, MEAN, SHORTEST, SIZE, STEP

_CHUNK = [StructField("chunk_ord", IntegerType()), StructField("chunk", StringType())]
_UNIT = [StructField("unit_ord", IntegerType()), StructField("unit", StringType())]


def _is_header(line: str) -> bool:
    own = line.strip()
    if not 3 <= len(own) <= 80:
        return False
    letters = [unicodedata.category(x) for x in own if x.isalpha()]
    return len(letters) >= 3 and letters.count("Lu") >= 0.8 * len(letters)


def _chunks(text: str | None, size: int, step: int) -> Iterator[tuple[int, str]]:
    """Numbered chunks of a text; ``str.splitlines`` and ``strip`` know the same characters as the columns' patterns."""
    if not text:
        return
    lines = text.splitlines()
    starts = [i for i, line in enumerate(lines) if i == 0 or _is_header(line)]
    parts = ["\n".join(lines[a:b]).strip() for a, b in zip(starts, [*starts[1:], len(lines)], strict=True)]
    if len(parts) >= MANY and sum(map(len, parts)) / len(parts) < MEAN:
        parts = [text]
    n = 0
    for part in parts:
        for k in range(max(0, -(-(len(part) - size) // step)) + 1):
            chunk = part[k * step : k * step + size]
            if len(chunk.strip()) >= SHORTEST:
                yield n, chunk
                n += 1


def _units(markdown: str | None, uses: str, terms: str) -> Iterator[tuple[int, str]]:
    """Bullets below one title, and all that stands below another as one unit."""

    def below(title: str) -> str:
        _, found, rest = (markdown or "").partition(title)
        return rest.split("\n## ", 1)[0] if found else ""

    own = [x.strip() for x in below(uses).splitlines()]
    units = [x[2:].strip() for x in own if x.startswith("- ")]
    words = below(terms).strip()
    yield from enumerate(units + ([words] if words else []))


def _positive(name: str, arg: AnalyzeArgument | None) -> None:
    if arg is not None and not (isinstance(arg.value, int) and arg.value > 0):
        raise ValueError(f"{name} is to be a constant of at least 1")


def _analyzed(rows: AnalyzeArgument, text: AnalyzeArgument | None, default: str, added: list[StructField]) -> AnalyzeResult:
    """All columns of the table argument but the text, and those that are added."""
    name = default if text is None else text.value
    if not rows.isTable or not isinstance(rows.dataType, StructType):
        raise ValueError("the first argument is a table: TABLE(name)")
    fields = {f.name.lower(): f for f in rows.dataType.fields}
    if name is None or name.lower() not in fields or fields[name.lower()].dataType != StringType():
        raise ValueError(f"the table has no text column {name!r}")
    kept = [f for f in rows.dataType.fields if f.name.lower() != name.lower()]
    clash = {f.name.lower() for f in kept} & {f.name for f in added}
    if clash:
        raise ValueError(f"the table has columns that would be added: {sorted(clash)}")
    return AnalyzeResult(StructType([*(StructField(f.name, f.dataType) for f in kept), *added]))


def _split(row: Row, name: str) -> tuple[tuple, str | None]:
    """The kept values of a row, and its text."""
    at = [x.lower() for x in row.__fields__].index(name.lower())
    return (*row[:at], *row[at + 1 :]), row[at]


class TextChunks:
    @staticmethod
    def analyze(rows: AnalyzeArgument, text: AnalyzeArgument | None = None, size: AnalyzeArgument | None = None, step: AnalyzeArgument | None = None) -> AnalyzeResult:
        _positive("size", size)
        _positive("step", step)
        return _analyzed(rows, text, "text", _CHUNK)

    def eval(self, rows: Row, text: str = "text", size: int = SIZE, step: int = STEP) -> Iterator[tuple]:
        kept, own = _split(rows, text)
        for chunk in _chunks(own, size, step):
            yield (*kept, *chunk)


class ProfileUnits:
    @staticmethod
    def analyze(rows: AnalyzeArgument, text: AnalyzeArgument | None = None, uses: AnalyzeArgument | None = None, terms: AnalyzeArgument | None = None) -> AnalyzeResult:
        return _analyzed(rows, text, "markdown", _UNIT)

    def eval(self, rows: Row, text: str = "markdown", uses: str = "## Aplicações típicas", terms: str = "## Tecnologias e termos relacionados") -> Iterator[tuple]:
        kept, own = _split(rows, text)
        for unit in _units(own, uses, terms):
            yield (*kept, *unit)


class ChunksOf:
    def eval(self, text: str, size: int = SIZE, step: int = STEP) -> Iterator[tuple]:
        yield from _chunks(text, size, step)


def register(spark: SparkSession) -> None:
    """Adds ``text_chunks``, ``profile_units`` and ``chunks_of`` to a session."""
    spark.udtf.register("text_chunks", udtf(TextChunks))
    spark.udtf.register("profile_units", udtf(ProfileUnits))
    spark.udtf.register("chunks_of", udtf(ChunksOf, returnType=StructType(_CHUNK)))
