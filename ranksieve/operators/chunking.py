"""Texts to chunks: sections that begin at header lines, long ones in overlapping windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ranksieve.functions.names import free_names, quoted
from ranksieve.functions.text import is_header, let, lines, strip

SIZE, STEP, SHORTEST = 2000, 1700, 50
MANY, MEAN = 200, 250


def sections(text: Column) -> Column:
    """Sections of a text, trimmed, in order: slices of its lines between header lines. No shuffle, one row a text."""

    def cut(own: Column) -> Column:
        first = F.transform(own, lambda line, i: F.when((i == 0) | is_header(line), i))
        starts = F.filter(first, lambda i: i.isNotNull())

        def section(s: Column, i: Column) -> Column:
            end = F.coalesce(F.get(s["starts"], i + 1), F.size(s["lines"]))
            start = F.get(s["starts"], i)
            return strip(F.array_join(F.slice(s["lines"], start + 1, end - start), "\n"))

        both = F.struct(own.alias("lines"), starts.alias("starts"))
        return let(both, lambda s: F.transform(s["starts"], lambda _, i: section(s, i)))

    return F.when(text == "", F.array(F.lit(""))).otherwise(let(lines(text), cut))


def windows(text: Column, size: int = SIZE, step: int = STEP) -> Column:
    """Overlapping windows; the last is the first that reaches the end."""
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(text, i * step + 1, F.lit(size)))


def is_degenerate(parts: Column, many: int = MANY, mean: int = MEAN) -> Column:
    """Too many too short sections, as tables give."""
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a + F.length(x))
    return (F.size(parts) >= many) & (total / F.size(parts) < mean)


def chunks(docs: DataFrame, key: str = "doc_id", text: str = "text", many: int = MANY, mean: int = MEAN) -> DataFrame:
    """key, chunk_ord, chunk. Texts that fall into degenerate sections are cut as they are."""
    own = F.coalesce(F.col(quoted(text)), F.lit(""))
    whole, parts = free_names(docs, "whole", "parts")
    cut_up = docs.select(key, own.alias(whole)).withColumn(parts, sections(F.col(whole)))
    raw = F.when(is_degenerate(F.col(parts), many, mean), F.array(whole)).otherwise(F.col(parts))
    cut = F.flatten(F.transform(raw, lambda x: windows(x)))
    kept = F.filter(cut, lambda x: F.length(strip(x)) >= SHORTEST)
    return cut_up.select(key, F.posexplode(kept).alias("chunk_ord", "chunk"))
