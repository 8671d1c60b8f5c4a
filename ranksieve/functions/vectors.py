"""Vector columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(doubles(v), F.lit(0.0), lambda a, x: a + x * x))


def dot(a: Column, b: Column) -> Column:
    """Over the length of the shorter one."""
    n = F.least(F.size(a), F.size(b))
    return F.aggregate(F.zip_with(F.slice(doubles(a), 1, n), F.slice(doubles(b), 1, n), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column, na: Column | None = None, nb: Column | None = None) -> Column:
    """0 where a norm is 0; norms made before may be given."""
    na, nb = norm(a) if na is None else na, norm(b) if nb is None else nb
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))
