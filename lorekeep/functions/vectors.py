"""Vector functions over ARRAY<FLOAT>, in double precision and without Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    zero = F.lit(0.0)
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), zero, lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, scale: str = "raw") -> Column:
    """Cosine similarity; null for a zero vector.  scale="unit" maps it from [-1, 1] to [0, 1]."""
    length = norm(a) * norm(b)
    c = F.when(length > 0, dot(a, b) / length)
    return c if scale == "raw" else (c + 1) / 2
