"""Column functions on ``ARRAY<FLOAT|DOUBLE>`` vectors (no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda s, z: s + z)


def norm2(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(col_(a), lambda x: x.cast("double") * x.cast("double")),
                              F.lit(0.0).cast("double"), lambda s, z: s + z))


def l2_normalize(a) -> Column:
    """Unit-length vector; the zero vector stays zero."""
    n = norm2(a)
    return F.transform(col_(a), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def cosine(a, b) -> Column:
    """dot / (|a||b|); NULL when either vector is zero."""
    den = norm2(a) * norm2(b)
    return F.when(den > 0, dot(a, b) / den)


def sq_distance(a, b) -> Column:
    return F.aggregate(F.zip_with(col_(a), col_(b), lambda x, y: (x - y) * (x - y)),
                       F.lit(0.0).cast("double"), lambda s, z: s + z)


def distance(a, b) -> Column:
    return F.sqrt(sq_distance(a, b))
