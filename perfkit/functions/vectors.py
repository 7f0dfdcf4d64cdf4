"""Vector expressions (F9, F10) as higher-order SQL functions, computed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sq_norm(v: Column) -> Column:
    """Sum of squares of an array, in double."""
    return F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def l2_normalize(v: Column) -> Column:
    """``v / ||v||``; a zero vector stays zero."""
    n = F.sqrt(sq_norm(v))
    return F.transform(v, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)))


def dot(a: Column, b: Column) -> Column:
    """inner product (= cosine for normalised inputs)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0).cast("double"), lambda acc, x: acc + x)
