"""Vector expressions over array<double> columns (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector has zero length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def as_double_array(c: Column) -> Column:
    return F.transform(c, lambda x: x.cast("double"))
