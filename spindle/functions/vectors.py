"""Vector ↔ array expressions (F4, F5, U1–U4) built on MLlib's JVM-side
converters, so no Python worker is involved."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vector_element(c: Column | str, i: int) -> Column:
    """Element ``i`` of an ML vector (e.g. P(class 1) from ``probability``)."""
    return vector_to_array(_c(c))[i]


def to_array(c: Column | str) -> Column:
    """Sparse or dense ML vector → ``array<double>``."""
    return vector_to_array(_c(c))


def to_dense_vector(c: Column | str) -> Column:
    """Any ML vector (or numeric array) → dense ML vector."""
    col = _c(c)
    return array_to_vector(col)


def densify(c: Column | str) -> Column:
    """Sparse vector → dense vector with the same values."""
    return array_to_vector(vector_to_array(_c(c)))


def numeric_array(*cols: str) -> Column:
    """Numeric columns → ``array<double>`` (the row-to-list step)."""
    return F.array(*[F.col(c).cast("double") for c in cols])


def array_sum(c: Column | str) -> Column:
    """Left-to-right sum of a numeric array."""
    return F.aggregate(_c(c), F.lit(0.0), lambda acc, x: acc + x)
