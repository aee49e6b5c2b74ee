"""Vector expressions over ``array<float>`` columns, computed in double."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def literal(values: Sequence[float]) -> Column:
    """A constant vector."""
    return F.lit([float(v) for v in values])


def parse(text: Column, dim: int) -> Column:
    """``'[0.1, 0.2]'`` to a vector; null unless it has ``dim`` elements."""
    vector = F.from_json(text, "array<float>")
    return F.when(F.size(vector) == dim, vector)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def cosine_distance(a: Column, b: Column) -> Column:
    """``1 - cos(a, b)``. Null for a null or zero vector and when the lengths
    differ. Rounding may leave a copy of the same vector a hair below 0."""
    return 1.0 - dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def unit(a: Column) -> Column:
    """The vector scaled to length 1; null for a zero vector."""
    # As an array of one the length is computed once, not for each element.
    scaled = F.transform(
        F.array(norm(a)),
        lambda size: F.when(size > 0, F.transform(a, lambda x: (x / size).cast("float"))),
    )
    return F.get(scaled, F.lit(0))


def has_dim(a: Column, dim: int) -> Column:
    return F.coalesce(F.size(a) == dim, F.lit(False))


def has_direction(a: Column) -> Column:
    """Whether a vector has elements, all finite, and not all zero."""
    finite = F.forall(a, lambda x: F.coalesce((F.abs(x) < float("inf")) & ~F.isnan(x), F.lit(False)))
    return F.coalesce(finite & F.exists(a, lambda x: x != 0), F.lit(False))


def text_form(a: Column) -> Column:
    """The vector as text; tells -0.0 from 0.0, as value equality does not."""
    return a.cast("string")
