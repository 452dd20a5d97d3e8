"""Arithmetic on array columns, summed in double precision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """1 minus the cosine distance; null when either vector has length zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def is_vector(a: Column, dim: int) -> Column:
    """True for an array of exactly ``dim`` numbers, none of them null or NaN."""
    sound = (F.size(a) == dim) & F.forall(a, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")))
    return F.coalesce(a.isNotNull() & sound, F.lit(False))


def vector_text(a: Column, dim: int) -> Column:
    """``[v1,v2,...]``, the text form a vector store takes; anything but ``dim`` numbers raises."""
    text = F.concat(F.lit("["), F.array_join(F.transform(a, lambda x: x.cast("double").cast("string")), ","), F.lit("]"))
    return F.when(is_vector(a, dim), text).otherwise(
        F.raise_error(F.lit(f"expected a vector of {dim} numbers")).cast("string")
    )


def unbroadcast(vectors: DataFrame) -> DataFrame:
    """The same rows, joined by a shuffle. Spark counts an array as one element, so its size check takes a table of vectors
    for a small fraction of what it is, and would send all of it through the driver."""
    return vectors.hint("merge")
