"""A seeded sample of at most n rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sample_ids(df: DataFrame, id_column: str, at_most: int, seed: int = 42, draw: Column | None = None) -> DataFrame:
    """The ``at_most`` ids with the smallest draw. The draw is a hash of seed and id unless given."""
    draw = F.xxhash64(F.lit(seed), F.col(id_column)) if draw is None else draw
    return df.select(id_column).distinct().orderBy(draw, id_column).limit(at_most)


def arithmetic_draw(id_column: str, seed: int = 42) -> Column:
    """A draw that any SQL engine can repeat."""
    return (F.col(id_column).cast("bigint") * 7919 + seed) % 10007
