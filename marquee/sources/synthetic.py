"""Seeded vectors for tests and trial loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.operators.contracts import enforce, synthetic_check
from marquee.sources.files import read_factors
from marquee.sources.schemas import EMBEDDING_DIM

# A prime, so that products of two remainders stay within a long, and the constants of the rounds; fixed values that
# every engine that is to make the same vectors has to share.
PRIME = 2147483647
ROUNDS = (48271, 69621, 16807, 39373)


def synthetic_vector(id_column: Column, dim: int, seed: int) -> Column:
    """``dim`` floats spread evenly over [-1, 1], drawn from seed, id and position by whole-number arithmetic.

    There is no generator state, so a row is the same in any partitioning and in any SQL engine. Each round multiplies
    a number by itself plus a constant, modulo PRIME, so neighbouring ids and positions have nothing in common.
    """
    prime = F.lit(PRIME).cast("bigint")
    positions = F.sequence(F.lit(1).cast("bigint"), F.lit(dim).cast("bigint"))
    drawn = F.transform(positions, lambda j: (id_column.cast("bigint") * 7919 + j * 104729 + seed * 15485863) % prime)

    def mixed(constant: int):
        return lambda x: x * ((x + constant) % prime) % prime

    for constant in ROUNDS:
        drawn = F.transform(drawn, mixed(constant))
    return F.transform(drawn, lambda x: (x * 2.0 / float(PRIME) - 1.0).cast("float"))


def arithmetic_vector(id_column: Column, dim: int, seed: int) -> Column:
    """``dim`` floats in [-1, 1] from plain whole-number arithmetic, which any SQL engine can repeat."""
    modulus = F.lit(2147483647).cast("bigint")

    def draw(position: Column) -> Column:
        start = (id_column.cast("bigint") * 7919 + position * 104729 + seed * 15485863) % modulus
        step = (start * 48271 % modulus) * 69621 % modulus
        return (step * 2.0 / 2147483647.0 - 1.0).cast("float")

    return F.transform(F.sequence(F.lit(1).cast("bigint"), F.lit(dim).cast("bigint")), draw)


def with_synthetic_vectors(ids: DataFrame, dim: int, seed: int = 42) -> DataFrame:
    """(id, features): a synthetic vector for every id of a table."""
    if dim <= 0:
        raise ValueError("dim must be greater than zero")
    return ids.select(F.col("id").cast("int").alias("id"), synthetic_vector(F.col("id"), dim, seed).alias("features"))


def synthetic_factors(spark: SparkSession, records: int, dim: int, seed: int = 42) -> DataFrame:
    """Ids 1..records with a synthetic vector each."""
    if records <= 0:
        raise ValueError("records must be greater than zero")
    return with_synthetic_vectors(spark.range(1, records + 1), dim, seed)


def write_synthetic_pair(spark: SparkSession, out_dir: str, records: int = 50, dim: int = EMBEDDING_DIM) -> tuple[str, str]:
    """Store synthetic user and movie vectors, read them back and check them; gives the two paths."""
    paths = f"{out_dir}/user_factors.parquet", f"{out_dir}/movie_factors.parquet"
    for path, seed in zip(paths, (42, 43)):
        synthetic_factors(spark, records, dim, seed).write.mode("overwrite").parquet(path)
        enforce(synthetic_check(read_factors(spark, path, path, dim), records, dim, path))
    return paths
