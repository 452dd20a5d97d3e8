"""Readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.operators.contracts import Contract, ContractError, check, enforce, schema_problems
from marquee.session import store_once
from marquee.sources import schemas


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """CSV with a header, every column text; quotes inside a field are doubled."""
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def read_sound_lines(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """The rows of a CSV file whose lines have all fields, and the other lines as they are, (line).

    Lines with fewer or more fields, or a quote that is never closed, are set aside instead of being filled up or cut. The
    file is parsed once and stored.
    """
    marked = StructType([*schema.fields, StructField("_line", StringType())])
    options = {"header": header, "escape": '"', "columnNameOfCorruptRecord": "_line", "columnPruning": False}
    rows = store_once(spark.read.schema(marked).options(**options).csv(path), "lines")
    return rows.where("_line IS NULL").drop("_line"), rows.where("_line IS NOT NULL").select(F.col("_line").alias("line"))


def read_raw(spark: SparkSession, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    """The raw movies and ratings of a folder."""
    movies = read_csv(spark, f"{raw_dir}/movies.csv", schemas.RAW_MOVIES)
    return movies, read_csv(spark, f"{raw_dir}/ratings.csv", schemas.RAW_RATINGS)


def read_checked(spark: SparkSession, path: str, name: str, required: Sequence[str], key: Sequence[str] | str) -> DataFrame:
    """A Parquet table that has the columns, is not empty and holds each key once, never null."""
    keys = (key,) if isinstance(key, str) else tuple(key)
    return checked(spark.read.parquet(path), Contract(name, tuple(required), keys))


def checked(df: DataFrame, contract: Contract) -> DataFrame:
    problems = schema_problems(df, contract)
    if problems:
        raise ContractError(f"{contract.table}: {', '.join(problems)}")
    enforce(check(df, contract))
    return df


def factor_layout(df: DataFrame) -> DataFrame:
    """Factor columns under one set of names: ``id`` and ``features``."""
    names = {"embedding": "features"}
    names["userId" if "userId" in df.columns else "movieId"] = "id"
    return df.withColumnsRenamed(names)


def read_factors(spark: SparkSession, path: str, name: str, dim: int = schemas.EMBEDDING_DIM) -> DataFrame:
    """A factor table in any accepted layout, checked: ids unique, vectors present and ``dim`` long."""
    factors = factor_layout(spark.read.parquet(path))
    contract = Contract(
        name, ("id", "features"), ("id",), not_null=("features",), integer=("id",), vectors={"features": dim}
    )
    return checked(factors, contract).select("id", "features")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
