"""Cleaning of raw text tables, and the minimum support of an item."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marquee.operators.skew import ROWS_PER_TASK, semi_join_counted

# The patterns that a trimmed field must match, and the fill text.
WHOLE_NUMBER = r"^\d+$"
PLAIN_DECIMAL = r"^\d+(\.\d+)?$"
UNKNOWN = "Unknown"

_RATING_FIELDS = (
    ("userId", WHOLE_NUMBER, "int"),
    ("movieId", WHOLE_NUMBER, "int"),
    ("rating", PLAIN_DECIMAL, "float"),
)
_MOVIE_FIELDS = (("movieId", WHOLE_NUMBER, "int"),)


def _rejection(fields) -> Column:
    """Why a raw row is dropped, or null when it is kept. The first reason counts."""
    nulls = reduce(lambda a, b: a | b, [F.col(name).isNull() for name, _, _ in fields])
    reason = F.when(nulls, "null")
    for name, pattern, _ in fields:
        reason = reason.when(~F.trim(F.col(name)).rlike(pattern), f"malformed {name}")
    for name, _, kind in fields:
        reason = reason.when(F.trim(F.col(name)).try_cast(kind).isNull(), f"out of range {name}")
    return reason


def _usable(fields) -> Column:
    """True where ``_rejection`` gives no reason, said as a conjunction that can be taken apart and pushed down."""
    sound = [
        F.trim(F.col(name)).rlike(pattern) & F.trim(F.col(name)).try_cast(kind).isNotNull() for name, pattern, kind in fields
    ]
    return reduce(lambda a, b: a & b, sound)


def rejections(table: str) -> list[str]:
    """All reasons for which a row of a raw table may be dropped."""
    fields = {"movies": _MOVIE_FIELDS, "ratings": _RATING_FIELDS}[table]
    return ["null", *[f"{fault} {name}" for fault in ("malformed", "out of range") for name, _, _ in fields]]


def movie_rejection() -> Column:
    return _rejection(_MOVIE_FIELDS)


def rating_rejection() -> Column:
    return _rejection(_RATING_FIELDS)


def _typed(fields) -> list[Column]:
    return [F.trim(F.col(name)).try_cast(kind).alias(name) for name, _, kind in fields]


def clean_movies(raw: DataFrame) -> DataFrame:
    """Rows with a usable id, typed; a missing title or genre list reads ``Unknown``."""
    return typed_movies(raw.filter(_usable(_MOVIE_FIELDS)))


def clean_ratings(raw: DataFrame) -> DataFrame:
    """Rows with usable ids and rating, typed; an unusable time becomes null and keeps its row."""
    return typed_ratings(raw.filter(_usable(_RATING_FIELDS)))


def typed_movies(sound: DataFrame) -> DataFrame:
    """The columns of a clean movie from raw rows that are known to be usable."""
    texts = [F.coalesce(F.col(name).cast("string"), F.lit(UNKNOWN)).alias(name) for name in ("title", "genres")]
    return sound.select(*_typed(_MOVIE_FIELDS), *texts)


def typed_ratings(sound: DataFrame) -> DataFrame:
    """The columns of a clean rating from raw rows that are known to be usable."""
    time = F.trim(F.col("timestamp").cast("string")).try_cast("bigint").alias("timestamp")
    return sound.select(*_typed(_RATING_FIELDS), time)


def cleaning_counts(raw: DataFrame, rejection: Column, table: str) -> DataFrame:
    """Rows kept and rows dropped for each reason, in one pass: (table, outcome, rows)."""
    outcome = F.coalesce(rejection, F.lit("kept")).alias("outcome")
    return raw.groupBy(outcome).agg(F.count("*").alias("rows")).select(F.lit(table).alias("table"), "outcome", "rows")


def null_counts(df: DataFrame, table: str) -> DataFrame:
    """Null values of every column, in one pass: (table, column, nulls)."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in df.columns])
    pairs = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).alias("nulls")) for name in df.columns])
    return counts.select(F.lit(table).alias("table"), F.inline(pairs))


def item_support(ratings: DataFrame, item: str = "movieId") -> DataFrame:
    """Rows per item, duplicates included."""
    return ratings.groupBy(item).agg(F.count("*").alias("support"))


def min_support(
    ratings: DataFrame, min_ratings: int = 10, item: str = "movieId", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Ratings of the items that have at least ``min_ratings`` rows."""
    supported = item_support(ratings, item).filter(F.col("support") >= min_ratings)
    return semi_join_counted(ratings, supported, item, "support", rows_per_task)
