"""From raw files to stored clean tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from marquee.operators.cleaning import (
    min_support,
    movie_rejection,
    rating_rejection,
    rejections,
    typed_movies,
    typed_ratings,
)
from marquee.session import store_once
from marquee.sources.files import read_raw
from marquee.sources.sinks import write_clean


def run_cleaning(spark: SparkSession, raw_dir: str, out_dir: str, min_ratings: int = 10) -> tuple[str, str, DataFrame]:
    """Clean both raw tables and store them; gives the two paths and the row counts.

    The counts are (table, outcome, rows): rows dropped for each reason, rows kept by the
    cleaning, and rows stored, which for ratings are fewer by the items with little support.
    The text is parsed once: the counts are observed while the cleaned rows are written, and
    the support of the items is counted on those.
    """
    raw_movies, raw_ratings = read_raw(spark, raw_dir)
    sound_movies, seen_movies = _sound_rows(raw_movies, movie_rejection(), "movies")
    sound_ratings, seen_ratings = _sound_rows(raw_ratings, rating_rejection(), "ratings")
    ratings = store_once(typed_ratings(sound_ratings), "ratings")
    paths = write_clean(typed_movies(sound_movies), min_support(ratings, min_ratings), out_dir)

    rows = []
    for table, seen, path in zip(("movies", "ratings"), (seen_movies, seen_ratings), paths):
        rows += [(table, outcome, count) for outcome, count in seen.get.items() if count]
        rows.append((table, "stored", spark.read.parquet(path).count()))
    return *paths, spark.createDataFrame(rows, "table string, outcome string, rows bigint")


def _sound_rows(raw: DataFrame, rejection: Column, table: str) -> tuple[DataFrame, Observation]:
    """The usable rows, and the number of rows per outcome once an action has read them."""
    seen = Observation(table)
    counts = [F.count_if(F.col("_outcome") == outcome).alias(outcome) for outcome in ["kept", *rejections(table)]]
    judged = raw.withColumn("_outcome", F.coalesce(rejection, F.lit("kept"))).observe(seen, *counts)
    return judged.filter("_outcome = 'kept'").drop("_outcome"), seen
