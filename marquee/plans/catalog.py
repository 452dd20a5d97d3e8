"""The movie catalogue: trending, search, genres, details."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.functions.exact import average_from_tenths, tenths
from marquee.functions.genres import genre_list
from marquee.operators.text_index import TextIndex


def trending(ratings: DataFrame, movies: DataFrame, limit: int = 10, min_ratings: int = 100) -> DataFrame:
    """Movies with at least ``min_ratings`` ratings, by rounded average, then count, then id.

    Ratings are summed per movie before the join: however hot a movie, it joins as one row.
    """
    per_movie = (
        ratings.groupBy("movie_id")
        .agg(F.sum(tenths(F.col("rating"))).alias("total"), F.count("rating").alias("rating_count"))
        .filter(F.col("rating_count") >= min_ratings)
    )
    average = average_from_tenths(F.col("total"), F.col("rating_count")).alias("avg_rating")
    joined = per_movie.join(movies, "movie_id").select("movie_id", "title", "genres", average, "rating_count")
    return joined.orderBy(F.desc("avg_rating"), F.desc("rating_count"), "movie_id").limit(limit)


def search(movies: DataFrame, query: str | None = None, limit: int = 20, genre: str | None = None) -> DataFrame:
    """Movies whose title, and genre list if asked, contain a text in any case; all without a text.

    ``%`` and ``_`` in the texts are wildcards.
    """
    found = movies.select("movie_id", "title", "genres")
    for column, text in (("title", query), ("genres", genre)):
        if text:
            found = found.filter(F.col(column).ilike(f"%{text}%"))
    return found.orderBy("title", "movie_id").limit(limit)


def search_indexed(index: TextIndex, query: str | None = None, limit: int = 20, genre: str | None = None) -> DataFrame:
    """The same movies as ``search``, through the stored trigrams of an index over them."""
    found = index.matching({"title": query, "genres": genre}).select("movie_id", "title", "genres")
    return found.orderBy("title", "movie_id").limit(limit)


def all_genres(movies: DataFrame) -> DataFrame:
    return movies.select(F.explode(genre_list(F.col("genres"))).alias("genre")).distinct().orderBy("genre")


def movie_details(movies: DataFrame, movie_id: int | None = None) -> DataFrame:
    found = movies.select("movie_id", "title", "genres")
    return found if movie_id is None else found.filter(F.col("movie_id") == movie_id)
