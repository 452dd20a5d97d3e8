"""Recommendations and the reasons shown with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions.genres import WORD, genre_list, genre_mask, genres_in_mask
from marquee.functions.vectors import unbroadcast
from marquee.operators.topk import top_k


def recommendations(
    users: DataFrame, items: DataFrame, movies: DataFrame, top_n: int = 10, exclude: DataFrame | None = None
) -> DataFrame:
    """The ``top_n`` nearest movies per user by cosine, best first.

    Movies are joined after the cut, so an item without a catalogue entry leaves a gap.
    Rated movies stay in unless given as ``exclude``.
    """
    return with_movies(top_k(users, items, top_n, "cosine", exclude), movies)


def with_movies(best: DataFrame, movies: DataFrame) -> DataFrame:
    named = best.join(movies, "movie_id")
    return named.select("user_id", "rank", "movie_id", "title", "genres", F.col("score").alias("similarity"))


def _best_first() -> list[Column]:
    return [F.desc("rating"), F.desc_nulls_last("rated_at"), F.col("movie_id")]


def liked_most(ratings: DataFrame, movies: DataFrame, top_n: int = 3, threshold: float = 4.0) -> DataFrame:
    """Each user's best rated movies, by id: rating, then newest, then id."""
    best = Window.partitionBy("user_id").orderBy(*_best_first())
    liked = ratings.filter(F.col("rating") >= threshold).join(unbroadcast(movies.select("movie_id")), "movie_id", "left_semi")
    return liked.withColumn("position", F.row_number().over(best)).filter(F.col("position") <= top_n)


def genre_masks(movies: DataFrame) -> tuple[list[str], DataFrame]:
    """The genres there are, in order, and (movie_id, codes, mask) of every movie; null without a genre list.

    The dictionary holds each name once, so it grows with the kinds of genres and not with the movies.
    """
    listed = movies.select("movie_id", F.array_distinct(genre_list(F.col("genres"))).alias("names"))
    dictionary = sorted(r[0] for r in listed.select(F.explode("names")).distinct().collect())
    names = F.array(*[F.lit(g) for g in dictionary]).cast("array<string>")
    codes = F.array_sort(F.transform("names", lambda g: (F.array_position(names, g) - 1).cast("int")))
    coded = listed.select("movie_id", codes.alias("codes"))
    words = max(1, -(-len(dictionary) // WORD))
    return dictionary, coded.withColumn("mask", F.when(F.col("codes").isNotNull(), genre_mask(F.col("codes"), words)))


def explanations(
    pairs: DataFrame,
    ratings: DataFrame,
    movies: DataFrame,
    top_n: int = 3,
    require_shared: bool = False,
    threshold: float = 4.0,
) -> DataFrame:
    """For each (user, recommended movie) pair: movies the user liked and the genres they share with it.

    The best rated movies are taken whether or not a genre is shared, and the recommended
    movie may be among them. With ``require_shared`` only movies that share a genre count.
    Pairs meet as ids and genre masks; titles and names join the rows that are left.
    """
    dictionary, masks = genre_masks(movies)
    wanted = masks.select(F.col("movie_id").alias("target_id"), F.col("codes").alias("target_codes"), F.col("mask").alias("target_mask"))
    # Like vectors, codes and masks are arrays, of which Spark's size check counts one element.
    target = pairs.select("user_id", F.col("movie_id").alias("target_id")).join(unbroadcast(wanted), "target_id", "left")
    if require_shared:
        joined = _best_sharing(target, ratings, masks, top_n, threshold)
    else:
        # The liked movies do not depend on the target: cut to top_n before the pairs multiply them.
        liked = liked_most(ratings, movies, top_n, threshold).join(unbroadcast(masks.select("movie_id", "codes")), "movie_id")
        joined = target.drop("target_codes").join(liked, "user_id")
    shared = genres_in_mask(F.col("codes"), F.col("target_mask"), dictionary).alias("shared_genres")
    found = joined.select("user_id", "target_id", "position", "movie_id", F.col("rating").cast("double").alias("rating"), "codes", "target_mask")
    found = found.join(unbroadcast(movies.select("movie_id", "title")), "movie_id")
    return found.select("user_id", "target_id", "position", "movie_id", "title", "rating", shared)


def _best_sharing(target: DataFrame, ratings: DataFrame, masks: DataFrame, top_n: int, threshold: float) -> DataFrame:
    """The best ``top_n`` liked movies per pair among those that share a genre.

    Each of them is among the best ``top_n`` of a genre it shares, so that many per user and
    genre are enough to choose from and a long history never meets all the user's targets.
    """
    liked = ratings.filter(F.col("rating") >= threshold).join(unbroadcast(masks), "movie_id")
    by_genre = liked.select("user_id", "movie_id", "rating", "rated_at", "codes", F.explode("codes").alias("genre"))
    in_genre = Window.partitionBy("user_id", "genre").orderBy(*_best_first())
    best = by_genre.withColumn("_place", F.row_number().over(in_genre)).filter(F.col("_place") <= top_n)
    wanted = target.select("user_id", "target_id", "target_mask", F.explode("target_codes").alias("genre"))
    met = wanted.join(best, ["user_id", "genre"]).drop("genre", "_place").distinct()
    in_pair = Window.partitionBy("user_id", "target_id").orderBy(*_best_first())
    return met.withColumn("position", F.row_number().over(in_pair)).filter(F.col("position") <= top_n)
