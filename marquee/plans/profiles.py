"""What a user has rated: history, statistics, genre shares, counts.

Each question is answered for all users; a filter on ``user_id`` reaches the scan by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marquee.functions.exact import average_from_tenths, tenths, whole_percent
from marquee.functions.genres import genre_list

# A user with fewer ratings is new: recommendations come with a warning.
COLD_START_BELOW = 5


def history(ratings: DataFrame, movies: DataFrame, limit: int = 50) -> DataFrame:
    """The newest ``limit`` rated movies per user, ``position`` 1 being the newest."""
    newest = Window.partitionBy("user_id").orderBy(F.desc_nulls_last("rated_at"), "movie_id")
    # Only ids meet before the cut; the texts join the few rows that are left.
    rated = ratings.join(movies.select("movie_id"), "movie_id", "left_semi").select("user_id", "movie_id", "rating", "rated_at")
    kept = rated.withColumn("position", F.row_number().over(newest)).filter(F.col("position") <= limit)
    return kept.join(movies, "movie_id").select("user_id", "movie_id", "title", "genres", "rating", "rated_at", "position")


def genre_profile(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Per user and genre: rated movies and the sum of their ratings in tenths.

    A null genre stands for all of the user's rated movies, so one scan and one join
    serve both the totals and the genres. The rows are shuffled before they are counted: a
    task in front of the shuffle holds movies, not users, so hardly two of its rows share a
    key, and counts kept there would fill its memory without saving anything.
    """
    rated = ratings.join(movies, "movie_id").select("user_id", tenths(F.col("rating")).alias("tenths"), "genres")
    everything = F.array(F.lit(None).cast("string"))
    genres = F.concat(F.coalesce(genre_list(F.col("genres")), F.array().cast("array<string>")), everything)
    long = rated.select("user_id", "tenths", F.explode(genres).alias("genre"))
    return long.repartition("user_id", "genre").groupBy("user_id", "genre").agg(
        F.count("*").alias("movies"), F.count("tenths").alias("scored"), F.sum("tenths").alias("tenths")
    )


def stats(ratings: DataFrame, movies: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Number of ratings, average score and commonest genre per user.

    With ``users``, everyone there gets a row; without ratings it reads 0, null, null.
    """
    profile = genre_profile(ratings, movies)
    total = F.col("genre").isNull()
    per_user = profile.groupBy("user_id").agg(
        F.max(F.when(total, F.col("movies"))).alias("ratings_count"),
        F.max(F.when(total, F.col("scored"))).alias("scored"),
        F.max(F.when(total, F.col("tenths"))).alias("tenths"),
        F.min(F.when(~total, F.struct(-F.col("movies"), F.col("genre")))).alias("top"),
    )
    if users is not None:
        per_user = users.select("user_id").join(per_user, "user_id", "left")
    return per_user.select(
        "user_id",
        F.coalesce("ratings_count", F.lit(0)).cast("bigint").alias("ratings_count"),
        average_from_tenths(F.col("tenths"), F.col("scored")).alias("avg_score"),
        F.col("top.genre").alias("top_affinity"),
    )


def genre_distribution(ratings: DataFrame, movies: DataFrame, top: int = 5) -> DataFrame:
    """The ``top`` commonest genres per user, each with the share of the user's rated movies that have it."""
    ranked = Window.partitionBy("user_id").orderBy(F.col("genre").isNotNull(), F.desc("movies"), "genre")
    # The row of the totals comes first, so the top + 1 rows hold all that is needed.
    best = genre_profile(ratings, movies).withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= top + 1)
    total = F.max(F.when(F.col("genre").isNull(), F.col("movies"))).over(Window.partitionBy("user_id"))
    shares = best.withColumn("total", total).filter(F.col("genre").isNotNull())
    return shares.select(
        "user_id",
        "genre",
        F.col("movies").alias("genre_count"),
        whole_percent(F.col("movies"), F.col("total")).alias("percentage"),
        (F.col("place") - 1).alias("rank"),
    )


def rating_counts(ratings: DataFrame) -> DataFrame:
    """Ratings per user, with or without a catalogue entry, and whether that is too few."""
    counted = ratings.groupBy("user_id").agg(F.count("*").alias("rating_count"))
    return counted.withColumn("cold_start", F.col("rating_count") < COLD_START_BELOW)


def all_users(user_factors: DataFrame, ratings: DataFrame, limit: int | None = 500) -> DataFrame:
    """Users with a vector and their number of ratings, by id.

    Ratings are counted before the join, so a busy user joins as one row.
    """
    counted = ratings.groupBy("user_id").agg(F.count("*").alias("rating_count"))
    users = user_factors.select("user_id").join(counted, "user_id", "left")
    users = users.select("user_id", F.coalesce("rating_count", F.lit(0)).cast("bigint").alias("rating_count"))
    return users if limit is None else users.orderBy("user_id").limit(limit)


def ratings_for_pairs(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """The rating each (user, movie) pair got, null where there is none."""
    known = ratings.select("user_id", "movie_id", F.col("rating").cast("double").alias("rating"))
    return pairs.select("user_id", "movie_id").join(known, ["user_id", "movie_id"], "left")
