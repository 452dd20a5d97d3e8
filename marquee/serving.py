"""The questions of the serving layer under one roof, for one user or for all of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.plans import catalog, pages, profiles, recommend, reports


class Serving:
    """Questions over the four published tables; each answer is a DataFrame.

    Leave ``user_id`` out to get the answer for all users at once.
    """

    def __init__(self, tables: dict[str, DataFrame]) -> None:
        self.movies = tables["movies"]
        self.ratings = tables["ratings"]
        self.user_factors = tables["user_factors"]
        self.movie_factors = tables["movie_factors"]

    def recommendations(self, user_id: int | None = None, top_n: int = 10) -> DataFrame:
        return recommend.recommendations(_only(self.user_factors, user_id), self.movie_factors, self.movies, top_n)

    def user_history(self, user_id: int | None = None, limit: int = 50) -> DataFrame:
        return profiles.history(_only(self.ratings, user_id), self.movies, limit).orderBy("user_id", "position")

    def user_stats(self, user_id: int | None = None) -> DataFrame:
        """An unknown user gets a row too: no ratings, no average, no genre."""
        if user_id is None:
            return profiles.stats(self.ratings, self.movies)
        asked = self.ratings.sparkSession.range(1).select(F.lit(user_id).cast("int").alias("user_id"))
        return profiles.stats(_only(self.ratings, user_id), self.movies, asked)

    def rating_count(self, user_id: int | None = None) -> DataFrame:
        return profiles.rating_counts(_only(self.ratings, user_id))

    def genre_distribution(self, user_id: int | None = None) -> DataFrame:
        return profiles.genre_distribution(_only(self.ratings, user_id), self.movies).orderBy("user_id", "rank")

    def trending_movies(self, limit: int = 10, min_ratings: int = 100) -> DataFrame:
        return catalog.trending(self.ratings, self.movies, limit, min_ratings)

    def search_movies(self, query: str | None = None, limit: int = 20, genre: str | None = None) -> DataFrame:
        return catalog.search(self.movies, query, limit, genre)

    def all_genres(self) -> DataFrame:
        return catalog.all_genres(self.movies)

    def movie_details(self, movie_id: int | None = None) -> DataFrame:
        return catalog.movie_details(self.movies, movie_id)

    def user_rating_for_movie(self, user_id: int, movie_id: int) -> DataFrame:
        """One row if the user rated the movie, else none."""
        rated = _only(self.ratings, user_id).filter(F.col("movie_id") == movie_id)
        return rated.select("user_id", "movie_id", F.col("rating").cast("double").alias("rating"))

    def explanation(self, user_id: int, movie_id: int, top_n: int = 3) -> DataFrame:
        spark = self.ratings.sparkSession
        pair = spark.range(1).select(F.lit(user_id).cast("int").alias("user_id"), F.lit(movie_id).cast("int").alias("movie_id"))
        reasons = recommend.explanations(pair, _only(self.ratings, user_id), self.movies, top_n)
        return reasons.orderBy("position")

    def explanations(self, pairs: DataFrame, top_n: int = 3, require_shared: bool = False) -> DataFrame:
        return recommend.explanations(pairs, self.ratings, self.movies, top_n, require_shared)

    def system_health(self) -> DataFrame:
        return reports.health(self.user_factors, self.movie_factors, self.ratings)

    def all_users(self, limit: int | None = 500) -> DataFrame:
        return profiles.all_users(self.user_factors, self.ratings, limit)

    def history_pages(self, user_id: int | None = None, limit: int = 50) -> DataFrame:
        return pages.history_pages(profiles.history(_only(self.ratings, user_id), self.movies, limit))

    def taste_shares(self, user_id: int | None = None) -> DataFrame:
        return pages.taste_shares(profiles.genre_distribution(_only(self.ratings, user_id), self.movies))

    def movie_cards(self, query: str | None = None, limit: int = 20, genre: str | None = None) -> DataFrame:
        return pages.movie_cards(self.search_movies(query, limit, genre))

    def user_picker(self, limit: int | None = 500) -> DataFrame:
        return pages.user_picker(self.all_users(limit))

    def health_cards(self) -> DataFrame:
        return pages.health_cards(self.system_health())

    def cards(self, user_id: int | None = None, top_n: int = 10) -> DataFrame:
        return pages.recommendation_cards(self.recommendations(user_id, top_n))


def _only(df: DataFrame, user_id: int | None) -> DataFrame:
    return df if user_id is None else df.filter(F.col("user_id") == user_id)
