"""Rows as the pages show them: cards, history pages, taste shares, the user picker."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marquee.functions import display

PAGE_ROWS = 5
CARDS_SHOWN = 5


def recommendation_cards(recommended: DataFrame) -> DataFrame:
    """Title, year, genres and match of each recommendation; the first five are shown, the next five on demand, others later."""
    section = F.when(F.col("rank") <= CARDS_SHOWN, "shown").when(F.col("rank") <= 2 * CARDS_SHOWN, "more").otherwise("later")
    return recommended.select(
        "user_id",
        "rank",
        "movie_id",
        display.title_part(F.col("title")).alias("title"),
        display.year_part(F.col("title")).alias("year"),
        display.genre_text(F.col("genres"), 3).alias("genre_text"),
        display.match_percent(F.col("similarity")).alias("match_percent"),
        section.alias("section"),
    )


def history_pages(history: DataFrame, per_page: int = PAGE_ROWS) -> DataFrame:
    """Rated movies by page. A history is already cut to a number of rows per user."""
    rows = F.count("*").over(Window.partitionBy("user_id"))
    return history.select(
        "user_id",
        "position",
        (F.floor((F.col("position") - 1) / per_page) + 1).cast("bigint").alias("page"),
        F.ceil(rows / per_page).cast("bigint").alias("pages"),
        "movie_id",
        display.title_part(F.col("title")).alias("title"),
        display.meta_text(F.col("title"), F.col("genres"), 2).alias("meta"),
        display.one_decimal(F.col("rating")).alias("rating_text"),
    )


def taste_shares(distribution: DataFrame) -> DataFrame:
    """Each kept genre's slice of a full circle, in degrees; percentages need not add to 100."""
    share = F.greatest(F.lit(0.0), display.to_number(F.col("percentage")))
    user = Window.partitionBy("user_id")
    whole = F.sum("share").over(user)
    upto = F.sum("share").over(user.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sliced = distribution.withColumn("share", share).withColumn("whole", F.when(whole == 0, 1.0).otherwise(whole))
    return sliced.withColumn("upto", upto).select(
        "user_id",
        "rank",
        "genre",
        display.bar_percent(F.col("percentage")).alias("percent"),
        F.round((F.col("upto") - F.col("share")) / F.col("whole") * 360, 2).alias("start_degree"),
        F.round(F.col("upto") / F.col("whole") * 360, 2).alias("end_degree"),
    )


def movie_cards(found: DataFrame) -> DataFrame:
    return found.select(
        "movie_id",
        display.title_part(F.col("title")).alias("title"),
        display.year_part(F.col("title")).alias("year"),
        display.meta_text(F.col("title"), F.col("genres"), 3).alias("meta"),
    )


def user_picker(users: DataFrame) -> DataFrame:
    return users.select("user_id", F.format_string("User %d  ·  %d ratings", "user_id", "rating_count").alias("label"))


def health_cards(health: DataFrame) -> DataFrame:
    """Table sizes with thousands separators."""
    return health.select(
        *[display.grouped_number(F.col(c)).alias(c) for c in ("total_users", "total_movies", "total_ratings")], "index_status"
    )
