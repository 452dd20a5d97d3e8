"""Item sets as bitmaps, one for each user and range of 32,768 ids.

A bitmap takes four kilobytes however many items it holds, is built by a map-side aggregate and never sorted; a user
with a million items is a row for each range. Sizes, unions and intersections are bit operations on rows of one range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def item_bitmaps(pairs: DataFrame, user_col: str = "user_id", item_col: str = "movie_id") -> DataFrame:
    """(user, range, items) of the distinct pairs; pairs without a user or an item are none."""
    sound = pairs.where(F.col(user_col).isNotNull() & F.col(item_col).isNotNull())
    placed = sound.select(
        F.col(user_col).alias("user_id"), F.bitmap_bucket_number(item_col).alias("range"), F.bitmap_bit_position(item_col).alias("position")
    )
    return placed.groupBy("user_id", "range").agg(F.bitmap_construct_agg("position").alias("items"))


def compared_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """(user_id, in_a, in_b, in_both, in_either) from two tables of bitmaps; users of either."""
    both = a.select("*", F.lit(1).alias("from_a")).unionByName(b.select("*", F.lit(0).alias("from_a")))
    ranges = both.groupBy("user_id", "range").agg(
        F.sum(F.when(F.col("from_a") == 1, F.bitmap_count("items")).otherwise(0)).alias("in_a"),
        F.sum(F.when(F.col("from_a") == 0, F.bitmap_count("items")).otherwise(0)).alias("in_b"),
        F.when(F.count("*") == 2, F.bitmap_count(F.bitmap_and_agg("items"))).otherwise(0).alias("in_both"),
        F.bitmap_count(F.bitmap_or_agg("items")).alias("in_either"),
    )
    return ranges.groupBy("user_id").agg(*[F.sum(c).alias(c) for c in ("in_a", "in_b", "in_both", "in_either")])
