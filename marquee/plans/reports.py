"""Table health and latency reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from marquee.operators.order_stats import floor_index, nearest_rank, order_statistics
from marquee.operators.quantile_sketch import bracketed_statistics
from marquee.session import store_once

# The percentiles reported.
PERCENTILES = {"p50_ms": 0.50, "p95_ms": 0.95, "p99_ms": 0.99}


def health(user_factors: DataFrame, movie_factors: DataFrame, ratings: DataFrame) -> DataFrame:
    """One row: table sizes, and whether there are item vectors to search."""
    tables = {"total_users": user_factors, "total_movies": movie_factors, "total_ratings": ratings}
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    wide = [F.max(F.when(F.col("name") == name, F.col("n"))).alias(name) for name in tables]
    status = F.when(F.col("total_movies") > 0, "present").otherwise("missing").alias("index_status")
    return reduce(DataFrame.unionAll, counts).agg(*wide).select(*tables, status)


def latency_summary(
    measures: DataFrame, group: str = "user_id", value: str = "ms", sketches: DataFrame | None = None
) -> DataFrame:
    """Per group: runs, and average and percentiles (element ``floor(n * p)``) to two decimals.

    Two decimals as a decimal number is written: 2.675 gives 2.68, though the double nearest to it is a little smaller.
    With ``sketches`` of the measures by group, or by day and group, only values close to a percentile leave their tasks.
    """
    ranks = {name: floor_index(p) for name, p in PERCENTILES.items()}
    if sketches is None:
        ranked = order_statistics(measures, [group], value, ranks, mean="avg_ms")
    else:
        ranked = bracketed_statistics(measures, [group], value, ranks, mean="avg_ms", sketches=sketches)
    return ranked.select(
        group,
        F.col("n").alias("runs"),
        # The first rounding takes away what summing doubles in another order would change.
        *[F.bround(F.round(name, 9), 2).alias(name) for name in ["avg_ms", *PERCENTILES]],
    )


def latency_report(
    measures: DataFrame, group: str = "user_id", value: str = "ms", sketches: DataFrame | None = None
) -> DataFrame:
    """One row over all measures: nearest-rank percentiles, average, number of groups and runs.

    With ``sketches`` of all measures, such as one a day, only values close to a percentile leave their tasks.
    """
    valued = measures.filter(F.col(value).isNotNull())
    ranks = {name: nearest_rank(p) for name, p in PERCENTILES.items()}
    if sketches is None:
        counted = store_once(valued.groupBy(group, value).agg(F.count("*").alias("times")), "measures")
        overall = order_statistics(counted, [], value, ranks, weight="times", mean="avg_ms")
        groups = counted.select(group).distinct().agg(F.count("*").alias("users_sampled"))
    else:
        overall = bracketed_statistics(valued, [], value, ranks, mean="avg_ms", sketches=sketches)
        groups = valued.select(group).distinct().agg(F.count("*").alias("users_sampled"))
    overall = overall.select(F.col("n").alias("total_runs"), "avg_ms", *PERCENTILES)
    long = _measures(overall).unionAll(_measures(groups))
    names = ["users_sampled", "total_runs", *PERCENTILES, "avg_ms"]
    wide = long.agg(*[F.max(F.when(F.col("name") == name, F.col("amount"))).alias(name) for name in names])
    whole = ("users_sampled", "total_runs")
    counts = {name: F.coalesce(F.col(name).cast("bigint"), F.lit(0).cast("bigint")).alias(name) for name in whole}
    return wide.select(*[counts.get(name, name) for name in names])


def of_users(measures: DataFrame, users: DataFrame) -> DataFrame:
    """The measures of some users, such as a sample."""
    return measures.join(users.select("user_id"), "user_id", "left_semi")


def _measures(one_row: DataFrame) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("amount")) for c in one_row.columns]
    return one_row.select(F.inline(F.array(*pairs)))
