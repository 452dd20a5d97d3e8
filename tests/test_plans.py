"""Shapes of physical plans: what must not be in them, and what must."""

import os
import time

import pytest
from pyspark.sql import functions as F

from marquee.operators.keyed import upsert
from marquee.operators.topk import top_k
from marquee.operators.order_stats import nearest_rank, order_statistics
from marquee.plans import catalog, evaluation, profiles, reports
from marquee.registry import QUERIES
from marquee.session import store_once
from marquee.sources.proxies import Proxies

SF = "/root/testdata/sf0.001"
# Building these fits a model; their frames are plain reads of what was stored.
FITTED = {"als_factors", "als_rmse", "als_ranking", "als_predictions", "training_pipeline"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - FITTED))
def test_no_query_pairs_all_rows(spark, with_conf, name):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "NestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["customer_predicted_ratings", "customer_rmse", "similarity_of_pairs"])
def test_tables_of_vectors_do_not_pass_through_the_driver(spark, with_conf, name):
    with_conf(spark__sql__autoBroadcastJoinThreshold="10m")
    text = plan(QUERIES[name](spark, SF))
    assert "SortMergeJoin [user_id" in text and "SortMergeJoin [movie_id" in text


def test_top_rows_per_user_are_cut_before_the_shuffle(spark):
    p = Proxies(spark, SF)
    for df in (profiles.history(p.ratings, p.movies), profiles.genre_distribution(p.ratings, p.movies)):
        text = plan(df)
        assert text.count("WindowGroupLimit") >= 2, text


def test_a_user_filter_reaches_the_scan_and_columns_are_pruned(spark, tmp_path):
    p = Proxies(spark, SF)
    p.ratings.write.parquet(str(tmp_path / "r"))
    p.movies.write.parquet(str(tmp_path / "m"))
    ratings, movies = spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "m"))
    text = plan(profiles.history(ratings, movies).filter("user_id = 7"))
    assert "EqualTo(user_id,7)" in text
    text = plan(profiles.stats(ratings, movies).filter("user_id = 7"))
    assert "EqualTo(user_id,7)" in text
    assert "rated_at" not in text and "title" not in text
    text = plan(catalog.trending(ratings, movies))
    assert "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<movie_id:int,rating:double>" in text


def test_ratings_are_counted_before_they_are_joined(spark, with_conf):
    with_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    p = Proxies(spark, SF)
    ratings = p.ratings_raw.select("user_id", "movie_id", "rating")
    text = plan(catalog.trending(ratings, p.movies))
    join = next(line for line in text.splitlines() if "SortMergeJoin" in line and "movie_id" in line)
    below = text[text.index(join) :]
    assert "HashAggregate" in below


def test_a_small_upsert_does_not_shuffle_the_table(spark, tmp_path):
    p = Proxies(spark, SF)
    p.ratings.write.parquet(str(tmp_path / "r"))
    existing = spark.read.parquet(str(tmp_path / "r"))
    incoming = existing.filter("user_id = 3").withColumn("rating", F.lit(1.0))
    merged = upsert(existing, incoming, ["user_id", "movie_id"])
    assert merged.columns == existing.columns
    text = plan(merged)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert merged.count() == existing.count()


SMALL_SKEW = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20000",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "40000",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__coalescePartitions__minPartitionSize": "1000",
}


def hot_ratings(spark):
    """A third of the rows on one movie."""
    hot = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 1000)
    return spark.range(0, 90_000, 1, 16).select(
        (F.col("id") % 9000).cast("int").alias("user_id"), hot.cast("int").alias("movie_id"), (F.col("id") % 5 + 1.0).alias("rating")
    )


def test_the_likes_of_a_hot_movie_are_cut_into_several_tasks(spark, with_conf):
    with_conf(**SMALL_SKEW)
    rated = hot_ratings(spark)
    pairs = evaluation.relevant_pairs(rated, spark.range(1000).selectExpr("cast(id as int) movie_id"))
    assert len(pairs.collect()) == rated.filter("rating >= 4").select("user_id", "movie_id").distinct().count()
    assert "skew=true" in plan(pairs)


def test_a_crowded_bucket_of_values_is_cut_into_several_tasks(spark, with_conf):
    with_conf(**SMALL_SKEW)
    # A third of the rows in one group and within one coarse bucket, all values distinct.
    crowded = F.when(F.col("id") % 3 == 0, 1000 + F.col("id") / 1e6).otherwise(F.col("id"))
    measures = spark.range(0, 90_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500).alias("g"), crowded.cast("double").alias("v")
    )
    found = order_statistics(measures, ["g"], "v", {"half": nearest_rank(0.5)})
    rows = {r["g"]: r["half"] for r in found.collect()}
    assert len(rows) == 500 and 1000 < rows[0] < 1001
    assert "skew=true" in plan(found)


def test_percentiles_read_their_input_once(spark, tmp_path):
    p = Proxies(spark, SF)
    p.latencies.write.parquet(str(tmp_path / "ms"))
    read = spark.sparkContext.accumulator(0)
    seen = spark.read.parquet(str(tmp_path / "ms")).rdd.map(lambda r: (read.add(1), r)[1]).toDF("user_id int, ms double")
    rows = p.latencies.count()
    for report in (reports.latency_summary, reports.latency_report):
        read.value = 0
        assert report(seen).count() > 0
        assert read.value == rows


def test_a_hot_movie_is_cut_into_several_tasks(spark, with_conf):
    with_conf(**SMALL_SKEW)
    rated = hot_ratings(spark)
    movies = spark.range(1000).selectExpr("cast(id as int) movie_id", "concat('t', id) title", "'A|B' genres")
    stats = profiles.stats(rated, movies)
    rows = stats.collect()
    assert sum(r["ratings_count"] for r in rows) == 90_000
    assert "skew=true" in stats._jdf.queryExecution().executedPlan().toString()


def test_the_scorer_needs_no_package_on_the_workers(spark):
    from pyspark import cloudpickle

    from marquee.operators import topk

    text = cloudpickle.dumps(topk._cell_scorer(3, "dot", False))
    assert b"_best_in_tile" in text


def test_a_user_block_is_scored_in_one_cell_per_item_block(spark):
    p = Proxies(spark, SF)
    text = plan(top_k(p.user_factors, p.movie_factors, 10))
    assert "FlatMapCoGroupsInArrow" in text
    assert "Broadcast" not in text
    assert "Window" not in text


def test_a_few_users_go_to_the_items(spark):
    p = Proxies(spark, SF)
    few = p.user_factors.filter("user_id < 5")
    text = plan(top_k(few, p.movie_factors, 10))
    assert "FlatMapCoGroupsInArrow" not in text and "MapInArrow" in text
    found = sorted(map(tuple, top_k(few, p.movie_factors, 10).collect()))
    assert found == sorted(tuple(r) for r in top_k(p.user_factors, p.movie_factors, 10).collect() if r["user_id"] < 5)
    assert top_k(p.user_factors.filter("user_id < 0"), p.movie_factors, 10).count() == 0


def test_genres_are_shuffled_before_they_are_counted(spark):
    """A task ahead of the shuffle would hold nearly every row as a group of its own."""
    ratings = spark.createDataFrame([(1, 1, 4.0), (1, 2, None), (2, 1, 3.5)], "user_id int, movie_id int, rating double")
    movies = spark.createDataFrame([(1, "a|b"), (2, "a")], "movie_id int, genres string")
    counted = profiles.genre_profile(ratings, movies)
    lines = counted._jdf.queryExecution().sparkPlan().toString().splitlines()
    steps = [line.strip(" :+-").split(" ")[0].split("(")[0] for line in lines]
    above = steps[: steps.index("Generate")]
    assert "Exchange" in above and "HashAggregate" not in above[above.index("Exchange") :]
    found = {(r["user_id"], r["genre"]): (r["movies"], r["scored"], r["tenths"]) for r in counted.collect()}
    assert found == {(1, "a"): (2, 1, 40), (1, "b"): (1, 1, 40), (1, None): (2, 1, 40), (2, "a"): (1, 1, 35), (2, "b"): (1, 1, 35), (2, None): (1, 1, 35)}


def test_stored_rows_leave_no_shuffle_files(spark):
    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())

    def shuffled() -> set[str]:
        return {name for folder in folders for _, _, names in os.walk(folder) for name in names if name.startswith("shuffle_")}

    before = shuffled()
    stored = store_once(spark.range(1000).groupBy((F.col("id") % 7).alias("rest")).agg(F.count("*").alias("n")), "counts")
    for _ in range(50):
        if shuffled() <= before:
            break
        time.sleep(0.2)
    assert shuffled() <= before
    assert stored.agg(F.sum("n")).first()[0] == 1000
