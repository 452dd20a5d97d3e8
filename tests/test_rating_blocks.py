"""The fit by stored blocks beside MLlib's own, and what it leaves behind."""

import os

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import functions as F

from marquee.operators import rating_blocks
from marquee.operators.fold_in import fold_in
from marquee.operators.rating_blocks import RatingBlocks, gram_of, rows_of, vector_pages
from marquee.plans.training import AlsSettings, factor_tables, train_als

RATING = "user_id int, movie_id int, rating float"


@pytest.fixture(scope="module")
def ratings(spark):
    rng = np.random.default_rng(4)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 60, 900), rng.integers(0, 40, 900), rng.integers(-1, 6, 900))]
    # The same pair twice, a user with one rating, and one who likes nothing.
    return spark.createDataFrame([*rows, (1, 1, 4.0), (1, 1, 2.0), (70, 3, 5.0), (71, 4, 0.0)], RATING).cache()


def test_the_vectors_of_mllib_from_stored_tables(spark, ratings):
    als = ALS(userCol="user_id", itemCol="movie_id", ratingCol="rating", implicitPrefs=True, rank=6, maxIter=4, regParam=0.05, alpha=40.0, seed=42)
    own = als.fit(ratings)
    model = train_als(ratings, AlsSettings(rank=6, max_iter=4))
    for ours, theirs in zip(factor_tables(model), (own.userFactors, own.itemFactors)):
        ours, theirs = ({r[0]: np.array(r[1]) for r in df.collect()} for df in (ours, theirs))
        assert ours.keys() == theirs.keys()
        assert all(np.allclose(ours[i], theirs[i], atol=1e-5) for i in ours)
    assert model.userFactors.inputFiles() and model.itemFactors.inputFiles()
    # Nothing is left of the rounds.
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert not [name for name in os.listdir(folder) if name.startswith(("als-users", "als-items", "blocks"))]


def test_no_rounds_give_the_start_vectors(ratings):
    assert factor_tables(train_als(ratings, AlsSettings(rank=6, max_iter=0)))[0].count() == 62


@pytest.mark.parametrize("few", [1, 50])
def test_blocks_and_hot_keys_do_not_matter(spark, ratings, monkeypatch, few):
    monkeypatch.setattr(rating_blocks, "_FEW_BLOCKS", few)
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([(i, rng.normal(size=20).tolist()) for i in range(38)], "movie_id int, features array<double>")
    y = np.array([r["features"] for r in items.collect()])
    found = []
    for hot in (1000, 10):
        solved = RatingBlocks(ratings, "user_id", "movie_id", hot=hot).solve(vector_pages(items, "movie_id", "y"), y.T @ y, 0.1, 5.0, "solved", "<f8")
        rows = {r["key"]: r for r in rows_of(solved, "rows").collect()}
        x = np.array([r["features"] for r in rows.values()])
        assert np.allclose(gram_of(solved), x.T @ x)
        found.append(rows)
    assert found[0].keys() == found[1].keys()
    for key, row in found[0].items():
        assert row["ratings"] == found[1][key]["ratings"]
        assert np.allclose(row["features"], found[1][key]["features"], atol=1e-9)


@pytest.mark.parametrize("column", ["user_id", "movie_id", "rating"])
def test_a_rating_without_one_of_its_parts_is_refused(ratings, column):
    damaged = ratings.withColumn(column, F.when(F.col("user_id") == 5, None).otherwise(F.col(column)))
    with pytest.raises(Exception, match="(?i)null|number"):
        train_als(damaged, AlsSettings(rank=4, max_iter=1))


def test_a_fold_in_neither_joins_nor_shuffles_vectors(spark, ratings, monkeypatch):
    plans, stored = [], rating_blocks.store_pages

    def store(pages, name):
        plans.append(pages._jdf.queryExecution().executedPlan().toString())
        return stored(pages, name)

    monkeypatch.setattr(rating_blocks, "store_pages", store)
    rng = np.random.default_rng(6)
    items = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(38)], "movie_id int, features array<double>")
    users = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(60)], "user_id int, features array<double>")
    assert fold_in(ratings, items, own=users).where("residual IS NULL").count() == 2
    assert plans and not [text for text in plans if "Exchange" in text or "Join" in text]
