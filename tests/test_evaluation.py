import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RankingEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from marquee.functions import ranking
from marquee.operators.contracts import ContractError, check_factors
from marquee.plans import evaluation, training
from marquee.sources.sinks import write_factors

RATING = "user_id int, movie_id int, rating double"


@pytest.fixture(scope="module")
def ratings(spark):
    """Ten users who all rate items 1, 2 and 3."""
    data = [(u, m, 1.0 + (u * m) % 5) for u in range(1, 11) for m in (1, 2, 3)]
    return spark.createDataFrame(data, RATING)


@pytest.fixture(scope="module")
def model(ratings):
    return training.train_als(ratings, training.AlsSettings(rank=5, max_iter=3, reg_param=0.1))


def lists(spark, rows):
    return spark.createDataFrame(rows, "recs array<int>, rel array<int>, train array<int>")


def test_list_metrics_by_hand(spark):
    rows = [
        ([10, 20, 30, 40], [20], []),
        ([10, 20, 30], [10, 20, 30], []),
        ([10, 20, 30], [20], None),
        ([1, 2, 3, 4, 5], [4, 5, 9, 8], [1, 2, 3]),
        ([1, 2], [], []),
        ([], [1], []),
    ]
    recs, rel, train = F.col("recs"), F.col("rel"), F.col("train")
    df = lists(spark, rows).select(
        ranking.ndcg_at(recs, rel, train, 10).alias("ndcg"),
        ranking.precision_at(recs, rel, train, 10).alias("precision"),
        ranking.hit_at(recs, rel, train, 10).alias("hit"),
        ranking.recall_at(recs, rel, train, 10).alias("recall"),
    )
    got = [tuple(r) for r in df.collect()]
    second = 1 / math.log2(3)
    partial = (1 + second) / sum(1 / math.log2(i + 1) for i in range(1, 5))
    assert got[0] == pytest.approx((0.63093, 0.1, 1.0, 1.0), abs=1e-5)
    assert got[1] == pytest.approx((1.0, 0.3, 1.0, 1.0))
    assert got[2] == pytest.approx((second, 0.1, 1.0, 1.0))
    assert got[3] == pytest.approx((partial, 0.2, 1.0, 0.5))
    assert got[4] == (0.0, 0.0, 0.0, None)
    assert got[5] == (0.0, 0.0, 0.0, 0.0)


def factors(spark, seed, count, name):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(1, count + 1)]
    return spark.createDataFrame(rows, f"{name} int, features array<float>")


@pytest.fixture(scope="module")
def setting(spark):
    """Users, items and train and test pairs; some users or items are in one table only."""
    rng = np.random.default_rng(3)
    users, items = factors(spark, 1, 30, "user_id"), factors(spark, 2, 60, "movie_id")
    pairs = [(int(u), int(i)) for u in range(1, 34) for i in rng.choice(np.arange(1, 70), 20, replace=False)]
    rated = [(u, i, float(rng.integers(1, 11)) / 2) for u, i in pairs]
    train = spark.createDataFrame([r for n, r in enumerate(rated) if n % 3], RATING)
    test = spark.createDataFrame([r for n, r in enumerate(rated) if n % 3 == 0], RATING)
    return users, items, train, test


def test_metrics_agree_with_sorting_by_hand(setting):
    users, items, train, test = setting
    vectors = {r["user_id"]: np.array(r["features"]) for r in users.collect()}
    matrix = {r["movie_id"]: np.array(r["features"]) for r in items.collect()}
    seen, liked = {}, {}
    for r in train.collect():
        seen.setdefault(r["user_id"], set()).add(r["movie_id"])
    for r in test.collect():
        if r["rating"] >= 4.0 and r["movie_id"] in matrix:
            liked.setdefault(r["user_id"], set()).add(r["movie_id"])
    per_user = {r["user_id"]: r for r in evaluation.user_metrics(users, items, train, test, k=10).collect()}
    assert per_user.keys() == vectors.keys() & liked.keys()
    for user, row in per_user.items():
        ranked = sorted((i for i in matrix if i not in seen.get(user, ())), key=lambda i: (-float(vectors[user] @ matrix[i]), i))[:10]
        hits = [rank for rank, i in enumerate(ranked, 1) if i in liked[user]]
        ideal = sum(1 / math.log2(i + 1) for i in range(1, min(10, len(liked[user])) + 1))
        assert row["hits"] == len(hits) and row["relevant"] == len(liked[user])
        assert row["precision"] == pytest.approx(len(hits) / 10)
        assert row["recall"] == pytest.approx(len(hits) / len(liked[user]))
        assert row["hit"] == float(bool(hits))
        assert row["ndcg"] == pytest.approx(sum(1 / math.log2(r + 1) for r in hits) / ideal)
    assert any(r["hits"] for r in per_user.values())


@pytest.mark.parametrize("metric", ["dot", "cosine"])
def test_only_contenders_are_ranked_on_all_items(setting, spark, metric):
    users, items, train, _ = setting
    everyone = users.select("user_id", F.lit(1).alias("movie_id"))
    ranked = evaluation.ranked_for_evaluation(users, items, train, everyone, 60, metric).collect()
    rank = {r["user_id"]: 3 if r["user_id"] < 8 else 35 for r in ranked}
    pairs = [(r["user_id"], r["movie_id"]) for r in ranked if r["rank"] == rank[r["user_id"]]]
    relevant = spark.createDataFrame(pairs, "user_id int, movie_id int")
    hit = {u for u, _ in pairs if u < 8}
    kept = {r["user_id"] for r in evaluation.contenders(users, items, train, relevant, 3, metric, probed=20).collect()}
    assert len(hit) == 7 and hit <= kept and len(kept) < 20


def test_ties_and_short_lists_stay_contenders(spark):
    users = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0])], "user_id int, features array<float>")
    items = spark.createDataFrame([(i, [0.1, float(i)]) for i in range(40)], "movie_id int, features array<float>")
    train = spark.createDataFrame([], RATING)
    relevant = spark.createDataFrame([(1, 39), (2, 39)], "user_id int, movie_id int")
    for k in (3, 30):
        for metric in ("dot", "cosine"):
            kept = {r["user_id"] for r in evaluation.contenders(users, items, train, relevant, k, metric, probed=10).collect()}
            assert kept == ({1, 2} if metric == "dot" or k == 30 else {2})


def test_metrics_agree_with_mllib(setting):
    users, items, train, test = setting
    relevant = evaluation.relevant_pairs(test, items)
    ranked = evaluation.ranked_for_evaluation(users, items, train, relevant, 10)
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("rank", "movie_id"))), lambda x: x["movie_id"].cast("double"))
    joined = ranked.groupBy("user_id").agg(in_order.alias("prediction")).join(
        relevant.groupBy("user_id").agg(F.collect_set(F.col("movie_id").cast("double")).alias("label")), "user_id"
    )
    means = evaluation.mean_metrics(evaluation.user_metrics(users, items, train, test, k=10)).first()
    for name, mllib in (("precision", "precisionAtK"), ("recall", "recallAtK"), ("ndcg", "ndcgAtK")):
        assert means[name] == pytest.approx(RankingEvaluator(metricName=mllib, k=10).evaluate(joined))
    assert means["precision"] <= means["hit_rate"] <= 1


def test_nobody_to_evaluate(spark, setting):
    users, items, train, test = setting
    means = evaluation.mean_metrics(evaluation.user_metrics(users, items, train, test.filter("rating < 4"))).first()
    assert tuple(means) == (0.0, 0.0, 0.0, 0.0, 0)


def test_a_user_with_nothing_left_counts_with_zero(spark):
    users, items = factors(spark, 1, 1, "user_id"), factors(spark, 2, 3, "movie_id")
    train = spark.createDataFrame([(1, i, 5.0) for i in (1, 2, 3)], RATING)
    test = spark.createDataFrame([(1, 2, 5.0)], RATING)
    row = evaluation.user_metrics(users, items, train, test).first()
    assert (row["relevant"], row["hits"], row["precision"], row["ndcg"]) == (1, 0, 0.0, 0.0)


def test_rmse(spark, setting):
    users, items, _, test = setting
    predictions = evaluation.predict(test, users, items)
    wanted = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(predictions)
    assert evaluation.rmse(predictions).first()["rmse"] == pytest.approx(wanted)
    assert tuple(evaluation.rmse(predictions.filter("1 = 0")).first()) == (None, 0)


def test_item_sets_are_chunked(spark):
    pairs = spark.createDataFrame([(1, m) for m in (9, 1, 5, 9, 12)] + [(2, 3)], "user_id int, movie_id int")
    sets = {(r["user_id"], r["chunk"]): r["items"] for r in evaluation.item_sets(pairs, 10).collect()}
    assert sets == {(1, 0): [1, 5, 9], (1, 1): [12], (2, 0): [3]}


def test_als(ratings, model):
    users, items = training.factor_tables(model)
    check_factors(users, items, 5)
    with pytest.raises(ContractError, match="vector length"):
        check_factors(users, items, 6)
    assert training.vector_lengths(users).collect() == [(5, 10)]
    assert [dict(df.dtypes)["features"] for df in (users, items)] == ["array<float>"] * 2
    ours = {(r["user_id"], r["movie_id"]): r["prediction"] for r in evaluation.predict(ratings, users, items).collect()}
    theirs = {(r["user_id"], r["movie_id"]): r["prediction"] for r in model.transform(ratings).collect()}
    assert ours.keys() == theirs.keys()
    assert all(ours[pair] == pytest.approx(theirs[pair], abs=1e-5) for pair in ours)
    again = training.train_als(ratings, training.AlsSettings(rank=5, max_iter=3, reg_param=0.1))
    same = training.factor_tables(again)[0].join(users.withColumnRenamed("features", "f"), "user_id")
    assert same.filter("features <> f").count() == 0


def test_cold_rows_are_dropped(spark, model):
    cold = spark.createDataFrame([(99, 1, 3.0), (1, 99, 3.0), (1, 1, 3.0)], RATING)
    assert evaluation.predict(cold, *training.factor_tables(model)).count() == 1


def test_export(spark, model, tmp_path):
    users, items = training.factor_tables(model)
    paths = write_factors(users, items, str(tmp_path), 5)
    assert [spark.read.parquet(p).columns for p in paths] == [["userId", "features"], ["movieId", "features"]]
    with pytest.raises(ContractError):
        write_factors(users.limit(1), items, str(tmp_path), 50)
    assert spark.read.parquet(paths[0]).count() == 10


def test_training_from_files(spark, tmp_path):
    rng = np.random.default_rng(0)
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "movies.csv").write_text("movieId,title,genres\n1,A,X\n")
    # Two groups of users with different tastes.
    lines = [f"{u},{m},{5.0 if (u + m) % 2 == 0 else 1.0},{u}" for u in range(60) for m in range(40) if rng.random() < 0.5 and (u + m) % 2 == 0]
    (tmp_path / "raw" / "ratings.csv").write_text("userId,movieId,rating,timestamp\n" + "\n".join(lines) + "\n")
    for split in ("hash", "random"):
        prepared = training.prepare_ratings(spark, str(tmp_path / "raw"), min_ratings=5)
        result = training.run_training(prepared, str(tmp_path / split), training.AlsSettings(rank=4, max_iter=6), split=split)
        assert result["users"] > 50
        assert result["precision_at_10"] <= result["hit_rate_at_10"] <= 1
        assert result["hit_rate_at_10"] > 0.9 and result["ndcg_at_10"] > 0.3
        assert spark.read.parquet(result["movie_factors_path"]).count() == 40


def test_recommended_beside_liked(spark, setting):
    users, items, train, test = setting
    ranked = evaluation.ranked_for_evaluation(users, items, train, evaluation.relevant_pairs(test, items), 5)
    rows = evaluation.recommended_and_liked(ranked, test)
    counts = {r["list"]: r["count"] for r in rows.groupBy("list").count().collect()}
    assert counts["recommended"] == ranked.count()
    assert rows.filter("list = 'liked' and position is not null").count() == 0
