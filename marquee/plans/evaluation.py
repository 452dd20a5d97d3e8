"""How good a ranking is: RMSE, precision, hit rate, recall and NDCG at k.

Lists are kept as rows of (user, item), never as one array per user: a user with a very
long history is then many rows that spread over the cluster.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import DataFrame, functions as F

from marquee.functions.ranking import discount, ideal_gain
from marquee.functions.vectors import cosine_similarity, dot, norm, unbroadcast
from marquee.operators.topk import top_k
from marquee.session import store_once

RELEVANT_FROM = 4.0
# Far more than the rounding errors of a score, as a share of the lengths of its two vectors.
_ROUNDING = 1e-9
# Ids in one chunk of a stored item set.
SET_WIDTH = 65_536


def relevant_pairs(test: DataFrame, items: DataFrame, threshold: float = RELEVANT_FROM) -> DataFrame:
    """Distinct (user, item) pairs rated at least ``threshold`` whose item the model knows.

    The explicit exchange keeps the rows of a hot movie from staying together after the join:
    without it the distinct pairs would reuse the join's placement, and adaptive execution
    could not split that movie.
    """
    liked = test.filter(F.col("rating") >= threshold).select("user_id", "movie_id")
    known = liked.join(items.select("movie_id"), "movie_id", "left_semi").select("user_id", "movie_id")
    return known.repartition("user_id", "movie_id").distinct()


def item_sets(pairs: DataFrame, width: int = SET_WIDTH) -> DataFrame:
    """Each user's distinct items as sorted arrays, one per range of ``width`` ids.

    An array is never longer than ``width``; a catalogue with ids below it gives one per user.
    """
    chunk = F.floor(F.col("movie_id") / width).cast("bigint").alias("chunk")
    return pairs.groupBy("user_id", chunk).agg(F.sort_array(F.collect_set("movie_id")).alias("items"))


def ranked_for_evaluation(
    users: DataFrame, items: DataFrame, train: DataFrame, relevant: DataFrame, k: int = 10, metric: str = "dot"
) -> DataFrame:
    """The k best unseen items of every user that has something relevant to find."""
    asked = users.join(relevant.select("user_id").distinct(), "user_id", "left_semi")
    seen = train.select("user_id", "movie_id")
    return top_k(asked, items, k, metric, exclude=seen, sized_by=users)


def contenders(
    users: DataFrame,
    items: DataFrame,
    train: DataFrame,
    relevant: DataFrame,
    k: int = 10,
    metric: str = "dot",
    probed: int | None = None,
) -> DataFrame:
    """The users that may have a relevant item among their k best unseen ones, with their vectors; no user with a hit is lost.

    Each user is ranked on about ``probed`` of the items, the same for all. A relevant item whose score lies below that of
    k unseen items among these is not among the k best of all items either, whatever the other items are. Only users with
    a relevant item for which this is not proven have to be ranked on all items. Where few items make it not worth
    while, all users are given.
    """
    size = items.agg(F.count("*").alias("items"), F.max(norm(F.col("features"))).alias("longest")).first()
    if probed is None:
        # Balances the pairs scored here with those left: about k of ``probed`` relevant items are not ruled out.
        probed = max(1024, ceil(sqrt(10 * k * size["items"])))
        if 8 * probed > size["items"]:
            return users
    some = F.pmod(F.xxhash64(F.lit(k), F.col("movie_id")), F.lit(max(1, size["items"] // probed)).cast("bigint")) == 0
    asked = users.join(relevant.select("user_id").distinct(), "user_id", "left_semi")
    best = top_k(asked, items.filter(some), k, metric, exclude=train.select("user_id", "movie_id"), sized_by=users)
    floor = best.filter(F.col("rank") == k).select("user_id", F.col("score").alias("_floor"))
    vectors = asked.select("user_id", F.col("features").alias("_uf")).join(floor, "user_id", "left")
    pairs = relevant.join(unbroadcast(vectors), "user_id")
    pairs = pairs.join(unbroadcast(items.select("movie_id", F.col("features").alias("_if"))), "movie_id")
    a, b = F.col("_uf"), F.col("_if")
    if metric == "cosine":
        score, slack = cosine_similarity(a, b), F.lit(_ROUNDING)
    else:
        score, slack = dot(a, b), norm(a) * F.lit(_ROUNDING * (size["longest"] or 0.0))
    beaten = F.coalesce(score + slack < F.col("_floor"), F.lit(False))
    kept = pairs.filter(~beaten).select("user_id").distinct()
    return store_once(users.join(kept, "user_id", "left_semi"), "contenders")


def user_metrics(
    users: DataFrame,
    items: DataFrame,
    train: DataFrame,
    test: DataFrame,
    k: int = 10,
    threshold: float = RELEVANT_FROM,
    metric: str = "dot",
) -> DataFrame:
    """Hits, precision, hit, recall and NDCG of each user with a vector and a relevant item.

    Precision divides by k even when fewer items were left to recommend.
    """
    relevant = store_once(relevant_pairs(test, items, threshold), "relevant")
    # A user who is no contender has no hit, so its list is not needed.
    ranking = contenders(users, items, train, relevant, k, metric)
    seen = train if ranking is users else train.join(ranking.select("user_id"), "user_id", "left_semi")
    ranked = ranked_for_evaluation(ranking, items, seen, relevant, k, metric)
    hits = ranked.join(relevant, ["user_id", "movie_id"]).groupBy("user_id").agg(
        F.count("*").alias("hits"), F.sum(discount(F.col("rank"))).alias("gain")
    )
    wanted = relevant.groupBy("user_id").agg(F.count("*").alias("relevant"))
    scored = wanted.join(users.select("user_id"), "user_id", "left_semi").join(hits, "user_id", "left")
    found = F.coalesce("hits", F.lit(0)).cast("bigint")
    return scored.select(
        "user_id",
        "relevant",
        found.alias("hits"),
        (found / F.lit(float(k))).alias("precision"),
        (found > 0).cast("double").alias("hit"),
        (found.cast("double") / F.col("relevant").cast("double")).alias("recall"),
        (F.coalesce("gain", F.lit(0.0)) / ideal_gain(F.col("relevant"), k)).alias("ndcg"),
    )


def mean_metrics(per_user: DataFrame) -> DataFrame:
    """One row: the means over all users, 0 for no users, and the number of users."""
    means = {"precision": "precision", "hit_rate": "hit", "recall": "recall", "ndcg": "ndcg"}
    averaged = [F.coalesce(F.avg(column), F.lit(0.0)).alias(name) for name, column in means.items()]
    return per_user.agg(*averaged, F.count("*").alias("users"))


def predict(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """The model's score for each rating; a user or item without a vector drops the row."""
    with_user = ratings.join(unbroadcast(users.select("user_id", F.col("features").alias("_uf"))), "user_id")
    with_both = with_user.join(unbroadcast(items.select("movie_id", F.col("features").alias("_if"))), "movie_id")
    return with_both.select(*ratings.columns, dot(F.col("_uf"), F.col("_if")).alias("prediction"))


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction") -> DataFrame:
    """One row: root mean squared error and the number of rows; null for no rows.

    Scores of an implicit model lie near 0 to 1 while ratings run from 0.5 to 5, so the
    figure tells runs apart and says nothing about quality.
    """
    error = F.col(prediction).cast("double") - F.col(label).cast("double")
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"), F.count("*").alias("rows"))


def recommended_and_liked(ranked: DataFrame, test: DataFrame, threshold: float = RELEVANT_FROM) -> DataFrame:
    """What the model recommends beside what the user liked in the test part: (user, list, position, item)."""
    recommended = ranked.select("user_id", F.lit("recommended").alias("list"), F.col("rank").alias("position"), "movie_id")
    liked = test.filter(F.col("rating") >= threshold).select("user_id", "movie_id").distinct()
    liked = liked.join(ranked.select("user_id").distinct(), "user_id", "left_semi")
    return recommended.unionByName(
        liked.select("user_id", F.lit("liked").alias("list"), F.lit(None).cast("int").alias("position"), "movie_id")
    )
