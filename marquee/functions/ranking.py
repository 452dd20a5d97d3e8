"""Ranking metrics of one user's list, as expressions over three short arrays.

``recommended`` is in rank order; ``relevant`` has no duplicates; ``train`` may be null.
For long histories use ``marquee.plans.evaluation``, which keeps one row per item instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def unseen_top(recommended: Column, train: Column, k: int) -> Column:
    """The first ``k`` recommendations that are not among the user's training items."""
    empty = F.slice(recommended, 1, 0)
    return F.slice(F.array_except(recommended, F.coalesce(train, empty)), 1, k)


def hit_count(recommended: Column, relevant: Column, train: Column, k: int) -> Column:
    return F.size(F.array_intersect(unseen_top(recommended, train, k), relevant))


def precision_at(recommended: Column, relevant: Column, train: Column, k: int) -> Column:
    """Hits divided by ``k``, even when fewer than ``k`` items were recommended."""
    return hit_count(recommended, relevant, train, k) / F.lit(float(k))


def hit_at(recommended: Column, relevant: Column, train: Column, k: int) -> Column:
    return (hit_count(recommended, relevant, train, k) > 0).cast("double")


def recall_at(recommended: Column, relevant: Column, train: Column, k: int) -> Column:
    return F.try_divide(hit_count(recommended, relevant, train, k).cast("double"), F.size(relevant).cast("double"))


def discount(rank: Column) -> Column:
    """Weight of a hit at a rank counted from 1."""
    return F.lit(1.0) / F.log2(rank.cast("double") + 1)


def ideal_gain(relevant_count: Column, k: int) -> Column:
    """The gain of a perfect list for a user with this many relevant items."""
    ranks = F.sequence(F.lit(1), F.least(F.lit(k), relevant_count.cast("int")))
    total = F.aggregate(ranks, F.lit(0.0), lambda gain, rank: gain + discount(rank))
    return F.when(relevant_count > 0, total).otherwise(F.lit(0.0))


def ndcg_at(recommended: Column, relevant: Column, train: Column, k: int) -> Column:
    """Binary-relevance NDCG; 0 when nothing is relevant."""
    gains = F.transform(
        unseen_top(recommended, train, k),
        lambda item, i: F.when(F.array_contains(relevant, item), discount(i + 1)).otherwise(F.lit(0.0)),
    )
    gain = F.aggregate(gains, F.lit(0.0), lambda total, x: total + x)
    return F.coalesce(F.try_divide(gain, ideal_gain(F.size(relevant), k)), F.lit(0.0))
