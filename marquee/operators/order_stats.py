"""Exact percentiles of groups of any size.

Sorting a group in one task does not survive a group that holds a third of all rows. Here
a value falls into a coarse and, inside it, a fine bucket. Both grow with the value, and
both are functions of the value alone. Counting the coarse buckets finds the one that holds
the wanted rank, counting its fine buckets narrows it again, and only the distinct values
of one fine bucket are put in order. The input is read once and stored as counts of its distinct
values, so a value that is repeated many times is one row from there on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.session import store_once

# Coarse buckets per doubling of a value, and fine buckets in each. All the doubles there are
# fall into some two million coarse buckets, and a fine one holds less than half a million.
_COARSE = 512
_FINE = 1 << 24
# Lifts the logarithm of the smallest positive double above zero.
_LIFT = 1100.0


def nearest_rank(p: float) -> Callable[[Column], Column]:
    """Rank of the nearest-rank percentile, ``ceil(p * n)``, at least 1."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("a percentile lies between 0 and 1")
    return lambda n: F.greatest(F.lit(1), F.ceil(F.lit(p) * n)).cast("bigint")


def floor_index(p: float) -> Callable[[Column], Column]:
    """Rank of element ``floor(n * p)`` counted from 0, and never beyond the last."""
    if not 0.0 <= p <= 1.0:
        raise ValueError("a percentile lies between 0 and 1")
    return lambda n: F.least(n, F.floor(n * F.lit(p)) + 1).cast("bigint")


def order_statistics(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    weight: str | None = None,
    mean: str | None = None,
) -> DataFrame:
    """One row per group: its columns, ``n`` (values) and the value at each named rank.

    Nulls and NaN are no values. With no group columns the whole table is one group; an empty table gives no row.
    ``weight`` names a column that says how often a value stands in the table; ``mean`` names an output column for the average.
    """
    keys = [f"_g{i}" for i in range(len(group))] or ["_g0"]
    renamed = [F.col(g).alias(k) for g, k in zip(group, keys)] or [F.lit(0).alias("_g0")]
    size = F.coalesce(F.log2(F.abs(F.col("_v"))), F.lit(-_LIFT)) + _LIFT
    scaled = F.signum("_v") * size * _COARSE
    fine = F.floor((F.col("_s") - F.floor("_s")) * _FINE)
    once = F.lit(1) if weight is None else F.col(weight)
    values = (
        df.select(*renamed, F.col(value).cast("double").alias("_v"), once.cast("bigint").alias("_c"))
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
        .withColumn("_s", scaled)
        .select(*keys, "_v", F.floor("_s").alias("_coarse"), fine.alias("_fine"), "_c")
    )
    count = F.sum("_c").alias("_c")
    # The one pass over the input: what follows reads the counts of distinct values.
    values = store_once(values.groupBy(*keys, "_coarse", "_fine", "_v").agg(count), "value-counts")

    # Counts shrink inside each task, so only buckets are shuffled, however many rows there are.
    coarse = values.groupBy(*keys, "_coarse").agg(count, F.sum(F.col("_v") * F.col("_c")).alias("_t"))
    whole = Window.partitionBy(*keys)
    wanted = F.explode(
        F.array(*[F.struct(F.lit(name).alias("_name"), rank(F.col("_n")).alias("_rank")) for name, rank in ranks.items()])
    )
    counted = coarse.withColumn("_n", F.sum("_c").over(whole)).withColumn("_total", F.sum("_t").over(whole))
    counted = counted.withColumn("_upto", F.sum("_c").over(whole.orderBy("_coarse"))).withColumn("_w", wanted)
    kept = [*keys, "_n", "_total", "_name", "_rank"]
    in_coarse = _holding_rank(counted.select("*", "_w._name", "_w._rank")).select(*kept, "_coarse")

    slot = Window.partitionBy(*keys, "_name")
    # The explicit exchange lets adaptive execution split a crowded bucket in the join below it.
    inside = values.join(in_coarse, [*keys, "_coarse"]).repartition(*keys, "_coarse", "_fine")
    finer = inside.groupBy(*kept, "_coarse", "_fine").agg(count)
    finer = finer.withColumn("_upto", F.sum("_c").over(slot.orderBy("_fine")))
    in_fine = _holding_rank(finer).select(*kept, "_coarse", "_fine")

    last = values.join(in_fine, [*keys, "_coarse", "_fine"]).groupBy(*kept, "_v").agg(count)
    last = _holding_rank(last.withColumn("_upto", F.sum("_c").over(slot.orderBy("_v"))))
    named = [F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks]
    result = last.groupBy(*keys).agg(F.max("_n").alias("n"), F.max(F.col("_total") / F.col("_n")).alias("_mean"), *named)
    means = [] if mean is None else [F.col("_mean").alias(mean)]
    return result.select(*[F.col(k).alias(g) for g, k in zip(group, keys)], "n", *means, *ranks)


def _holding_rank(buckets: DataFrame) -> DataFrame:
    """The bucket that holds the wanted rank, and the rank counted inside it."""
    before = F.col("_upto") - F.col("_c")
    held = buckets.filter((before < F.col("_rank")) & (F.col("_rank") <= F.col("_upto")))
    return held.withColumn("_rank", F.col("_rank") - before)


def at_ranks(counts: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., _v): the value at the wanted rank of each combination, from counts (keys..., _v, _c) of distinct values.

    ``wanted`` holds (keys..., _rank). Counts of coarse buckets lead to the one bucket that is put in order, so a
    combination with very many distinct values is not sorted in one task.
    """
    size = F.coalesce(F.log2(F.abs(F.col("_v"))), F.lit(-_LIFT)) + _LIFT
    exact = F.signum("_v") * size * _COARSE
    placed = counts.withColumn("_s", exact).withColumn("_coarse", F.floor("_s"))
    placed = placed.withColumn("_fine", F.floor((F.col("_s") - F.col("_coarse")) * _FINE)).drop("_s")
    for bucket in ("_coarse", "_fine", "_v"):
        order = Window.partitionBy(*keys).orderBy(bucket)
        sums = placed.groupBy(*keys, bucket).agg(F.sum("_c").alias("_c")).withColumn("_upto", F.sum("_c").over(order))
        wanted = _holding_rank(sums.join(wanted, list(keys))).select(*keys, bucket, "_rank")
        placed = placed.join(wanted.select(*keys, bucket), [*keys, bucket])
        if bucket != "_v":
            wanted = wanted.drop(bucket)
    return wanted.select(*keys, "_v")
