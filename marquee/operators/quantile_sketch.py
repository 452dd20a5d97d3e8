"""Exact percentiles by way of mergeable sketches.

A KLL sketch of a group's values is a few kilobytes whatever their number, and sketches of parts (days, loads,
tasks) merge into that of the whole. Its quantiles are off by a small share of the ranks. ``bracketed_statistics``
reads the sketch at ``GRID`` even steps and goes ``MARGIN`` steps beyond the wanted rank on either side, so the interval of
values between holds the wanted one all but certainly. One pass over the input then counts, inside each task, the values in front of
the interval as one number, and those inside as counts of distinct values; only these leave the tasks, and only
they are put in order. If an interval should not hold its rank, its group is computed without a sketch, so the result is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marquee.operators.order_stats import at_ranks, order_statistics
from marquee.session import store_once

# Items a sketch keeps at its base; ranks are then off by about 1.3 %, and by more than the margin in one case of many millions.
ITEMS = 200
GRID = 50
MARGIN = 2


def _valued(df: DataFrame, keys: Sequence[Column], value: str) -> DataFrame:
    rows = df.select(*keys, F.col(value).cast("double").alias("_v"))
    return rows.where(F.col("_v").isNotNull() & ~F.isnan("_v"))


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """(by..., sketch, n, total): one row for each combination, such as day and group. Nulls and NaN are no values."""
    rows = _valued(df, [F.col(c) for c in by], value)
    return rows.groupBy(*by).agg(
        F.kll_sketch_agg_double("_v", F.lit(ITEMS)).alias("sketch"), F.count("*").alias("n"), F.sum("_v").alias("total")
    )


def merged_sketches(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The same for coarser combinations, such as the group over all days."""
    whole = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.sum("n").alias("n"), F.sum("total").alias("total"))
    return whole.where("n > 0")


def bracketed_statistics(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    ranks: dict[str, Callable[[Column], Column]],
    mean: str | None = None,
    sketches: DataFrame | None = None,
    margin: int = MARGIN,
) -> DataFrame:
    """The rows of ``order_statistics``. ``sketches`` are those of ``df`` by ``group`` or finer, if they are kept already."""
    keys = [f"_g{i}" for i in range(len(group))] or ["_g0"]
    named = [F.col(g).alias(k) for g, k in zip(group, keys)] or [F.lit(0).alias("_g0")]
    made = quantile_sketches(df, group, value) if sketches is None else sketches
    whole = merged_sketches(made.select(*named, "sketch", "n", "total"), keys)
    points = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    whole = whole.withColumn("grid", F.kll_sketch_get_quantile_double("sketch", points))
    bounds = []
    for name, rank in ranks.items():
        wanted = rank(F.col("n"))
        first = F.floor((wanted - 1) / F.col("n") * GRID).cast("int") - margin
        last = F.ceil(wanted / F.col("n") * GRID).cast("int") + margin
        low = F.when(first <= 0, F.lit(float("-inf"))).otherwise(F.get("grid", first))
        high = F.when(last >= GRID, F.lit(float("inf"))).otherwise(F.get("grid", last))
        bounds.append(F.struct(F.lit(name).alias("name"), wanted.alias("rank"), low.alias("low"), high.alias("high")))
    brackets = store_once(whole.select(*keys, "n", "total", F.array(*bounds).alias("brackets")), "brackets")

    # One row per group on the right; a value in front of an interval is counted, one behind it is not looked at.
    rows = _valued(df, named, value).join(brackets.select(*keys, "brackets"), keys)
    place = F.explode(F.filter("brackets", lambda b: F.col("_v") <= b["high"])).alias("b")
    inside = F.when(F.col("_v") >= F.col("b.low"), F.col("_v")).alias("_v")
    counts = rows.select(*keys, "_v", place).select(*keys, F.col("b.name").alias("_name"), inside)
    counts = store_once(counts.groupBy(*keys, "_name", "_v").agg(F.count("*").alias("_c")), "bracket-counts")

    asked = brackets.select(*keys, "n", "total", F.explode("brackets").alias("b")).select(*keys, "n", "total", F.col("b.name").alias("_name"), F.col("b.rank").alias("_rank"))
    held = counts.groupBy(*keys, "_name").agg(
        F.sum(F.when(F.col("_v").isNull(), F.col("_c")).otherwise(0)).alias("_front"), F.sum("_c").alias("_all")
    )
    asked = store_once(asked.join(held, [*keys, "_name"], "left"), "asked-ranks")
    sound = (F.col("_front") < F.col("_rank")) & (F.col("_rank") <= F.col("_all"))
    left = (F.col("_rank") - F.col("_front")).alias("_rank")
    found = at_ranks(counts.where("_v IS NOT NULL"), asked.where(sound).select(*keys, "_name", left), [*keys, "_name"])
    wide = [F.max(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in ranks]
    means = [] if mean is None else [(F.col("total") / F.col("n")).alias(mean)]
    values = found.groupBy(*keys).agg(*wide, F.count("*").alias("_found")).where(F.col("_found") == len(ranks))
    result = values.join(brackets.select(*keys, "n", "total"), keys)
    result = result.select(*[F.col(k).alias(g) for g, k in zip(group, keys)], "n", *means, *ranks)
    missed = asked.where(~F.coalesce(sound, F.lit(False))).select(*keys).distinct()
    if missed.isEmpty():
        return result
    again = df.select(*named, F.col(value).alias("_v")).join(missed, keys, "left_semi")
    names = dict(zip(keys, group)) if group else {}
    exact = order_statistics(again, keys, "_v", ranks, mean=mean).withColumnsRenamed(names)
    return result.unionByName(exact.select(*result.columns))

