"""Joins in which one key may hold a large part of all rows.

A plain equi join of two shuffled inputs needs no help: adaptive execution cuts an
oversized partition by map output. It cannot do so when one side is an aggregate, since
that side is already placed by the key. The operator here spreads such keys itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Above this many rows a key is spread over several tasks.
ROWS_PER_TASK = 2_000_000


def semi_join_counted(
    facts: DataFrame, kept: DataFrame, key: str, count: str, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Rows of ``facts`` whose key is in ``kept``, which holds each key once with its row count.

    A key with more than ``rows_per_task`` rows is split into as many salts as it needs. Only
    those keys are broadcast, and there are at most ``rows / rows_per_task`` of them. The salt
    is a hash of the whole row, so a retried task gives the same answer. Copies of one row
    share a salt; both sides are shuffled by (key, salt), so adaptive execution can cut
    that partition too.
    """
    salts = F.ceil(F.col(count) / F.lit(rows_per_task)).cast("int")
    hot = kept.filter(F.col(count) > rows_per_task).select(key, salts.alias("_salts"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in facts.columns]), F.col("_salts")).cast("int")
    salted_facts = facts.join(F.broadcast(hot), key, "left").withColumn("_salt", F.coalesce(spread, F.lit(0)))
    salted_keys = kept.select(key, F.explode(F.sequence(F.lit(0), salts - 1)).alias("_salt"))
    return salted_facts.join(salted_keys, [key, "_salt"], "left_semi").select(*facts.columns)
