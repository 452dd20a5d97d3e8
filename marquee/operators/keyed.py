"""One row per key: last write wins, and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def last_write_wins(df: DataFrame, key: Sequence[str], newest_by: Sequence[str]) -> DataFrame:
    """The row of each key that is largest by ``newest_by``, nulls lowest.

    The remaining columns break ties, so the result does not depend on row order. It is an
    aggregate, not a window: a hot key collapses to one row per task before the shuffle.
    """
    rest = [c for c in df.columns if c not in key and c not in newest_by]
    newest = F.max(F.struct(*newest_by, *rest)).alias("_row")
    picked = df.groupBy(*key).agg(newest)
    return picked.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in df.columns])


# Tenths take the low ten bits, 0 for none; times the others, the least one for none.
_TENTHS_BITS = 10
_MOST_TENTHS = (1 << _TENTHS_BITS) - 2
_MOST_TIME = (1 << 53) - 1


def newest_ratings(df: DataFrame, key: Sequence[str], time: str = "rated_at", value: str = "rating") -> DataFrame:
    """``last_write_wins`` by time, then value, for rows that have no further column.

    A date or timestamp and a value in whole tenths from 0 to 102.2 make one long number that orders like the two, nulls
    lowest, so its maximum is a hash aggregate: nothing is sorted, before the shuffle or behind it. Values that are no
    such tenths, and times too far from 1970 (beyond 285 years for timestamps), raise an error.
    """
    kind = df.schema[time].dataType.simpleString()
    if set(df.columns) != {*key, time, value}:
        raise ValueError("the rows must hold the key, the time and the value only")
    if kind not in ("date", "timestamp", "timestamp_ntz"):
        raise ValueError(f"{time} must be a date or a timestamp")
    clock = F.col(time).cast("timestamp") if kind == "timestamp_ntz" else F.col(time)
    moment = F.unix_date(clock).cast("long") if kind == "date" else F.unix_micros(clock)
    tenths = F.round(F.col(value).cast("double") * 10).cast("long")
    value_of = lambda number: (number / 10).cast(df.schema[value].dataType)
    whole = (value_of(tenths) == F.col(value)) & tenths.between(0, _MOST_TENTHS)
    sound = F.coalesce(whole, F.lit(True)) & F.coalesce(F.abs(moment) < _MOST_TIME, F.lit(True))
    packed = F.coalesce(moment, F.lit(-_MOST_TIME)) * (1 << _TENTHS_BITS) + F.coalesce(tenths + 1, F.lit(0))
    checked = F.when(sound, packed).otherwise(F.raise_error(F.lit(f"{value} or {time} out of range")).cast("long"))
    newest = df.groupBy(*key).agg(F.max(checked).alias("_newest"))
    low = F.col("_newest").bitwiseAND((1 << _TENTHS_BITS) - 1)
    high = F.shiftright("_newest", _TENTHS_BITS)
    back = F.date_from_unix_date(high.cast("int")) if kind == "date" else F.timestamp_micros(high)
    values = {
        time: F.when(high != -_MOST_TIME, back).cast(kind),
        value: F.when(low > 0, value_of(low - 1)),
    }
    return newest.select(*[values[c].alias(c) if c in values else c for c in df.columns])


def upsert(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], kept_from_existing: Sequence[str] = ()
) -> DataFrame:
    """``existing`` with the rows of ``incoming`` added, or put in place of those with their key.

    Columns in ``kept_from_existing`` keep the value of the row that was there first. Each
    input holds a key at most once, never null (a contract checks it). A small ``incoming``
    is broadcast by Spark's own size check, and then ``existing`` is not shuffled at all.
    """
    rows = incoming.select(*existing.columns)
    keys = incoming.select(*key)
    untouched = existing.join(keys, list(key), "left_anti").select(*existing.columns)
    if kept_from_existing:
        held = existing.select(*key, F.struct(*kept_from_existing).alias("_held")).join(keys, list(key), "left_semi")
        first = [
            F.when(F.col("_held").isNotNull(), F.col(f"_held.{c}")).otherwise(F.col(c)).alias(c) if c in kept_from_existing else c
            for c in existing.columns
        ]
        rows = rows.join(held, list(key), "left").select(*first)
    return untouched.unionByName(rows)
