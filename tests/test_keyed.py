from datetime import date, datetime

import pytest

from marquee.operators.keyed import last_write_wins, newest_ratings, upsert
from marquee.operators.split import split_arithmetic, split_hash, split_random


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_last_write_wins(spark):
    data = [(1, 1, 3.0, 5), (1, 1, 4.0, 9), (1, 2, 1.0, None), (1, 2, 2.0, 1), (2, 1, 5.0, 7), (2, 1, 4.5, 7), (3, 3, 1.0, None)]
    df = spark.createDataFrame(data, "user_id int, movie_id int, rating double, rated_at int")
    wanted = rows(spark.createDataFrame([(1, 1, 4.0, 9), (1, 2, 2.0, 1), (2, 1, 5.0, 7), (3, 3, 1.0, None)], df.schema))
    assert rows(last_write_wins(df, ["user_id", "movie_id"], ["rated_at", "rating"])) == wanted
    assert rows(last_write_wins(df.repartition(7, "rating"), ["user_id", "movie_id"], ["rated_at", "rating"])) == wanted


@pytest.mark.parametrize("kind, times", [
    ("date", [date(1969, 5, 1), date(2020, 1, 2), date(2020, 1, 3), date(9999, 12, 31), None]),
    ("timestamp", [datetime(1960, 1, 1), datetime(2020, 1, 2, 3, 4, 5, 678901), datetime(2020, 1, 2, 3, 4, 5, 678902), datetime(2250, 1, 1), None]),
    ("timestamp_ntz", [datetime(1960, 1, 1), datetime(2020, 1, 2, 3, 4, 5, 678901), datetime(2020, 1, 2, 3, 4, 5, 678902), datetime(2250, 1, 1), None]),
])
@pytest.mark.parametrize("value", ["double", "decimal(3,1)", "float"])
def test_newest_ratings_by_one_number(spark, kind, times, value):
    values = [None, 0.0, 0.5, 4.5, 10.2, 3.0]
    data = [(n % 7, n % 3, values[n % 6], times[n * n % 5]) for n in range(400)] + [(50, 1, None, None), (51, 1, 2.5, None)]
    df = spark.createDataFrame(data, f"user_id int, movie_id int, rating double, rated_at {kind}")
    df = df.withColumn("rating", df["rating"].cast(value))
    found = newest_ratings(df, ["user_id", "movie_id"])
    assert found.schema == df.schema or [f.dataType for f in found.schema] == [f.dataType for f in df.schema]
    assert rows(found) == rows(last_write_wins(df, ["user_id", "movie_id"], ["rated_at", "rating"]))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_what_does_not_fit_one_number_is_refused(spark):
    schema = "user_id int, rating double, rated_at timestamp"
    for row in ((1, 3.25, None), (1, -1.0, None), (1, 500.0, None), (1, 1.0, datetime(2300, 1, 1))):
        with pytest.raises(Exception, match="out of range"):
            newest_ratings(spark.createDataFrame([row], schema), ["user_id"]).collect()
    with pytest.raises(ValueError):
        newest_ratings(spark.createDataFrame([(1, 1.0, 5)], "user_id int, rating double, rated_at int"), ["user_id"])
    with pytest.raises(ValueError):
        newest_ratings(spark.createDataFrame([], schema + ", more int"), ["user_id"])


def test_upsert_inserts_and_replaces(spark):
    schema = "movie_id int, title string, genres string"
    existing = spark.createDataFrame([(1, "a", "X"), (2, "b", "Y")], schema)
    incoming = spark.createDataFrame([(2, "B", None), (3, "c", "Z")], schema)
    merged = upsert(existing, incoming, ["movie_id"])
    assert rows(merged) == [(1, "a", "X"), (2, "B", None), (3, "c", "Z")]
    assert rows(upsert(merged, incoming, ["movie_id"])) == rows(merged)
    assert rows(upsert(existing.limit(0), incoming, ["movie_id"])) == rows(incoming)


def test_upsert_keeps_the_first_load_time(spark):
    schema = "user_id int, features array<float>, loaded_at int"
    existing = spark.createDataFrame([(1, [1.0], 10), (2, [2.0], 10)], schema)
    incoming = spark.createDataFrame([(2, [9.0], 20), (3, [3.0], 20)], schema)
    assert rows(upsert(existing, incoming, ["user_id"], ["loaded_at"])) == [(1, [1.0], 10), (2, [9.0], 10), (3, [3.0], 20)]


def ratings(spark):
    return spark.range(2000).selectExpr("cast(id % 40 as int) userId", "cast(id / 40 as int) movieId", "id % 10 / 2 rating")


def test_splits_are_disjoint_complete_and_repeat(spark):
    df = ratings(spark).repartition(4, "userId").cache()
    for split in (split_random, split_hash):
        train, test = split(df)
        assert train.count() + test.count() == 2000
        assert train.join(test, ["userId", "movieId"]).count() == 0
        assert 0.75 < train.count() / 2000 < 0.85
        again, _ = split(df)
        assert rows(again) == rows(train)
        other, _ = split(df, seed=7)
        assert rows(other) != rows(train)


def test_the_hash_split_does_not_depend_on_partitions(spark):
    assert rows(split_hash(ratings(spark).repartition(13))[0]) == rows(split_hash(ratings(spark).coalesce(1))[0])
    train, test = split_arithmetic(ratings(spark), "userId", "movieId")
    assert train.count() + test.count() == 2000
