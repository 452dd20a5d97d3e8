import numpy as np
import pytest

from marquee.operators.contracts import (
    MOVIES,
    RATINGS,
    ContractError,
    check,
    enforce,
    factor_contract,
    orphans_by_key,
    schema_problems,
    split_valid,
    synthetic_check,
)
from marquee.sources.files import factor_layout, read_checked, read_factors
from marquee.sources.synthetic import synthetic_factors, write_synthetic_pair


def found(report):
    return {r["check"]: r["violations"] for r in report.collect()}


def test_ratings(spark):
    data = [(1, 1, 3.0, None), (1, 1, 3.0, None), (2, 1, 0.0, None), (2, 9, 5.5, None), (None, 1, 1.0, None), (3, 1, None, None)]
    df = spark.createDataFrame(data, "user_id int, movie_id int, rating double, rated_at timestamp")
    movies = spark.createDataFrame([(1, "t", None)], "movie_id int, title string, genres string")
    report = check(df, RATINGS, {"movies": movies})
    assert found(report) == {
        "empty": 0,
        "null key user_id": 1,
        "null key movie_id": 0,
        "null rating": 1,
        "out of range rating": 2,
        "repeated key": 1,
        "orphan movie_id": 1,
    }
    with pytest.raises(ContractError, match="repeated key"):
        enforce(report)
    enforce(check(movies, MOVIES))
    assert [tuple(r) for r in orphans_by_key(df, movies, "movie_id").collect()] == [(9, 1)]
    sound, broken = split_valid(df, RATINGS)
    assert sound.count() == 2
    assert sorted(r["broken_rule"] for r in broken.collect()) == [
        "null key user_id",
        "null rating",
        "out of range rating",
        "out of range rating",
    ]


def test_empty_and_missing_columns(spark):
    empty = spark.createDataFrame([], "movie_id int, title string, genres string")
    assert found(check(empty, MOVIES))["empty"] == 1
    with pytest.raises(ContractError, match="genres"):
        check(empty.drop("genres"), MOVIES)
    assert schema_problems(empty.selectExpr("cast(movie_id as string) movie_id", "title"), MOVIES) == [
        "missing column genres",
        "not an integer movie_id",
    ]


def test_vectors(spark):
    data = [(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [1.0, None]), (5, [1.0, float("nan")])]
    df = spark.createDataFrame(data, "id int, features array<float>")
    report = found(check(df, factor_contract("f", "id", 2)))
    assert report["vector length features"] == 3
    assert report["null features"] == 1


def test_factor_layouts(spark, tmp_path):
    base = synthetic_factors(spark, 5, 4)
    layouts = {
        "a": base,
        "b": base.withColumnRenamed("id", "userId"),
        "c": base.withColumnsRenamed({"id": "movieId", "features": "embedding"}),
    }
    for name, df in layouts.items():
        df.write.parquet(str(tmp_path / name))
        read = read_factors(spark, str(tmp_path / name), name, 4)
        assert read.columns == ["id", "features"] and read.count() == 5
    with pytest.raises(ContractError, match="vector length"):
        read_factors(spark, str(tmp_path / "a"), "a", 5)
    base.unionByName(base).write.parquet(str(tmp_path / "twice"))
    with pytest.raises(ContractError, match="repeated key"):
        read_factors(spark, str(tmp_path / "twice"), "twice", 4)
    with pytest.raises(ContractError, match="missing column"):
        read_checked(spark, str(tmp_path / "a"), "a", ["id", "title"], "id")
    assert read_checked(spark, str(tmp_path / "a"), "a", ["id"], ["id"]).count() == 5
    assert factor_layout(base).columns == ["id", "features"]


def test_synthetic(spark):
    df = synthetic_factors(spark, 200, 50, 42)
    assert all(v == 0 for v in found(synthetic_check(df, 200, 50, "t")).values())
    again = synthetic_factors(spark, 200, 50, 42).repartition(7).orderBy("id")
    assert [r["features"] for r in again.collect()] == [r["features"] for r in df.orderBy("id").collect()]
    other = synthetic_factors(spark, 200, 50, 43)
    assert other.first()["features"] != df.first()["features"]
    values = [x for r in df.collect() for x in r["features"]]
    assert abs(sum(values) / len(values)) < 0.03 and min(values) < -0.99 and max(values) > 0.99
    broken = df.filter("id <> 7").unionByName(df.filter("id = 8"))
    report = found(synthetic_check(broken, 200, 49, "t"))
    assert report["repeated id"] == 1 and report["vector length features"] == 200
    for bad in ((0, 5), (5, 0)):
        with pytest.raises(ValueError):
            synthetic_factors(spark, *bad)


def test_synthetic_vectors_are_spread_evenly(spark):
    rows = synthetic_factors(spark, 3000, 20, 7).orderBy("id").collect()
    matrix = np.array([r["features"] for r in rows], np.float64)
    counts = np.histogram(matrix, bins=20, range=(-1, 1))[0]
    assert abs(counts / counts.mean() - 1).max() < 0.08
    assert abs(matrix.mean()) < 0.01 and abs(matrix.var() - 1 / 3) < 0.01
    assert abs(np.corrcoef(matrix.T) - np.eye(20)).max() < 0.1
    assert abs(np.corrcoef(matrix[:-1].ravel(), matrix[1:].ravel())[0, 1]) < 0.02
    assert abs(np.corrcoef(matrix[:, :-1].ravel(), matrix[:, 1:].ravel())[0, 1]) < 0.02


def test_synthetic_pair_written_and_read_back(spark, tmp_path):
    users, movies = write_synthetic_pair(spark, str(tmp_path))
    assert spark.read.parquet(users).count() == spark.read.parquet(movies).count() == 50
    assert spark.read.parquet(users).first()["features"] != spark.read.parquet(movies).first()["features"]
