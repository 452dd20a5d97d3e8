import math
import random

import pytest

from marquee import session
from marquee.operators.order_stats import floor_index, nearest_rank, order_statistics
from marquee.operators.quantile_sketch import bracketed_statistics, quantile_sketches
from marquee.operators.sampling import sample_ids
from marquee.plans.reports import latency_report, latency_summary, of_users
from marquee.sources.sinks import write_report


def by_nearest_rank(values, p):
    ordered = sorted(values)
    return ordered[max(0, min(math.ceil(p * len(ordered)) - 1, len(ordered) - 1))]


def by_floor_index(values, p):
    ordered = sorted(values)
    return ordered[min(int(len(ordered) * p), len(ordered) - 1)]


def test_one_to_four(spark):
    df = spark.createDataFrame([(float(x),) for x in (4, 2, 1, 3)], "ms double")
    row = order_statistics(df, [], "ms", {"a": nearest_rank(0.5), "b": floor_index(0.5), "c": nearest_rank(0), "d": floor_index(1)}).first()
    assert tuple(row) == (4, 2.0, 3.0, 1.0, 4.0)


def test_against_sorting(spark):
    rng = random.Random(1)
    groups = {
        "spread": [rng.lognormvariate(0, 3) for _ in range(999)],
        "close": [100 + rng.random() * 1e-9 for _ in range(500)],
        "same": [7.5] * 400,
        "signs": [rng.uniform(-1e6, 1e6) for _ in range(300)] + [0.0, -0.0] * 20,
        "tiny": [rng.random() * 10.0 ** rng.randint(-300, 300) for _ in range(200)],
        "one": [3.25],
        "small": [rng.random() * 1e-6 for _ in range(250)],
        "ends": [5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf, 0.0],
        "whole": [float(x) for x in range(100)],
    }
    rows = [(g, v) for g, values in groups.items() for v in values] + [("spread", None), ("empty", None), ("one", math.nan)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    points = [0.0, 0.01, 0.5, 0.95, 0.99, 1.0]
    ranks = {f"near_{i}": nearest_rank(p) for i, p in enumerate(points)} | {f"floor_{i}": floor_index(p) for i, p in enumerate(points)}
    result = {r["g"]: r for r in order_statistics(df.repartition(5), ["g"], "v", ranks).collect()}
    assert result.keys() == groups.keys()
    for group, values in groups.items():
        assert result[group]["n"] == len(values)
        for i, p in enumerate(points):
            assert result[group][f"near_{i}"] == by_nearest_rank(values, p)
            assert result[group][f"floor_{i}"] == by_floor_index(values, p)


def test_no_values_and_bad_points(spark):
    empty = spark.createDataFrame([], "g int, v double")
    assert order_statistics(empty, ["g"], "v", {"a": nearest_rank(0.5)}).count() == 0
    assert order_statistics(empty, [], "v", {"a": nearest_rank(0.5)}).count() == 0
    for point in (nearest_rank, floor_index):
        with pytest.raises(ValueError):
            point(1.5)


def test_a_report_is_stored_as_json(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 9.0)], "user_id int, ms double")
    report = latency_report(of_users(df, df.filter("user_id < 3")))
    write_report(report, str(tmp_path / "report"))
    stored = spark.read.json(str(tmp_path / "report")).first().asDict()
    assert stored == {"users_sampled": 2, "total_runs": 2, "p50_ms": 2.0, "p95_ms": 4.0, "p99_ms": 4.0, "avg_ms": 3.0}


def test_reports(spark):
    data = {1: [float(x) for x in range(1, 101)], 2: [0.125, 0.135], 3: [2.0]}
    df = spark.createDataFrame([(u, v) for u, values in data.items() for v in values], "user_id int, ms double")
    summary = {r["user_id"]: r for r in latency_summary(df).collect()}
    assert tuple(summary[1]) == (1, 100, 50.5, 51.0, 96.0, 100.0)
    assert tuple(summary[2])[1:4] == (2, 0.13, 0.14)
    report = latency_report(df).first()
    everything = [v for values in data.values() for v in values]
    assert (report["users_sampled"], report["total_runs"]) == (3, 103)
    assert report["p95_ms"] == by_nearest_rank(everything, 0.95)
    assert report["avg_ms"] == pytest.approx(sum(everything) / 103)


def test_sample(spark):
    df = spark.range(1000).selectExpr("cast(id % 300 as int) as user_id")
    first = [r[0] for r in sample_ids(df, "user_id", 20, seed=1).collect()]
    again = [r[0] for r in sample_ids(df.repartition(9), "user_id", 20, seed=1).collect()]
    assert first == again and len(set(first)) == 20
    assert [r[0] for r in sample_ids(df, "user_id", 20, seed=2).collect()] != first
    assert sample_ids(df, "user_id", 5000).count() == 300


@pytest.mark.parametrize("margin", [2, 0, -8])
def test_brackets_give_the_same_rows(spark, margin):
    """With the margin gone, intervals miss their rank, and the group is computed without a sketch."""
    rng = random.Random(4)
    groups = {
        "spread": [rng.lognormvariate(0, 3) for _ in range(20_000)],
        "same": [7.5] * 3000,
        "signs": [rng.uniform(-1e6, 1e6) for _ in range(3000)] + [0.0, -0.0] * 200,
        "one": [3.25],
        "ends": [5e-324, -5e-324, 1.7e308, -1.7e308, math.inf, -math.inf, 0.0],
        "whole": [float(x) for x in range(5000)],
    }
    rows = [(g, v, n % 7) for g, values in groups.items() for n, v in enumerate(values)]
    rows += [("spread", None, 1), ("empty", None, 1), ("one", math.nan, 2)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double, day int").repartition(5)
    ranks = {f"near_{i}": nearest_rank(p) for i, p in enumerate((0.0, 0.3, 0.95, 1.0))} | {"floor": floor_index(0.5)}
    kept = quantile_sketches(df, ["day", "g"], "v")
    for sketches in (None, kept):
        found = {r["g"]: r for r in bracketed_statistics(df, ["g"], "v", ranks, "avg", sketches, margin).collect()}
        assert found.keys() == groups.keys()
        for group, values in groups.items():
            assert found[group]["n"] == len(values)
            assert [found[group][f"near_{i}"] for i in range(4)] == [by_nearest_rank(values, p) for p in (0.0, 0.3, 0.95, 1.0)]
            assert found[group]["floor"] == by_floor_index(values, 0.5)
    everything = [v for values in groups.values() for v in values]
    (row,) = bracketed_statistics(df, [], "v", ranks, margin=margin).collect()
    assert row["n"] == len(everything) and row["near_2"] == by_nearest_rank(everything, 0.95)
    assert bracketed_statistics(df.limit(0), ["g"], "v", ranks).collect() == []


def test_few_values_leave_the_tasks(spark):
    rng = random.Random(6)
    df = spark.createDataFrame([(rng.random(),) for _ in range(40_000)], "v double").repartition(4)
    before = set(session._NAMED)
    assert bracketed_statistics(df, [], "v", {"p": nearest_rank(0.5)}).first()["n"] == 40_000
    (counts,) = [p for p in session._NAMED if p not in before and "bracket-counts" in p]
    assert spark.read.parquet(counts).count() < 5000
