"""Rank-one updates and whitening against dense decompositions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import whitening
from marquee.llm.queries import QUERIES
from marquee.llm.spectrum import Spectrum, secular_roots
from marquee.llm.whitening import whitened_rows

DATA = "/root/testdata/sf0.001"


def scatter(x):
    off = x - x.mean(0)
    return off.T @ off


def assert_decomposes(spectrum, x):
    whole = scatter(x)
    size = max(1.0, np.linalg.eigvalsh(whole)[-1])
    assert spectrum.count == len(x) and np.allclose(spectrum.mean, x.mean(0))
    assert np.abs(spectrum.vectors * spectrum.values @ spectrum.vectors.T - whole).max() < 1e-12 * size
    assert np.abs(spectrum.vectors.T @ spectrum.vectors - np.eye(x.shape[1])).max() < 1e-12
    assert (np.diff(spectrum.values) >= 0).all()


@pytest.mark.parametrize("dimension, count", [(1, 6), (2, 9), (7, 3), (8, 90), (40, 120)])
def test_updates_and_joins(dimension, count):
    draw = np.random.default_rng(dimension)
    x = np.floor(64 * draw.standard_normal((count, dimension)) * np.linspace(0.05, 3, dimension))
    if dimension == 8:
        x[:, 3], x[:, 5], x[:, 6] = x[:, 2], 0, 7  # repeated, empty and constant directions
    parts = [Spectrum(dimension) for _ in range(3)]
    for i, row in enumerate(x):
        parts[i % 3].add(row)
    parts[1].add(x[0], 5)
    for part in parts[1:]:
        parts[0].join(part)
    parts[0].join(Spectrum(dimension))
    assert_decomposes(parts[0], np.vstack([x, *[x[:1]] * 5]))


def test_secular_roots_stand_between_the_poles():
    poles, weights = np.array([0.0, 1e-9, 1.0, 1e6]), np.array([1e-12, 3.0, 1e-7, 2.0])
    roots, away = secular_roots(poles, weights)
    assert (roots[:-1] >= poles[:-1]).all() and (roots[:-1] <= poles[1:]).all() and roots[-1] > poles[-1]
    whole = np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights))
    assert np.allclose(roots, np.linalg.eigvalsh(whole), rtol=1e-12, atol=1e-9)
    assert (np.sign(away) == np.where(np.arange(4)[:, None] <= np.arange(4), -1, 1)).all()


def check(rows, vectors, most=32):
    """The rows against a dense decomposition; ``vectors`` are (id, list) that take part."""
    x = np.floor(64 * np.array([v for _, v in vectors], np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    off = x - sums / n
    values, directions = np.linalg.eigh(off.T @ off / n)
    values, directions = values[::-1], directions[:, ::-1]
    used = min(most, x.shape[1])
    assert len(rows) == n * used and {r["n"] for r in rows} == {n}
    deviations = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    found = {}
    for r in rows:
        found.setdefault((r["vec_id"], r["deviation"]), {}).setdefault(r["component"], []).append(r)
    assert {(i, d) for (i, _), d in zip(vectors, deviations)} == set(found)
    matrix = np.full((n, used), np.nan)
    for at, ((i, _), d) in enumerate(zip(vectors, deviations)):
        for component, same in found[i, d].items():
            matrix[at, component - 1] = np.nan if same[0]["whitened"] is None else same[0]["whitened"]
            assert same[0]["explained"] == pytest.approx(max(0.0, values[component - 1] / values.sum()), rel=1e-9, abs=1e-14)
    spread = values[:used] > 1e-10 * values[0]
    assert np.isnan(matrix[:, ~spread]).all()
    wanted = off @ directions[:, :used][:, spread] / np.sqrt(values[:used][spread])
    signs = np.sign((matrix[:, spread] * wanted).sum(0))
    gaps = np.abs(np.subtract.outer(values, values) + np.eye(len(values)) * values[0]).min(1)[:used][spread] > 1e-6 * values[0]
    assert np.allclose((matrix[:, spread] * signs)[:, gaps], wanted[:, gaps], atol=1e-7)
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-4


def whitened(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, n int, part string")
    return whitened_rows(frame.repartition(5), **options).collect()


def test_whole_given_table(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding").collect()
    check(QUERIES["op13_whitening"](spark, DATA).collect(), [tuple(r) for r in table])


def test_joins_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    draw = np.random.default_rng(2)
    rows = [(i, (draw.standard_normal(6) * [1, 2, 3, 4, 5, 6]).tolist()) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)
    check(whitened_rows(frame, most=4).collect(), [(i, np.array(v)) for i, v in rows], most=4)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [math.sin(i), math.cos(3 * i) * 2, i / 7]) for i in range(30)]
    good += [(None, [0.5, 0.25, 1.0]), (3, [9.0, 9.0, 9.0]), *[(99, [1.0, 1.0, 1.0])] * 12]
    good = [(i, np.array(v, np.float32).tolist()) for i, v in good]
    odd = [(50, None), (51, []), (52, [1.0, nan, 1.0]), (53, [inf, 1.0, 1.0]), (54, [1.0, None, 2.0]), (55, [1.0, 2.0]), (56, [1e38, 0.0, 0.0])]
    rows = whitened(spark, good + odd)
    once = {}
    for r in rows:
        once.setdefault((r["vec_id"], r["deviation"], r["component"]), []).append(r)
    assert [len(v) for k, v in once.items() if k[0] == 99] == [12] * 3
    check(rows, good)


def test_without_spread(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None), (2, [])]) == []
    one = whitened(spark, [(7, [1.0, 2.0])])
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in sorted(one)] == [
        (7, 1, 1, 0, None, None), (7, 2, 1, 0, None, None),
    ]
    flat = whitened(spark, [(i, [float(i), 1.0]) for i in range(4)])
    assert [r["whitened"] is None for r in sorted(flat)] == [False, True] * 4


def test_large_deviations():
    x = np.array([[1_000_000 + (1 << 45), 5]], np.int64)
    assert whitening._exact_deviations(x, 1 << 20, [0, 0]) == [None]
    small = np.array([[1_000_000 + (1 << 28), 5]], np.int64)
    assert whitening._exact_deviations(small, 4, [0, 8]) == [(4 * int(small[0, 0])) ** 2 + 144]
