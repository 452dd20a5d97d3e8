"""Collision counting against the cosines of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import neighbours
from marquee.llm.neighbours import nearest_neighbours


def plain(rows, is_query, k):
    """The k nearest by cosine in double precision, as (query, rank, id, score)."""
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for q, a in sorted(usable):
        if not is_query(q):
            continue
        scored = {}
        for i, b in usable:
            if i != q and len(a) == len(b):
                score = np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b))
                scored[i] = max(score, scored.get(i, -2))
        best = sorted(scored.items(), key=lambda x: (-round(x[1], 12), x[0]))[:k]
        out += [(q, n, i, pytest.approx(s)) for n, (i, s) in enumerate(best, 1)]
    return out


def search(spark, rows, k=5, query=10):
    frame = spark.createDataFrame([(i, v, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, label string, score double")
    found = nearest_neighbours(frame, F.col("vec_id") % query == 0, k).collect()
    return sorted(tuple(r) for r in found)


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [-1.0, 0.0]),
        (6, None), (7, []), (8, [0.0, 0.0]), (9, [nan, 1.0]), (10, [inf, 1.0]), (11, [None, 1.0]), (12, [1.0, 0.0, 0.0]),
        (20, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (30, [1.0, 1.0]), (30, [1.0, 1.0]), (40, [1.0, 2.0, 3.0, 4.0]),
    ]
    assert search(spark, rows) == plain(rows, lambda q: q % 10 == 0, 5)
    assert search(spark, []) == []
    assert search(spark, [(0, [1.0])]) == []


def test_a_crowd_of_equal_vectors(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(300 + i, [float(i), 1.0, 0.5]) for i in range(20)]
    assert search(spark, rows, 5, 50) == plain(rows, lambda q: q % 50 == 0, 5)


def test_blocks_and_groups_change_nothing_when_all_is_verified(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    monkeypatch.setattr(neighbours, "GROUP", 3)
    monkeypatch.setattr(neighbours, "FIRST_RADIUS", 2.0)
    draw = np.random.default_rng(1)
    rows = [(i, draw.standard_normal(8).astype(np.float32).tolist()) for i in range(200)]
    assert search(spark, rows) == plain(rows, lambda q: q % 10 == 0, 5)


@pytest.mark.parametrize("scale", ["0.001", "0.1"])
def test_recall_of_the_query(spark, scale):
    from marquee.llm.queries import QUERIES

    folder = f"/root/testdata/sf{scale}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in QUERIES["op5_neighbours"](spark, folder).collect()}
    hits = total = 0
    for at in np.flatnonzero(ids % 50 == 0):
        scores = unit @ unit[at]
        scores[at] = -2
        want = ids[np.lexsort((ids, -scores))[:5]].tolist()
        got = [found[ids[at], n] for n in range(1, 6)]
        assert [s for _, s in got] == sorted((s for _, s in got), reverse=True)
        assert all(abs(s - scores[np.flatnonzero(ids == i)[0]]) < 1e-12 for i, s in got)
        hits += len(set(want) & {i for i, _ in got})
        total += 5
    assert len(found) == total
    assert hits / total >= 0.9
