"""Nearest neighbours by collision counting over single-projection sorted arrays.

Each of ``PROJECTIONS`` random directions gives one number per unit vector; in a block of vectors these
are sorted arrays. Round by round a window centred on the query's own projection grows in every
array (virtual rehashing: the bucket of width ``WIDTH`` times the radius, never a stored table),
and a vector that lies in at least ``THRESHOLD`` of the windows collides often enough to be
verified by its true distance. A round's radius is large enough for a query when its k-th best
verified neighbour lies within it; by the projections' normal spread a vector at that distance is in
the windows with near certainty. Once the radius spans the sphere every vector of the block is
verified. There is no cap on candidates.

Vectors are dealt into blocks of about ``BLOCK``, queries into groups of about ``GROUP``, and each pair of
block and group is one task's work, of bounded size; blocks return their k best per query. Equal
vectors are stored once with the ids that can still win: the smallest k + 1.

Nearness is the cosine in double precision on the original components, ties go to the smaller id.
Defined results: vectors that are null, empty, zero, or hold a null or a component that is not
finite take no part, nor do rows without an id; vectors of different lengths are not compared. A
row is no neighbour of a row with its own id; repeated rows count once. A query with fewer candidates than k gets them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.session import store_once

PROJECTIONS = 64
THRESHOLD = 36
WIDTH = 2.0
FIRST_RADIUS = 0.25
GROWTH = 1.25
SEED = 20
BLOCK = 8192
GROUP = 2048
LARGEST_DISTANCE = 2.0  # between unit vectors


def usable(vector: Column) -> Column:
    """True for a vector that has a direction."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def directions(dimension: int) -> np.ndarray:
    """The same random directions everywhere, a column each."""
    return np.random.default_rng([SEED, dimension]).standard_normal((dimension, PROJECTIONS))


class CollisionIndex:
    """Sorted projections of one block of unit vectors."""

    def __init__(self, unit: np.ndarray) -> None:
        self.unit = unit
        self.directions = directions(unit.shape[1])
        projected = unit @ self.directions
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(projected.T, self.order, axis=1)

    def nearest(self, queries: np.ndarray, k: int) -> list[np.ndarray]:
        """For each unit query the places of its verified vectors, the k nearest among them."""
        size = len(self.unit)
        centres = queries @ self.directions
        found: list[np.ndarray] = [np.empty(0, np.int64)] * len(queries)
        waiting = np.arange(len(queries))
        radius = FIRST_RADIUS
        while len(waiting):
            if radius >= LARGEST_DISTANCE or size <= k:
                for q in waiting:
                    found[q] = np.arange(size)
                break
            half = WIDTH * radius / 2
            low = np.stack([np.searchsorted(s, centres[waiting, i] - half) for i, s in enumerate(self.sorted)])
            high = np.stack([np.searchsorted(s, centres[waiting, i] + half, "right") for i, s in enumerate(self.sorted)])
            left = []
            for column, q in enumerate(waiting):
                windows = [o[a:b] for o, a, b in zip(self.order, low[:, column], high[:, column])]
                collisions = np.bincount(np.concatenate(windows), minlength=size)
                candidates = np.flatnonzero(collisions >= THRESHOLD)
                if len(candidates) >= k:
                    closeness = self.unit[candidates] @ queries[q]
                    within = closeness >= 1 - radius * radius / 2  # distance at most the radius
                    if within.sum() >= k:
                        found[q] = candidates[within]
                        continue
                left.append(q)
            waiting = np.array(left, dtype=np.int64)
            radius *= GROWTH
        return found


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)


def _search(k: int):
    schema = pa.schema(
        [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    )

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        if not queries.num_rows or not block.num_rows:
            return schema.empty_table()
        wanted, stored = _vectors(queries["vector"]), _vectors(block["vector"])
        wanted_norm, stored_norm = np.linalg.norm(wanted, axis=1), np.linalg.norm(stored, axis=1)
        index = CollisionIndex(stored / stored_norm[:, None])
        # One more than k distinct vectors, as the query's own may be among them.
        found = index.nearest(wanted / wanted_norm[:, None], k + 1)
        ids = block["ids"].to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        for q, (query_id, places) in enumerate(zip(queries["query_id"].to_pylist(), found)):
            scores = (stored[places] @ wanted[q]) / (stored_norm[places] * wanted_norm[q])
            rows = []
            # In falling order; all that tie with the last one that can matter are looked at.
            for at in np.argsort(-scores, kind="stable"):
                score = float(scores[at])
                if len(rows) >= k and score < rows[k - 1][0]:
                    break
                rows += [(score, i) for i in ids[places[at]] if i != query_id]
                rows.sort(key=lambda r: (-r[0], r[1]))
            for score, vec_id in rows[:k]:
                out[0].append(query_id)
                out[1].append(vec_id)
                out[2].append(score)
        return pa.table(list(out), schema=schema)

    return search


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for the rows that ``is_query`` picks, the k nearest of all rows."""
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"), is_query.alias("asked")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    rows = store_once(rows, "neighbour-rows")
    # Equal vectors: the smallest ids are enough; the limit per group is applied before the shuffle.
    smallest = Window.partitionBy("vector").orderBy("id")
    distinct = (
        rows.select("id", "vector")
        .withColumn("place", F.dense_rank().over(smallest))
        .where(F.col("place") <= k + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_set("id")).alias("ids"))
    )
    distinct = store_once(distinct, "neighbour-vectors")
    queries = rows.where("asked").select(F.col("id").alias("query_id"), "vector").distinct()
    queries = store_once(queries, "neighbour-queries")
    blocks, groups = max(1, -(-distinct.count() // BLOCK)), max(1, -(-queries.count() // GROUP))
    place = lambda n, *columns: F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    length = F.size("vector").alias("length")
    asked = queries.select("query_id", "vector", length, place(groups, "query_id").alias("group")).withColumn("block", each(blocks))
    stored = distinct.select("ids", "vector", length, place(blocks, "vector").alias("block")).withColumn("group", each(groups))
    cell = ["length", "group", "block"]
    found = (
        asked.groupBy(*cell)
        .cogroup(stored.groupBy(*cell))
        .applyInArrow(
            lambda left, right: _search(k)(left, right), "query_id long, vec_id long, score double"
        )
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
