"""A trained, stored index of item vectors: a search that finds most of the nearest items, and an exact one that
leaves out cells which cannot hold any.

Training draws a sample, finds centres by k-means on directions, and gives every item to the cell of its closest
centre. The items are written once, sorted by cell, beside a small table of the cells: centre, items, the widest
angle between the centre and an item, the longest and the shortest vector. A search reads this table as a whole (at most
``MOST_CELLS`` centres) and the items' table by cell.

``search`` looks in the cells whose centres are closest to the user until a share of all items is reached. The share is
part of the training: the least one with which a sample of vectors finds ``recall`` of its exact neighbours, so it is small
where vectors form clusters and large where they have no structure.

``exact`` first scores each user against the cells with k items that promise most. The k-th score found is a floor: a cell
whose best possible score (from the angle between user and centre, less the widest angle in the cell, and from the vectors'
lengths) lies below it holds nothing better, and is skipped. What is left is scored, and the rows are those of ``top_k``.

Neighbouring cells share a block of bounded size, and a crowded cell is cut into several. A user travels to each block once,
with the numbers of its cells there, and a block asked for by many users is scored in parts, like the grid of ``top_k``: what is
shuffled follows the blocks, not the cells, that a user asks for.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.operators.topk import ITEMS_PER_CELL, USERS_PER_CELL, best_of, check_choice, named, score_asked, top_k
from marquee.session import new_folder, remove_folder, store_once

# Like the scorer, these functions travel to the workers as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_CELLS = 4096
CELLS_PER_ROOT = 4
# Sampled vectors for each centre, and vectors that the share is measured with (as many as ``top_k`` sends to the items).
SAMPLE_PER_CELL = 64
MEASURED = 64
RECALL = 0.93
ROUNDS = 10
_DRAWS = 1 << 30
# A similarity in single or double precision is off by less.
_SLACK = 1e-6
# Items without a direction.
NOWHERE = -1
_PLACES = pa.list_(pa.struct([("block", pa.int32()), ("cells", pa.list_(pa.int32()))]))
# Blocks or parts of blocks that one task scores where there are many.
_GROUPS_A_TASK = 16
# Items looked at first for each one that is wanted, where some are left out.
_HIDDEN_TOO = 8
# Closeness of users to cells that is held at once, eight bytes each, and cells that are put in order before all are.
_CLOSENESS_AT_ONCE = 2_000_000
_FIRST_CELLS = 32


@dataclass
class Cells:
    """The table of the cells that hold items; ``share`` of all items is what ``search`` looks at."""

    numbers: np.ndarray
    centres: np.ndarray
    items: np.ndarray
    widest: np.ndarray
    longest: np.ndarray
    shortest: np.ndarray
    share: float
    blocks: np.ndarray
    parts: np.ndarray
    nowhere: int
    nowhere_block: int
    nowhere_parts: int

    def closeness(self, vectors: np.ndarray) -> np.ndarray:
        lengths = np.linalg.norm(vectors, axis=1)
        return np.clip((vectors / np.where(lengths > 0, lengths, 1.0)[:, None]) @ self.centres.T, -1.0, 1.0)

    def likeness(self, closeness: np.ndarray, metric: str) -> np.ndarray:
        """What cells are looked in first by: the closest ones, by dot product those whose long vectors promise most."""
        return closeness if metric == "cosine" else closeness * self.longest

    def until(self, closeness: np.ndarray, wanted: float) -> np.ndarray:
        """For each row whether a cell is one of the closest that together hold ``wanted`` items."""
        chosen = np.zeros(closeness.shape, dtype=bool)
        rest = np.arange(len(closeness))
        if closeness.shape[1] > 4 * _FIRST_CELLS:
            near = np.sort(np.argpartition(-closeness, _FIRST_CELLS, axis=1)[:, :_FIRST_CELLS], axis=1)
            rest = rest[~self._take(chosen, rest, closeness, near, wanted)]
        if len(rest):
            self._take(chosen, rest, closeness, np.broadcast_to(np.arange(closeness.shape[1]), closeness.shape), wanted)
        return chosen

    def _take(self, chosen: np.ndarray, rows: np.ndarray, closeness: np.ndarray, among: np.ndarray, wanted: float) -> np.ndarray:
        """Mark the closest cells among some; false for rows where these hold too little, which stay unmarked."""
        among = among[rows]
        order = np.take_along_axis(among, np.argsort(-closeness[rows[:, None], among], axis=1, kind="stable"), axis=1)
        held = np.cumsum(self.items[order], axis=1)
        enough = (held[:, -1] >= wanted) | (order.shape[1] == closeness.shape[1])
        needed = np.hstack([np.ones((len(rows), 1), dtype=bool), held[:, :-1] < wanted]) & enough[:, None]
        row, place = np.nonzero(needed)
        chosen[rows[row], order[row, place]] = True
        return enough

    def best_possible(self, closeness: np.ndarray, lengths: np.ndarray, metric: str) -> np.ndarray:
        """No item of a cell scores higher; users in rows."""
        # The cosine of the angle to the centre less the widest one in the cell.
        apart = closeness * np.cos(self.widest) + np.sqrt(1.0 - closeness * closeness) * np.sin(self.widest)
        bound = np.where(closeness >= np.cos(self.widest), 1.0, apart) + _SLACK
        if metric == "cosine":
            return bound
        reach = np.where(bound > 0, self.longest, self.shortest)
        return lengths[:, None] * reach * bound + _SLACK * lengths[:, None] * self.longest

    def by_block(self, chosen: np.ndarray, nowhere: np.ndarray) -> pa.ListArray:
        """For each row the blocks of its cells, with the cells' numbers; a cell of several blocks is in each."""
        row, cell = np.nonzero(chosen)
        lost = np.flatnonzero(nowhere)
        numbers = np.r_[self.numbers[cell], np.full(len(lost), NOWHERE, dtype=np.int32)].astype(np.int32)
        first = np.r_[self.blocks[cell], np.full(len(lost), self.nowhere_block)]
        parts = np.r_[self.parts[cell], np.full(len(lost), self.nowhere_parts)].astype(np.int64)
        row = np.repeat(np.r_[row, lost], parts)
        block = np.repeat(first, parts) + np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        numbers = np.repeat(numbers, parts)
        order = np.lexsort((numbers, block, row))
        row, block, numbers = row[order], block[order], numbers[order]
        starts = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(block) != 0)]) if len(row) else row
        cells = pa.ListArray.from_arrays(np.r_[starts, len(row)].astype(np.int32), pa.array(numbers, pa.int32()))
        places = pa.StructArray.from_arrays([pa.array(block[starts].astype(np.int32)), cells], ["block", "cells"])
        return pa.ListArray.from_arrays(np.searchsorted(row[starts], np.arange(len(chosen) + 1)).astype(np.int32), places)


def _directions(df: DataFrame, id_column: str, features: str, name: str, vector: str) -> DataFrame:
    kind = "array<float>" if df.schema[features].dataType.simpleString() == "array<float>" else "array<double>"
    return df.select(F.col(id_column).alias(name), F.col(features).cast(kind).alias(vector))


def _has_direction(vector: str) -> Column:
    return F.exists(vector, lambda x: x != 0)


def _rows(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _pieces(rows: int, cells: int) -> Iterator[slice]:
    step = max(1, _CLOSENESS_AT_ONCE // max(1, cells))
    return (slice(start, start + step) for start in range(0, rows, step))


def _first_blocks(centres: np.ndarray, items: np.ndarray, parts: np.ndarray, most: int) -> np.ndarray:
    """The first block of each cell: neighbouring cells share one of at most ``most`` items, and a larger cell has its own."""
    groups, open_ = [], [np.flatnonzero(parts == 1)]
    while open_:
        cells = open_.pop()
        if len(cells) < 2 or items[cells].sum() <= most:
            groups += [cells] * (len(cells) > 0)
            continue
        # Cut across the direction in which the centres differ most, at the widest gap in the middle.
        away = centres[cells] - centres[cells].mean(axis=0)
        place = away @ np.linalg.eigh(away.T @ away)[1][:, -1]
        order = np.argsort(place, kind="stable")
        held = np.cumsum(items[cells[order]]) / items[cells].sum()
        middle = (held[:-1] >= 0.25) & (held[:-1] <= 0.75)
        cut = np.argmax(np.where(middle if middle.any() else True, np.diff(place[order]), -1.0)) + 1
        open_ += [cells[order[cut:]], cells[order[:cut]]]
    first, following = np.zeros(len(items), dtype=np.int64), len(groups)
    for number, cells in enumerate(groups):
        first[cells] = number
    for cell in np.flatnonzero(parts > 1):
        first[cell], following = following, following + parts[cell]
    return first


def _placed(centres: np.ndarray, vector: Column) -> Column:
    """Each vector's cell, its angle to the centre and its length."""
    kind = pa.struct([("cell", pa.int32()), ("angle", pa.float64()), ("length", pa.float64())])

    @F.arrow_udf("struct<cell:int,angle:double,length:double>")
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            if not len(lists) or not len(centres):
                yield pa.array([None] * len(lists), kind)
                continue
            vectors = _rows(lists)
            lengths = np.linalg.norm(vectors, axis=1)
            directions = vectors / np.where(lengths > 0, lengths, 1.0)[:, None]
            cell, angle = np.empty(len(lists), dtype=np.int64), np.empty(len(lists))
            for piece in _pieces(len(lists), len(centres)):
                likeness = directions[piece] @ centres.T
                cell[piece] = likeness.argmax(axis=1)
                angle[piece] = np.arccos(np.clip(likeness[np.arange(len(likeness)), cell[piece]], -1.0, 1.0))
            columns = [pa.array(cell.astype(np.int32)), pa.array(angle), pa.array(lengths)]
            yield pa.StructArray.from_arrays(columns, ["cell", "angle", "length"])

    return place(vector)


def _drawn(id_column: str, count: int, wanted: int, seed: int) -> Column:
    """A sample by a hash of the id: the same in any partitioning."""
    share = min(1.0, 1.2 * wanted / max(1, count))
    return F.pmod(F.xxhash64(F.lit(seed), id_column), F.lit(_DRAWS)) < int(share * _DRAWS)


class ItemIndex:
    """The index in a folder, which ``build`` has written."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
        placed = [r for r in rows if r["cell"] != NOWHERE]
        column = lambda name: np.array([r[name] for r in placed], dtype=np.float64)
        lost = next((r for r in rows if r["cell"] == NOWHERE), {"items": 0, "block": 0, "parts": 0})
        self.cells = Cells(
            np.array([r["cell"] for r in placed], dtype=np.int32),
            np.array([r["centre"] for r in placed], dtype=np.float64),
            *(column(name) for name in ("items", "widest", "longest", "shortest")),
            share=rows[0]["share"] if rows else 1.0,
            blocks=np.array([r["block"] for r in placed], dtype=np.int64),
            parts=np.array([r["parts"] for r in placed], dtype=np.int64),
            nowhere=lost["items"],
            nowhere_block=lost["block"],
            nowhere_parts=lost["parts"],
        )

    @classmethod
    def build(
        cls,
        items: DataFrame,
        path: str,
        item_col: str = "movie_id",
        features: str = "features",
        recall: float = RECALL,
        k: int = 10,
        seed: int = 42,
        items_per_cell: int = ITEMS_PER_CELL,
    ) -> ItemIndex:
        """Train on the items and write the index; the folder must not exist yet."""
        spark = items.sparkSession
        # Written once and dealt out evenly: a small file may hold many vectors, and they are gone through several times.
        _directions(items, item_col, features, "_item", "_if").repartition("_item").write.parquet(f"{path}/vectors")
        vectors = spark.read.parquet(f"{path}/vectors")
        count = vectors.where(_has_direction("_if")).count()
        wanted = max(1, min(MOST_CELLS, ceil(CELLS_PER_ROOT * sqrt(count))))
        centres = cls._centres(vectors, count, wanted, seed)
        located = vectors.withColumn("_at", F.when(_has_direction("_if"), _placed(centres, F.col("_if"))))
        located = located.select("_item", "_if", F.coalesce("_at.cell", F.lit(NOWHERE)).alias("_cell"), "_at.angle", "_at.length")
        located.write.parquet(f"{path}/located")
        remove_folder(spark, f"{path}/vectors")
        located = spark.read.parquet(f"{path}/located")
        sizes = located.groupBy(F.col("_cell").alias("cell")).agg(
            F.count("*").alias("items"),
            F.coalesce(F.max("angle"), F.lit(0.0)).alias("widest"),
            F.coalesce(F.max("length"), F.lit(0.0)).alias("longest"),
            F.coalesce(F.min("length"), F.lit(0.0)).alias("shortest"),
        )
        sizes = sizes.withColumn("parts", F.ceil(F.col("items") / items_per_cell).cast("int"))
        rows = [r.asDict() for r in sizes.collect()]  # as many as there are cells
        middle = np.zeros((len(rows), centres.shape[1]))
        for place, row in enumerate(rows):
            middle[place] = 0 if row["cell"] == NOWHERE else centres[row["cell"]]
        held, cut = (np.array([r[name] for r in rows], dtype=np.int64) for name in ("items", "parts"))
        for row, block in zip(rows, _first_blocks(middle, held, cut, items_per_cell).tolist()):
            row["block"] = block
        places = spark.createDataFrame([(r["cell"], r["block"], r["parts"]) for r in rows], "_cell int, _first int, _parts int")
        block = (F.col("_first") + F.pmod(F.xxhash64("_item"), F.col("_parts"))).cast("int").alias("_block")
        stored = located.join(F.broadcast(places), "_cell").select(block, "_cell", "_item", "_if")
        stored.repartitionByRange("_block", "_cell").sortWithinPartitions("_block", "_cell").write.parquet(f"{path}/items")
        table = [
            (
                r["cell"],
                centres[r["cell"]].tolist() if r["cell"] != NOWHERE else [],
                *(r[name] for name in ("items", "block", "parts", "widest", "longest", "shortest")),
            )
            for r in rows
        ]
        names = "cell int, centre array<double>, items long, block int, parts int, widest double, longest double, shortest double"
        cells = spark.createDataFrame(table, names)
        share = cls._needed_share(located, table, centres, count, recall, k, seed)
        cells.coalesce(1).withColumn("share", F.lit(share)).write.parquet(f"{path}/cells")
        remove_folder(spark, f"{path}/located")
        return cls(spark, path)

    @staticmethod
    def _centres(vectors: DataFrame, count: int, wanted: int, seed: int) -> np.ndarray:
        if not count:
            return np.empty((0, 0))
        sample = vectors.where(_has_direction("_if") & _drawn("_item", count, wanted * SAMPLE_PER_CELL, seed))
        sample = sample.repartition("_item").select(array_to_vector(F.col("_if").cast("array<double>")).alias("features")).persist()
        try:
            found = min(wanted, max(1, sample.count()))
            model = KMeans(k=found, seed=seed, maxIter=ROUNDS, initMode="random", distanceMeasure="cosine").fit(sample)
        finally:
            sample.unpersist()
        centres = np.array(model.clusterCenters(), dtype=np.float64)
        lengths = np.linalg.norm(centres, axis=1)
        return centres[lengths > 0] / lengths[lengths > 0][:, None]

    @staticmethod
    def _needed_share(located: DataFrame, table: list[tuple], centres: np.ndarray, count: int, recall: float, k: int, seed: int) -> float:
        """The least share of the items in which a sample of vectors finds ``recall`` of its exact neighbours."""
        directed = located.where(F.col("_cell") != NOWHERE)
        asked = directed.where(_drawn("_item", count, MEASURED, seed + 1)).orderBy("_item").limit(MEASURED)
        asked = asked.select(F.col("_item").alias("user_id"), F.col("_if").alias("features"))
        queries = {r["user_id"]: r["features"] for r in asked.collect()}
        if not queries:
            return 1.0
        items = directed.select(F.col("_item").alias("movie_id"), F.col("_if").alias("features"))
        best = top_k(asked, items, k).select("user_id", "movie_id")
        best = best.join(directed.select(F.col("_item").alias("movie_id"), "_cell"), "movie_id").collect()  # MEASURED * k rows
        sizes = np.zeros(len(centres))
        for row in table:
            if row[0] != NOWHERE:
                sizes[row[0]] = row[2]
        needed = []
        for row in best:
            vector = np.array(queries[row["user_id"]])
            closeness = centres @ vector
            needed.append(sizes[closeness >= closeness[row["_cell"]]].sum() / count)
        return float(np.quantile(needed, recall, method="higher"))

    @property
    def items(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/items")

    def _asked(self, users: DataFrame, choose: Callable, *extra: str) -> DataFrame:
        """Users and the blocks of the cells that ``choose`` names: a function of vectors and the columns ``extra``.

        Chosen once and stored: the users of a block are counted before they travel.
        """
        chosen = F.arrow_udf("array<struct<block:int,cells:array<int>>>")(choose)(F.col("_uf"), *[F.col(c) for c in extra])
        # Dealt to all cores whatever the bytes: a user is compared with every centre.
        tasks = 4 * self.spark.sparkContext.defaultParallelism
        return store_once(users.repartition(tasks, "_user").select("_user", "_uf", chosen.alias("_at")), "asked")

    @staticmethod
    def _by_block(asked: DataFrame) -> DataFrame:
        """One row for each user and block."""
        rows = asked.select("_user", "_uf", F.explode("_at").alias("_at"))
        return rows.select("_user", "_uf", F.col("_at.block").alias("_block"), F.col("_at.cells").alias("_cells"))

    def _seen(self, exclude: DataFrame, user_col: str, item_col: str) -> DataFrame:
        """Excluded items as one array per user and block: never longer than a block."""
        pairs = exclude.select(F.col(user_col).alias("_user"), F.col(item_col).alias("_item"))
        placed = pairs.join(self.items.select("_item", "_block"), "_item").groupBy("_user", "_block")
        return store_once(placed.agg(F.collect_set("_item").alias("_seen")), "seen")

    def _scored(self, asked: DataFrame, k: int, metric: str, users_per_cell: int, seen: DataFrame | None = None) -> DataFrame:
        """The k best rows of each user in each block that it asks for; a block that many ask for is scored in parts."""
        crowds = asked.groupBy("_block").count().collect()  # as many as there are blocks
        # Two parts for every core if there is work for them: each is one more copy of the block.
        cores = self.spark.sparkContext.defaultParallelism
        most = max(1, min(users_per_cell, max(256, ceil(sum(r["count"] for r in crowds) / (2 * cores)))))
        parts = self.spark.createDataFrame([(r["_block"], ceil(r["count"] / most)) for r in crowds], "_block int, _parts int")
        left = asked.join(F.broadcast(parts), "_block")
        left = left.select("_user", "_uf", "_cells", "_block", F.pmod(F.xxhash64("_user"), F.col("_parts")).cast("int").alias("_ub"))
        if seen is not None:
            left = left.join(seen, ["_user", "_block"], "left")
        right = self.items.join(F.broadcast(parts), "_block")
        right = right.select("_item", "_if", "_cell", "_block", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_ub"))
        # Spread by the scoring to do, which the bytes do not show.
        place = ["_block", "_ub"]
        groups = sum(ceil(r["count"] / most) for r in crowds)
        tasks = max(1, min(2 * groups, max(8 * cores, groups // _GROUPS_A_TASK)))
        return score_asked(left.repartition(tasks, *place), right.repartition(tasks, *place), place, k, metric, seen is not None)

    def _nearest(self, wanted: float, metric: str = "cosine") -> Callable:
        cells = self.cells

        def choose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for lists in batches:
                if not len(lists) or not len(cells.items):
                    yield pa.array([[]] * len(lists), _PLACES)
                    continue
                vectors, out = _rows(lists), []
                for piece in _pieces(len(vectors), len(cells.items)):
                    chosen = cells.until(cells.likeness(cells.closeness(vectors[piece]), metric), wanted)
                    out.append(cells.by_block(chosen, np.zeros(len(chosen), dtype=bool)))
                yield pa.concat_arrays(out)

        return choose

    def asked_pairs(self, asked: DataFrame) -> int:
        """How many pairs the users by block are scored with."""
        place = ["_block", "_cell"]
        wanted = asked.select("_block", F.explode("_cells").alias("_cell")).groupBy(*place).agg(F.count("*").alias("users"))
        sizes = self.items.groupBy(*place).agg(F.count("*").alias("n"))
        return wanted.join(sizes, place).agg(F.coalesce(F.sum(F.col("users") * F.col("n")), F.lit(0))).first()[0]

    def probes(self, users: DataFrame, user_col: str = "user_id", features: str = "features") -> DataFrame:
        """Users with a direction by the blocks and cells that ``search`` looks in."""
        directed = _directions(users, user_col, features, "_user", "_uf").where(_has_direction("_uf"))
        return self._by_block(self._asked(directed, self._nearest(self.cells.share * self.cells.items.sum())))

    def search(
        self,
        users: DataFrame,
        k: int,
        user_col: str = "user_id",
        item_col: str = "movie_id",
        features: str = "features",
        users_per_cell: int = USERS_PER_CELL,
    ) -> DataFrame:
        """(user, item, score, rank) by cosine; a neighbour in a cell that is not looked in is missed."""
        check_choice(k, "cosine")
        found = self._scored(self.probes(users, user_col, features), k, "cosine", users_per_cell)
        return named(best_of(found, k), user_col, item_col)

    def exact_steps(
        self, users: DataFrame, k: int, metric: str, user_col: str, features: str, users_per_cell: int, seen: DataFrame | None = None
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Users by the blocks of their first cells, the best rows found there, and users by those of the other cells that may
        hold better ones."""
        everyone = _directions(users, user_col, features, "_user", "_uf")
        cells = self.cells
        # Some of the first items may be hidden; a user left with less than k of them looks in all cells.
        looked = float(k if seen is None else _HIDDEN_TOO * k)
        asked = self._asked(everyone, self._nearest(looked, metric))
        first = self._by_block(asked)
        found = store_once(best_of(self._scored(first, k, metric, users_per_cell, seen), k), "first-cells")
        floors = found.groupBy("_user").agg(F.min("_score").alias("_floor"), F.count("_score").alias("_n"))
        floors = asked.select("_user", "_uf").join(floors.where(F.col("_n") >= k).select("_user", "_floor"), "_user", "left")

        def choose(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for lists, floor in batches:
                if not len(lists):
                    yield pa.array([], _PLACES)
                    continue
                vectors, floors_of = _rows(lists), floor.to_numpy(zero_copy_only=False).astype(np.float64)
                out = []
                for piece in _pieces(len(vectors), len(cells.items)):
                    lengths, least = np.linalg.norm(vectors[piece], axis=1), floors_of[piece]
                    open_ = np.zeros((len(least), len(cells.items)), dtype=bool)
                    if len(cells.items):
                        closeness = cells.closeness(vectors[piece])
                        bounds = cells.best_possible(closeness, lengths, metric)
                        # Every score of a vector without direction is the same: all cells may hold a lower id.
                        open_ = (bounds >= least[:, None] - _SLACK) | np.isnan(least)[:, None] | (lengths == 0)[:, None]
                        open_ &= ~cells.until(cells.likeness(closeness, metric), looked)
                    # Without a direction: similarity is null and ranks last, a product is zero.
                    zero = np.isnan(least) | (lengths == 0) | ((least <= _SLACK) & (metric == "dot"))
                    out.append(cells.by_block(open_, zero & (cells.nowhere > 0)))
                yield pa.concat_arrays(out)

        return first, found, self._by_block(self._asked(floors, choose, "_floor"))

    def exact(
        self,
        users: DataFrame,
        k: int,
        metric: str = "cosine",
        user_col: str = "user_id",
        item_col: str = "movie_id",
        features: str = "features",
        users_per_cell: int = USERS_PER_CELL,
        exclude: DataFrame | None = None,
    ) -> DataFrame:
        """The rows of ``top_k`` for these items, without scoring the cells that cannot hold any of them."""
        check_choice(k, metric)
        seen = None if exclude is None else self._seen(exclude, user_col, item_col)
        _, found, rest = self.exact_steps(users, k, metric, user_col, features, users_per_cell, seen)
        more = self._scored(rest, k, metric, users_per_cell, seen)
        columns = ["_user", "_item", "_score"]
        return named(best_of(found.select(*columns).unionByName(more.select(*columns)), k), user_col, item_col)

    def exact_pairs(self, users: DataFrame, k: int, metric: str = "cosine", user_col: str = "user_id", features: str = "features") -> int:
        """How many pairs ``exact`` scores."""
        first, _, rest = self.exact_steps(users, k, metric, user_col, features, USERS_PER_CELL)
        return self.asked_pairs(first) + self.asked_pairs(rest)

    def sampled_share(self, users: DataFrame, count: int, k: int, metric: str, user_col: str, features: str, seed: int = 42) -> float:
        """The share of the items that ``exact`` has to score, measured with a sample of about ``count`` users."""
        everyone = _directions(users, user_col, features, "user_id", "features")
        asked = everyone.where(_drawn("user_id", count, MEASURED, seed)).limit(MEASURED).collect()
        if not asked or not len(self.cells.items):
            return 1.0
        sample = self.spark.createDataFrame([tuple(r) for r in asked], everyone.schema)
        items = self.items.select(F.col("_item").alias("movie_id"), F.col("_if").alias("features"))
        worst = top_k(sample, items, k, metric).groupBy("user_id").agg(F.min("score").alias("floor")).collect()  # MEASURED rows
        floor = {r["user_id"]: r["floor"] for r in worst}
        vectors = np.array([r["features"] for r in asked], dtype=np.float64)
        least = np.array([floor.get(r["user_id"]) for r in asked], dtype=np.float64)
        closeness, lengths = self.cells.closeness(vectors), np.linalg.norm(vectors, axis=1)
        open_ = self.cells.best_possible(closeness, lengths, metric) >= least[:, None] - _SLACK
        open_ |= np.isnan(least)[:, None] | (lengths == 0)[:, None] | self.cells.until(self.cells.likeness(closeness, metric), float(k))
        return float((open_ * self.cells.items).sum() / (len(asked) * self.cells.items.sum()))


def exact_if_pruned(
    users: DataFrame,
    items: DataFrame,
    k: int,
    metric: str,
    exclude: DataFrame | None,
    user_col: str,
    item_col: str,
    features: str,
    everyone: DataFrame,
    count: int,
    most: float,
) -> DataFrame | None:
    """The rows of ``top_k`` through an index of its own, or None where bounds leave more than a share ``most`` of the pairs.

    Also None where an item's vector is unusable. The sample that tells is drawn from ``everyone``, about ``count`` rows.
    """
    check_choice(k, metric)
    if features not in everyone.columns:
        everyone = users
    sound = F.forall(features, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    kinds = items.agg(
        F.count_if(~F.coalesce(sound, F.lit(False))).alias("unsound"),
        F.min(F.size(features)).alias("shortest"),
        F.max(F.size(features)).alias("longest"),
    ).first()
    if kinds["unsound"] or kinds["shortest"] != kinds["longest"] or not kinds["longest"]:
        return None
    index = ItemIndex.build(items, new_folder(items.sparkSession, "searched"), item_col, features, k=k)
    if index.sampled_share(everyone, count, k, metric, user_col, features) > most:
        remove_folder(index.spark, index.path)
        return None
    return index.exact(users, k, metric, user_col, item_col, features, exclude=exclude)
