"""The best k items of every user, exactly, by blocks of a matrix product.

Users and items are cut into blocks. Each pair of a user block and an item block is one
cell of a grid: a matrix product scores the cell and only k rows per user leave it. With
more than one item block a second step keeps the best k of the blocks' winners. Neither
table passes through the driver or is broadcast, a cell has a bounded size, and more users
or items only mean more cells.

All pairs are scored that way. Where these are many, the items are indexed first (``ItemIndex``): if a sample of the
users shows that bounds rule out most pairs, only the others are scored, with the same rows as a result.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

# The scorer travels to the Python workers as code, so they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Each user block is one more copy of the items on the way, so it is as large as an item block.
USERS_PER_CELL = 32768
ITEMS_PER_CELL = 32768
# So few users travel to the items instead of meeting them in cells.
FEW_USERS = 64
# Scores held at once inside a cell, four bytes each, and pairs scored again at once.
_TILE_SCORES = 8_000_000
_PAIRS_AT_ONCE = 200_000
# Lists of users whose rows are held at once, k each.
_LISTS_AT_ONCE = 50_000
_GROUPS = 512
# From so many pairs on an index is tried, and used if at most this share of the pairs is left.
PAIRS_FOR_INDEX = 50_000_000_000
INDEX_SHARE = 0.125
# A product of all pairs in double precision costs as much as scoring one pair of so many again by itself.
_PRODUCTS_PER_PAIR = 16
_DOUBLES_AT_ONCE = 2_000_000
# Numbers in the item vectors of a cell: long vectors make smaller cells, down to a least number of items.
_CELL_NUMBERS = 4_194_304
_LEAST_ITEMS = 1024

METRICS = ("cosine", "dot")


def top_k(
    users: DataFrame,
    items: DataFrame,
    k: int,
    metric: str = "cosine",
    exclude: DataFrame | None = None,
    user_col: str = "user_id",
    item_col: str = "movie_id",
    features: str = "features",
    users_per_cell: int = USERS_PER_CELL,
    items_per_cell: int = ITEMS_PER_CELL,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """(user, item, score, rank), rank 1..k by score descending, then item id.

    ``exclude`` holds (user, item) pairs that must not be recommended; they are left out
    before the k best are taken. A cosine with a zero vector is null and ranks last.
    ``sized_by`` stands in for ``users`` when counting, if ``users`` is costly to compute.
    """
    if exclude is None and sized_by is None:
        few = users.select(F.col(user_col).alias("_user"), F.col(features).alias("_uf")).limit(FEW_USERS + 1).collect()
        if len(few) <= FEW_USERS:
            return named(_best_for_few(few, users, items, k, metric, user_col, item_col, features), user_col, item_col)
    everyone = users if sized_by is None else sized_by
    user_count, item_count = _sizes(everyone, items)
    if user_count * item_count >= PAIRS_FOR_INDEX:
        # Imported here, as it imports this module.
        from marquee.operators.item_index import exact_if_pruned

        found = exact_if_pruned(users, items, k, metric, exclude, user_col, item_col, features, everyone, user_count, INDEX_SHARE)
        if found is not None:
            return found
    items_per_cell = min(items_per_cell, max(_LEAST_ITEMS, _CELL_NUMBERS // _dimension(items, features)))
    item_blocks = max(1, ceil(item_count / items_per_cell))
    # Two cells for every core if there is work for them, but no more: each user block is one more copy of the items.
    cores = users.sparkSession.sparkContext.defaultParallelism
    user_blocks = max(1, ceil(user_count / users_per_cell), min(ceil(2 * cores / item_blocks), ceil(user_count / 256)))

    item_block = _block(item_col, F.lit(item_blocks)).alias("_ib")
    left = users.select(
        F.col(user_col).alias("_user"),
        F.col(features).alias("_uf"),
        _block(user_col, F.lit(user_blocks)).alias("_ub"),
        F.explode(F.sequence(F.lit(0), F.lit(item_blocks - 1))).alias("_ib"),
    )
    right = items.select(
        F.col(item_col).alias("_item"),
        F.col(features).alias("_if"),
        item_block,
        F.explode(F.sequence(F.lit(0), F.lit(user_blocks - 1))).alias("_ub"),
    )
    if exclude is not None:
        left = left.join(_excluded_by_block(exclude, items, user_col, item_col, item_block), ["_user", "_ib"], "left")
    cells = score_cells(left, right, ["_ub", "_ib"], k, metric, exclude is not None)
    best = cells if item_blocks == 1 else best_of(cells, k)
    return named(best, user_col, item_col)


def _best_for_few(
    few: list, users: DataFrame, items: DataFrame, k: int, metric: str, user_col: str, item_col: str, features: str
) -> DataFrame:
    """The k best items of at most FEW_USERS users, scored where the items are read; k rows per user and batch leave a task."""
    check_choice(k, metric)
    types = [users.schema[user_col].dataType.simpleString(), items.schema[item_col].dataType.simpleString()]
    schema = f"_user {types[0]}, _item {types[1]}, _score double, _rank int"
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    left = pa.table({"_user": pa.array([r[0] for r in few], kinds.get(types[0])), "_uf": pa.array([r[1] for r in few], pa.list_(pa.float64()))})
    scorer = _cell_scorer(k, metric, False)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and left.num_rows:
                yield from scorer(left, pa.Table.from_batches([batch])).to_batches()

    right = items.select(F.col(item_col).alias("_item"), F.col(features).alias("_if"))
    return best_of(right.mapInArrow(score, schema), k)


def check_choice(k: int, metric: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if k < 1:
        raise ValueError("k must be positive")


def named(scored: DataFrame, user_col: str, item_col: str) -> DataFrame:
    """Scored pairs under the caller's column names."""
    scores = scored.withColumnsRenamed({"_user": user_col, "_item": item_col, "_score": "score", "_rank": "rank"})
    return scores.select(user_col, item_col, "score", "rank")


def _sizes(users: DataFrame, items: DataFrame) -> tuple[int, int]:
    counts = users.select(F.lit(1).alias("u")).unionAll(items.select(F.lit(0).alias("u"))).agg(
        F.coalesce(F.sum("u"), F.lit(0)), F.count("*")
    ).first()
    return counts[0], counts[1] - counts[0]


def _dimension(items: DataFrame, features: str) -> int:
    row = items.select(F.size(features)).filter(F.col(features).isNotNull()).first()
    return max(1, row[0]) if row else 1


def _block(id_column: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.col(id_column).cast("bigint")), blocks.cast("bigint")).cast("int")


def _excluded_by_block(exclude: DataFrame, items: DataFrame, user_col: str, item_col: str, item_block: Column) -> DataFrame:
    """Excluded items as one array per user and item block: never longer than a block."""
    known = exclude.select(user_col, item_col).join(items.select(item_col), item_col, "left_semi")
    grouped = known.groupBy(F.col(user_col).alias("_user"), item_block)
    return grouped.agg(F.collect_set(item_col).alias("_seen"))


def score_cells(left: DataFrame, right: DataFrame, cell: list[str], k: int, metric: str, excluding: bool = False) -> DataFrame:
    """(_user, _item, _score, _rank) of each cell's k best items per user."""
    check_choice(k, metric)
    types = {f.name: f.dataType.simpleString() for f in [*left.schema.fields, *right.schema.fields]}
    schema = f"_user {types['_user']}, _item {types['_item']}, _score double, _rank int"
    scorer = _cell_scorer(k, metric, excluding)
    return left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(scorer, schema)


def best_of(scored: DataFrame, k: int) -> DataFrame:
    """The k best rows per user; only k rows per user and task are shuffled."""
    order = Window.partitionBy("_user").orderBy(F.desc_nulls_last("_score"), "_item")
    return scored.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)


def _cell_scorer(k: int, metric: str, excluding: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out_types = [left.schema.field("_user").type, right.schema.field("_item").type, pa.float64(), pa.int32()]
        out_schema = pa.schema(list(zip(["_user", "_item", "_score", "_rank"], out_types)))
        if left.num_rows == 0 or right.num_rows == 0:
            return out_schema.empty_table()
        items = right.column("_item").to_numpy()
        order = np.argsort(items, kind="stable")
        item_matrix = _matrix(right.column("_if"))[order]
        users = left.column("_user").to_numpy()
        seen = left.column("_seen").combine_chunks() if excluding else None
        # Of equal vectors the lower ids win, so only as many can matter as are wanted and hidden together.
        possible = _copies_before(item_matrix) < k + (_longest(seen) if excluding else 0)
        items = items[order][possible]
        item_side = _Side(item_matrix[possible], unit=metric == "cosine")
        user_side = _Side(_matrix(left.column("_uf")), unit=True)

        step = max(1, _TILE_SCORES // len(items))
        found = []
        for start in range(0, len(users), step):
            rows = slice(start, start + step)
            hidden = _positions(seen[rows], items) if excluding else None
            row, col, values, rank = _best_in_tile(user_side, item_side, rows, k, metric, hidden)
            found.append((users[rows][row], items[col], values, rank))
        columns = [np.concatenate(parts) for parts in zip(*found)]
        scores = pa.array(columns[2], mask=np.isnan(columns[2]))
        return pa.table([pa.array(columns[0]), pa.array(columns[1]), scores, pa.array(columns[3])], schema=out_schema)

    return score


def score_asked(left: DataFrame, right: DataFrame, block: list[str], k: int, metric: str, excluding: bool = False) -> DataFrame:
    """(_user, _item, _score, _rank) of each block's k best items per user, out of the lists (_cell) that the user asks for.

    A user comes to a block once, with the numbers of its lists there (_cells), however many these are, and with the
    items of the block that are left out for it (_seen).
    """
    check_choice(k, metric)
    types = {f.name: f.dataType.simpleString() for f in [*left.schema.fields, *right.schema.fields]}
    schema = f"_user {types['_user']}, _item {types['_item']}, _score double, _rank int"
    return left.groupBy(*block).cogroup(right.groupBy(*block)).applyInArrow(_asked_scorer(k, metric, excluding), schema)


def _asked_scorer(k: int, metric: str, excluding: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out_types = [left.schema.field("_user").type, right.schema.field("_item").type, pa.float64(), pa.int32()]
        out_schema = pa.schema(list(zip(["_user", "_item", "_score", "_rank"], out_types)))
        if left.num_rows == 0 or right.num_rows == 0:
            return out_schema.empty_table()
        items, cells = right.column("_item").to_numpy(), right.column("_cell").to_numpy()
        order = np.lexsort((items, cells))
        items, cells, item_matrix = items[order], cells[order], _matrix(right.column("_if"))[order]
        starts = np.flatnonzero(np.r_[True, np.diff(cells) != 0])
        seen = left.column("_seen").combine_chunks() if excluding else None
        most = k + (_longest(seen) if excluding else 0)
        lists = []
        for start, end in zip(starts, np.r_[starts[1:], len(cells)]):
            # Of equal vectors the lower ids win, so only as many can matter as are wanted and hidden together.
            possible = start + np.flatnonzero(_copies_before(item_matrix[start:end]) < most)
            lists.append((items[possible], _Side(item_matrix[possible], unit=metric == "cosine")))
        users, user_side = left.column("_user").to_numpy(), _Side(_matrix(left.column("_uf")), unit=True)
        wanted = left.column("_cells").combine_chunks()
        lengths = wanted.value_lengths().to_numpy(zero_copy_only=False)
        asking, ends = np.repeat(np.arange(len(users)), lengths), np.cumsum(lengths)
        places = np.searchsorted(cells[starts], wanted.flatten().to_numpy(zero_copy_only=False))

        found = []
        last = 0
        while last < len(users):
            held = ends[last - 1] if last else 0
            last = max(last + 1, int(np.searchsorted(ends, held + _LISTS_AT_ONCE, side="right")))
            near = slice(held, ends[last - 1])
            by_place = np.argsort(places[near], kind="stable")
            rows, at = asking[near][by_place], places[near][by_place]
            cuts = np.flatnonzero(np.r_[True, np.diff(at) != 0]) if len(at) else at
            parts = []
            for a, b in zip(cuts, np.r_[cuts[1:], len(at)]):
                ids, side = lists[at[a]]
                step = max(1, _TILE_SCORES // len(ids))
                for start in range(a, b, step):
                    some = rows[start : min(b, start + step)]
                    hidden = _positions(seen.take(pa.array(some)), ids) if excluding else None
                    row, col, values, _ = _best_in_tile(user_side, side, some, k, metric, hidden)
                    parts.append((some[row], ids[col], values))
            if parts:
                found.append(_best_of_lists(*(np.concatenate(column) for column in zip(*parts)), k))
        if not found:
            return out_schema.empty_table()
        row, ids, values, rank = (np.concatenate(column) for column in zip(*found))
        scores = pa.array(values, mask=np.isnan(values))
        return pa.table([pa.array(users[row]), pa.array(ids), scores, pa.array(rank)], schema=out_schema)

    return score


def _best_of_lists(
    row: np.ndarray, ids: np.ndarray, values: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each row, by score, then id."""
    order = np.lexsort((ids, -np.nan_to_num(values, nan=-np.inf), row))
    row, ids, values = row[order], ids[order], values[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
    kept = rank <= k
    return row[kept], ids[kept], values[kept], rank[kept].astype(np.int32)


def _copies_before(matrix: np.ndarray) -> np.ndarray:
    """How many earlier rows equal each row."""
    none = np.zeros(len(matrix), dtype=np.int64)
    weights = np.sqrt(np.arange(2.0, matrix.shape[1] + 2.0))
    if len(np.unique(np.einsum("ij,j->i", matrix, weights))) == len(matrix):
        return none
    whole_rows = np.ascontiguousarray(matrix).view(np.dtype((np.void, matrix.dtype.itemsize * matrix.shape[1]))).ravel()
    _, group = np.unique(whole_rows, return_inverse=True)
    order = np.argsort(group, kind="stable")
    starts = np.flatnonzero(np.r_[True, np.diff(group[order]) > 0])
    earlier = none.copy()
    earlier[order] = np.arange(len(matrix)) - np.repeat(starts, np.diff(np.r_[starts, len(matrix)]))
    return earlier


def _longest(seen: pa.ListArray) -> int:
    return int(np.nan_to_num(seen.value_lengths().to_numpy(zero_copy_only=False)).max())


class _Side:
    """The vectors of one side of a cell: exact, and scaled to lengths of at most 1."""

    def __init__(self, exact: np.ndarray, unit: bool) -> None:
        self.exact = exact
        self.norms = np.sqrt(np.einsum("ij,ij->i", exact, exact))
        lengths = self.norms if unit else np.full(len(exact), self.norms.max())
        self.lengths = np.where(lengths > 0, lengths, 1.0)
        self.scaled = (exact / self.lengths[:, None]).astype(np.float32)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    vectors = column.combine_chunks()
    flat = vectors.flatten()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if vectors.null_count or flat.null_count or (lengths != lengths[0]).any():
        raise ValueError("vectors must be non-null, of one length and without null elements")
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), int(lengths[0]))


def _pair_products(user_matrix: np.ndarray, item_matrix: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Dot product of each chosen pair, a bounded number at a time."""
    values = np.empty(len(row))
    for start in range(0, len(row), _PAIRS_AT_ONCE):
        part = slice(start, start + _PAIRS_AT_ONCE)
        values[part] = np.einsum("ij,ij->i", user_matrix[row[part]], item_matrix[col[part]])
    return values


def _positions(seen: pa.ListArray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every excluded pair; ``items`` is sorted."""
    lengths = np.nan_to_num(seen.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    wanted = seen.flatten().to_numpy(zero_copy_only=False)
    col = np.searchsorted(items, wanted)
    known = col < len(items)
    known[known] = items[col[known]] == wanted[known]
    return row[known], col[known]


def _best_in_tile(
    users: _Side, items: _Side, rows: slice | np.ndarray, k: int, metric: str, hidden: tuple[np.ndarray, np.ndarray] | None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, column, score and rank of the k best pairs of each row.

    The block product runs in single precision on vectors no longer than 1, so a score is off
    by less than a known bound. Every pair within that bound of the k-th best is then scored
    again in double precision, always summed in the same order: the result is exact, and
    equal vectors get equal scores wherever they stand. Rows in which a large part of the pairs
    is that close go through a block product in double precision first, whose bound is narrower.
    """
    scores = users.scaled[rows] @ items.scaled.T
    if metric == "cosine":
        # A similarity that does not exist stands below every real one.
        scores[:, items.norms == 0] = -2.0
    # All pairs of a zero vector tie, so the lowest ids win; said so, they are not all candidates.
    scores[users.norms[rows] == 0] = -np.arange(scores.shape[1], dtype=np.float32)
    if hidden is not None:
        scores[hidden] = -np.inf
    bound = 4 * items.exact.shape[1] * np.finfo(np.float32).eps
    floor = np.maximum(_kth_lower_bound(scores, k) - bound, np.finfo(np.float32).min)
    near = scores >= floor[:, None]
    count = np.count_nonzero(near, axis=1)
    crowded = np.flatnonzero((count > 4 * k) & (count * _PRODUCTS_PER_PAIR > scores.shape[1]))
    step = max(1, _DOUBLES_AT_ONCE // scores.shape[1])
    for start in range(0, len(crowded), step):
        some = crowded[start : start + step]
        near[some] &= _near_in_double(users, items, np.arange(len(users.exact))[rows][some], near[some], k, metric)
    row, col = np.divmod(np.flatnonzero(near), scores.shape[1])

    values = _pair_products(users.exact[rows], items.exact, row, col)
    if metric == "cosine":
        lengths = users.norms[rows][row] * items.norms[col]
        values = np.divide(values, lengths, out=np.full(len(values), np.nan), where=lengths > 0)
    order = np.lexsort((col, -np.nan_to_num(values, nan=-2.0), row))
    row, col, values = row[order], col[order], values[order]
    first = np.searchsorted(row, np.arange(len(scores)))
    rank = np.arange(len(row)) - first[row] + 1
    kept = rank <= k
    return row[kept], col[kept], values[kept], rank[kept].astype(np.int32)


def _near_in_double(users: _Side, items: _Side, rows: np.ndarray, near: np.ndarray, k: int, metric: str) -> np.ndarray:
    """Of the pairs in ``near``, which holds the k best of each row, those that lie within the rounding bound of the k-th best."""
    scores = (users.exact[rows] / users.lengths[rows][:, None]) @ items.exact.T
    scores /= items.lengths
    if metric == "cosine":
        scores[:, items.norms == 0] = -2.0
    scores[~near] = -np.inf
    bound = 4 * items.exact.shape[1] * np.finfo(np.float64).eps
    return scores >= (np.partition(scores, scores.shape[1] - k, axis=1)[:, -k] - bound)[:, None]


def _kth_lower_bound(scores: np.ndarray, k: int) -> np.ndarray:
    """A number per row that at least k of its scores reach, and few more.

    The k-th best of the maxima of disjoint column groups cannot exceed the k-th best score.
    """
    columns = scores.shape[1]
    if columns <= k:
        return np.full(len(scores), -np.inf, dtype=scores.dtype)
    groups = max(_GROUPS, 8 * k)
    if columns > 4 * groups:
        deep = columns // groups
        grouped = scores[:, : deep * groups].reshape(len(scores), deep, groups).max(axis=1)
        scores = np.hstack([grouped, scores[:, deep * groups :]])
    return np.partition(scores, scores.shape[1] - k, axis=1)[:, -k]
