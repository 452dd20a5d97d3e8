"""Ratings stored by blocks of keys, to set up and solve the normal equations of all keys again and again.

Ratings are dealt into blocks by their key once. A block is solved by one task: it reads the block's ratings and the
stored vectors of the other side, of which it keeps those that the block's ratings name. Vectors are stored once by
the task that has solved them and only read after that: none is shuffled or copied on disk for each block, and what
a step stored can be deleted when the next one is done. Keys of more than ``HOT`` ratings are spread over several blocks, each
of which leaves one matrix, and these are added up.

Ratings and vectors are stored as pages: rows that hold many ids and numbers in binary form, so that reading them costs little.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from contextlib import ExitStack
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from marquee.session import FREE_SHUFFLES, new_folder, remove_folder, runtime_option, store_once

# These functions travel to the workers as code.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOT = 100_000
# Ratings that are worth a block of their own, up to MANY blocks, and ratings that a block holds at most.
_WORTH_A_BLOCK = 1_000_000
_RATINGS_PER_BLOCK = 2_500_000
_FEW_BLOCKS = 8
_MANY_BLOCKS = 24
_VECTORS_PER_PAGE = 8192
# Keys whose equations are solved at once, and ratings that these have together.
_KEYS_AT_ONCE = 64
_RATINGS_AT_ONCE = 8_192
# An eigenvalue is usable as a divisor from this share of the largest one on.
_SOUND = 1e-6

_PAGE = "block int, kind string, number long, ids binary, matrix binary, type string, ratings binary, residuals binary"
_PAGE_TYPES = pa.schema(
    [
        ("block", pa.int32()),
        ("kind", pa.string()),
        ("number", pa.int64()),
        ("ids", pa.binary()),
        ("matrix", pa.binary()),
        ("type", pa.string()),
        ("ratings", pa.binary()),
        ("residuals", pa.binary()),
    ]
)
# Pages are large rows: so few are held at once. Each block has a task of its own.
_PAGED = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "16",
    "spark.sql.parquet.columnarReaderBatchSize": "16",
    "spark.sql.unionOutputPartitioning": "false",
}


def store_pages(pages: DataFrame, name: str) -> DataFrame:
    """``store_once`` for what is made from pages."""
    with ExitStack() as options:
        for key, value in _PAGED.items():
            options.enter_context(runtime_option(pages.sparkSession, key, value))
        return store_once(pages, name)


def _page(block: int, kind: str, number: int, ids: np.ndarray, matrix: np.ndarray, ratings=None, residuals=None) -> tuple:
    kept = [None if x is None else np.ascontiguousarray(x).tobytes() for x in (ids, matrix, ratings, residuals)]
    return block, kind, number, kept[0], kept[1], matrix.dtype.str, kept[2], kept[3]


def _batch(pages: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), t.type) for c, t in zip(zip(*pages), _PAGE_TYPES)], schema=_PAGE_TYPES)


def _bytes(value: pa.Scalar, kind: str) -> np.ndarray | None:
    return np.frombuffer(value.as_buffer(), kind) if value.is_valid else None


def _pack_ratings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of block and key as pages, each of one block."""
    number = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        if any(batch.column(c).null_count for c in ("key", "other", "rating")):
            raise ValueError("a rating needs a user, an item and a number")
        block, key, other, rating = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "key", "other", "rating"))
        if not np.isfinite(rating).all():
            raise ValueError("ratings must be finite numbers")
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
        pages = []
        for a, b in zip(cuts, cuts[1:]):
            pages.append(_page(int(block[a]), "ratings", number, key[a:b], other[a:b], rating[a:b]))
            number += 1
        yield _batch(pages)


def vector_pages(vectors: DataFrame, id_column: str, name: str, features: str = "features") -> DataFrame:
    """(id, features) as stored pages, in the precision that they have."""
    kind = "<f4" if vectors.schema[features].dataType.simpleString() == "array<float>" else "<f8"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = batch.column("y")
                matrix = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(kind)
                ids = batch.column("id").to_numpy(zero_copy_only=False)
                cuts = range(0, len(ids), _VECTORS_PER_PAGE)
                yield _batch([_page(0, "vectors", 0, ids[a : a + _VECTORS_PER_PAGE], matrix[a : a + _VECTORS_PER_PAGE]) for a in cuts])

    known = vectors.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(features).alias("y"))
    return store_once(known.mapInArrow(pack, _PAGE), name)


def rows_of(pages: DataFrame, name: str) -> DataFrame:
    """Solved pages as stored rows (key, ratings, features, residual); the residual is null where no vector was given."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = lambda c: batch.column(c)[row]
                ids = _bytes(value("ids"), "<i8")
                flat = _bytes(value("matrix"), value("type").as_py()).astype(np.float64)
                starts = np.arange(len(ids) + 1, dtype=np.int32) * (len(flat) // len(ids))
                residual = _bytes(value("residuals"), "<f8")
                residual = pa.nulls(len(ids), pa.float64()) if residual is None else pa.array(residual, mask=np.isnan(residual))
                columns = [pa.array(ids), pa.array(_bytes(value("ratings"), "<i8")), pa.ListArray.from_arrays(starts, flat), residual]
                yield pa.RecordBatch.from_arrays(columns, ["key", "ratings", "features", "residual"])

    solved = pages.where("kind = 'vectors'").select("ids", "matrix", "type", "ratings", "residuals")
    return store_pages(solved.mapInArrow(unpack, "key long, ratings long, features array<double>, residual double"), name)


def gram_of(pages: DataFrame) -> np.ndarray:
    """The sum of y y' over all solved vectors, from one matrix of each block and hot key."""
    rows = pages.where("kind = 'gram'").select("block", "number", "matrix").collect()
    total = np.sum([np.frombuffer(r["matrix"]) for r in sorted(rows)], axis=0)
    size = int(round(total.size**0.5))
    return total.reshape(size, size)


class RatingBlocks:
    """The ratings of a table by blocks of one of its two ids, the key; they are stored when this is made."""

    def __init__(self, ratings: DataFrame, key: str, other: str, rating: str = "rating", hot: int = HOT) -> None:
        self.spark = ratings.sparkSession
        known = ratings.select(F.col(key).cast("long").alias("key"), F.col(other).cast("long").alias("other"), F.col(rating).cast("double").alias("rating"))
        total = known.count()
        blocks = max(min(_MANY_BLOCKS, max(_FEW_BLOCKS, ceil(total / _WORTH_A_BLOCK))), ceil(total / _RATINGS_PER_BLOCK))
        counts = known.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > hot).collect()  # at most ratings / hot rows
        self.hot = np.array(sorted(r["key"] for r in counts), dtype=np.int64)
        salt = F.lit(0)
        if counts:
            salts = self.spark.createDataFrame([(r["key"], ceil(r["n"] / hot)) for r in counts], "key long, salts int")
            known = known.join(F.broadcast(salts), "key", "left")
            salt = F.coalesce(F.pmod(F.xxhash64("other", "rating"), F.col("salts")), F.lit(0))
        block = F.pmod(F.xxhash64("key", salt.cast("long")), F.lit(blocks)).cast("int").alias("block")
        # In one order, so that sums do not depend on how rows arrived.
        rows = known.select(block, "key", "other", "rating").repartition(4 * blocks, "block")
        rows = rows.sortWithinPartitions("block", "key", "other", "rating")
        self.path = new_folder(self.spark, "blocks")
        with runtime_option(self.spark, FREE_SHUFFLES, "true"):
            rows.mapInArrow(_pack_ratings, _PAGE).write.partitionBy("block").parquet(self.path)
        stored = self.spark.read.schema(_PAGE).parquet(self.path)
        self.pages = {r["block"]: r["count"] for r in stored.groupBy("block").count().collect()}
        kept = stored.drop("block").schema
        self.blocks = {
            b: self.spark.read.schema(kept).parquet(f"{self.path}/block={b}").select(F.lit(b).alias("block"), *kept.names) for b in sorted(self.pages)
        }

    def remove(self) -> None:
        """Delete the stored ratings."""
        remove_folder(self.spark, self.path)

    def solve(
        self, vectors: DataFrame, base: np.ndarray, reg: float, alpha: float, name: str, kind: str = "<f4", own: DataFrame | None = None
    ) -> DataFrame:
        """Pages with the vector of each key that has a rating of a known vector; ``base`` is the sum of y y' over all vectors.

        ``own`` are pages with vectors of the keys, whose residuals are wanted.
        """
        rest = [f.name for f in vectors.schema.fields[2:]]
        given = vectors.where("kind = 'vectors'")
        mine = None if own is None else own.where("kind = 'vectors'")
        parts = []
        for block, ratings in self.blocks.items():
            one = ratings.unionAll(given.selectExpr(f"{block} AS block", "kind", *rest))
            if mine is not None:
                one = one.unionAll(mine.selectExpr(f"{block} AS block", "'own' AS kind", *rest))
            parts.append(one.coalesce(1))
        if not parts:
            return self.spark.createDataFrame([], _PAGE)
        # Joined two by two: a chain of all blocks is slow to plan.
        while len(parts) > 1:
            parts = [a[0] if len(a) == 1 else a[0].unionAll(a[1]) for a in (parts[i : i + 2] for i in range(0, len(parts), 2))]
        solved = store_pages(parts[0].mapInArrow(_solver(self.pages, self.hot, base, reg, alpha, kind), _PAGE), name)
        if not len(self.hot):
            return solved
        sums = solved.where("kind = 'sums'").groupBy("number").applyInArrow(_solver_of_sums(base, reg, kind), _PAGE)
        return solved.where("kind <> 'sums'").unionByName(store_pages(sums, f"hot-{name}"))


class _Block:
    """What a task holds of its block: ratings, and the vectors that they name."""

    def __init__(self, pages: int) -> None:
        self.expected, self.parts, self.early = pages, [], []
        self.matrix = self.own = None

    def add(self, kind: str, number: int, ids: pa.Scalar, matrix: pa.Scalar, type_: str, ratings: pa.Scalar) -> None:
        if kind == "ratings":
            self.parts.append((number, _bytes(ids, "<i8"), _bytes(matrix, "<i8"), _bytes(ratings, "<f8")))
            if len(self.parts) == self.expected:
                self._complete()
        elif len(self.parts) < self.expected:
            self.early.append((kind, ids, matrix, type_))
        else:
            self._place(kind, ids, matrix, type_)

    def _complete(self) -> None:
        self.parts.sort(key=lambda part: part[0])
        self.key, other, self.rating = (np.concatenate([part[i] for part in self.parts]) for i in (1, 2, 3))
        self.parts = [None] * self.expected
        self.keys = np.unique(self.key)
        self.others, self.at = np.unique(other, return_inverse=True)
        for page in self.early:
            self._place(*page)
        self.early = []

    def _place(self, kind: str, ids: pa.Scalar, matrix: pa.Scalar, type_: str) -> None:
        ids = _bytes(ids, "<i8")
        matrix = _bytes(matrix, type_).reshape(len(ids), -1)
        wanted = self.keys if kind == "own" else self.others
        place = np.minimum(np.searchsorted(wanted, ids), len(wanted) - 1)
        found = wanted[place] == ids
        if kind == "own":
            if self.own is None:
                self.own = np.full((len(wanted), matrix.shape[1]), np.nan)
            self.own[place[found]] = matrix[found]
            return
        if self.matrix is None:
            self.matrix, self.known = np.zeros((len(wanted), matrix.shape[1]), type_), np.zeros(len(wanted), bool)
        self.matrix[place[found]] = matrix[found]
        self.known[place[found]] = True


def _sums(y: np.ndarray, at: np.ndarray, rating: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of keys with equally many ratings, in rows: the sums of c y y' and of (1 + c) y, and how many ratings are above zero."""
    size = y.shape[1]
    gram, right = None, 0.0
    step = max(1, _RATINGS_AT_ONCE // len(at))
    for a in range(0, at.shape[1], step):
        r, vectors = rating[:, a : a + step], y[at[:, a : a + step]].astype(np.float64)
        c, liked = alpha * np.abs(r), r > 0
        more = np.matmul((vectors * c[:, :, None]).transpose(0, 2, 1), vectors)
        gram = more if a == 0 else gram + more
        right = right + np.matmul((liked * (1 + c))[:, None, :], vectors)[:, 0]
    return gram, right, (rating > 0).sum(axis=1)


def _solved(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.solve(matrix, right[..., None])[..., 0]
    except np.linalg.LinAlgError:  # nothing above zero and fewer items than dimensions
        return np.array([np.linalg.lstsq(m, r, rcond=None)[0] for m, r in zip(matrix, right)])


def _solved_short(
    y: np.ndarray, at: np.ndarray, rating: np.ndarray, alpha: float, reg: float, values: np.ndarray, axes: np.ndarray
) -> np.ndarray | None:
    """The vectors of keys with fewer ratings than dimensions, from one equation for each rating; None where these are unsound.

    With D the base and the regularisation, which the axes make diagonal, Y the vectors of a key's ratings, c and p what each adds
    to the matrix and to the right side: x = inverse(D) Y' w, and w = p - c Y x, so (I + c Y inverse(D) Y') w = p.
    """
    vectors = y[at].astype(np.float64)
    turned = (vectors.reshape(-1, len(values)) @ axes).reshape(vectors.shape)
    c, liked = alpha * np.abs(rating), rating > 0
    scale = values + reg * liked.sum(axis=1)[:, None]
    if (scale.min(axis=1) <= _SOUND * scale.max(axis=1)).any():
        return None
    over = turned / scale[:, None, :]
    matrix = np.matmul(turned, over.transpose(0, 2, 1))
    matrix *= c[:, :, None]
    matrix.reshape(len(at), -1)[:, :: at.shape[1] + 1] += 1.0
    w = np.linalg.solve(matrix, (liked * (1 + c))[..., None])
    return np.matmul(w.transpose(0, 2, 1), over)[:, 0] @ axes.T


def _residuals(matrix: np.ndarray, right: np.ndarray, own: np.ndarray) -> np.ndarray:
    """What the own vectors leave of the right side; not a number where there is none."""
    length = np.linalg.norm(right, axis=1)
    left = np.linalg.norm(np.matmul(matrix, own[..., None])[..., 0] - right, axis=1)
    return left / np.where(length > 0, length, 1.0)


def _solver(pages: dict[int, int], hot: np.ndarray, base: np.ndarray, reg: float, alpha: float, kind: str) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for row in range(batch.num_rows):
                value = [batch.column(c)[row] for c in ("block", "kind", "number", "ids", "matrix", "type", "ratings")]
                yield value[0].as_py(), value[1].as_py(), value[2].as_py(), value[3], value[4], value[5].as_py(), value[6]

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, given in groupby(rows(batches), key=lambda row: row[0]):
            held = _Block(pages[block])
            for row in given:
                held.add(*row[1:])
            if held.matrix is not None:
                yield from solve_block(block, held)

    def solve_block(block: int, held: _Block) -> Iterator[pa.RecordBatch]:
        known = held.known[held.at]
        key, at, rating = (x if known.all() else x[known] for x in (held.key, held.at, held.rating))
        if not len(key):
            return
        starts = np.flatnonzero(np.r_[True, np.diff(key) != 0])
        lengths, keys = np.diff(np.r_[starts, len(key)]), key[starts]
        own = None if held.own is None else held.own[np.searchsorted(held.keys, keys)]
        found, residual = np.zeros((len(keys), len(base))), np.full(len(keys), np.nan)
        whole = ~np.isin(keys, hot)
        values, axes = np.linalg.eigh(base)
        order = np.argsort(lengths, kind="stable")
        cuts = [0, *(np.flatnonzero(np.diff(lengths[order])) + 1).tolist(), len(order)]
        for first, last in zip(cuts, cuts[1:]):
            length = int(lengths[order[first]])
            step = max(1, min(_KEYS_AT_ONCE, _RATINGS_AT_ONCE // length))
            for a in range(first, last, step):
                some = order[a : min(last, a + step)]
                places = starts[some][:, None] + np.arange(length)
                if own is None and 4 * length <= 3 * len(base) and whole[some].all():
                    short = _solved_short(held.matrix, at[places], rating[places], alpha, reg, values, axes)
                    if short is not None:
                        found[some] = short
                        continue
                gram, right, liked = _sums(held.matrix, at[places], rating[places], alpha)
                for i in np.flatnonzero(~whole[some]):
                    sums = np.r_[gram[i].ravel(), right[i]]
                    mine = None if own is None else own[some[i]]
                    yield _batch([_page(block, "sums", int(keys[some[i]]), keys[some[i : i + 1]], sums, np.array([length, liked[i]]), mine)])
                gram += base
                gram.reshape(len(some), -1)[:, :: len(base) + 1] += (reg * liked)[:, None]
                found[some] = _solved(gram, right)
                if own is not None:
                    residual[some] = _residuals(gram, right, own[some])
        keys, found, counts, residual = (x[whole] for x in (keys, found.astype(kind), lengths, residual))
        total = np.zeros(base.shape)
        for number, a in enumerate(range(0, len(keys), _VECTORS_PER_PAGE)):
            part = slice(a, a + _VECTORS_PER_PAGE)
            y = found[part].astype(np.float64)
            total += y.T @ y
            yield _batch([_page(block, "vectors", number, keys[part], found[part], counts[part].astype(np.int64), None if own is None else residual[part])])
        yield _batch([_page(block, "gram", 0, keys[:0], total)])

    return solve


def _solver_of_sums(base: np.ndarray, reg: float, kind: str) -> Callable[[pa.Table], pa.Table]:
    """The sums that a hot key's blocks have left, added up and solved."""

    def solve(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("block").to_pylist()
        size = len(base)
        sums = np.sum([np.frombuffer(part["matrix"]) for part in parts], axis=0)
        count, liked = np.sum([np.frombuffer(part["ratings"], np.int64) for part in parts], axis=0)
        matrix, right = base + sums[:-size].reshape(base.shape) + reg * liked * np.eye(size), sums[-size:]
        found = _solved(matrix[None], right[None]).astype(kind)
        own = parts[0]["residuals"]
        residual = None if own is None else _residuals(matrix[None], right[None], np.frombuffer(own)[None])
        ids, key = np.frombuffer(parts[0]["ids"], np.int64), parts[0]["number"]
        y = found.astype(np.float64)
        pages = [_page(-1, "vectors", key, ids, found, np.array([count]), residual), _page(-1, "gram", key, ids, y.T @ y)]
        return pa.Table.from_batches([_batch(pages)])

    return solve
