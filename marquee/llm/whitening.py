"""Embedding whitening by incremental eigendecomposition.

Entries become whole numbers (``scaled``), so counts, sums and deviations are exact. Each task keeps a
``Spectrum`` of its vectors, one centred rank-one update for each different vector of a batch, however often
it occurs. The tasks' spectra are joined in rounds of ``FAN``, again by rank-one updates. The directions found
are then refined: one more pass over the vectors gives their covariance in these directions (a Rayleigh-Ritz
step over all of them), whose eigenvectors turn the directions into the components. A last pass measures the
covariance of the whitened vectors.

What leaves a task is one row of its sums (at most dimension x (dimension + 3) numbers); the driver gets the last one.

Defined results: vectors that are null, empty, or hold entries that are null, not finite or beyond ``LARGEST``
take no part, nor do those of another length than the most common one (of equally common ones the longest).
Rows without an id stay, repeated rows count as often as they occur. A component that the vectors do not spread
along (its eigenvalue is below ``LEAST_SHARE`` of the largest) has no whitened value, and no share in the error;
without any spread ``explained`` is null as well. A deviation beyond the long type is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, functions as F

from marquee.llm.spectrum import Spectrum
from marquee.session import store_once

SCALE = 64
SHIFT = 1_000_000
FAN = 16
COMPONENTS = 32
LARGEST = float(1 << 40)
LEAST_SHARE = 1e-10
_SUMS = "part long, n long, whole array<long>, a array<double>, b array<double>, c array<double>"


def scaled(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, x) of the vectors that take part: x = floor(SCALE * c) + SHIFT."""
    vectors = df.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
    usable = F.forall("x", lambda c: F.coalesce(F.abs(c) <= LARGEST, F.lit(False)))
    vectors = vectors.where((F.size("x") > 0) & usable)
    common = vectors.groupBy(F.size("x").alias("length")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    vectors = vectors.where(F.size("x") == (common["length"] if common else 0))
    return vectors.select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE) + SHIFT).cast("array<long>").alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _row(part: int, n: int, whole=(), a=(), b=(), c=()) -> pa.RecordBatch:
    lists = [pa.array([np.asarray(x, float).ravel()], pa.list_(pa.float64())) for x in (a, b, c)]
    columns = [pa.array([part], pa.int64()), pa.array([n], pa.int64()), pa.array([list(whole)], pa.list_(pa.int64())), *lists]
    return pa.RecordBatch.from_arrays(columns, ["part", "n", "whole", "a", "b", "c"])


def _gathered(vectors: DataFrame, take: Callable, join: Callable) -> Row | None:
    """What ``take`` makes of each task's batches, joined in rounds to one row."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if found := take(b for b in batches if b.num_rows):
            yield _row(TaskContext.get().partitionId(), *found)

    def of_group(rows: pa.Table) -> pa.Table:
        parts = sorted(rows.to_pylist(), key=lambda r: r["part"])
        return pa.Table.from_batches([_row(parts[0]["part"] // FAN, *join(parts))])

    parts = store_once(vectors.select("x").mapInArrow(of_task, _SUMS), "parts")
    while parts.count() > 1:
        parts = store_once(parts.groupBy(F.expr(f"part div {FAN}").alias("to")).applyInArrow(of_group, _SUMS), "parts")
    return parts.first()


def _add_up(parts: list[dict]) -> tuple:
    whole = [sum(x) for x in zip(*(p["whole"] for p in parts))]
    return (sum(p["n"] for p in parts), whole, *(np.sum([p[k] for p in parts], 0) for k in "abc"))


def _totals(batches: Iterator[pa.RecordBatch]) -> tuple | None:
    n, total = 0, 0
    for batch in batches:
        x = _matrix(batch)
        n, total = n + len(x), total + x.sum(0, dtype=np.int64)
    return (n, total) if n else None


def _spectrum(batches: Iterator[pa.RecordBatch]) -> tuple | None:
    own = None
    for batch in batches:
        different, times = np.unique(_matrix(batch), axis=0, return_counts=True)
        own = own or Spectrum(different.shape[1])
        for vector, count in zip((different - SHIFT).astype(float), times.tolist()):
            own.add(vector, count)
    return (own.count, (), own.mean, own.values, own.vectors) if own else None


def _read_spectrum(part) -> Spectrum:
    own = Spectrum(len(part["a"]))
    own.count, own.mean, own.values = part["n"], np.array(part["a"]), np.array(part["b"])
    own.vectors = np.array(part["c"]).reshape(len(own.mean), -1)
    return own


def _joined(parts: list[dict]) -> tuple:
    whole = _read_spectrum(parts[0])
    for part in parts[1:]:
        whole.join(_read_spectrum(part))
    return whole.count, (), whole.mean, whole.values, whole.vectors


class _Centre:
    """Takes the mean off without rounding the large part: x - S/n = (x - S div n) - (S mod n)/n."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.floor = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n / n for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(float) - self.rest


def _covariance(centre: _Centre, directions: np.ndarray) -> Callable:
    """Sums and squares of the centred vectors along the directions."""

    def take(batches: Iterator[pa.RecordBatch]) -> tuple | None:
        n, total, squares = 0, 0.0, 0.0
        for batch in batches:
            y = centre(_matrix(batch)) @ directions
            n, total, squares = n + len(y), total + y.sum(0), squares + y.T @ y
        return (n, (), total, squares) if n else None

    return take


def _as_covariance(row: Row) -> np.ndarray:
    mean = np.array(row["a"]) / row["n"]
    return np.array(row["b"]).reshape(len(mean), -1) / row["n"] - np.outer(mean, mean)


def _exact_deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2."""
    floor = np.array([s // n for s in sums], np.int64)
    reach = (int(np.abs(x - floor).max()) + 1) * n
    if reach * reach * x.shape[1] < 1 << 63:
        off = (x - floor) * n - np.array([s % n for s in sums], np.int64)
        return (off * off).sum(1).tolist()
    found = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [d if d < 1 << 63 else None for d in found]


class Whitening:
    """Components (columns, by falling eigenvalue), eigenvalues and exact sums of the vectors it was fitted on."""

    def __init__(self, n: int, sums: list[int], components: np.ndarray, values: np.ndarray) -> None:
        self.n, self.sums, self.components, self.values = n, sums, components, values
        self.spread = values > LEAST_SHARE * max(float(values[0]), 0.0)
        self.trace = float(values.sum())

    @classmethod
    def fit(cls, vectors: DataFrame) -> Whitening | None:
        """From the column x of ``scaled`` vectors, stored ones preferably as they are read three times; None without any."""
        totals = _gathered(vectors, _totals, _add_up)
        if totals is None:
            return None
        n, sums = totals["n"], list(totals["whole"])
        directions = _read_spectrum(_gathered(vectors, _spectrum, _joined)).vectors
        # The updates leave the directions orthogonal to rounding; the step needs no more of them.
        directions = np.linalg.qr(directions)[0]
        refined = _as_covariance(_gathered(vectors, _covariance(_Centre(n, sums), directions), _add_up))
        values, turn = np.linalg.eigh(refined)
        components = directions @ turn[:, ::-1]
        signs = np.sign(components[np.abs(components).argmax(0), np.arange(components.shape[1])])
        return cls(n, sums, components * signs, np.maximum(values[::-1], 0.0))

    def _used(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        used = self.components[:, :most]
        with np.errstate(divide="ignore"):
            return used, np.where(self.spread[:most], 1 / np.sqrt(self.values[:most]), np.nan)

    def identity_error(self, vectors: DataFrame, most: int = COMPONENTS) -> float:
        """The largest entry by which the whitened vectors' covariance differs from the identity."""
        used, lengths = self._used(most)
        used = (used * lengths)[:, self.spread[:most]]
        if not used.shape[1]:
            return 0.0
        found = _as_covariance(_gathered(vectors, _covariance(_Centre(self.n, self.sums), used), _add_up))
        return float(np.abs(found - np.eye(len(found))).max())

    def transform(self, vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
        """(vec_id, deviation, whitened): one array of up to ``most`` values for each vector."""
        n, sums, centre = self.n, self.sums, _Centre(self.n, self.sums)
        used, lengths = self._used(most)

        def whiten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch)
                y = (centre(x) @ used) * lengths
                values = pa.array(y.ravel(), mask=np.isnan(y.ravel()))
                ends = pa.array(np.arange(len(y) + 1, dtype=np.int32) * y.shape[1])
                columns = [batch.column("vec_id"), pa.array(_exact_deviations(x, n, sums), pa.int64()), pa.ListArray.from_arrays(ends, values)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.select("vec_id", "x").mapInArrow(whiten, f"vec_id {kind}, deviation long, whitened array<double>")


def whitened_rows(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """One row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    spark = df.sparkSession
    vectors = store_once(scaled(df, id_column, vector_column), "scaled-vectors")
    model = Whitening.fit(vectors)
    if model is None:
        kind = vectors.schema["vec_id"].dataType.simpleString()
        names = "n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], f"vec_id {kind}, component int, {names}")
    shares = [float(v) / model.trace if model.trace > 0 else None for v in model.values[:most]]
    rows = model.transform(vectors, most).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(s).cast("double") for s in shares]), F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error(vectors, most)).alias("identity_error"),
    )
