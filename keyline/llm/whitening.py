"""Whitening of embeddings from a covariance that is recovered by polarisation.

Entries are put on a grid of 1/256 and every distinct vector counts once. Spark adds up
exact integers only: first the number of vectors and the sum of each dimension, then the
squares of every centred dimension and of every centred sum of two dimensions. A
cross-covariance is half the variance of the sum less the two variances; the matrix goes
to ``eigh`` and each vector is projected on the leading eigenvectors.

Values are centred on the integer next to their mean before they are squared, so squares
stay as small as the spread of the data whatever the number of vectors; the remaining
fraction of a unit is taken out of the sums afterwards, in exact integers. A sum leaves a
task as signed digits of ``LIMB`` bits, so no total overflows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyline.llm.common import free_name, materialize, table

GRID = 256  # steps a unit
COMPONENTS = 4  # components that are returned
LIMB = 24  # bits of a digit: 2^39 tasks add up without overflow
BLOCK = 1024  # vectors that are squared at a time
_LONG = np.iinfo(np.int64)
_TOTALS = "k int, place int, digit long"


def grid_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Whole grid steps of the valid vectors (rows, width), and the mask of valid rows.

    A vector is valid if it is not null, has ``width`` entries and all are finite. Steps
    beyond a long count as the nearest long.
    """
    if not isinstance(column, pa.ListArray | pa.LargeListArray):
        column = column.cast(pa.list_(pa.float64()))
    offsets = column.offsets.to_numpy()
    start, size = offsets[:-1], np.diff(offsets)
    valid = (size == width) & np.asarray(column.is_valid())
    entries = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    picked = start[valid][:, None] + np.arange(width)
    dense = entries[picked] if len(picked) else np.zeros((0, width))
    finite = np.isfinite(dense).all(axis=1)
    valid[np.flatnonzero(valid)[~finite]] = False
    steps = np.floor(GRID * dense[finite])
    inside = np.abs(steps) < 2.0**63
    x = np.where(inside, steps, 0).astype(np.int64)
    return np.where(inside, x, np.where(steps > 0, _LONG.max, _LONG.min)), valid


def _fit_rows(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, _ = grid_vectors(batch.column(0), width)
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * width, pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([lists], names=["x"])

    return run


def centred(x: np.ndarray, centre: list[int]) -> tuple[np.ndarray, int]:
    """``x - centre`` and its largest magnitude; Python integers where a long is too short."""
    if not x.size:
        return x, 0
    if max(-int(x.min()), int(x.max())) + max(map(abs, centre)) < 1 << 62:
        y = x - np.array(centre, np.int64)
    else:
        y = x.astype(object) - np.array(centre, object)
    return y, int(np.abs(y).max())


def _digits(totals: list[int]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple[int, int, int]] = []
    for k, total in enumerate(totals):
        sign, rest, place = (-1 if total < 0 else 1), abs(total), 0
        while rest:
            rows.append((k, place, sign * (rest & ((1 << LIMB) - 1))))
            rest, place = rest >> LIMB, place + 1
    if rows:
        k, place, digit = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(place, pa.int32()), pa.array(digit, pa.int64())], names=["k", "place", "digit"])


class _Total:
    """Exact running totals: longs while they surely suffice, Python integers beyond."""

    def __init__(self, n: int):
        self.whole, self.now, self.room = [0] * n, np.zeros(n, np.int64), 1 << 62

    def add(self, values: np.ndarray, bound: int) -> None:
        """``values``, each of at most ``bound`` in magnitude."""
        if bound >= 1 << 62:
            self.whole = [a + int(b) for a, b in zip(self.whole, values)]
            return
        if self.room < bound:
            self.flush()
        self.now += values.astype(np.int64)
        self.room -= bound

    def flush(self) -> list[int]:
        self.whole = [a + b for a, b in zip(self.whole, self.now.tolist())]
        self.now[:] = 0
        self.room = 1 << 62
        return self.whole


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        x = batch.column(0).flatten().to_numpy().reshape(-1, width)
        for i in range(0, len(x), BLOCK):
            yield x[i : i + BLOCK]


def _sums(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The number of vectors, then the sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, _Total(width)
        for x in _matrices(batches, width):
            y, peak = centred(x, [0] * width)
            bound = peak * len(y)
            total.add(y.sum(axis=0) if bound < 1 << 62 else y.astype(object).sum(axis=0), bound)
            n += len(y)
        yield from _digits([n, *total.flush()])

    return run


def squares_of_sums(y: np.ndarray) -> np.ndarray:
    """Sum over rows of the squares of every dimension, then of every sum of two
    dimensions (i, j), i < j, by i and then j. The caller chose a type that holds them."""
    t = np.ascontiguousarray(y.T)
    out = [(t * t).sum(axis=1)]
    for i in range(len(t) - 1):
        z = t[i + 1 :] + t[i]
        out.append((z * z).sum(axis=1))
    return np.concatenate(out)


def _squares(width: int, centre: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Total(width * (width + 1) // 2)
        for x in _matrices(batches, width):
            y, peak = centred(x, centre)
            bound = 4 * peak * peak * len(y)
            total.add(squares_of_sums(y if bound < 1 << 62 else y.astype(object)), bound)
        yield from _digits(total.flush())

    return run


def _added(rows: DataFrame, n: int) -> list[int]:
    """The totals 0 to n - 1 over all tasks."""
    out = [0] * n
    for k, place, digit in rows.groupBy("k", "place").agg(F.sum("digit").alias("digit")).collect():
        out[k] += digit << (LIMB * place)
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted model: number of distinct vectors, exact sums, leading eigenpairs."""

    n: int
    sums: list[int]
    values: list[float]  # falling
    vectors: np.ndarray  # (width, components)
    explained: list[float | None]

    @property
    def width(self) -> int:
        return len(self.sums)

    def centre(self) -> list[int]:
        """The integer next to each mean."""
        return [(2 * s + self.n) // (2 * self.n) for s in self.sums]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums`` of each row, exact (floats never enter)."""
        centre = self.centre()
        y, peak = centred(x, centre)
        rest = [s - self.n * c for s, c in zip(self.sums, centre)]
        if self.n * (peak + 1) < 1 << 62:
            return y * self.n - np.array(rest, np.int64)
        return y.astype(object) * self.n - np.array(rest, object)

    def project(self, deviations: np.ndarray) -> np.ndarray:
        """Whitened coordinates (rows, components); NaN where a component has no variance."""
        scale = np.array([1 / np.sqrt(e) if e > 0 else np.nan for e in self.values])
        return (deviations / self.n).astype(np.float64) @ self.vectors * scale


def covariance(n: int, sums: list[int], centre: list[int], squares: list[int]) -> np.ndarray:
    """The covariance (divisor ``n``), each entry rounded once: half the variance of a
    sum of two dimensions less the variances of the two."""
    width = len(sums)
    rest = [s - n * c for s, c in zip(sums, centre)]
    variance = [n * q - r * r for q, r in zip(squares, rest)]  # n^2 times the variance
    out = np.zeros((width, width))
    at = width
    for i in range(width):
        out[i, i] = variance[i] / (n * n)
        for j in range(i + 1, width):
            both = n * squares[at] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - variance[i] - variance[j]) / (2 * n * n)
            at += 1
    return out


def leading(matrix: np.ndarray, components: int) -> tuple[list[float], np.ndarray, list[float | None]]:
    """Eigenvalues by falling size, unit eigenvectors, shares of the trace. Values within
    rounding of zero are zero. A vector's largest entry is positive."""
    scale = float(np.abs(matrix).max()) or 1.0
    values, vectors = np.linalg.eigh(matrix / scale)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    flat = values <= len(matrix) * np.finfo(np.float64).eps * max(float(values[0]), 0.0)
    values = np.where(flat, 0.0, values) * scale
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    trace = float(np.trace(matrix))
    return values.tolist(), vectors * sign, [float(e) / trace if trace > 0 else None for e in values]


def fit(fit_rows: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The model of ``fit_rows(x array<long>)``, distinct vectors of ``width`` entries;
    None if there is none. Two passes: sums, then centred squares. Only
    ``width * (width + 1) / 2`` totals reach the driver."""
    n, *sums = _added(fit_rows.mapInArrow(_sums(width), _TOTALS), width + 1)
    if not n:
        return None
    centre = Whitening(n, sums, [], np.zeros((width, 0)), []).centre()
    squares = _added(fit_rows.mapInArrow(_squares(width, centre), _TOTALS), width * (width + 1) // 2)
    values, vectors, explained = leading(covariance(n, sums, centre, squares), components)
    return Whitening(n, sums, values, vectors, explained)


def identity_error(fit_rows: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the measured covariance of the whitened fit list less the
    identity, over components that have variance; None if none has."""
    kept = [i for i, e in enumerate(model.values) if e > 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(kept) * (len(kept) + 1))
        for x in _matrices(batches, model.width):
            w = model.project(model.deviations(x))[:, kept]
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["k", "v"])

    if not kept:
        return None
    total = np.zeros(len(kept) * (len(kept) + 1))
    for k, v in fit_rows.mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v")).collect():
        total[k] = v / model.n
    mean, square = total[: len(kept)], total[len(kept) :].reshape(len(kept), len(kept))
    return float(np.abs(square - np.outer(mean, mean) - np.eye(len(kept))).max())


def _applied(model: Whitening, index: int, names: list[str], kept: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, valid = grid_vectors(batch.column(index), model.width)
            off = model.deviations(x)
            peak = int(np.abs(off).max()) if off.size else 0
            if peak * peak * model.width < 1 << 62:
                squared = pa.array((off * off).sum(axis=1).astype(np.int64)).cast(pa.decimal128(38, 0))
            else:
                exact = (off.astype(object) ** 2).sum(axis=1)
                squared = pa.array([v if v < 10**38 else None for v in exact], pa.decimal128(38, 0))
            whitened = pa.array(model.project(off).ravel(), from_pandas=True)  # NaN: null
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(model.values), whitened)
            mask = pa.array(valid)
            yield pa.RecordBatch.from_arrays([*[batch.column(i).filter(mask) for i in kept], squared, lists], names=names)

    return run


def whiten(vectors: DataFrame, *, column: str = "embedding", components: int = COMPONENTS) -> tuple[DataFrame, Whitening | None, float | None]:
    """The rows of ``vectors`` with a valid vector, the model, and its identity error.

    The rows keep every column but ``column`` and get ``deviation`` decimal(38, 0) (sum
    over dimensions of the squared ``n * x - sum``; null beyond 38 digits) and
    ``whitened`` array<double> (null entries for components without variance; fewer
    entries where vectors are shorter). New names get leading underscores on a clash.

    Rows whose vector is null or holds null or non-finite entries are left out, and so are
    vectors of another length than the most frequent one (the longer on a tie) and empty
    vectors. Equal vectors teach once; every row is projected. An empty table, or one
    without a valid vector, gives no rows and no model.
    """
    kept = [i for i, c in enumerate(vectors.columns) if c != column]
    new = [free_name(vectors, "deviation"), free_name(vectors, "whitened")]
    schema = T.StructType([*[vectors.schema[i] for i in kept], T.StructField(new[0], T.DecimalType(38, 0)), T.StructField(new[1], T.ArrayType(T.DoubleType()))])
    size = F.size(column).alias("width")
    common = vectors.select(size).filter("width > 0").groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    model = None
    if common:
        width = common["width"]
        fit_rows = materialize(vectors.select(column).mapInArrow(_fit_rows(width), "x array<long>").distinct(), "fit-list")
        model = fit(fit_rows, width, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema), None, None
    run = _applied(model, vectors.columns.index(column), [f.name for f in schema], kept)
    return vectors.mapInArrow(run, schema), model, identity_error(fit_rows, model)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model, error = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    explained = F.array(*[F.lit(e).cast("double") for e in (model.explained if model else [])]).cast("array<double>")
    long = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "w"))
    return long.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("w").alias("whitened"),
        F.try_element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
