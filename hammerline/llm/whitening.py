"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors are packed once into blocks of whole numbers. Everything after is passes over the
blocks: each adds up C'(CQ) for the centred rows C of its blocks and a narrow basis Q, so the
covariance V of d x d is never formed, and the driver holds d x ``WIDTH`` numbers whatever the
number of rows.

One round applies a Chebyshev polynomial of V to the basis, one pass a degree by the three-term
recurrence. On the unwanted spectrum, from 0 to the least Ritz value of the basis, the polynomial
stays below a bound that falls with the degree, while wanted directions keep their size; it is
scaled to one at the largest Ritz value, so nothing overflows. QR makes the basis orthonormal
again, and one more pass gives the Rayleigh-Ritz values, vectors and the residuals |Vq - eq|.
Rounds go on until every wanted residual is ``TOLERANCE`` of the largest eigenvalue, or rounding
stops its fall below ``ROUNDING``; a run that reaches neither is an error, never an answer.

Entries c are taken as x = floor(1024 c) + 100000, so sums and deviations are whole numbers and
exact; rows are centred as (n x - S) / n before anything is multiplied.

Defined cases: rows whose vector is NULL or empty or holds NULL, NaN or infinite entries are
dropped, as are vectors of another length than the most frequent one (of equally frequent ones
the longest). Entries beyond 2^43 saturate. A NULL id stays. Repeated rows and ties are vectors
of their own; of equal eigenvalues any basis of their space is returned, the same for all rows.
Components whose variance is zero up to rounding don't exist: equal vectors give no row at all.
A deviation beyond a long is NULL. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline.session import write_table

SCALE, OFFSET, LIMIT = 1024, 100_000, float(1 << 53)
# Bytes of a packed block.
BLOCK_BYTES = 1 << 20
# Columns of the basis beyond the wanted ones; polynomial degree of a round; rounds at most.
GUARDS, DEGREE, ROUNDS = 16, 10, 100
TOLERANCE, ROUNDING = 1e-14, 1e-11
# Eigenvalues below this share of the trace are rounding.
LEAST_SHARE = 1e-12
LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class Blocks:
    """Packed vectors: a table of (ids, x), their length, number and exact sums."""

    table: DataFrame
    dims: int
    n: int
    sums: np.ndarray


@dataclass(frozen=True)
class Model:
    """Eigenvectors as columns, their falling eigenvalues, and the trace of the covariance."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float


def usable(rows: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, int]:
    """(id, vector) of the rows that stay, and the length of their vectors, 0 for none."""
    infinite = F.lit(float("inf")).cast("double")
    finite = F.forall(
        "vector", lambda v: F.coalesce(~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) != infinite), F.lit(False))
    )
    narrow = rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    good = narrow.where(F.col("vector").isNotNull()).where((F.size("vector") > 0) & finite)
    lengths = good.groupBy(F.size("vector").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).first()
    dims = common["size"] if common else 0
    return good.where(F.size("vector") == dims), dims


def _packer(dims: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, rows):
                part = batch.slice(a, rows)
                entries = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.clip(np.floor(SCALE * entries), -LIMIT, LIMIT).astype(np.int64) + OFFSET
                ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
                yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes()], pa.binary())], ["ids", "x"])

    return pack


def _sums(blocks: DataFrame, part: Callable[[np.ndarray], np.ndarray], dims: int, kind: str, size: int) -> np.ndarray:
    """The elementwise sum of ``part`` over all blocks: one row of numbers per task is shuffled."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for packed in batch.column(0):
                own = part(np.frombuffer(packed.as_py(), dtype=np.int64).reshape(-1, dims))
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(total.ravel())], ["slot", "value"])

    added = blocks.select("x").mapInArrow(add, f"slot int, value {kind}").groupBy("slot").agg(F.sum("value").alias("value"))
    total = np.zeros(size, dtype=np.int64 if kind == "long" else np.float64)
    for row in added.collect():
        total[row["slot"]] = row["value"]
    return total


def pack(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> Blocks:
    """Pack the usable vectors into written blocks, and count and add them up exactly."""
    good, dims = usable(rows, id_col, vector_col)
    schema = T.StructType(
        [T.StructField("ids", T.ArrayType(good.schema["id"].dataType)), T.StructField("x", T.BinaryType())]
    )
    per_block = max(1, BLOCK_BYTES // (8 * max(1, dims)))
    if not dims:
        empty = rows.sparkSession.createDataFrame([], schema)
        return Blocks(empty, 0, 0, np.zeros(0, dtype=np.int64))
    table = write_table(good.mapInArrow(_packer(dims, per_block), schema), "vectors")
    count = lambda x: np.append(x.sum(axis=0), len(x))
    sums = _sums(table, count, dims, "long", dims + 1)
    return Blocks(table, dims, int(sums[-1]), sums[:-1])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S/n, from exact products where they fit a long."""
    if n * (int(np.abs(x).max(initial=0)) + 1) < 1 << 62:
        return (n * x - sums) / n
    whole = sums // n
    return (x - whole) - (sums - whole * n) / n


def _covariance_times(blocks: Blocks, q: np.ndarray) -> np.ndarray:
    """V Q in one distributed pass."""
    n, sums = blocks.n, blocks.sums

    def part(x: np.ndarray) -> np.ndarray:
        c = _centred(x, n, sums)
        return c.T @ (c @ q)

    return _sums(blocks.table, part, blocks.dims, "double", q.size).reshape(q.shape) / n


def _filtered(times: Callable[[np.ndarray], np.ndarray], basis: np.ndarray, cut: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of V on the basis, small on [0, cut] and one at top."""
    centre = half = cut / 2
    scale = half / (top - centre)
    first, sigma = scale, scale
    before, now = basis, (times(basis) - centre * basis) * (sigma / half)
    for _ in range(DEGREE - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * following / half) - sigma * following * before
        sigma = following
    return now


def fit(blocks: Blocks, wanted: int = 8) -> Model:
    """The leading eigenvectors of the covariance, certified by their residuals."""
    dims = blocks.dims
    trace = float(_sums(blocks.table, _spread(blocks), dims, "double", 1)[0]) / blocks.n if dims else 0.0
    if not trace > 0:
        return Model(np.zeros((dims, 0)), np.zeros(0), trace)
    wanted, width = min(wanted, dims), min(wanted + GUARDS, dims)
    times = lambda q: _covariance_times(blocks, q)
    basis = np.linalg.qr(np.random.default_rng(7).standard_normal((dims, width)))[0]
    least = np.inf
    for _ in range(ROUNDS):
        image = times(basis)
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        vectors, image = basis @ turn, image @ turn
        real = values[:wanted] > LEAST_SHARE * trace
        off = np.linalg.norm(image[:, :wanted] - vectors[:, :wanted] * values[:wanted], axis=0) / values[0]
        residual = off[real].max()
        if residual <= TOLERANCE or (residual <= ROUNDING and residual > least / 2):
            return Model(vectors[:, :wanted][:, real], values[:wanted][real], trace)
        least = min(least, residual)
        # Below the least Ritz value all is unwanted; a basis that spans the whole range needs no filter.
        cut = max(values[-1], 0.0) if width < dims else 0.0
        full = cut <= LEAST_SHARE * trace
        basis = np.linalg.qr(image if full else _filtered(times, vectors, cut, values[0]))[0]
    raise RuntimeError(f"eigenvectors not certified: residual {residual:.1e} after {ROUNDS} rounds")


def _spread(blocks: Blocks) -> Callable[[np.ndarray], np.ndarray]:
    n, sums = blocks.n, blocks.sums
    return lambda x: np.array([np.square(_centred(x, n, sums)).sum()])


def _whitened(blocks: Blocks, model: Model) -> Callable[[np.ndarray], np.ndarray]:
    n, sums, projection = blocks.n, blocks.sums, model.vectors / np.sqrt(model.values)
    return lambda x: _centred(x, n, sums) @ projection


def identity_error(blocks: Blocks, model: Model) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    n, k, white = blocks.n, len(model.values), _whitened(blocks, model)
    mean = _sums(blocks.table, lambda x: white(x).sum(axis=0), blocks.dims, "double", k) / n

    def part(x: np.ndarray) -> np.ndarray:
        w = white(x) - mean
        return w.T @ w

    covariance = _sums(blocks.table, part, blocks.dims, "double", k * k).reshape(k, k) / n
    return float(np.abs(covariance - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over the dimensions of (n x - S)^2, exact; None beyond a long."""
    most = n * (int(np.abs(x).max(initial=0)) + 1)
    if most < 1 << 62:
        away = n * x - sums
        if len(sums) * int(np.abs(away).max(initial=0)) ** 2 <= LONGEST:
            return np.square(away).sum(axis=1).tolist()
    exact = [sum((n * a - s) ** 2 for a, s in zip(row, sums.tolist())) for row in x.tolist()]
    return [d if d <= LONGEST else None for d in exact]


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = 8) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened,
    explained, identity_error. The fit reads all rows; the rows are made block by block."""
    blocks = pack(rows, id_col, vector_col)
    model = fit(blocks, wanted)
    k, n, dims, sums = len(model.values), blocks.n, blocks.dims, blocks.sums
    error = identity_error(blocks, model) if k else 0.0
    white, explained = _whitened(blocks, model), model.values / model.trace if k else model.values

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if k else ():
            for i in range(batch.num_rows):
                x = np.frombuffer(batch.column(1)[i].as_py(), dtype=np.int64).reshape(-1, dims)
                each = np.repeat(np.arange(len(x)), k)
                columns = [
                    batch.column(0)[i].values.take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(each), n)),
                    pa.array(deviations(x, n, sums), pa.int64()).take(pa.array(each)),
                    pa.array(white(x).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(each), error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = [blocks.table.schema["ids"].dataType.elementType, T.IntegerType(), T.LongType(), T.LongType(), *[T.DoubleType()] * 3]
    schema = T.StructType([T.StructField(name, kind) for name, kind in zip(names, kinds)])
    return blocks.table.mapInArrow(unpack, schema).withColumnRenamed("id", id_col)
