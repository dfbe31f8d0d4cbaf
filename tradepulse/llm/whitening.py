"""Embedding whitening on leading principal components, found by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.shared import Batches, landed

#: Vectors of a packed block; the greatest degree and growth of a filter, and how many are applied before
#: more guard vectors join; the residual, over its eigenvalue, at which a component counts as found, and the
#: share of the largest one, a dimension, up to which an eigenvalue is zero.
BLOCK_ROWS, DEGREE, GROWTH, CYCLES, TOLERANCE, ROUNDING = 4096, 10, 1e10, 12, 2e-14, 1e-14


def whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    """``floor(scale * c) + shift`` per component; null for a vector with a null or non-finite one.

    What lies beyond a bigint stays at 2^62.
    """
    scaled = F.transform(vector, lambda c: c.cast("double") * scale)
    usable = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = float(2 ** 62)
    return F.when(usable, F.transform(scaled, lambda c: F.floor(F.greatest(F.least(c, F.lit(most)), F.lit(-most))) + F.lit(shift)))


def matrix(row: dict) -> np.ndarray:
    return np.frombuffer(row["data"], np.int64).reshape(len(row["ids"]), -1)


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums of columns as Python integers; halves of each entry cannot overflow."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(l) for h, l in zip(high, low)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: as int64 where that holds it, else as Python integers."""
    most = max(int(np.abs(x).max(initial=0)), 1) * n + max(map(abs, sums), default=0)
    if most < 2 ** 62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return deviations(x, n, sums).astype(np.float64) / n


def squares(dev: np.ndarray) -> list[int]:
    """Exact sums of squares of the rows."""
    if dev.dtype == object or float(np.abs(dev).max(initial=0)) ** 2 * dev.shape[1] >= 2.0 ** 62:
        return [int(s) for s in (dev.astype(object) ** 2).sum(axis=1)]
    return (dev * dev).sum(axis=1).tolist()


@dataclass
class Components:
    """``vectors`` (columns) and falling ``values`` of the covariance, its ``trace``, and what was measured."""

    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int


class Covariance:
    """The covariance of the packed vectors as an operator: each product with a block is a pass over the data."""

    def __init__(self, blocks: DataFrame, n: int, sums: list[int]):
        self.blocks, self.n, self.sums, self.passes = blocks, n, sums, 0

    def times(self, q: np.ndarray) -> np.ndarray:
        """``V q``, as the sum over centred vectors ``x`` of ``x (x . q) / n``."""
        n, sums = self.n, self.sums
        self.passes += 1

        def run(batches: Batches) -> Batches:
            y = np.zeros_like(q)
            for batch in batches:
                for row in batch.to_pylist():
                    x = centred(matrix(row), n, sums)
                    y += x.T @ (x @ q)
            yield rows_batch(y)

        return summed(self.blocks.mapInArrow(run, "i int, y array<double>"), q.shape) / n

    def trace(self) -> float:
        n, sums = self.n, self.sums

        def run(batches: Batches) -> Batches:
            total = sum((float((centred(matrix(row), n, sums) ** 2).sum()) for batch in batches for row in batch.to_pylist()), 0.0)
            yield rows_batch(np.array([[total]]))

        return float(summed(self.blocks.mapInArrow(run, "i int, y array<double>"), (1, 1))[0, 0]) / n


def rows_batch(y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(y)), pa.int32()), pa.array(list(y), pa.list_(pa.float64()))], ["i", "y"])


def summed(rows: DataFrame, shape: tuple[int, int]) -> np.ndarray:
    """The tasks' matrices added up, row by row. What reaches the driver is one matrix."""
    out = np.zeros(shape)
    for row in rows.groupBy("i").agg(*[F.sum(F.col("y")[j]).alias(f"c{j}") for j in range(shape[1])]).collect():
        out[row[0]] = row[1:]
    return out


def filtered(cov: Covariance, q: np.ndarray, image: np.ndarray, low: float, high: float, top: float, found: np.ndarray) -> np.ndarray:
    """A Chebyshev polynomial of the covariance on ``q``: small on [low, high], growing fast above.

    ``image`` is the first product, known from the Rayleigh-Ritz step. Steps are scaled by the value
    at ``top``, so that nothing overflows, and the degree stays where what grows fastest cannot push the
    rest below rounding. The vectors ``found`` are kept out at each step.
    """
    half, mid = (high - low) / 2, (high + low) / 2
    degree = min(DEGREE, max(2, int(np.log(GROWTH) / np.arccosh((top - mid) / half))))
    apart = lambda y: y - found @ (found.T @ y)
    sigma = first = half / (top - mid)
    before, now = q, apart((image - mid * q) * (sigma / half))
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        before, now = now, apart((cov.times(now) - mid * now) * (2 * following / half) - before * (sigma * following))
        sigma = following
    return now


def leading(cov: Covariance, d: int, k: int, trace: float, seed: int = 7) -> Components:
    """The ``k`` leading eigenpairs of the covariance.

    A block of 4 k vectors is filtered, made orthonormal by QR and turned by Rayleigh-Ritz until the
    residuals of the first k are at rounding level; vectors that are there already are locked. Then the
    other vectors of the block are replaced by random ones and filtered once more: had a larger
    eigenvalue been missed, it would show. A spectrum without a gap gets a larger block; a block as
    wide as the vectors is exact at once, so the search ends.
    """
    pick, width = np.random.default_rng(seed), min(d, 4 * k)
    low, certified, best, quiet, done = np.inf, None, np.inf, 0, 0
    q = np.linalg.qr(pick.standard_normal((d, width)))[0]
    while True:
        image = cov.times(q)
        values, turn = np.linalg.eigh((q.T @ image + image.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        top = max(float(values[0]), 0.0)
        # residuals over their own eigenvalues; what rounding leaves of an eigenvalue zero has none
        gaps = np.linalg.norm(image[:, :k] - q[:, :k] * values[:k], axis=0)
        gaps = np.where(values[:k] > ROUNDING * d * top, gaps / np.maximum(values[:k], 1e-300), 0.0)
        gap = float(gaps.max())
        if width == d or top == 0:
            return Components(q[:, :k], values[:k], trace, gap, cov.passes)
        done, quiet, best = done + 1, quiet + 1 if gap > best / 2 else 0, min(best, gap)
        settled = gap <= TOLERANCE or (quiet >= 2 and gap * values[k - 1] <= 100 * TOLERANCE * top)
        if settled and certified is not None and np.abs(values[:k] - certified).max() <= 1e-9 * top:
            return Components(q[:, :k], values[:k], trace, gap, cov.passes)
        locked = k if settled else int(np.argmin(np.append(gaps <= TOLERANCE, False)))
        least = float(values[-1])
        if settled:
            certified, quiet, done = values[:k], 0, 0
            q = np.linalg.qr(np.hstack([q[:, :k], pick.standard_normal((d, width - k))]))[0]
            image = cov.times(q)
        elif done >= CYCLES or values[locked] - least <= 1e-8 * top:
            more = min(d, 2 * width)
            q = np.linalg.qr(np.hstack([q, pick.standard_normal((d, more - width))]))[0]
            width, best, quiet, done = more, np.inf, 0, 0
            continue
        # Ritz values lie inside the spectrum: one spread below the least seen is a lower end, and
        # an eigenvalue that is still lower shows itself in the next block.
        low = min(low, max(0.0, least - (float(values[k - 1]) - least)))
        ahead = float(values[min(locked, k - 1)])
        moved = filtered(cov, q[:, locked:], image[:, locked:], low, max(least, low + 0.1 * (ahead - low)), ahead, q[:, :locked])
        q = np.linalg.qr(np.hstack([q[:, :locked], moved]))[0]


def packed(rows: DataFrame, id_type: str) -> DataFrame:
    """``(ids, data)`` blocks of vectors of one length, as machine integers."""
    def run(batches: Batches) -> Batches:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                column = part.column(1)
                data = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([part.column(0).to_pylist()], pa.list_(part.column(0).type)), pa.array([data], pa.binary())], ["ids", "data"])

    return rows.mapInArrow(run, f"ids array<{id_type}>, data binary")


def whiten(rows: DataFrame, k: int = 8, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024,
           shift: int = 100_000) -> DataFrame:
    """``(id, component, n, deviation decimal(38,0), whitened, explained, identity_error)`` per vector and component.

    Vectors become whole numbers ``floor(scale * c) + shift``. Components are the ``k`` leading unit
    eigenvectors of their covariance (fewer where its rank is lower: a component without variance
    cannot be whitened). Null vectors, vectors with a null or non-finite entry and empty vectors take no
    part. Of vectors of different length those of the commonest length take part (of equals the
    longer). Rows that repeat, or whose id is null, are rows like others; other columns are ignored. An empty
    table, one vector, or equal vectors give an empty result.

    A pass multiplies the centred vectors with a narrow block; only matrices of the vectors' length
    by the block's width reach the driver. ``deviation`` is exact.
    """
    spark, id_type = rows.sparkSession, rows.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    v = whole_numbers(F.col(vector_col), scale, shift)
    usable = rows.select(F.col(id_col).alias("id"), v.alias("v")).where("v is not null and size(v) > 0")
    common = usable.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], schema)
    d, n = common["d"], common["count"]
    blocks = landed(packed(usable.where(F.size("v") == d), id_type), "vectors")

    def adding(batches: Batches) -> Batches:
        total = [0] * d
        for batch in batches:
            for row in batch.to_pylist():
                total = [a + b for a, b in zip(total, exact_sums(matrix(row)))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(total, pa.decimal128(38, 0))], ["i", "s"])

    sums = [0] * d
    for i, s in blocks.mapInArrow(adding, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s")).collect():
        sums[i] = int(s)
    cov = Covariance(blocks, n, sums)
    trace = cov.trace()
    if trace <= 0:
        return spark.createDataFrame([], schema)
    found = leading(cov, d, min(k, d), trace)
    # What rounding leaves of an eigenvalue zero is no component.
    rank = int((found.values > ROUNDING * d * found.values[0]).sum())
    if rank == 0:
        return spark.createDataFrame([], schema)
    project = found.vectors[:, :rank] / np.sqrt(found.values[:rank])
    explained = found.values[:rank] / trace

    def moments(batches: Batches) -> Batches:
        total = np.zeros((rank + 1, rank))
        for batch in batches:
            for row in batch.to_pylist():
                w = centred(matrix(row), n, sums) @ project
                total += np.vstack([w.T @ w, w.sum(axis=0)])
        yield rows_batch(total)

    total = summed(blocks.mapInArrow(moments, "i int, y array<double>"), (rank + 1, rank)) / n
    error = float(np.abs(total[:rank] - np.outer(total[rank], total[rank]) - np.eye(rank)).max())

    def projected(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.to_pylist():
                dev = deviations(matrix(row), n, sums)
                w = (dev.astype(np.float64) / n) @ project
                m = len(w)
                ids = pa.array(row["ids"], batch.column(0).type.value_type).take(pa.array(np.repeat(np.arange(m), rank)))
                spread = pa.array(squares(dev), pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(m), rank)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, rank + 1), m), pa.int32()), pa.array(np.full(m * rank, n), pa.int64()), spread,
                     pa.array(w.ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * rank, error))],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(projected, schema)
