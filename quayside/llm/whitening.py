"""Whitening of embeddings from a covariance found by polarisation.

An entry c becomes the whole number x = floor(``scale`` * c) + ``shift``, so every sum
below is a sum of whole numbers and exact, in whatever order tasks add it up.

1. n and S, the sums of each dimension.
2. With y = x less the whole number nearest to its dimension's mean, every task adds
   up y_i^2 of each dimension and (y_i + y_j)^2 of each pair of dimensions. What the
   rounded centre leaves over is put right afterwards, in whole numbers: with
   r = sum of y, the squares around the true mean are n^2 * sum(y^2) - n * r^2, over n^2.
3. var(i + j) - var(i) - var(j) = 2 cov(i, j): differences of those variances give all
   cross-covariances, each rounded to a double once, after the last exact step.
4. eigh of the d x d covariance on the driver; a pass that projects gives the
   covariance of the result, a last one the result.

A task sends d * (d + 1) / 2 sums whatever it reads, Spark adds them up by pair, and the
driver gets one set of them; vectors never leave their task before the result.

Defined results: vectors that are NULL or hold a NULL, NaN or infinite entry are left
out, and so are vectors of another length than the most common one (the longer on
ties); scaled entries beyond 2^50 count as 2^50; repeated rows and ids, and a NULL id,
are rows of their own; a component without variance (all of one vector, dimensions
that copy each other) is not whitened: its ``whitened`` is NULL and identity_error
leaves it out; ``explained`` is NULL if no dimension varies; a ``deviation`` too large
for a long is NULL; no vectors give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Scaled entries end here, so that their squares have a place in a decimal(38).
LIMIT = 1 << 50
#: Rows squared at once.
CHUNK = 4096

_SUM = pa.decimal128(38, 0)


def _integers(column: pa.Array, size: int, scale: int, shift: int) -> np.ndarray:
    """x of every row, as (rows, size)."""
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.clip(np.floor(values * scale), -LIMIT, LIMIT).astype(np.int64) + shift


def square_sums(y: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of ``y``: y_i^2 at (i, i), (y_i + y_j)^2 at (i, j), i < j."""
    d = y.shape[1]
    out = np.zeros((d, d), object)
    top = 2 * int(np.abs(y).max(initial=0))
    fits = (1 << 62) // max(1, top * top)  # rows whose squares add up in 64 bits
    step = max(1, min(CHUNK, fits))
    for a in range(0, len(y), step):
        part = np.ascontiguousarray(y[a:a + step].T)
        part = part if fits else part.astype(object)
        for i in range(d):
            both = part[i:] + part[i]
            both[0] = part[i]
            out[i, i:] += (both * both).sum(1).astype(object)
    return out


def _sums(size: int, scale: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(size, object)
        for batch in batches:
            x = _integers(batch.column(0), size, scale, shift)
            n += len(x)
            for a in range(0, len(x), CHUNK):  # 2^12 values of about 2^50 have a place in 64 bits
                total += x[a:a + CHUNK].sum(0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(-1, size), pa.int32()), pa.array([Decimal(int(v)) for v in (n, *total)], _SUM)], ["i", "v"])
    return run


def _squares(size: int, scale: int, shift: int, centre: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size), object)
        for batch in batches:
            total += square_sums(_integers(batch.column(0), size, scale, shift) - centre)
        i, j = np.triu_indices(size)
        if any(total[i, j]):
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([Decimal(int(v)) for v in total[i, j]], _SUM)], ["i", "j", "v"])
    return run


class Whitening:
    """What the fit gives: exact sums, eigenvectors and the projection of vectors."""

    def __init__(self, n: int, sums: list[int], squares: dict[tuple[int, int], int], components: int):
        self.n, self.size = n, len(sums)
        self.centre = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = [s - n * m for s, m in zip(sums, self.centre, strict=True)]
        # exact sums of (n x - S)^2, for dimensions and for pairs of them
        r, cube = self.rest, n ** 3
        around = {(i, j): n * n * q - n * (r[i] + (r[j] if j != i else 0)) ** 2 for (i, j), q in squares.items()}
        self.covariance = np.zeros((self.size, self.size))
        for (i, j), q in around.items():
            own = q / cube if i == j else (q - around[i, i] - around[j, j]) / (2 * cube)
            self.covariance[i, j] = self.covariance[j, i] = own
        self.trace = sum(around[i, i] for i in range(self.size)) / cube
        values, vectors = np.linalg.eigh(self.covariance)
        self.k = min(components, self.size)
        self.values, vectors = values[::-1][:self.k], vectors[:, ::-1][:, :self.k]
        flip = vectors[np.abs(vectors).argmax(0), np.arange(self.k)] < 0
        self.vectors = np.where(flip, -vectors, vectors)
        self.varies = self.values > self.size * np.finfo(float).eps * max(0.0, values[-1])

    def project(self, y: np.ndarray) -> np.ndarray:
        """Whitened rows; components without variance are NaN."""
        scaled = self.vectors / np.sqrt(np.where(self.varies, self.values, np.nan))
        return (y - np.array(self.rest, float) / self.n) @ scaled

    def deviation(self, y: np.ndarray) -> pa.Array:
        """Exact sums of (n x - S)^2; NULL beyond 64 bits."""
        y = y.astype(np.int64)
        exact = y * np.int64(self.n % (1 << 63)) - np.array(self.rest, np.int64)  # modulo 2^64, as is the sum
        near = ((y.astype(float) * self.n - np.array(self.rest, float)) ** 2).sum(1)
        out = (exact * exact).sum(1)
        fits = near < 2.0 ** 63 * (1 - 1e-9)
        for i in np.flatnonzero(~fits & (near < 2.0 ** 63 * (1 + 1e-9))).tolist():
            fits[i] = sum((self.n * int(v) - r) ** 2 for v, r in zip(y[i], self.rest, strict=True)) < 1 << 63
        return pa.array(out, pa.int64(), mask=~fits)


def _products(model: Whitening, scale: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, k = np.array(model.centre, np.int64), model.k
        total = np.zeros((k + 1, k))
        for batch in batches:
            w = model.project(_integers(batch.column(0), model.size, scale, shift) - centre)
            total += np.vstack([w.sum(0), w.T @ w])
        i, j = np.meshgrid(range(-1, k), range(k), indexing="ij")
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])
    return run


def _projected(model: Whitening, scale: int, shift: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = np.array(model.centre, np.int64)
        for batch in batches:
            y = _integers(batch.column(1), model.size, scale, shift) - centre
            w = model.project(y).ravel()
            flat = pa.array(w, pa.float64(), mask=np.isnan(w))
            offsets = pa.array(np.arange(0, len(w) + 1, model.k), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), model.deviation(y), pa.ListArray.from_arrays(offsets, flat)], ["id", "deviation", "whitened"])
    return run


def usable(vector: F.Column) -> F.Column:
    """Not NULL, and without NULL, NaN or infinite entries."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def fit(vectors: DataFrame, size: int, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening:
    """Fit on all of ``vectors`` (one column of usable arrays of ``size`` doubles)."""
    def summed(rows: DataFrame, *keys: str) -> dict:
        return {tuple(r[:-1]): int(r["v"]) for r in rows.groupBy(*keys).agg(F.sum("v").cast("decimal(38,0)").alias("v")).collect()}

    sums = summed(vectors.mapInArrow(_sums(size, scale, shift), "i int, v decimal(38,0)"), "i")
    n = sums[-1,]
    sums = [sums[i,] for i in range(size)]
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    squares = summed(vectors.mapInArrow(_squares(size, scale, shift, centre), "i int, j int, v decimal(38,0)"), "i", "j")
    return Whitening(n, sums, {(i, j): squares.get((i, j), 0) for i in range(size) for j in range(i, size)}, components)


def identity_error(vectors: DataFrame, model: Whitening, scale: int = SCALE, shift: int = SHIFT) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    rows = vectors.mapInArrow(_products(model, scale, shift), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    sums = np.zeros((model.k + 1, model.k))
    for i, j, v in rows:
        sums[i + 1, j] = v
    own = np.flatnonzero(model.varies)
    mean = sums[0, own] / model.n
    off = sums[1:][np.ix_(own, own)] / model.n - np.outer(mean, mean) - np.eye(len(own))
    return float(np.abs(off).max()) if len(own) else None


def whiten(df: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable vector and component: the id, component (from 1), n, deviation,
    whitened, explained and identity_error."""
    rows = df.select(F.col(id_column).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).head()
    kind = dict(df.dtypes)[id_column]
    if common is None or not common["size"]:
        return df.sparkSession.createDataFrame(
            [], f"{id_column} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    size = common["size"]
    rows = rows.where(F.size("vector") == size)
    vectors = rows.select("vector")
    model = fit(vectors, size, components, scale, shift)
    error = identity_error(vectors, model, scale, shift)
    explained = F.array(*[F.lit(float(v) / model.trace if model.trace else None).cast("double") for v in model.values])
    out = rows.mapInArrow(_projected(model, scale, shift), f"id {kind}, deviation bigint, whitened array<double>")
    out = out.select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(F.col("id").alias(id_column), (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation",
                      "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
