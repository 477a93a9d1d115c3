"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors are taken as whole numbers (64ths, rounded down), so column sums and each
row's deviation are exact.  With X the centred rows, a step takes the unit vector
v, forms Xv and the transposed product of that in one distributed pass, and keeps
two numbers of the bidiagonal matrix B: X V = U B.  A left vector u is never stored:
u = Xw for a short w, which tasks apply to the rows they read, so no state lives on
executors and a lost one repeats its tasks only.  Every new u and v is made
orthogonal to all before it, twice for v; for u the dot products come out of the
same pass, as U'p = W'(X'p).  The singular value decomposition of B then gives
components (V Q) and deviations; a last pass measures how far the whitened
covariance is from the identity.

The driver holds vectors and matrices of the dimension only.  A task adds up its
rows and returns one row; these are added by a pre-aggregated shuffle.

``steps``: all dimensions up to ``FULL`` of them; beyond, the process ends as soon as
the wanted components' residuals are below ``RESIDUAL`` of the largest deviation.  A
direction in which nothing is left starts the process anew from a random vector.

Defined cases: null vectors, vectors with null or non-finite components, empty ones
and ones of another length than the commonest (of equally common ones the longest)
are dropped; null and repeated ids and repeated rows are rows like others;
components whose deviation is below ``NOISE`` of the largest are not returned, so
equal rows, a single row or an empty table give no rows; of a component and its
negative, the one whose largest entry is positive is taken; a deviation beyond 64
bits is null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.common import written

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Dimensions up to which all steps are taken.
FULL = 128
RESIDUAL = 1e-14
NOISE = 1e-10
SEED = 20240229

SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, x): valid vectors as 64ths.  The constant that the contract adds
    shifts a column and its mean alike, so it is left out."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x")
    )


class Centred:
    """Rows of batches as deviations from the mean, exact up to the last division."""

    def __init__(self, n: int, sums: list[int], largest: int):
        self.n, self.sums = n, sums
        # whole-number arithmetic in 64 bits while squares and their sum fit
        self.exact64 = len(sums) * (2 * n * max(largest, 1)) ** 2 < 2**63

    def whole(self, batch: pa.RecordBatch) -> np.ndarray:
        """n * x - sum, by row and dimension."""
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(self.sums))
        if self.exact64:
            return x * np.int64(self.n) - np.array(self.sums, dtype=np.int64)
        return x.astype(object) * self.n - np.array(self.sums, dtype=object)

    def rows(self, batch: pa.RecordBatch) -> np.ndarray:
        return (self.whole(batch) / self.n).astype(np.float64)


def _summed(table: DataFrame, centred: Centred, add) -> np.ndarray:
    """Sum over all rows of ``add(rows)``, a flat array for each batch of rows."""

    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                part = add(centred.rows(batch))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = table.select("x").mapInArrow(run, "sums array<double>")
    found = parts.select(F.posexplode("sums").alias("at", "part")).groupBy("at").agg(F.sum("part").alias("s")).collect()
    out = np.zeros(len(found))  # as long as one task's array
    for r in found:
        out[r["at"]] = r["s"]
    return out


def _both_products(w: np.ndarray):
    """p = Xw, then X'p and p'p."""

    def add(rows: np.ndarray) -> np.ndarray:
        p = rows @ w
        return np.append(p @ rows, p @ p)

    return add


def _orthogonal(v: np.ndarray, to: np.ndarray) -> np.ndarray:
    for _ in range(2):
        v = v - to @ (to.T @ v)
    return v


def bidiagonalise(table: DataFrame, centred: Centred, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(components as columns, singular values) of the centred rows, largest first."""
    d = len(centred.sums)
    random = np.random.default_rng(SEED)
    right, short, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # V, W (U = XW), X'U
    alphas: list[float] = []
    betas: list[float] = []  # betas[j] joins columns j and j + 1

    def start() -> np.ndarray:
        v = _orthogonal(random.standard_normal(d), right)
        return v / np.linalg.norm(v)

    v, beta = start(), 0.0
    while True:
        right = np.column_stack([right, v])
        w = v - beta * short[:, -1] if beta else v
        sums = _summed(table, centred, _both_products(w))
        z, pp = sums[:-1], float(sums[-1])
        c = short.T @ z  # U'p, zero but for rounding
        w, z = w - short @ c, z - back @ c
        alpha = float(np.sqrt(max(pp - c @ c, 0.0)))
        floor = 1e-13 * max([*alphas, alpha])
        if alpha > floor:
            w, z = w / alpha, z / alpha
        else:
            w, z, alpha = np.zeros(d), np.zeros(d), 0.0
        alphas.append(alpha)
        short, back = np.column_stack([short, w]), np.column_stack([back, z])
        m = len(alphas)
        left, values, mixed = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        if m == d:
            break
        r = _orthogonal(z - alpha * v, right)
        beta = float(np.linalg.norm(r))
        if beta > floor:
            v = r / beta
            if m >= max(FULL, 2 * wanted) and (beta * np.abs(left[-1, :wanted]) <= RESIDUAL * values[0]).all():
                break
        else:
            v, beta = start(), 0.0
        betas.append(beta)
    parts = right @ mixed.T
    sign = np.sign(parts[np.abs(parts).argmax(axis=0), np.arange(parts.shape[1])])
    return parts * sign, values


def _whitened(centred: Centred, projection: np.ndarray, explained: np.ndarray, error: float):
    k = projection.shape[1]

    def run(batches):
        for batch in batches:
            n_rows = batch.num_rows
            if not n_rows:
                continue
            whole = centred.whole(batch)
            deviation = (whole * whole).sum(axis=1)
            if centred.exact64:
                deviation = pa.array(np.repeat(deviation, k), pa.int64())
            else:
                fits = [int(s) if s < 2**63 else None for s in deviation]
                deviation = pa.array([s for s in fits for _ in range(k)], pa.int64())
            white = (whole / centred.n).astype(np.float64) @ projection
            n = n_rows * k
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(n_rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n_rows)),
                    pa.array(np.full(n, centred.n, dtype=np.int64)),
                    deviation,
                    pa.array(white.ravel()),
                    pa.array(np.tile(explained, n_rows)),
                    pa.array(np.full(n, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def whitened(
    df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """One row per vector and component: its exact deviation, its whitened value, the
    share of the variance the component explains and the measured error."""
    valid = whole_vectors(df, id_col, vec_col)
    table = written(valid.withColumn("dim", F.size("x")), "white_rows")
    dims = table.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dim")).first()
    if dims is None:
        return df.sparkSession.createDataFrame([], SCHEMA)
    table = table.where(F.col("dim") == dims["dim"]).select("vec_id", "x")
    n = dims["n"]
    each = table.select(F.posexplode("x").alias("at", "c")).groupBy("at")
    found = each.agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("s"), F.min("c").alias("low"), F.max("c").alias("high")).collect()
    found.sort(key=lambda r: r["at"])  # one row per dimension
    largest = max(max(-r["low"], r["high"]) for r in found)
    centred = Centred(n, [int(r["s"]) for r in found], largest)

    parts, values = bidiagonalise(table, centred, components)
    if not values[0] > 0:
        return df.sparkSession.createDataFrame([], SCHEMA)
    k = min(components, int((values > NOISE * values[0]).sum()))
    variance = values[:k] ** 2 / n
    projection = parts[:, :k] / np.sqrt(variance)

    def squares(rows: np.ndarray) -> np.ndarray:
        y = rows @ projection
        return np.concatenate([(y.T @ y).ravel(), y.sum(axis=0), [(rows * rows).sum()]])

    sums = _summed(table, centred, squares)
    mean = sums[k * k : k * k + k] / n
    cov = sums[: k * k].reshape(k, k) / n - np.outer(mean, mean)  # the mean is zero but for rounding
    error = float(np.abs(cov - np.eye(k)).max())
    explained = variance / (sums[-1] / n)
    return table.mapInArrow(_whitened(centred, projection, explained, error), SCHEMA)
