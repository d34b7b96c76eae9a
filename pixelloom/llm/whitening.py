"""Whitening of vectors by the leading components of their covariance, which Jacobi-Davidson finds from distributed products alone."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelloom.llm.common import materialise

#: Each entry c counts as the whole number floor(64 c) + 1,000,000. Entries beyond 2^40 are taken as not finite.
SCALE, OFFSET = 64, 1_000_000
BOUND = float(1 << 40)
#: A residual counts as zero from so many times the precision of a double times the largest eigenvalue, for each root of the dimension.
RESIDUAL = 16 * np.finfo(float).eps
#: Steps of the inner solver for each correction, and outer rounds at most.
INNER, ROUNDS = 12, 60


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x array<bigint>): rows without null or non-finite entries, and of the most common length (ties: the shorter)."""
    c = F.col(vector_col).cast("array<double>")
    good = ~F.exists("c", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) > BOUND))
    rows = vectors.select(F.col(id_col).alias("vec_id"), c.alias("c")).where("c IS NOT NULL AND size(c) > 0").where(good)
    x = F.transform("c", lambda v: F.floor(v * SCALE).cast("long") + OFFSET)
    rows = materialise(rows.select("vec_id", x.alias("x")), "whole")
    length = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
    return rows.where(F.size("x") == (length.d if length else 0))


def centring(n: int, sums: list[int]) -> Callable[[pa.ListArray], np.ndarray]:
    """Rows of x less the mean, as a function of the column: the whole part of the mean is taken off whole numbers, without rounding."""
    whole = np.array([s // n for s in sums], np.int64) if n else np.zeros(0, np.int64)
    part = np.array([(s % n) / n for s in sums]) if n else np.zeros(0)
    return lambda column: (column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(sums)) - whole).astype(np.float64) - part


class Centred:
    """The covariance of the column x of rows as an operator: products with blocks of vectors, each one pass over the rows."""

    def __init__(self, rows: DataFrame):
        self.rows, first = rows, rows.first()
        self.d = len(first.x) if first else 0
        sums = rows.agg(F.count("*"), *[F.sum(F.col("x")[i].cast("decimal(38,0)")) for i in range(self.d)]).first()
        self.n, self.sums = sums[0], [int(s) for s in sums[1:]]
        self.centre, self.passes = centring(self.n, self.sums), 0

    def gather(self, function: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
        """The sum over all rows of a function that makes a d x width matrix of a batch of centred rows.

        A task adds up its batches and returns d rows; Spark adds those of all tasks, so the driver gets d rows of width numbers.
        """
        centre, d = self.centre, self.d

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((d, width))
            for b in batches:
                if b.num_rows:
                    total += function(centre(b.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

        parts = self.rows.select("x").mapInArrow(run, "i int, v array<double>")
        found = parts.groupBy("i").agg(F.array(*[F.sum(F.col("v")[j]) for j in range(width)]).alias("v")).collect()  # d rows
        self.passes += 1
        out = np.zeros((d, width))
        for r in found:
            out[r.i] = r.v
        return out

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q for a block q of vectors."""
        return self.gather(lambda x: x.T @ (x @ q), q.shape[1]) / self.n


def orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what new adds to the spaces of against, projected twice."""
    for turn in range(3):
        size = np.linalg.norm(new, axis=0)
        some = size > (1e-10 if turn else 0)  # corrections become small, but their directions count
        new = new[:, some] / size[some]
        for q in against:
            new = new - q @ (q.T @ new)
    u, s, _ = np.linalg.svd(new, full_matrices=False)
    return u[:, s > 1e-8]


def minres_block(product: Callable[[np.ndarray], np.ndarray], shift: np.ndarray, project: Callable[[np.ndarray], np.ndarray], b: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t of the projected equations (I - QQ') (V - shift_j) (I - QQ') t_j = b_j: MINRES for all columns at once.

    Every step is one product with a block; columns that have converged stay as they are.
    """
    m = b.shape[1]
    t, r = np.zeros_like(b), project(b)
    beta = np.linalg.norm(r, axis=0)
    start = np.maximum(beta, 1e-300)
    v, v_old = r / start, np.zeros_like(b)
    w, w_old = np.zeros_like(b), np.zeros_like(b)
    eta, c, c_old, s, s_old = beta.copy(), np.ones(m), np.ones(m), np.zeros(m), np.zeros(m)
    live = beta > 0
    carry = np.zeros(m)
    for _ in range(steps):
        p = project(product(v) - v * shift)
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha - v_old * carry
        after = np.linalg.norm(p, axis=0)
        rho0 = c * alpha - c_old * s * carry
        rho1 = np.hypot(rho0, after)
        rho2, rho3 = s * alpha + c_old * c * carry, s_old * carry
        live = live & (rho1 > 1e-300)
        safe = np.where(rho1 > 1e-300, rho1, 1.0)
        c_old, c, s_old, s = c, rho0 / safe, s, after / safe
        w_old, w = w, (v - w_old * rho3 - w * rho2) / safe
        t = t + np.where(live, c * eta, 0.0) * w
        eta = np.where(live, -s * eta, 0.0)
        live = live & (after > 1e-14 * start) & (np.abs(eta) > 1e-3 * start)
        if not live.any():
            break
        v_old, v, carry = v, p / np.where(after > 0, after, 1.0), after
    return project(t)


def leading_components(op: Centred, k: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(e, U): the k largest eigenvalues that aren't zero, falling, and their unit eigenvectors as columns.

    Block Jacobi-Davidson. The search space starts with random vectors; each round takes the Ritz pairs of the space,
    locks the leading ones whose residuals are zero to double precision, solves the correction equations of the others,
    kept orthogonal to all locked and current vectors, by a few steps of MINRES, and adds the corrections. All products
    are passes over the rows; the driver holds vectors of the dimension only. A full space restarts from its Ritz vectors.
    """
    d, k = op.d, min(k, op.d)
    locked, values = np.zeros((d, 0)), []
    space = orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, k + 4))))
    image = op.times(space)
    most = min(d, 4 * k + 8)
    for _ in range(ROUNDS):
        small = space.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        ritz, ritz_image = space @ y, image @ y
        top = max(values[0] if values else 0.0, theta[0] if len(theta) else 0.0)
        left = k - len(values)
        residual = ritz_image[:, :left] - ritz[:, :left] * theta[:left]
        size = np.linalg.norm(residual, axis=0)
        good = size <= RESIDUAL * max(top, 1e-300) * np.sqrt(d)
        full = locked.shape[1] + space.shape[1] >= d
        n = left if full else int(np.argmin(good)) if not good.all() else len(good)
        locked, values = np.hstack([locked, ritz[:, :n]]), [*values, *theta[:n]]
        if len(values) >= k or n and locked.shape[1] == d:
            break
        space, image = ritz[:, n:], ritz_image[:, n:]
        ritz_left, shift, residual = ritz[:, n:left], theta[n:left], residual[:, n:]
        hold = np.hstack([locked, ritz_left])

        def project(z: np.ndarray, q: np.ndarray = hold) -> np.ndarray:
            z = z - q @ (q.T @ z)
            return z - q @ (q.T @ z)

        t = minres_block(op.times, shift, project, -residual, INNER)
        if space.shape[1] + t.shape[1] > most:
            space, image = space[:, : left - n + 4], image[:, : left - n + 4]
        new = orthonormal(t, locked, space)
        if not new.shape[1]:
            new = orthonormal(np.random.default_rng(seed + len(values)).standard_normal((d, 4)), locked, space)
        if new.shape[1]:
            space, image = np.hstack([space, new]), np.hstack([image, op.times(new)])
    else:
        raise ArithmeticError(f"{k - len(values)} components didn't reach double precision in {ROUNDS} rounds")
    e, order = np.array(values), np.argsort(-np.array(values), kind="stable")
    e, u = e[order], locked[:, order]
    some = e > d * np.finfo(float).eps * max(e[0] if len(e) else 0.0, 1e-300)
    return e[some], u[:, some]


def whiten(vectors: DataFrame, k: int = 32, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), for each remaining row and component up to k.

    Entries c become whole numbers x = floor(64 c) + 1,000,000. Components are unit eigenvectors of the covariance of all
    remaining rows (divisor n), numbered from 1 by falling eigenvalue e; whitened is the centred row on the component over
    sqrt(e). deviation: the sum over dimensions of (n x - S)^2, without rounding; explained: e over the trace, which is
    exact; identity_error: the largest entry by which the covariance of whitened, from a pass over it, isn't the identity.

    Rows whose vector is null, empty, or holds null or non-finite entries (or beyond 2^40) drop out, as do those of another
    length than most. Components with e = 0 to double precision aren't returned: k is more than the rank, all rows are
    equal, or there is one. Repeated rows and null ids each keep their rows and count; of equal eigenvalues any
    orthonormal basis may come. An empty table gives no rows; other columns are ignored, whatever their names.
    """
    rows = materialise(whole_vectors(vectors, id_col, vector_col), "vectors")
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    op = Centred(rows)
    if not op.d:
        return rows.sparkSession.createDataFrame([], schema)
    n, d = op.n, op.d
    apart = lambda x, s: F.lit(n).cast("decimal(38,0)") * x - s
    squares = [(z := apart(F.col("x")[i].cast("decimal(20,0)"), F.lit(Decimal(s)))).cast("decimal(19,0)") * z.cast("decimal(19,0)") for i, s in enumerate(op.sums)]
    far = squares[0]
    for s in squares[1:]:
        far = (far + s).cast("decimal(38,0)")
    rows = materialise(rows.withColumn("deviation", far), "deviations")
    total = int(rows.agg(F.sum("deviation")).first()[0])
    op.rows = rows
    e, u = leading_components(op, k)
    m = len(e)
    if not m:
        return rows.sparkSession.createDataFrame([], schema)
    turn, trace = u / np.sqrt(e), total / n**3
    wide = np.zeros((d, m))

    def gram(x: np.ndarray) -> np.ndarray:
        out, w = wide.copy(), x @ turn
        out[:m] = w.T @ w
        return out

    mean = op.gather(lambda x: np.vstack([(x @ turn).sum(axis=0), np.zeros((d - 1, m))]), m)[0] / n
    error = float(np.abs(op.gather(gram, m)[:m] / n - np.outer(mean, mean) - np.eye(m)).max())
    explained = [float(x) / trace for x in e]
    centre = op.centre

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = centre(b.column(2)) @ turn
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(list(w), pa.list_(pa.float64()))], names=["vec_id", "deviation", "w"])

    done = rows.select("vec_id", F.col("deviation").cast("long").alias("deviation"), "x").mapInArrow(run, f"vec_id {kind}, deviation long, w array<double>")
    each = done.select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    shares = F.array(*map(F.lit, explained))
    return each.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"))
