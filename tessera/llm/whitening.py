"""Whitening of embeddings by leading components, which LOBPCG finds from products with the covariance.

The covariance is never formed: each round multiplies a block of directions with it in one pass over the centred rows,
Y'(YB) / n, summed by task and then by entry. The round's Rayleigh-Ritz step takes the best directions out of the iterate,
its residuals and the step before. It ends when a fresh product certifies the residuals. The driver holds blocks of
(dimensions) x (some columns), never rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lean

#: Directions beside those asked for, which make the last of them converge as fast as the first.
GUARD = 8
#: A component counts as found when its residual is at most so much of the largest eigenvalue.
TOLERANCE = 1e-12
#: Rounds after which it is an error that it isn't.
ROUNDS = 500
#: A direction with at most so much of the largest eigenvalue has no variance and can't be whitened.
NO_VARIANCE = 1e-10
#: Scale and offset of the integers that entries become, and the largest of them: sums of products stay exact in doubles' integers.
SCALE, OFFSET, LARGEST = 1024, 100_000, 2**52


def _matrix(batch: pa.RecordBatch, column: str, d: int) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(column))
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), d)


def summed(points: DataFrame, of: Callable[[np.ndarray], np.ndarray], d: int, size: int) -> np.ndarray:
    """The sum over all batches of rows (x as a matrix) of ``of``, an array of ``size`` numbers.

    Each task sums its own batches; the sums meet entry by entry, so one task sees no more than its share of the entries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_row = np.zeros(size), False
        for b in batches:
            if b.num_rows:
                any_row = True
                total += of(_matrix(b, "x", d)).ravel()
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["slot", "value"])

    out = np.zeros(size)
    for r in points.select("x").mapInArrow(lean(run), "slot int, value double").groupBy("slot").agg(F.sum("value").alias("value")).collect():
        out[r.slot] = r.value
    return out


def _orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``block`` adds to the orthonormal ``against``, without its negligible directions."""
    for _ in range(2):
        block = block - against @ (against.T @ block)
        size = np.linalg.norm(block, axis=0)
        block = block[:, size > 0] / size[size > 0]
        if not block.shape[1]:
            return block
        u, s, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, s > 1e-10 * s[0]]
    return block


def lobpcg(product: Callable[[np.ndarray], np.ndarray], d: int, k: int, tolerance: float = TOLERANCE, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``k`` largest eigenvalues, falling, their unit eigenvectors as columns, and the largest certified residual.

    ``product`` multiplies a block of columns with the symmetric positive semidefinite matrix. The certificate: for unit v,
    an eigenvalue lies within the residual |Av - ev| of e. Raises ArithmeticError if the residuals don't come below
    ``tolerance`` times the largest eigenvalue.
    """
    k = min(k, d)
    m = min(d, k + GUARD)
    x = np.linalg.qr(np.random.default_rng(13).standard_normal((d, m)))[0]
    ax, before, fresh = product(x), np.zeros((d, 0)), True
    for _ in range(rounds):
        e, q = np.linalg.eigh((x.T @ ax + ax.T @ x) / 2)
        e, q = e[::-1], q[:, ::-1]
        x, ax = x @ q, ax @ q
        residuals = ax - x * e
        worst = np.linalg.norm(residuals[:, :k], axis=0).max()
        if worst <= tolerance * e[0] or e[0] <= 0:
            if fresh:
                return e[:k], x[:, :k], float(worst)
            x = np.linalg.qr(x)[0]
            ax, fresh = product(x), True
            continue
        more = _orthonormal(residuals, x)
        more = np.hstack([more, _orthonormal(before, np.hstack([x, more]))]) if before.shape[1] else more
        if not more.shape[1]:
            x = np.linalg.qr(x)[0]
            ax, fresh = product(x), True
            continue
        basis, a_basis = np.hstack([x, more]), np.hstack([ax, product(more)])
        _, c = np.linalg.eigh((basis.T @ a_basis + a_basis.T @ basis) / 2)
        c = c[:, ::-1][:, :m]
        before = basis[:, m:] @ c[m:]
        x, ax, fresh = basis @ c, a_basis @ c, False
    raise ArithmeticError(f"residuals of {worst / e[0]:.1e} of the largest eigenvalue after {rounds} rounds")


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """A row for each vector and component: vec_id, component, n, deviation, whitened, explained, identity_error, residual.

    Entries c become integers x = floor(1024 c) + 100000. Rows whose vector is null or empty, has null or non-finite entries, or
    entries whose x is beyond 2^52 are left out, and so are vectors of another length than the most frequent one (of equally
    frequent ones the longest). Components without variance (fewer rows than components, constant dimensions) aren't
    returned, so one row alone gives no rows. Of equal eigenvalues any orthonormal directions are components. Ids are passed on,
    null or repeated; rows that repeat count and come out each. ``deviation`` is exact, null where it doesn't fit into a long.
    """
    scratch = Scratch(df.sparkSession)
    c = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fine = F.size("c") > 0
    inside = F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) <= F.lit((LARGEST - OFFSET) / SCALE)))
    x = F.transform("c", lambda v: F.floor(v * F.lit(float(SCALE))).cast("double") + F.lit(float(OFFSET)))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), c.alias("c")).filter(F.col("c").isNotNull() & fine & F.coalesce(inside, F.lit(False))).select("vec_id", x.alias("x"))
    rows = scratch.save(rows, "points")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    nothing = df.sparkSession.createDataFrame([], schema)
    if lengths is None:
        return nothing
    d, n = lengths["d"], lengths["count"]
    points = rows.filter(F.size("x") == d)
    sums = {r["pos"]: int(r["s"]) for r in points.select(F.posexplode("x").alias("pos", "v")).groupBy("pos").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).collect()}
    total = [sums[i] for i in range(d)]
    mean = np.array([s / n for s in total])
    trace = summed(points, lambda m: np.square(m - mean).sum(keepdims=True), d, 1)[0] / n

    def product(block: np.ndarray) -> np.ndarray:
        def of(m: np.ndarray) -> np.ndarray:
            y = m - mean
            return y.T @ (y @ block)

        return summed(points, of, d, block.size).reshape(block.shape) / n

    if trace <= 0:
        return nothing
    e, vectors, residual = lobpcg(product, d, components)
    k = int((e > NO_VARIANCE * e[0]).sum())
    turn = vectors[:, :k] / np.sqrt(e[:k])

    def moments(m: np.ndarray) -> np.ndarray:
        w = (m - mean) @ turn
        return np.hstack([(w.T @ w).ravel(), w.sum(axis=0)])

    seen = summed(points, moments, d, k * k + k) / n
    error = float(np.abs(seen[: k * k].reshape(k, k) - np.outer(seen[k * k :], seen[k * k :]) - np.eye(k)).max())

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            m = _matrix(b, "x", d)
            short = max(n * float(np.abs(m).max()), *map(abs, total)) < 2**62
            exact = m.astype(np.int64) * n - np.array(total) if short else m.astype(np.int64).astype(object) * n - np.array(total, dtype=object)
            if short and float(np.abs(exact).max()) ** 2 * d >= 2**62:
                exact = exact.astype(object)
            far = [v if v < 2**63 else None for v in (int(v) for v in np.square(exact).sum(axis=1))]
            w = (m - mean) @ turn
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index("vec_id")), pa.array(far, pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(0, len(m) * k + 1, k, dtype=np.int32)), pa.array(w.ravel()))], names=["vec_id", "deviation", "w"])

    out = points.mapInArrow(lean(projected), "vec_id long, deviation long, w array<double>").select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    shares = F.array(*(F.lit(float(v / trace)) for v in e[:k]))
    return out.select("vec_id", (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("i")).alias("explained"), F.lit(error).alias("identity_error"), F.lit(residual / e[0]).alias("residual"))
