"""Whitening of embeddings by a Jacobi-Davidson eigensolver whose products run over the rows in tasks."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiolume.session import stage

#: Vectors that stand in one row of the packed fit list, and the most array entries of such a row.
BLOCK_ROWS, BLOCK_ENTRIES = 4096, 1 << 19
#: Entries beyond this, times ``scale``, count as this.
_MOST = float(1 << 52)
#: Partial sums that come to the driver at most; more are added up in as many tasks first.
_PARTS = 16
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
Product = Callable[[np.ndarray], np.ndarray]


# ---------------------------------------------------------------- the solver


def orthonormal(block: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what a block adds to an orthonormal one; columns that add nothing go."""
    kept = [block[:, :0]]
    for column in block.T:
        size = np.linalg.norm(column)
        if size == 0 or not np.isfinite(size):
            continue
        column = column / size
        for _ in range(2):
            for basis in (against, *kept):
                column = column - basis @ (basis.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-8:
                break
            column = column / left
        else:
            for basis in (against, *kept):
                column = column - basis @ (basis.T @ column)
            kept.append((column / np.linalg.norm(column))[:, None])
    return np.concatenate(kept, axis=1)


def minres_block(product: Product, shifts: np.ndarray, locked: np.ndarray, own: np.ndarray, right: np.ndarray, steps: int, rest: float) -> np.ndarray:
    """MINRES for several correction equations side by side, one product for all of them in each step.

    Column i solves (I - P)(A - shift_i)(I - P) t = right_i, P projecting on the locked vectors and the column's own Ritz
    vector. A column stops when its residual is below ``rest`` of what it was.
    """

    def project(v: np.ndarray) -> np.ndarray:
        v = v - locked @ (locked.T @ v)
        return v - own * (own * v).sum(axis=0)

    tiny = np.finfo(float).tiny
    r = project(right)
    beta = first = np.linalg.norm(r, axis=0)
    v_old, v = np.zeros_like(r), r / np.maximum(beta, tiny)
    w_old = w = np.zeros_like(r)
    x, eta = np.zeros_like(r), beta.copy()
    c_old = c = np.ones_like(beta)
    s_old = s = np.zeros_like(beta)
    going = first > 0
    for _ in range(steps):
        if not going.any():
            break
        p = project(product(v) - v * shifts)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        new = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta
        low = s * alpha + c_old * c * beta
        lowest = s_old * beta
        size = np.sqrt(delta**2 + new**2)
        good = going & (size > tiny)
        size = np.where(good, size, 1.0)
        c_old, s_old, c, s = c, s, np.where(good, delta / size, 1.0), np.where(good, new / size, 0.0)
        step = (v - low * w - lowest * w_old) / size
        w_old, w = w, step
        x = x + np.where(good, c * eta, 0.0) * step
        eta = -s * eta
        v_old, v, beta = v, p / np.maximum(new, tiny), new
        going = good & (np.abs(eta) > rest * first) & (new > 1e-14 * np.abs(shifts))
        v = np.where(going, v, 0.0)
    return project(x)


def jacobi_davidson(product: Product, dim: int, k: int, seed: int = 11, guard: int = 8, inner: int = 8, most_outer: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric, non-negative matrix known by its products, and unit eigenvectors.

    Each round takes Ritz pairs from the subspace, locks the leading ones whose residuals have come to double precision,
    and extends the subspace by the corrections of the next ones. ``guard`` further directions keep close eigenvalues
    from changing places. The subspace is cut back to its best directions when it grows beyond four times what is wanted.
    """
    k = min(k, dim)
    width = min(dim, k + guard)
    basis = orthonormal(np.random.default_rng(seed).normal(size=(dim, width)), np.zeros((dim, 0)))
    images = product(basis)
    locked, values = np.zeros((dim, 0)), []
    best, stalled = np.inf, 0
    for _ in range(most_outer):
        small = basis.T @ images
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, images = basis @ turn, images @ turn
        left = k - len(values)
        residual = images[:, :left] - basis[:, :left] * theta[:left]
        residual = residual - locked @ (locked.T @ residual)
        norms = np.linalg.norm(residual, axis=0)
        largest = max([*values, theta[0] if len(theta) else 0.0, 0.0])
        floor = 4 * np.finfo(float).eps * np.sqrt(dim) * largest
        # Where rounding alone keeps residuals from falling further, they have come to double precision.
        stalled = stalled + 1 if norms.max(initial=0.0) > best / 2 else 0
        best = min(best, norms.max(initial=0.0))
        near = norms <= floor * (1 if stalled < 4 else 64)
        n_done = int(np.argmin(near)) if not near.all() else len(near)
        if n_done:
            locked = np.concatenate([locked, basis[:, :n_done]], axis=1)
            values += theta[:n_done].tolist()
            basis, images, theta = basis[:, n_done:], images[:, n_done:], theta[n_done:]
            residual, norms, best, stalled = residual[:, n_done:], norms[n_done:], np.inf, 0
        if len(values) == k:
            break
        if basis.shape[1] > 4 * width:
            basis, images = basis[:, : 2 * width], images[:, : 2 * width]
        far = norms > floor
        own, shifts = basis[:, : len(norms)][:, far], theta[: len(norms)][far]
        fix = minres_block(product, shifts, locked, own, -residual[:, far], inner, 1e-3)
        spanned = np.concatenate([locked, basis], axis=1)
        more = orthonormal(fix, spanned)
        if not more.shape[1] and spanned.shape[1] < dim:
            more = orthonormal(np.random.default_rng(seed + spanned.shape[1]).normal(size=(dim, 1)), spanned)
        if more.shape[1]:
            basis, images = np.concatenate([basis, more], axis=1), np.concatenate([images, product(more)], axis=1)
        else:  # the subspace is the whole space: fresh images remove what rounding has gathered
            basis = orthonormal(basis, locked)
            images = product(basis)
    else:
        raise RuntimeError(f"residuals of {best:.3g} after {most_outer} rounds; {len(values)} of {k} pairs are locked")
    small = locked.T @ product(locked)
    theta, turn = np.linalg.eigh((small + small.T) / 2)
    return theta[::-1], locked @ turn[:, ::-1]


# ------------------------------------------------------------ work in tasks


def whole_numbers(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S in whole numbers of any size."""
    most = n * max(1, int(np.abs(x).max(initial=0))) + max(map(abs, sums))
    if most < 2**63:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def square_sums(y: np.ndarray) -> pa.Array:
    """Sums of squares in whole numbers; beyond 64 bits NULL."""
    if y.dtype != object and y.shape[1] * int(np.abs(y).max(initial=0)) ** 2 < 2**63:
        return pa.array((y * y).sum(axis=1), pa.int64())
    found = (y.astype(object) ** 2).sum(axis=1)
    return pa.array([int(v) if v < 2**63 else None for v in found], pa.int64())


def _blocks(dim: int, n: int, sums: list[int]):
    most = max(1, min(BLOCK_ROWS, BLOCK_ENTRIES // dim))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = (centred(whole_numbers(batch.column("x"), dim), n, sums) / n).astype(np.float64)
            cells = [z[i : i + most].tobytes() for i in range(0, len(z), most)]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary())], ["z"])

    return run


def _summed(block: DataFrame, each: Callable[[np.ndarray], np.ndarray], dim: int) -> np.ndarray:
    """The sum over all blocks of what ``each`` makes of a block, added up in tasks first."""
    tasks = block.rdd.getNumPartitions()

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for cell in batch.column("z"):
                part = each(np.frombuffer(cell.as_buffer(), np.float64).reshape(-1, dim))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["part"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [row for batch in batches for row in batch.column("part").to_numpy(zero_copy_only=False)]
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array([np.sum(parts, axis=0)], pa.list_(pa.float64()))], ["part"])

    parts = block.mapInArrow(add, "part array<double>")
    if tasks > _PARTS:
        parts = parts.repartition(_PARTS).mapInArrow(merge, "part array<double>")
    return np.sum([np.array(r["part"]) for r in parts.collect()], axis=0)


def _products(block: DataFrame, dim: int, n: int, u: np.ndarray) -> np.ndarray:
    """V u for the covariance V of the fit list, without V: z' (z u) summed over the centred rows."""
    return _summed(block, lambda z: z.T @ (z @ u), dim).reshape(dim, -1) / n


def _whitener(dim: int, n: int, sums: list[int], turn: np.ndarray, shares: np.ndarray, error: float):
    """Rows of the result; ``turn`` projects a centred vector on the components and divides by their deviations."""
    k = turn.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = centred(whole_numbers(batch.column("x"), dim), n, sums)
            whitened = (y / n).astype(np.float64) @ turn
            rows = np.repeat(np.arange(len(y)), k)
            size = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(y))),
                    pa.array(np.full(size, n)), square_sums(y).take(pa.array(rows)), pa.array(whitened.ravel()),
                    pa.array(np.tile(shares, len(y))), pa.array(np.full(size, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


def _whiten_length(rows: DataFrame, dim: int, k: int) -> DataFrame | None:
    """The result for the vectors of one length, or none where nothing varies."""
    x = rows.where(F.size("x") == dim).select("id", "x")
    fit = stage(x.select("x").distinct(), "fit")
    sums = fit.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    ).collect()  # as many rows as a vector has entries
    n = sums[0]["n"]
    total = [int(Decimal(r["s"])) for r in sorted(sums, key=lambda r: r["at"])]
    block = stage(fit.mapInArrow(_blocks(dim, n, total), "z binary"), "centred").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        product = functools.partial(_products, block, dim, n)
        trace = float(_summed(block, lambda z: np.array([(z * z).sum()]), dim)[0]) / n
        if not trace > 0:
            return None
        values, vectors = jacobi_davidson(product, dim, k)
        varies = values > 1e-13 * trace
        values, vectors = values[varies], vectors[:, varies]
        turn = vectors / np.sqrt(values)
        identity = _summed(block, lambda z: (z @ turn).T @ (z @ turn), dim).reshape(len(values), -1) / n
    finally:
        block.unpersist()
    error = float(np.abs(identity - np.eye(len(values))).max())
    return x.mapInArrow(_whitener(dim, n, total, turn, values / trace, error), RESULT)


def whiten(
    vectors: DataFrame,
    components: int = 16,
    scale: int = 64,
    offset: int = 1_000_000,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Project vectors on the leading eigenvectors of their covariance and divide by the deviations there.

    Entries become whole numbers x = floor(scale * c) + offset. Mean S/n and covariance V are those of the fit list, in which each
    different vector stands once; S is exact. V is never formed: the eigensolver asks for products with a few
    columns, and tasks add up z' (z u) over centred rows z. The solver runs Jacobi-Davidson rounds for all wanted pairs
    side by side, so that one job serves one step of all correction equations; only blocks of a vector's length by some
    dozens of columns are sent out and come back. The centred fit list is written once and kept by executors that have room.

    Returns for each row and component (from 1, by falling eigenvalue e): ``vec_id, component, n, deviation`` (sum over
    entries of (n x - S)^2; NULL beyond 64 bits), ``whitened`` ((x - S/n) on the component, over sqrt(e)),
    ``explained`` (e / trace V) and ``identity_error`` (largest entry of the whitened fit list's covariance minus the identity).

    Vectors that are NULL, empty or hold NULL, NaN or infinity are left out. A NULL id comes back as NULL; repeated rows
    have a result each. Vectors of each length are a list of their own. Components without variance (e at most 1e-13 of the
    trace) have no rows, so a list of one vector gives none; an empty table gives none either. Equal eigenvalues have some
    orthonormal vectors of their space.
    """
    spark = vectors.sparkSession
    value = F.col(f"`{vec_col}`")
    given = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), value.cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = given.where(F.col("vec").isNotNull() & (F.size("vec") > 0) & finite)
    held = lambda c: F.greatest(F.least(c * scale, F.lit(_MOST)), F.lit(-_MOST))
    x = F.transform("vec", lambda c: F.floor(held(c)) + F.lit(offset).cast("long"))
    rows = stage(kept.select("id", x.alias("x")), "whole")
    lengths = [r[0] for r in rows.select(F.size("x")).distinct().collect()]
    found = [out for dim in sorted(lengths) if (out := _whiten_length(rows, dim, components)) is not None]
    if not found:
        return spark.createDataFrame([], RESULT)
    return functools.reduce(DataFrame.unionAll, found)
