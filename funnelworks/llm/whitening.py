"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

With X the centred rows over the square root of their number, V and U have
orthonormal columns and X V = U B, Xᵀ U = V Bᵀ + (one more column), B upper
bidiagonal.  A step multiplies X by a vector v and Xᵀ by the result, in one
pass over the rows; both sides are orthogonalised against all earlier
columns.  U's columns are as long as the data and lie in the span of X's, so
they are kept as coefficients: u = X c, and products with them are sums over
the rows.  The singular values and vectors of the small B then give X's.

What a pass returns, and all the driver holds, has the size of the
dimensions; rows are read from a table of blocks in the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelworks.llm.storage import stored

SCALE, SHIFT = 64, 1_000_000
#: Relative to the largest singular value: a column without length, and the residual at which a vector is done.
NOTHING, DONE = 1e-12, 1e-15
#: Bytes of a block; batches have up to a thousand blocks.
BLOCK_BYTES = 1 << 15
_BLOCKS = "ids array<long>, dims int, sums array<long>, x binary"


def _blocks(batches):
    """Rows of whole numbers in blocks; unusable vectors go."""
    for batch in batches:
        batch = batch.filter(batch.column(1).is_valid())
        ids, vectors = batch.column(0), batch.column(1)
        size = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = vectors.flatten().to_numpy(zero_copy_only=False)  # null entries become NaN
        row = np.repeat(np.arange(len(size)), size)
        good = (np.bincount(row[~np.isfinite(flat)], minlength=len(size)) == 0) & (size > 0)
        if not good.any():
            continue
        dims = np.unique(size[good])
        if len(dims) > 1:
            raise ValueError(f"vectors of {dims[0]} and {dims[-1]} entries")
        c = SCALE * flat[good[row]].reshape(-1, dims[0])
        if (np.abs(c) >= 1 << 52).any():
            raise ValueError(f"entries of {(1 << 52) // SCALE} or more")
        x, own = np.floor(c).astype("<i8") + SHIFT, ids.filter(pa.array(good)).to_pylist()
        step = max(1, BLOCK_BYTES // max(8 * int(dims[0]), 1))
        parts = [(own[i : i + step], x[i : i + step]) for i in range(0, len(x), step)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, _ in parts], pa.list_(pa.int64())),
                pa.array([int(dims[0])] * len(parts), pa.int32()),
                pa.array([m.sum(0).tolist() for _, m in parts], pa.list_(pa.int64())),
                pa.array([m.tobytes() for _, m in parts]),
            ],
            ["ids", "dims", "sums", "x"],
        )


class Rows:
    """The fit list: blocks of rows, their number and exact sums."""

    def __init__(self, vectors: DataFrame):
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
        self.spark = vectors.sparkSession
        self.blocks = stored(rows.mapInArrow(_blocks, _BLOCKS), "vector-blocks")
        n, least, most = self.blocks.agg(F.sum(F.size("ids")), F.min("dims"), F.max("dims")).first()
        if least != most:
            raise ValueError(f"vectors of {least} and {most} entries")
        self.n, self.dims = n or 0, most or 0
        sums = self.blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i")
        self.sums = [r.s for r in sums.collect()]  # a row a dimension

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """Whole and fractional parts of the means."""
        whole = [s // self.n for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole, strict=True)])

    def add_up(self, work, given: np.ndarray) -> np.ndarray:
        """Sum over the blocks of ``work(centred rows, given)``, a vector."""
        sent = self.spark.sparkContext.broadcast((self.centre(), given))
        dims = self.dims

        def run(batches):
            (whole, part), own = sent.value
            total = 0.0
            for batch in batches:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8").reshape(-1, dims)
                total = total + work((x - whole).astype(np.float64) - part, own)
            if np.ndim(total):
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["i", "v"])

        parts = self.blocks.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
        out = {r.i: r.v for r in parts.collect()}
        sent.destroy()
        return np.array([out[i] for i in range(len(out))])


def _products(x: np.ndarray, given: np.ndarray) -> np.ndarray:
    """Uᵀ y, y·y, Xᵀ y and all squares, with y = X p; ``given``: U's coefficients, then p."""
    y = x @ given
    last = y[:, -1]
    return np.concatenate((y[:, :-1].T @ last, [last @ last], x.T @ last, [np.einsum("ij,ij->", x, x)]))


def _moments(x: np.ndarray, given: np.ndarray) -> np.ndarray:
    y = x @ given
    return np.concatenate((y.sum(0), (y.T @ y).ravel()))


def _orthogonal(w: np.ndarray, basis: np.ndarray) -> np.ndarray:
    for _ in range(2):
        w = w - basis @ (basis.T @ w)
    return w


def principal(rows: Rows, limit: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(eigenvalues, unit eigenvectors as columns, trace) of the rows'
    covariance, at most ``limit`` and none beyond the rank."""
    d, n = rows.dims, rows.n
    draw = np.random.default_rng(20240607)
    v_all, c_all, z_all = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))
    alphas: list[float] = []
    betas: list[float] = [0.0]  # betas[j]: between columns j - 1 and j
    v = draw.standard_normal(d)
    v /= np.linalg.norm(v)
    while True:
        p = v - betas[-1] * c_all[:, -1] if betas[-1] else v
        for again in (False, True):
            got = rows.add_up(_products, np.column_stack((c_all, p))) / n
            k = c_all.shape[1]
            h, yy, g, trace = got[:k], got[k], got[k + 1 : -1], got[-1]
            p, g = p - c_all @ h, g - z_all @ h
            rest = yy - h @ h
            if again or rest > 0.5 * yy:
                break
        alpha = float(np.sqrt(max(rest, 0.0)))
        top = max([*alphas, *betas, alpha])
        if alpha <= NOTHING * top or not top:
            alpha, c, z = 0.0, np.zeros(d), np.zeros(d)
        else:
            c, z = p / alpha, g / alpha
        alphas.append(alpha)
        v_all, c_all, z_all = (np.column_stack(x) for x in ((v_all, v), (c_all, c), (z_all, z)))
        w = _orthogonal(z - alpha * v, v_all)
        beta = float(np.linalg.norm(w))
        left, s, right = np.linalg.svd(np.diag(alphas) + np.diag(betas[1:], 1))
        j = len(alphas)
        if j == d:
            break
        if beta <= NOTHING * max(top, alpha):  # an invariant subspace: go on with any other direction
            beta, w = 0.0, _orthogonal(draw.standard_normal(d), v_all)
            v = w / np.linalg.norm(w)
        else:
            if j >= limit and (beta * np.abs(left[-1, :limit]) <= DONE * s[0]).all():
                break
            v = w / beta
        betas.append(beta)
    use = min(limit, int((s > s[0] * d * NOTHING).sum())) if s[0] > 0 else 0
    vectors = v_all @ right[:use].T
    return s[:use] ** 2, vectors / np.linalg.norm(vectors, axis=0), float(trace)


def _whitened(rows: Rows, factors: np.ndarray):
    (whole, part), n, sums, dims = rows.centre(), rows.n, rows.sums, rows.dims
    sent = rows.spark.sparkContext.broadcast(factors)

    s = [n * int(w) - t for w, t in zip(whole, sums, strict=True)]

    def deviations(x: np.ndarray) -> pa.Array:
        """Sum over dimensions of (n x - S)^2 for each row, in whole numbers:
        n^2 sum a^2 + 2 n sum a s + sum s^2 with a = x - whole, s = n whole - S."""
        a = x - whole
        if np.abs(a).max(initial=0) >= 1 << 20 or n >= 1 << 36:
            a = a.astype(object)
        squares, mixed = (a * a).sum(1).astype(object), (a * np.array(s, a.dtype)).sum(1).astype(object)
        return pa.array((squares * n * n + mixed * (2 * n) + sum(v * v for v in s)).tolist(), pa.decimal128(38, 0))

    def run(batches):
        for batch in batches:
            for ids, data in zip(batch.column(0), batch.column(1), strict=True):
                x = np.frombuffer(data.as_buffer(), "<i8").reshape(-1, dims)
                y = ((x - whole).astype(np.float64) - part) @ sent.value
                ends = np.arange(len(x) + 1, dtype=np.int32) * y.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [ids.values, deviations(x), pa.ListArray.from_arrays(pa.array(ends), pa.array(y.ravel()))],
                    ["vec_id", "deviation", "y"],
                )

    return run


def whiten(vectors: DataFrame, limit: int = 32) -> DataFrame:
    """One row per usable row of ``vectors`` (needs vec_id, embedding; other
    columns are not read) and component: vec_id, component, n, deviation
    (decimal(38,0)), whitened, explained, identity_error.

    Entries are scaled to whole numbers x = floor(64 c) + 1000000; n rows
    with sums S are all fitted.  Components are the unit eigenvectors of x's
    covariance (divisor n) by falling eigenvalue e, numbered from 1, at most
    ``limit`` and none beyond the rank (so identical rows, or one, give none).
    deviation: exact sum over dimensions of (n x - S)^2.  whitened: (x - S/n)
    on the component over sqrt(e).  explained: e over the trace.
    identity_error: largest absolute entry of whitened's covariance minus the
    identity.

    Rows whose vector is null, has no entries or holds null or non-finite
    ones are dropped; null and repeated vec_ids are carried.  Usable vectors of
    different lengths, or entries of 2^46 or more, raise.  Empty table: no
    rows.
    """
    rows = Rows(vectors)
    values, axes, trace = principal(rows, limit) if rows.n and rows.dims else (np.zeros(0), np.zeros((rows.dims, 0)), 0.0)
    factors = axes / np.sqrt(values)
    k = len(values)
    error = 0.0
    if k:
        got = rows.add_up(_moments, factors) / rows.n
        mean, second = got[:k], got[k:].reshape(k, k)
        error = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    found = rows.blocks.where(F.lit(k > 0)).select("ids", "x")
    found = found.mapInArrow(_whitened(rows, factors), "vec_id long, deviation decimal(38,0), y array<double>")
    each = found.select("vec_id", "deviation", F.posexplode("y").alias("i", "whitened"))
    share = F.array(*[F.lit(float(v / trace)) for v in values]) if k else F.array(F.lit(0.0))
    return each.select(
        "vec_id",
        (F.col("i") + 1).alias("component"),
        F.lit(rows.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(share, "i").alias("explained"),
        F.lit(error).alias("identity_error"),
    )
