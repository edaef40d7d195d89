"""Embedding whitening (operator 12): Golub-Kahan-Lanczos bidiagonalisation of the centred fit list.

Entries become whole numbers on a grid; each distinct grid vector counts once. The fit list is stored in blocks of
rows, so that a pass is one matrix product a block. A step of the bidiagonalisation takes the current right vector v and, in one pass over the centred rows, forms
p = Xv - beta u and then X'p, which leaves d + 1 sums. Every left vector is X times a d-vector, u = Xc, and is kept as
that c: products of u with others follow from the sums, so both families are reorthogonalised in full, twice,
without a stored column as long as the list. Where the sequence ends early (equal or zero eigenvalues) it starts
again from a random direction outside the span.
The small bidiagonal matrix's SVD gives the components and their deviations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import scratch, small_batches, stored

#: Cells of the grid a unit, and the offset that keeps usual entries positive.
SCALE, OFFSET = 64, 1_000_000
#: Larger grid values, beyond which doubles aren't whole numbers any more, are set to this bound.
FAR = 2 ** 52
COMPONENTS = 16
#: Bytes of a stored block of the fit list; bytes of a task's share of the list.
BLOCK_BYTES, TASK_BYTES = 1 << 19, 32 << 20
#: Below this share of the largest deviation a direction has none; below this share of the first a vector is used up.
NONE, USED_UP = 1e-10, 1e-11

SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def finite(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v): rows whose vector is there, and all of its entries with it."""
    v = F.col(vec_col).cast("array<double>")
    return (vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"))
            .where(F.size("v") > 0).where(F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))))


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, d)


def fit_blocks(grid: DataFrame, d: int, folder: str) -> DataFrame:
    """(rows, block): the distinct vectors of length d, less OFFSET, as stored blocks of little-endian longs."""
    most = max(1, BLOCK_BYTES // (8 * d))
    distinct = stored(grid.where(F.size("x") == d).groupBy("x").count().select("x"), folder, f"distinct-{d}")

    def pack(batches):
        for batch in batches:
            x = matrix(batch.column(0), d) - OFFSET
            for at in range(0, len(x), most):
                part = x[at:at + most]
                yield pa.RecordBatch.from_pydict({"rows": pa.array([len(part)], pa.int64()), "block": [part.astype("<i8").tobytes()]})

    # A pass starts a task for each file, so that a file is about a task's share and not a shuffle partition's.
    tasks = max(1, -(-distinct.count() * 8 * d // TASK_BYTES))
    return stored(distinct.coalesce(tasks).mapInArrow(pack, "rows bigint, block binary"), folder, f"fit-{d}")


class Fit:
    """Passes over the stored fit list: sums over all rows of functions of the centred vectors."""

    def __init__(self, blocks: DataFrame, d: int):
        self.d = d
        self.blocks, self.n = blocks.select("block"), blocks.agg(F.sum("rows")).first()[0] or 0
        self.sums = [0] * d
        if self.n:
            high = self._sums(lambda x: np.concatenate(((x >> 26).sum(0), (x & (2 ** 26 - 1)).sum(0))), "bigint")
            self.sums = [(int(high[i]) << 26) + int(high[d + i]) for i in range(d)]
            self.mean = np.array([s / self.n for s in self.sums])

    def _sums(self, f, kind: str) -> list:
        """The sums over all blocks of f(block of rows less OFFSET), entry by entry."""
        d = self.d

        def run(batches):
            total = None
            for batch in batches:
                for raw in batch.column(0):
                    out = f(np.frombuffer(raw.as_buffer(), "<i8").reshape(-1, d))
                    total = out if total is None else total + out
            if total is not None:
                yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(total)), pa.int32()), "s": pa.array(total)})

        add = F.sum(F.col("s").cast("decimal(38,0)")) if kind == "bigint" else F.sum("s")
        rows = self.blocks.mapInArrow(run, f"i int, s {kind}").groupBy("i").agg(add.alias("s")).collect()
        return [r.s for r in sorted(rows)]

    def centred(self, f) -> np.ndarray:
        mean = self.mean
        return np.array(self._sums(lambda x: np.ascontiguousarray(f(x - mean), np.float64).ravel(), "double"))

    def product(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """X'(Xw) and the square of Xw's length."""
        def f(x):
            p = x @ w
            return np.append(p @ x, p @ p)

        out = self.centred(f)
        return out[:-1], out[-1]


def without(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    """v less its share in the span of orthonormal vectors, taken away twice."""
    if basis:
        q = np.array(basis)
        for _ in range(2):
            v = v - (q @ v) @ q
    return v


def bidiagonalised(product, d: int, steps: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, falling; right singular vectors as rows) of X, given w -> (X'Xw, |Xw|^2)."""
    rng = np.random.default_rng(seed)
    right, c_all, z_all = [], [], []           # v_j; u_j = X c_j; z_j = X'u_j
    small, scale, beta = [], 0.0, 0.0          # entries (u, v, value) of the bidiagonal matrix

    def fresh():
        """A random unit vector outside the span of all right vectors so far."""
        v = without(rng.standard_normal(d), right)
        return without(v / np.linalg.norm(v), right)

    v = fresh()
    while True:
        v = v / np.linalg.norm(v)
        w = v - beta * c_all[-1] if beta else v
        g, square = product(w)
        if c_all:
            # u'p is c'X'p: p loses what it has in common with earlier left vectors, and the sums follow.
            c, z = np.array(c_all), np.array(z_all)
            for _ in range(2):
                share = c @ g
                w, g, square = w - share @ c, g - share @ z, square - share @ share
        if beta:
            small.append((len(c_all) - 1, len(right), beta))
        right.append(v)
        alpha, beta = np.sqrt(max(square, 0.0)), 0.0
        scale = max(scale, alpha)
        if alpha > USED_UP * scale:
            c_all.append(w / alpha)
            z_all.append(g / alpha)
            small.append((len(c_all) - 1, len(right) - 1, alpha))
        if len(right) >= min(d, steps):
            break
        if alpha > USED_UP * scale:
            v = without(z_all[-1] - alpha * v, right)
            beta = np.linalg.norm(v)
            scale = max(scale, beta)
        if beta <= USED_UP * scale:
            v, beta = fresh(), 0.0
    if not c_all:
        return np.zeros(0), np.zeros((0, d))
    b = np.zeros((len(c_all), len(right)))
    for i, j, value in small:
        b[i, j] = value
    _, s, rows = np.linalg.svd(b, full_matrices=False)
    return s, rows @ np.array(right)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The squared length of n * x - sums of each row, exactly; None where a long can't hold it."""
    s = np.array(sums, object)
    if len(x) and x.shape[1] * (n * int(np.abs(x).max()) + max(map(abs, sums))) ** 2 < 2 ** 63:
        y = n * x - s.astype(np.int64)
        return (y * y).sum(1).tolist()
    y = n * x.astype(object) - s
    return [q if q < 2 ** 63 else None for q in (y * y).sum(1).tolist()]


def whitened_rows(grid: DataFrame, d: int, components: int, steps: int | None, folder: str) -> DataFrame:
    """The result of vectors of one length."""
    fit = Fit(fit_blocks(grid, d, folder), d)
    s, vectors = bidiagonalised(fit.product, d, steps or d)
    k = int((s[:components] > NONE * s[0]).sum()) if len(s) and s[0] > 0 else 0
    n, sums, mean, e = fit.n, fit.sums, fit.mean, s[:k] ** 2 / fit.n
    to = vectors[:k].T / np.sqrt(e)
    trace = fit.centred(lambda x: np.array([(x * x).sum()]))[0] / n
    error = 0.0
    if k:
        def moments(x):
            w = x @ to
            return np.append(w.sum(0), w.T @ w)

        out = fit.centred(moments) / n
        error = float(np.abs(out[k:].reshape(k, k) - np.outer(out[:k], out[:k]) - np.eye(k)).max())

    def run(batches):
        for batch in batches:
            x, m = matrix(batch.column(1), d) - OFFSET, batch.num_rows
            many = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(many), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(deviations(x, n, sums), pa.int64()).take(many),
                 pa.array(((x - mean) @ to).ravel()), pa.array(np.tile(e / trace if k else e, m)), pa.array(np.full(m * k, error))],
                names=[c.split()[0] for c in SCHEMA.split(", ")])

    return small_batches(grid).where(F.size("x") == d).mapInArrow(run, SCHEMA)


def whitened(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
             steps: int | None = None) -> DataFrame:
    """Columns as in SCHEMA, one row for each vector and component.

    Entries c become floor(64 c) + 1000000. The fit list holds each distinct vector once, n in all. ``component``
    counts unit eigenvectors of its covariance (divisor n) from 1 by falling eigenvalue, ``components`` at most;
    ``whitened`` is the centred vector's part along one, over its deviation; ``explained`` the eigenvalue's share of
    the trace; ``deviation`` the squared length of n * x - sum of the list, null where a long can't hold it;
    ``identity_error`` the largest entry, in size, of the whitened list's covariance less the identity.

    ``steps``: passes over the fit list, all dimensions by default, which finds every component; fewer, such as four
    times ``components``, do for wide vectors whose leading eigenvalues stand apart.

    Null and empty vectors and those with an entry that is null or not finite are dropped. Vectors of different
    lengths are whitened among themselves. Directions without deviation have no component, so a list of equal vectors
    gives no rows, nor does an empty table. Repeated rows get equal results, a null id stays null, other columns
    are ignored. Entries beyond 2^46 count as that."""
    spark, folder = vectors.sparkSession, scratch(vectors.sparkSession)
    grid = finite(vectors, id_col, vec_col).select("vec_id", F.transform("v", lambda c: F.floor(
        F.greatest(F.least(c * SCALE, F.lit(float(FAR))), F.lit(-float(FAR)))) + OFFSET).alias("x"))
    out = spark.createDataFrame([], SCHEMA)
    for d, in sorted(grid.select(F.size("x")).distinct().collect()):
        out = out.union(whitened_rows(grid, d, components, steps, folder))
    return out
