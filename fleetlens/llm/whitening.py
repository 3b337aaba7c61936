"""Embedding whitening by QDWH spectral divide and conquer.

The covariance of the distinct vectors is summed over the cluster.  On the driver, which
holds one matrix of the vectors' length, the polar factor of the covariance less a shift
(dynamically weighted Halley steps by QR) gives the spectral projector of the part above
the shift; its range and the complement split the space in two, and both parts are
treated alike until single components are left.  The components then go to all tasks,
which project their rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.llm.common import staged

# An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000

COMPONENTS = 16

EPS = np.finfo(np.float64).eps


# --- spectral divide and conquer of a symmetric matrix

def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a symmetric matrix, by dynamically weighted Halley steps."""
    n = len(a)
    x = a / np.linalg.norm(a)
    try:  # a lower bound of the least singular value
        low = 1 / (np.linalg.norm(np.linalg.inv(x), 1) * math.sqrt(n))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS / n), 1.0)
    for _ in range(40):
        d = (4 * (1 - low ** 2) / low ** 4) ** (1 / 3)
        root = math.sqrt(1 + d)
        u = root + 0.5 * math.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low ** 2) / (low ** 2 * root)))
        v = (u - 1) ** 2 / 4
        w = u + v - 1
        q, _ = np.linalg.qr(np.vstack([math.sqrt(w) * x, np.eye(n)]))
        after = v / w * x + (u - v / w) / math.sqrt(w) * (q[:n] @ q[n:].T)
        after = (after + after.T) / 2
        step, x = np.linalg.norm(after - x), after
        low = min(1.0, low * (u + v * low ** 2) / (1 + w * low ** 2))
        if step <= math.sqrt(n) * 1e-13 and 1 - low <= 1e-14:
            break
    return x


def _shifts(a: np.ndarray):
    """Places to split: between the diagonal's ends, so that both parts hold something."""
    diagonal = np.sort(np.diag(a))
    spread = max(diagonal[-1] - diagonal[0], np.linalg.norm(a - np.diag(np.diag(a))) / len(a))
    yield np.median(diagonal)
    yield diagonal.mean()
    gap = int(np.argmax(np.diff(diagonal)))
    yield (diagonal[gap] + diagonal[gap + 1]) / 2
    for t in range(1, 9):
        yield diagonal.mean() + spread * (0.37 * t % 1 - 0.5)


def _split(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the invariant subspaces above and below a shift."""
    n, rng = len(a), np.random.default_rng(7)
    for shift in _shifts(a):
        moved = a - shift * np.eye(n)
        if not np.linalg.norm(moved):
            continue
        projector = (polar_factor(moved) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        basis = np.linalg.qr(projector @ rng.standard_normal((n, k)))[0]
        basis = np.linalg.qr(projector @ basis, mode="complete")[0]  # a second step cleans the range
        above, below = basis[:, :k], basis[:, k:]
        if np.linalg.norm(below.T @ a @ above) <= 100 * n * EPS * size:
            return above, below
    raise ArithmeticError("no shift splits the matrix")


def eigenvectors(a: np.ndarray, want: int) -> np.ndarray:
    """Unit eigenvectors (columns) of the ``want`` largest eigenvalues of a symmetric matrix, largest first.

    Parts below a shift are split only while components are still wanted.  A part whose
    eigenvalues agree to rounding is its own basis.
    """
    size = np.linalg.norm(a)
    found: list[np.ndarray] = []
    todo = [np.eye(len(a))]
    while todo and sum(b.shape[1] for b in found) < want:
        basis = todo.pop()
        inner = basis.T @ a @ basis
        inner = (inner + inner.T) / 2
        n = len(inner)
        if n == 1 or np.linalg.norm(inner - np.trace(inner) / n * np.eye(n)) <= 4 * n * EPS * size:
            found.append(basis)
            continue
        above, below = _split(inner, size)
        todo += [basis @ below, basis @ above]  # the upper part is next
    vectors = np.hstack(found)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    return vectors[:, np.argsort(-values, kind="stable")[:want]]


class Whitening:
    """Centre and scaled components for the vectors of one length (fixed size: no row in it)."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, want: int):
        self.n, self.sums = n, sums
        self.base, self.rest = centre(n, sums)
        trace = float(np.trace(covariance))
        vectors = eigenvectors(covariance, want) if trace > 0 else np.zeros((len(sums), 0))
        values = np.einsum("ij,ij->j", vectors, covariance @ vectors)
        real = values > len(sums) * EPS * values.max(initial=0.0)  # beyond the rank there is nothing to scale
        vectors, values = vectors[:, real], values[real]
        top = np.abs(vectors).argmax(axis=0) if vectors.size else np.zeros(0, np.int64)
        vectors = vectors * np.where(vectors[top, np.arange(len(top))] < 0, -1.0, 1.0)
        self.explained = values / trace if trace > 0 else values
        self.weights = vectors / np.sqrt(values)

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.base, self.rest) @ self.weights

    def deviations(self, x: np.ndarray) -> list[int] | np.ndarray:
        """Sum over dimensions of (n x - S)^2, exact at any size."""
        far = max((max(abs(self.n * int(v) - s) for v in pair) for pair, s in
                   zip(zip(x.min(axis=0), x.max(axis=0)), self.sums)), default=0) if len(x) else 0
        if far ** 2 * max(1, len(self.sums)) < 1 << 62:
            return ((self.n * x - np.array(self.sums, np.int64)) ** 2).sum(axis=1)
        return [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]


def centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The mean as a whole number and a rest within one half, so that centring loses no digits."""
    base = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(base, np.int64), np.array([(s - b * n) / n for s, b in zip(sums, base)], np.float64)


def centred(x: np.ndarray, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - base).astype(np.float64) - rest


# --- over the cluster

def whole_numbers(vector: Column) -> Column:
    """The vector's entries as longs; null if the vector or an entry is null or not finite."""
    sound = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(sound, F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + SHIFT))


def _by_length(batch, column="x"):
    """(row positions, matrix) for each length of the vectors in an Arrow batch."""
    lists = batch.column(column)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == size)
        yield at, size, flat[starts[at][:, None] + np.arange(size)[None, :]]


def _products(of):
    """Per partition and vector length, a row of the sum of outer products of ``of(size, x)`` (a closure of tasks)."""
    def run(batches):
        import pyarrow as pa

        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, size, x in _by_length(batch):
                c = of(size, x)
                total[size] = total.get(size, 0.0) + c.T @ c
        for size, matrix in total.items():
            if len(matrix):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * len(matrix), pa.int32()), pa.array(range(len(matrix)), pa.int32()),
                     pa.array(list(matrix), pa.list_(pa.float64()))], names=["size", "row", "sums"])
    return run


def _added(batches):
    import pyarrow as pa

    total: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        sums = batch.column("sums")
        for i, key in enumerate(zip(batch.column("size").to_pylist(), batch.column("row").to_pylist())):
            row = sums[i].values.to_numpy()
            total[key] = total[key] + row if key in total else row.copy()
    if total:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
             pa.array(list(total.values()), pa.list_(pa.float64()))], names=["size", "row", "sums"])


PRODUCT_ROWS = "size int, row int, sums array<double>"


def _summed(fit: DataFrame, of) -> dict[int, np.ndarray]:
    """Sum over all rows of the outer products, by vector length: rows of partial sums meet by their number."""
    rows = fit.mapInArrow(_products(of), PRODUCT_ROWS).repartition("size", "row").mapInArrow(_added, PRODUCT_ROWS)
    found: dict[int, dict[int, list[float]]] = {}
    for r in rows.collect():  # at most a matrix of the vectors' length
        found.setdefault(r["size"], {})[r["row"]] = r["sums"]
    return {size: np.array([m[i] for i in range(len(m))]) for size, m in found.items()}


def fitted(vectors: DataFrame, want: int = COMPONENTS) -> dict[int, Whitening]:
    """A fit for each length among the distinct vectors ``x`` (array of long)."""
    moments: dict[int, dict[int, tuple[int, int]]] = {}
    sums = vectors.select(F.size("x").alias("size"), F.posexplode("x").alias("at", "v")).groupBy("size", "at").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    for r in sums.collect():  # a row per dimension
        moments.setdefault(r["size"], {})[r["at"]] = (r["n"], int(r["s"]))
    if not moments:
        return {}
    means = {size: (m[0][0], [m[i][1] for i in range(size)]) for size, m in moments.items()}
    centres = {size: centre(n, s) for size, (n, s) in means.items()}
    products = _summed(vectors, lambda size, x: centred(x, *centres[size]))
    return {size: Whitening(n, s, products[size] / n, want) for size, (n, s) in means.items()}


COLUMNS = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def _project(fits, error):
    def run(batches):
        from decimal import Decimal

        import pyarrow as pa

        kind = pa.decimal128(38, 0)
        for whole in batches:
            for at0 in range(0, whole.num_rows, 4096):
                batch = whole.slice(at0, 4096)
                for at, size, x in _by_length(batch):
                    fit = fits.get(size)
                    if fit is None or not len(fit.explained):
                        continue
                    k = len(fit.explained)
                    far = fit.deviations(x)
                    far = pa.array(far, pa.int64()).cast(kind) if isinstance(far, np.ndarray) else pa.array(list(map(Decimal, far)), kind)
                    each = pa.array(np.repeat(np.arange(len(at)), k))
                    rows = len(at) * k
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(np.repeat(at, k))),
                         pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()), pa.array(np.full(rows, fit.n), pa.int64()),
                         far.take(each), pa.array(fit.project(x).reshape(-1), pa.float64()),
                         pa.array(np.tile(fit.explained, len(at)), pa.float64()), pa.array(np.full(rows, error), pa.float64())],
                        names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", want: int = COMPONENTS) -> DataFrame:
    """Per row and component up to ``want``: the whitened projection with the fit's figures.

    Columns: the id, ``component`` (1 is the largest), ``n`` (distinct vectors), ``deviation``
    (decimal: sum over dimensions of (n x - S)^2), ``whitened``, ``explained``, ``identity_error``
    (largest absolute entry of the whitened covariance less the identity, over all fits).

    Rows whose vector is null or has a null or non-finite entry are left out; null ids stay.
    The fit counts each distinct vector once, whatever share of the rows holds it: copies are
    combined before they move.  Vectors of different lengths are different spaces with a fit
    each; empty vectors have no component.  Components beyond the covariance's rank don't
    exist, so one vector alone gives no rows; nor does an empty table.  Equal eigenvalues give
    some orthonormal basis of their space.  Other columns are not read.

    The driver holds a matrix of the vectors' length squared, tasks the same and a slice of rows.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), whole_numbers(F.col(f"`{vector_col}`")).alias("x")).where(F.size("x") > 0)
    fit = staged(rows.select("x").distinct(), "whitening-fit")
    fits = fitted(fit, want)
    left = _summed(fit, lambda size, x: fits[size].project(x))
    error = max((float(np.abs(p / fits[size].n - np.eye(len(p))).max()) for size, p in left.items()), default=0.0)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_project(fits, error), f"id {kind}, {COLUMNS}").withColumnRenamed("id", id_col)
