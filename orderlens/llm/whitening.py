"""Whitening of embeddings by FEAST.

Spark gathers the covariance of the distinct vectors (centred before multiplying, one d x d
partial a task, summed by entry), so only d*d numbers reach the driver, whatever the rows.
FEAST then finds the eigenpairs of the wanted interval at the upper end of the spectrum:

* Inertia: a symmetric factorisation of V - s I, from its tridiagonal form, counts the
  eigenvalues above s (Sylvester).  Bisection with these counts finds an interval that holds the wanted eigenvalues.
* Contour: the spectral projector of the interval is the integral of (z I - V)^-1 around
  it.  Gauss-Legendre quadrature turns it into a few complex shifted solves of a block.
* Rayleigh-Ritz on the projected block gives eigenpairs; these steps are repeated until the
  residuals are at the level of rounding.
* The number of pairs found inside must equal the inertia count; if one is missing, the
  block grows and the steps start again.

Defined results.  ``x = floor(scale * c)`` as long.  Rows whose vector is NULL or has NULL or
non-finite entries are left out; rows with a NULL id stay.  Vectors of unequal length count
as ending in zeros.  Directions without variance (below ``d * 2**-50`` of the largest) are no
components, so fewer than ``k`` rows a vector come back where the rank is smaller, and none
for an empty table or one distinct vector.  Equal eigenvalues: any orthonormal basis.  Equal
rows give equal results.  ``deviation`` is NULL where it exceeds a long.  Other columns are
passed on; those named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import adding, free_name, without, written

LONG = np.iinfo(np.int64)


# --- eigenpairs of a small symmetric matrix ---------------------------------------------------


def tridiagonal(v: np.ndarray) -> tuple[list[float], list[float]]:
    """Diagonal and squared neighbours of a tridiagonal matrix with the eigenvalues of ``v`` (Householder reflections)."""
    a = np.array(v, dtype=np.float64)
    for j in range(len(a) - 2):
        below = a[j + 1:, j].copy()
        length = np.linalg.norm(below)
        if np.linalg.norm(below[1:]) == 0:
            continue
        edge = -np.copysign(length, below[0])
        below[0] -= edge
        below /= np.linalg.norm(below)
        rest = a[j + 1:, j + 1:]
        p = rest @ below
        p -= (below @ p) * below
        rest -= 2 * (np.outer(p, below) + np.outer(below, p))
        a[j + 1:, j] = a[j, j + 1:] = 0
        a[j + 1, j] = a[j, j + 1] = edge
    return np.diag(a).tolist(), (np.diag(a, 1) ** 2).tolist()


class Inertia:
    """Counts eigenvalues above a shift: the signs of the pivots of L D L' of the shifted tridiagonal form (Sylvester)."""

    def __init__(self, v: np.ndarray):
        self.diagonal, self.squares = tridiagonal(v)
        self.tiny = np.finfo(float).eps ** 2 * max(np.abs(v).max(initial=0.0), np.finfo(float).tiny * 1e40)

    def above(self, shift: float) -> int:
        count, pivot = 0, 1.0
        for d, square in zip(self.diagonal, [0.0, *self.squares]):
            pivot = d - shift - square / pivot
            if abs(pivot) < self.tiny:  # a shift that is an eigenvalue counts it as not above
                pivot = -self.tiny
            count += pivot > 0
        return count


@dataclass
class Found:
    values: np.ndarray  #: falling
    vectors: np.ndarray  #: columns
    low: float  #: of the interval searched
    high: float
    inside: int  #: eigenvalues in it by inertia
    rounds: int


def narrowed(test, low: float, high: float, width) -> tuple[float, float]:
    """Bisection: ``test`` fails at ``low`` and holds at ``high``; both ends move together until ``width(low, high)``."""
    while high - low > width(low, high):
        middle = (low + high) / 2
        if not low < middle < high:
            break
        low, high = (low, middle) if test(middle) else (middle, high)
    return low, high


def interval(v: np.ndarray, k: int) -> tuple[float, float, int]:
    """(low, high, count): bounds between which at least ``k`` eigenvalues lie, and as few others as gaps permit.

    Gershgorin's circles bound the spectrum.  Where the k-th eigenvalue and the next are equal
    in working precision, all equal ones are taken in.  The lower end lies in the middle of the
    gap below, the upper end a little above the largest value.
    """
    above = Inertia(v).above
    reach = np.abs(v).sum(axis=1).max() * (1 + 1e-9)
    tiny = 4e-15 * reach
    many, _ = narrowed(lambda x: above(x) < k, -reach, reach, lambda low, high: tiny)
    many -= 2 * tiny
    count = above(many)
    least, _ = narrowed(lambda x: above(x) < count, many, reach, lambda low, high: max(tiny, 0.01 * (high - many)))
    if count == len(v):
        low = least - 0.1 * reach
    else:
        _, top = narrowed(lambda x: above(x) == count, -reach, many, lambda low, high: max(tiny, 0.02 * (least - low)))
        low = (least + top) / 2
    _, high = narrowed(lambda x: above(x) == 0, low, reach, lambda low_, high: max(tiny, 0.02 * (high - low)))
    return low, high + max(0.05 * (high - low), tiny), count


def project(v: np.ndarray, block: np.ndarray, low: float, high: float, nodes: int) -> np.ndarray:
    """The block times the quadrature of the resolvent on a circle through ``low`` and ``high``.

    Nodes and their conjugates contribute conjugate values: half of them are solved.
    """
    x, w = np.polynomial.legendre.leggauss(nodes)
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for t, weight in zip(x, w):
        z = radius * np.exp(1j * np.pi * (1 - t) / 2)
        out += weight / 2 * np.real(z * np.linalg.solve((middle + z) * np.eye(len(v)) - v, block))
    return out


def feast(v: np.ndarray, k: int, nodes: int = 8, rounds: int = 40) -> Found:
    """The ``k`` largest eigenvalues and their unit vectors, and others that the interval holds besides."""
    v = (v + v.T) / 2
    size = len(v)
    scale = np.abs(v).max()
    if scale == 0:
        return Found(np.zeros(k), np.eye(size)[:, :k], 0.0, 0.0, size, 0)
    unit = v / scale
    low, high, inside = interval(unit, min(k, size))
    width = min(size, max(2 * inside, inside + 8))
    while True:
        block = np.linalg.qr(np.random.default_rng(7).standard_normal((size, width)))[0]
        last = np.inf
        for done in range(1, rounds + 1):
            block = np.linalg.qr(project(unit, block, low, high, nodes))[0]
            small = block.T @ unit @ block
            values, turned = np.linalg.eigh((small + small.T) / 2)
            block = block @ turned
            kept = (values > low) & (values < high)
            error = np.linalg.norm(unit @ block[:, kept] - block[:, kept] * values[kept], axis=0).max(initial=0.0)
            if int(kept.sum()) == inside and (error < 4e-16 * size or (error < 1e-13 * size and error > last / 2)):
                order = np.argsort(-values[kept], kind="stable")
                return Found(values[kept][order] * scale, block[:, kept][:, order], low * scale, high * scale, inside, done)
            last = error
        if width == size:
            raise ArithmeticError(f"{inside} eigenvalues lie in ({low * scale}, {high * scale}), not all were found")
        width = min(size, 2 * width)


# --- rows -------------------------------------------------------------------------------------


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Lists of longs as rows of one array, zeros behind short ones."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths == size).all():
        return flat.reshape(-1, size)
    out = np.zeros((len(lengths), size), np.int64)
    out[np.arange(size) < lengths[:, None]] = flat
    return out


def usable(vector_col: str):
    """Whether a vector is there and all its entries are finite numbers."""
    good = F.forall(vector_col, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    return F.coalesce(F.col(vector_col).isNotNull() & good, F.lit(False))


def integers(vector_col: str, scale: int):
    return F.transform(vector_col, lambda e: F.floor(e.cast("double") * F.lit(float(scale))).cast("long"))


def _summed(parts: DataFrame, keys: list[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(F.sum("v").alias("v"))


@dataclass
class Model:
    size: int  #: dimensions
    n: int  #: distinct vectors
    sums: list[int]
    components: np.ndarray  #: d x k
    values: np.ndarray  #: of the k components
    trace: float
    identity_error: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums)


def _exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - S: in 64-bit integers where they hold it, else in Python's."""
    most = max((abs(int(f)) for f in (x.max(initial=0), x.min(initial=0))), default=0) * n + max(map(abs, sums), default=0)
    if most > LONG.max:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * np.int64(n) - np.array(sums, dtype=np.int64)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _exact(x, n, sums).astype(np.float64) / n


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n*x - S)^2; None beyond a long."""
    y = _exact(x, n, sums)
    if y.dtype != object and int(np.abs(y).max(initial=0)) ** 2 * max(1, y.shape[1]) <= LONG.max:
        return (y * y).sum(axis=1).tolist()
    exact = [sum(int(e) ** 2 for e in row) for row in y]
    return [e if e <= LONG.max else None for e in exact]


def _square(fit: DataFrame, size: int, n: int, sums: list[int], turn: np.ndarray | None) -> np.ndarray:
    """Covariance over the fit list of the centred vectors, or of what ``turn`` makes of them."""
    width = size if turn is None else turn.shape[1]

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            y = _centred(matrix(batch.column(0), size), n, sums)
            y = y if turn is None else y @ turn
            total += y.T @ y
        at = np.indices(total.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(total.ravel())], ["i", "j", "v"])

    out = np.zeros((width, width))
    for r in _summed(fit.mapInArrow(run, "i int, j int, v double"), ["i", "j"]).collect():  # width * width rows
        out[r.i, r.j] = r.v / n
    return out


def fit(vectors: DataFrame, vector_col: str = "embedding", k: int = 4, scale: int = 256) -> Model:
    """The mean and whitening components of the distinct vectors of ``x``."""
    x = vectors.filter(usable(vector_col)).select(integers(vector_col, scale).alias("x"))
    distinct = written(x.distinct(), "whitening-fit")  # equal vectors meet in the partial aggregate already
    shape = distinct.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("size")).first()
    n, size = shape["n"], shape["size"] or 0
    empty = Model(size, n, [0] * size, np.zeros((size, 0)), np.zeros(0), 0.0, 0.0)
    if not n or not size:
        return empty
    sums = [0] * size
    at = distinct.select(F.posexplode("x").alias("i", "v")).withColumn("v", F.col("v").cast("decimal(38,0)"))
    for r in _summed(at, ["i"]).collect():  # a row for each dimension
        sums[r.i] = int(r.v)
    v = _square(distinct, size, n, sums, None)
    trace = float(np.trace(v))
    found = feast(v, min(k, size))
    wanted = [j for j in range(min(k, size)) if found.values[j] > size * 2.0**-50 * found.values[0]] if trace > 0 else []
    values, vectors_ = found.values[wanted], found.vectors[:, wanted]
    if not wanted:
        return Model(size, n, sums, np.zeros((size, 0)), np.zeros(0), trace, 0.0)
    vectors_ = vectors_ * np.sign(vectors_[np.abs(vectors_).argmax(axis=0), range(len(wanted))])  # the largest entry is positive
    seen = _square(distinct, size, n, sums, vectors_ / np.sqrt(values))
    return Model(size, n, sums, vectors_, values, trace, float(np.abs(seen - np.eye(len(wanted))).max()))


FIELDS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, model: Model, vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """A row for each usable vector and component; the vector itself is not returned."""
    names = [f.split()[0] for f in FIELDS.split(", ")]
    vectors = vectors.filter(usable(vector_col))
    x = free_name(vectors, "x")
    df = vectors.withColumn(x, integers(vector_col, scale))
    rest = without(vectors, [*names, vector_col])
    df = df.select(*[F.col(f"`{c}`") for c in rest.columns], x)
    k = len(model.values)
    turn = model.components / np.sqrt(model.values)

    def run(batches):
        for batch in batches:
            if not k:
                continue
            m = batch.num_rows
            rows = matrix(batch.column(x), model.size)
            white = model.centred(rows) @ turn
            each = batch.drop_columns([x]).take(pa.array(np.repeat(np.arange(m), k)))
            more = {
                "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                "n": pa.array(np.full(m * k, model.n, np.int64)),
                "deviation": pa.array([d for d in deviations(rows, model.n, model.sums) for _ in range(k)], pa.int64()),
                "whitened": pa.array(white.ravel()),
                "explained": pa.array(np.tile(model.values / model.trace, m)),
                "identity_error": pa.array(np.full(m * k, model.identity_error)),
            }
            for name, column in more.items():
                each = each.append_column(name, column)
            yield each

    return df.mapInArrow(run, adding(rest, FIELDS))
