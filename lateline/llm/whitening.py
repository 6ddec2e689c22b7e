"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Entries become integers, so means and deviations are exact.  With X the rows
minus their mean, the bidiagonalisation alternates u = Xv and v = X'u; every u
is kept as the combination u = Xp of X's columns, so a row's entry of any u is
computed where the row lies and no table of n rows is written for a step.  One
pass over the rows gives Xv against all earlier u (full reorthogonalisation)
and X'(Xv); v is reorthogonalised against all earlier v where it is, since it
has one entry per dimension.  The small bidiagonal matrix's SVD yields the
components and their variances.

What reaches the driver is a few numbers per dimension, whatever the number of
rows and tasks; every pass re-reads a staged table.

Odd rows: a vector that is null or holds a null or non-finite entry is left
out; a shorter vector counts as filled with zeros; entries count as at most
2^40 / 64 in size; an id may be null or repeated, its rows are separate.  A
table without remaining vectors, or without variance, has no components and
gives no rows; a component whose variance is below 1e-11 of the largest is
none.  A deviation beyond a long's range is null.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lateline.llm.common import Stage

#: Fixed values of the contract.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 32

_MOST = float(1 << 40)
#: Least variance of a component, against the largest.
_LEAST = 1e-11


# -- arrays in tasks ---------------------------------------------------------------

def scaled(vectors: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Which vectors remain, and floor(64 c) of each vector's entries as bytes."""
    at = vectors.offsets.to_numpy().astype(np.int64)
    values = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    keep = (bad[at[1:]] == bad[at[:-1]]) & vectors.is_valid().to_numpy(zero_copy_only=False)
    y = np.floor(np.clip(np.nan_to_num(values * SCALE, nan=0.0, posinf=0.0, neginf=0.0), -_MOST, _MOST)).astype(np.int64)
    raw = pa.Array.from_buffers(pa.binary(), len(vectors), [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(y)])
    return keep, raw


def matrix(raw: pa.Array, dim: int) -> np.ndarray:
    """The integer rows of a batch, short ones filled with zeros."""
    at = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1]
    data = raw.buffers()[2]
    flat = np.frombuffer(data, np.int64, (at[-1] - at[0]) // 8, at[0]) if data is not None and len(raw) else np.zeros(0, np.int64)
    sizes = np.diff(at) // 8
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(raw), dim), np.int64)
    out[np.repeat(np.arange(len(raw)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Centre:
    """Exact mean of the integer rows: whole part and remainder over n."""

    def __init__(self, n: int, sums: np.ndarray):
        self.n, self.whole = n, sums // n
        self.rest = sums - n * self.whole

    def rows(self, y: np.ndarray) -> np.ndarray:
        return (y - self.whole) - self.rest / self.n

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        d = y - self.whole
        if float(np.abs(d).max(initial=0) + 1) ** 2 * float(self.n) ** 2 * max(1, y.shape[1]) < 2.0 ** 62:
            return ((d * self.n - self.rest) ** 2).sum(1).tolist()
        d = d.astype(object) * self.n - self.rest.astype(object)
        return [v if v < 1 << 63 else None for v in (d * d).sum(1)]


def _sums(rows: DataFrame, f) -> np.ndarray:
    """Sum over all batches of the vector that ``f`` makes of each: added up in
    the task, then by place; the driver gets one row per place."""

    def run(batches):
        total = None
        for b in batches:
            v = f(b)
            total = v if total is None else total + v
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["i", "v"])

    probe = f(pa.RecordBatch.from_arrays([pa.array([], pa.binary())], names=["y"]))
    kind = "long" if probe.dtype == np.int64 else "double"
    got = rows.select("y").mapInArrow(run, f"i int, v {kind}").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(len(probe), probe.dtype)
    for r in got:
        out[r.i] = r.v
    return out


# -- the bidiagonalisation -----------------------------------------------------------

def bidiagonalise(product, dim: int, wanted: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """Singular values of X and right singular vectors (columns), largest
    first.  ``product(v, P)`` returns X'Xv, (XP)'Xv and |Xv|^2.  Ends when the
    wanted triplets are exact to rounding, after ``dim`` steps at most; where
    the sequence breaks down (repeated values, low rank) a new direction that
    is orthogonal to all before goes on."""
    rng = np.random.default_rng(seed)

    def orthogonal(v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            v = v - V @ (V.T @ v)
        return v

    V, P, Z = (np.zeros((dim, 0)) for _ in range(3))  # v, p with u = Xp, and X'u
    alphas: list[float] = []
    betas: list[float] = []
    v = rng.standard_normal(dim)
    v /= np.linalg.norm(v)
    top = 0.0
    while True:
        g, c, size = product(v, P)
        top = max(top, size)
        left = size - c @ c
        alpha = float(np.sqrt(left)) if left > 1e-24 * top else 0.0
        p, z = ((v - P @ c) / alpha, (g - Z @ c) / alpha) if alpha else (np.zeros(dim), np.zeros(dim))
        V, P, Z = np.column_stack([V, v]), np.column_stack([P, p]), np.column_stack([Z, z])
        alphas.append(alpha)
        k = len(alphas)
        r = orthogonal(z - alpha * v)
        beta = float(np.linalg.norm(r))
        B = np.diag(alphas) + np.diag(betas, 1)
        left_vectors, sigma, right = np.linalg.svd(B)
        if k == dim or (k >= wanted and (beta * np.abs(left_vectors[-1, :wanted]) <= 1e-15 * sigma[0]).all() and beta > 0):
            return sigma, V @ right.T
        if beta <= 1e-13 * np.sqrt(top):
            beta, r = 0.0, orthogonal(rng.standard_normal(dim))
        betas.append(beta)
        v = r / np.linalg.norm(r)


# -- the operator ----------------------------------------------------------------------

class Whitening:
    """A fitted whitening: ``staged`` rows (id, y), their exact ``centre``,
    ``components`` (columns), their variances, and the total variance."""

    def __init__(self, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS):
        src = vectors.select(F.col(vec_id).alias("id"), F.col(vector).alias("v"))
        kind = src.schema["id"].dataType.simpleString()

        def ints(batches):
            for b in batches:
                keep, raw = scaled(b.column(1))
                yield pa.RecordBatch.from_arrays([b.column(0), raw], names=["id", "y"]).filter(pa.array(keep))

        stage = Stage(vectors.sparkSession)
        self.staged = stage.save(src.mapInArrow(ints, f"id {kind}, y binary"), "integers")
        self.kind = kind
        head = self.staged.agg(F.count("*").alias("n"), F.max(F.length("y")).alias("d")).first()
        self.n, self.dim = head.n, (head.d or 0) // 8
        self.components, self.variances, self.total = np.zeros((self.dim, 0)), np.zeros(0), 0.0
        if not self.n or not self.dim:
            return
        dim = self.dim
        sums = _sums(self.staged, lambda b: matrix(b.column(0), dim).sum(0, dtype=np.int64))
        centre = self.centre = Centre(self.n, sums)

        def product(v, P):
            def one(b):
                x = centre.rows(matrix(b.column(0), dim))
                w = x @ v
                return np.concatenate([x.T @ w, (x @ P).T @ w, [w @ w]])

            out = _sums(self.staged, one)
            return out[:dim], out[dim:-1], out[-1]

        # the total variance, from the exact centred rows
        self.total = float(_sums(self.staged, lambda b: np.array([(centre.rows(matrix(b.column(0), dim)) ** 2).sum()]))[0]) / self.n
        if self.total == 0.0:
            return
        sigma, right = bidiagonalise(product, dim, min(wanted, dim))
        e = sigma ** 2 / self.n
        m = min(wanted, int((e > _LEAST * e[0]).sum()))
        self.components, self.variances = right[:, :m], e[:m]

    def identity_error(self) -> float:
        """Largest absolute entry of the whitened rows' covariance, centred
        once more before multiplying, minus the identity."""
        centre, dim, m, n = self.centre, self.dim, len(self.variances), self.n
        w = self.components / np.sqrt(self.variances)
        mean = _sums(self.staged, lambda b: (centre.rows(matrix(b.column(0), dim)) @ w).sum(0)) / n

        def cov(b):
            x = centre.rows(matrix(b.column(0), dim)) @ w - mean
            return (x.T @ x).ravel()

        return float(np.abs(_sums(self.staged, cov).reshape(m, m) / n - np.eye(m)).max())

    def transform(self) -> DataFrame:
        """``id, deviation, whitened`` (an array, one entry per component) of every remaining row."""
        centre, dim = getattr(self, "centre", None), self.dim
        w = self.components / np.sqrt(self.variances)
        m = w.shape[1]

        def run(batches):
            for b in batches:
                y = matrix(b.column(1), dim)
                out = centre.rows(y) @ w
                ends = pa.array(np.arange(len(y) + 1) * m, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(centre.deviations(y), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))],
                    names=["id", "deviation", "whitened"])

        rows = self.staged if m else self.staged.limit(0)
        return rows.mapInArrow(run, f"id {self.kind}, deviation long, whitened array<double>")


def whitened_rows(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", wanted: int = COMPONENTS) -> DataFrame:
    """One row per remaining vector and component: ``vec_id, component, n,
    deviation, whitened, explained, identity_error``."""
    fit = Whitening(vectors, vec_id, vector, wanted)
    shares = (fit.variances / fit.total).tolist() if len(fit.variances) else []
    error = fit.identity_error() if shares else 0.0
    long = fit.transform().select("id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    share = F.element_at(F.array(*[F.lit(s) for s in shares]) if shares else F.array(F.lit(0.0)), F.col("i") + 1)
    return long.select(F.col("id").alias("vec_id"), (F.col("i") + 1).alias("component"), F.lit(fit.n).cast("long").alias("n"),
                       "deviation", "whitened", share.alias("explained"), F.lit(error).alias("identity_error"))
