"""Whitening of vectors on the principal components of their covariance.

Vectors are put on a grid of whole numbers, so sums are exact.  The covariance of the distinct vectors is one scan of
partial products; its eigenvectors come from spectral divide and conquer: the polar factor of the shifted matrix (QDWH
iterations) gives the projector on the eigenvectors above the shift, whose range and complement are split again until every
part is one component.  Components, means and scales (``width * components`` doubles) are broadcast.

Rows: a null vector, or one that holds a null or an entry that is not finite, is left out; so is a vector of another
width than the commonest (of several: the greatest).  Entries are held within ±2^60 on the grid.  Null ids and repeated
rows stay as they are.  A component without variance has null coordinates and does not count for the identity error.  A
deviation beyond a long is null.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.gram import batch_matrix, covariance
from ..session import materialize

EPS = np.finfo(np.float64).eps
GRID, ZERO, FAR = 64, 1_000_000, 1 << 60


# ---------------------------------------------------------------- spectral divide and conquer

def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by dynamically weighted Halley steps: with a stack's QR
    while the weights are large, by a Cholesky factor after that."""
    m = len(a)
    eye = np.eye(m)
    scale = np.linalg.norm(a)
    if scale == 0:
        return np.zeros_like(a)
    x = a / scale
    try:
        low = 1.0 / np.linalg.norm(np.linalg.inv(x))
    except np.linalg.LinAlgError:
        low = EPS
    low = float(np.clip(low if np.isfinite(low) else EPS, EPS, 1.0))
    for _ in range(30):
        l2 = low * low
        d = np.cbrt(4 * (1 - l2) / (l2 * l2)) if l2 < 1 else 0.0
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - l2) / (l2 * root)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            low_tri = np.linalg.cholesky(eye + wc * (x.T @ x))
            y = np.linalg.solve(low_tri.T, np.linalg.solve(low_tri, x.T)).T
            new = wb / wc * x + (wa - wb / wc) * y
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (wa + wb * l2) / (1 + wc * l2))
        if abs(1 - low) < 10 * EPS and moved < (4 * EPS) ** (1 / 3):
            break
    return 1.5 * x - 0.5 * (x @ x @ x)


def _halves(a: np.ndarray, shift: float, rng: np.random.Generator) -> tuple[np.ndarray, int] | None:
    """Orthogonal basis whose first ``k`` columns span the eigenvectors above ``shift``; None if the shift does not
    part the spectrum well."""
    m = len(a)
    p = (np.eye(m) + polar_factor(a - shift * np.eye(m))) / 2
    k = int(round(float(np.trace(p))))
    if not 0 < k < m or np.linalg.norm(p @ p - p) > 1e-9 * m:
        return None
    basis = rng.standard_normal((m, m))
    for _ in range(2):          # range of the projector and of its complement
        basis = np.hstack([np.linalg.qr(p @ basis[:, :k])[0], np.linalg.qr(basis[:, k:] - p @ basis[:, k:])[0]])
    return np.linalg.qr(basis)[0], k


def components_of(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order and unit eigenvectors (columns; the entry of the largest size is positive)."""
    d = len(v)
    size = np.linalg.norm(v)
    q_all = np.eye(d)
    rng = np.random.default_rng(0)
    todo = [(0, d)]
    while todo:
        at, to = todo.pop()
        m = to - at
        q = q_all[:, at:to]
        a = q.T @ v @ q
        a = (a + a.T) / 2
        off = np.linalg.norm(a - np.diag(np.diag(a)))
        if m == 1 or off <= EPS * size:         # nothing is left to turn
            continue
        mean, spread = float(np.trace(a)) / m, np.linalg.norm(a - np.eye(m) * np.trace(a) / m) / np.sqrt(m)
        median = float(np.median(np.diag(a)))
        for shift in (median, mean, *[mean + f * spread for f in (0.11, -0.13, 0.29, -0.31, 0.53, -0.57)]):
            half = _halves(a, shift, rng)
            if half is not None and np.linalg.norm(half[0][:, : half[1]].T @ a @ half[0][:, half[1]:]) <= 64 * m * EPS * size:
                break
        else:
            raise ArithmeticError("no shift parts the spectrum")
        q_all[:, at:to] = q @ half[0]
        todo += [(at, at + half[1]), (at + half[1], to)]
    e = np.einsum("ij,ij->j", q_all, v @ q_all)
    order = np.argsort(-e, kind="stable")
    q_all = q_all[:, order]
    return e[order], q_all * np.sign(q_all[np.abs(q_all).argmax(axis=0), np.arange(d)])


# ---------------------------------------------------------------- the fit

@dataclass
class Whitening:
    """``sums`` and ``n`` of the distinct grid vectors, all ``values`` of the covariance, and the kept ``vectors`` (columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float = 0.0

    @property
    def scales(self) -> np.ndarray:
        """Divisors of the coordinates; 0 where a component has no variance."""
        e = self.values[: self.vectors.shape[1]]
        return np.where(e > len(self.values) * EPS * max(self.values.max(initial=0.0), 0.0), np.sqrt(np.maximum(e, 0.0)), 0.0)

    @property
    def explained(self) -> np.ndarray:
        total = float(self.values.sum())
        return np.maximum(self.values[: self.vectors.shape[1]], 0.0) / total if total > 0 else np.zeros(self.vectors.shape[1])

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Grid vectors less the nearest whole mean, the exact rest ``n * mean - sums``, and vectors less the mean."""
        whole = [round_half(s, self.n) for s in self.sums]
        rest = np.array([self.n * c - s for c, s in zip(whole, self.sums)], dtype=np.int64)
        y = x - np.array(whole, dtype=np.int64)
        return y, rest, y + rest / self.n

    def coordinates(self, x: np.ndarray) -> np.ndarray:
        scales = self.scales
        return np.divide(self.centred(x)[2] @ self.vectors, scales, out=np.full((len(x), len(scales)), np.nan), where=scales > 0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of ``(n x - sums)^2``, exact."""
        y, rest, _ = self.centred(x)
        far = self.n * (float(np.abs(y).max(initial=0)) + 1.0)
        if far * far * max(1, x.shape[1]) < 2.0**62:
            return ((self.n * y + rest) ** 2).sum(axis=1).tolist()
        full = ((self.n * y.astype(object) + rest.astype(object)) ** 2).sum(axis=1)
        return [int(d) if d < 2**63 else None for d in full]


def round_half(s: int, n: int) -> int:
    return (2 * s + n) // (2 * n)


def grid(vec: str = "embedding") -> Column:
    """The vector on the grid: ``floor(64 c) + 1000000``."""
    far = F.lit(FAR).cast("long")
    return F.transform(F.col(vec), lambda c: F.greatest(F.least(F.floor(c.cast("double") * GRID).cast("long"), far), -far) + ZERO)


def _whole(vec: str) -> Column:
    finite = F.forall(F.col(vec), lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    return F.col(vec).isNotNull() & finite


def grid_rows(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding") -> tuple[DataFrame, int]:
    """``(vec_id, x)`` of the rows that can be whitened, and their width."""
    rows = df.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec}`").alias("v")).where(_whole("v"))
    widths = rows.groupBy(F.size("v").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("w")).limit(1).collect()
    width = widths[0]["w"] if widths else 0
    return rows.where(F.size("v") == width).select("vec_id", grid("v").alias("x")), width


def _longs(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def exact_sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension: per task in two halves of 32 bits, which Spark adds as decimals."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for b in batches:
            x = _longs(b.column(0), width)
            n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([high.tolist()], pa.list_(pa.int64())), pa.array([low.tolist()], pa.list_(pa.int64()))], ["n", "high", "low"])

    parts = vectors.mapInArrow(run, "n long, high array<long>, low array<long>")
    cells = parts.select("n", F.posexplode(F.arrays_zip("high", "low")).alias("i", "s"))
    add = lambda c: F.sum(c.cast("decimal(20,0)"))
    got = {r["i"]: r for r in cells.groupBy("i").agg(add(F.col("n")).alias("n"), add(F.col("s.high")).alias("high"), add(F.col("s.low")).alias("low")).collect()}
    return (int(got[0]["n"]) if got else 0), [int(got[i]["high"]) * 2**32 + int(got[i]["low"]) for i in range(width)] if got else [0] * width


def fit(rows: DataFrame, width: int, components: int = 16) -> Whitening | None:
    """Whitening of the distinct grid vectors ``x``; None without rows.  The driver holds the covariance (``width`` squared doubles)."""
    vectors = materialize(rows.select("x").distinct(), "grid-vectors")
    n, sums = exact_sums(vectors, width) if width else (0, [])
    if n == 0:
        return None
    _, _, v = covariance(vectors, "x", width)
    values, basis = components_of(v)
    model = Whitening(n, sums, values, basis[:, :components])
    use = np.flatnonzero(model.scales > 0)
    if len(use):
        shared = vectors.sparkSession.sparkContext.broadcast(model)

        def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                w = shared.value.coordinates(_longs(b.column(0), width))[:, use]
                yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(w.ravel()), len(use)).cast(pa.list_(pa.float64()))], ["w"])

        _, _, c = covariance(vectors.mapInArrow(project, "w array<double>"), "w", len(use))
        model.identity_error = float(np.abs(c - np.eye(len(use))).max())
    return model


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", components: int = 16) -> DataFrame:
    """One row for each remaining row and component, numbered from 1 by falling eigenvalue: ``vec_id``, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    rows, width = grid_rows(df, id_col, vec)
    model = fit(rows, width, components)
    spark = df.sparkSession
    if model is None:
        return spark.createDataFrame([], SCHEMA)
    shared = spark.sparkContext.broadcast(model)
    k = model.vectors.shape[1]
    names = [f.split()[0] for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            x = _longs(b.column(1), width)
            each = pa.array(np.repeat(np.arange(len(x)), k))
            w = m.coordinates(x).ravel()
            size = len(x) * k
            yield pa.RecordBatch.from_arrays([
                b.column(0).cast(pa.int64()).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(size, m.n, dtype=np.int64)),
                pa.array(m.deviations(x), pa.int64()).take(each), pa.array(w, mask=np.isnan(w)), pa.array(np.tile(m.explained, len(x))), pa.array(np.full(size, m.identity_error))], names)

    return rows.mapInArrow(run, SCHEMA)
